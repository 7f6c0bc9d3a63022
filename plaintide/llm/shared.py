"""Folders that all executors see, and totals per key that stay spread when one key is hot."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLICES = 64

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the package to the executors' Python, once per application."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = os.path.join(tempfile.mkdtemp(prefix="llm-"), f"{package.name}.zip")
    with zipfile.ZipFile(archive, "w") as files:
        for path in sorted(package.rglob("*.py")):
            files.write(path, path.relative_to(package.parent))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(application)


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder below ``spark.checkpoint.dir``; only a local master may fall back to a temporary one."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="llm-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to a shared folder and read again, so that lost executors cost no earlier stage."""
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slice_of(*columns: Column | str) -> Column:
    """A slice number that deals the rows of one key over SLICES tasks."""
    return F.pmod(F.xxhash64(*columns), F.lit(SLICES)).cast("int")


def spread_totals(partial: DataFrame, keys: Sequence[str], totals: dict[str, Column]) -> DataFrame:
    """Totals per key, repeated for each (key, slice) that occurs.

    ``partial`` has one row per key and ``slice``, so a key has SLICES rows at most, however many rows stand
    behind it. Joining on (key, slice) afterwards splits a hot key over that many tasks.
    """
    whole = partial.groupBy(*keys).agg(*[c.alias(n) for n, c in totals.items()])
    return partial.select(*keys, "slice").join(whole, list(keys))
