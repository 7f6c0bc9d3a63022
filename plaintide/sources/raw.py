"""Raw layer: JSON lines by process date."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plaintide.schemas import RAW
from plaintide.session import freed_shuffles, parts, store_parts
from plaintide.sources import files

CHUNK_SIZE = 5000
JSON_FILES = "{*.json,*.jsonl,*.json.gz,*.jsonl.gz,part-*.txt,part-*.txt.gz}"
PARTITION = T.StructField("process_date", T.DateType())


def raw_path(root: str, process_date: str) -> str:
    """Folder of one process date."""
    return f"{root.rstrip('/')}/process_date={process_date}"


def to_json_records(df: DataFrame, fields: list[str], name: str = "record") -> DataFrame:
    """Replace the fields by one JSON text column, explicit nulls kept."""
    others = [c for c in df.columns if c not in set(fields)]
    return df.select(*others, F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias(name))


def write_raw(records: DataFrame, root: str, chunk_size: int = CHUNK_SIZE, compression: str = "none") -> None:
    """Write `record` lines below `process_date=…`, at most `chunk_size` records per file.

    A date that is written again replaces all its files. The records are stored compressed first, below `root`, so a broken
    one replaces nothing; then the dates are written a part at a time, so that the disk holds the shuffle of one part. A part
    is rebalanced, which brings a date into few tasks and splits a date that is too large for one. `compression` may be
    gzip, a tenth of the bytes or less: `chunk_size` bounds the files, so none has to be split by a reader.
    """
    spark, staged = records.sparkSession, f"{root.rstrip('/')}/_staged-{uuid.uuid4().hex[:12]}"
    try:
        with freed_shuffles(spark):
            lines = records.select("record", "process_date")
            store_parts(lines, "process_date", staged)
            for part in parts(spark, staged, lines.schema):
                (
                    part.hint("rebalance", "process_date")
                    .write.mode("overwrite")
                    .option("partitionOverwriteMode", "dynamic")
                    .option("maxRecordsPerFile", chunk_size)
                    .option("compression", compression)
                    .partitionBy("process_date")
                    .text(root)
                )
    finally:
        files.delete(spark, staged)


def read_raw_dir(spark: SparkSession, path: str) -> DataFrame:
    """Every JSON-lines file directly under `path`, all fields as text; a broken line fails the read."""
    return spark.read.schema(RAW).option("mode", "FAILFAST").option("pathGlobFilter", JSON_FILES).json(path)


def dated(df: DataFrame, first: str | None, last: str | None) -> DataFrame:
    """Rows of the process dates `first` to `last`; a bound that is None is open."""
    day = F.col("process_date")
    if first is not None:
        df = df.filter(day >= F.lit(first).cast("date"))
    return df if last is None else df.filter(day <= F.lit(last).cast("date"))


def of_days(df: DataFrame, days: Sequence[str]) -> DataFrame:
    """Rows of the given process dates; the scan reads their folders alone."""
    return df.filter(F.col("process_date").isin([date.fromisoformat(d) for d in days]))


def read_raw(spark: SparkSession, root: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Raw records of the process dates `first` to `last`; files of other dates are not read."""
    reader = spark.read.schema(T.StructType([*RAW.fields, PARTITION])).option("mode", "FAILFAST")
    rows = reader.option("pathGlobFilter", JSON_FILES).json(root)
    return dated(rows, first, last)
