"""Session settings and the folder for intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plaintide.sources import files


def get_session(app_name: str = "plaintide", **conf: str) -> SparkSession:
    """Session with UTC dates and adaptive execution; cluster settings stay with the submitter."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors must share."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def freed_shuffles(spark: SparkSession) -> AbstractContextManager[None]:
    """Writes inside delete their shuffle files when they end, not when the driver next collects garbage.

    A run of several steps then needs the disk of its largest step, not that of all.
    """
    return setting(spark, FREED, "true")


PARTS = 8
ZSTD_LEVEL = 9  # JSON lines take a third less of the disk than at the usual 3
PART = "stored_part"


def part_of(key: Column | str) -> Column:
    """One of PARTS, by a hash of `key`; rows without a key share one."""
    return F.pmod(F.xxhash64(key), F.lit(PARTS))


def store_parts(df: DataFrame, key: str, path: str) -> None:
    """Add rows, compressed, to PARTS folders by a hash of `key`; nothing is shuffled, nor sorted by part."""
    with setting(df.sparkSession, WRITERS, str(PARTS)):
        writer = df.withColumn(PART, part_of(key)).write.mode("append").partitionBy(PART)
        writer.option("parquet.compression.codec.zstd.level", ZSTD_LEVEL).parquet(path, compression="zstd")


def parts(spark: SparkSession, path: str, schema: T.StructType) -> Iterator[DataFrame]:
    """The stored parts that have rows. Each is deleted when the next is taken.

    Written one after another, only one part's shuffle is on the disk at a time.
    """
    for name in files.children(spark, path):
        if name.startswith(f"{PART}="):
            yield spark.read.schema(schema).parquet(f"{path}/{name}")
            files.delete(spark, f"{path}/{name}")
