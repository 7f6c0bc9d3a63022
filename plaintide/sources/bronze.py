"""Bronze layer: typed Parquet by process date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from plaintide.schemas import BRONZE
from plaintide.sources.raw import PARTITION, dated


def write_bronze(df: DataFrame, root: str) -> None:
    """Write normalised rows and their `process_date`; a date that is written again is replaced whole.

    There is no shuffle: rows read from the raw layer come date by date, so a task meets few dates and a
    date gets at most one file per raw split, as one file per raw file would.
    """
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy("process_date")
        .parquet(root)
    )


def scan_bronze(spark: SparkSession, root: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Bronze rows of the process dates `first` to `last`."""
    rows = spark.read.schema(T.StructType([*BRONZE.fields, PARTITION])).parquet(root)
    return dated(rows, first, last).drop("process_date")
