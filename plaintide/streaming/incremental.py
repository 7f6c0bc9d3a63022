"""Upsert of raw files as they arrive."""

from __future__ import annotations

import json
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from plaintide.operators.filters import lookback_window
from plaintide.operators.normalize import normalize_schema
from plaintide.schemas import RAW
from plaintide.sources.files import read_text
from plaintide.sources.raw import JSON_FILES, PARTITION
from plaintide.sources.warehouse import Warehouse


def incremental_upsert(
    warehouse: Warehouse,
    raw_root: str,
    checkpoint: str,
    max_files: int | None = None,
) -> StreamingQuery:
    """Load the raw files that came since the last call, then stop.

    The checkpoint remembers the files. A micro-batch may be handed over twice after a failure; the load of the first
    time holds the batch's number and the stream's id, by which the second time is known and skipped unread.
    """
    reader = (
        warehouse.spark.readStream.schema(T.StructType([*RAW.fields, PARTITION]))
        .option("mode", "FAILFAST")
        .option("pathGlobFilter", JSON_FILES)
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def load(batch: DataFrame, batch_id: int) -> None:
        stream = json.loads(read_text(warehouse.spark, f"{checkpoint}/metadata"))["id"]
        replace(warehouse, spark=batch.sparkSession).upsert(normalize_schema(batch), batch_of=(stream, batch_id))

    return (
        reader.json(raw_root)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def refresh_recent(warehouse: Warehouse, extracted: DataFrame, run_date: str, days: int = 90) -> None:
    """Upsert the records of a re-extraction that were received in the last `days` days."""
    warehouse.upsert(lookback_window(normalize_schema(extracted), run_date, days))
