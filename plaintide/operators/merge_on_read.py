"""A keyed Parquet table whose loads write their own rows only.

:func:`plaintide.operators.upsert.upsert_by_key` rewrites the key ranges of a batch. Here a load writes its rows into
a folder of its own and, for the rows that they replace, a deletion vector: per file, the positions of its rows
that no longer count. A read leaves those positions out with an anti join on file and position, in the JVM and without
looking at keys; the positions of BLOCK rows are a bitmap of 4 KB, so those of half a billion rows are broadcast, and the rows
are shuffled for them only beyond that. Compaction rewrites the key ranges whose vectors have grown and drops the vectors.

A load or compaction counts from the moment its marker is there. Its folder names the files it made and, for a
compaction, the loads it stands for, so a reader sees the one or the other. Writers must take turns.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plaintide.operators.upsert import RANGE, RANGE_WIDTH, copies, few_copies, key_range, latest_per_key, require_key
from plaintide.schemas import BRONZE, KEY
from plaintide.session import freed_shuffles
from plaintide.sources.files import children, create_new, delete, read_text, write_text

STEP = "step="
DONE, ROWS, VECTORS, REPLACES = "_done", "rows", "vectors", "replaces.txt"
#: Positions of one bitmap, as Spark has them, and bitmaps that go to every task.
BLOCK, BITMAPS = 32_768, 1 << 14
VECTOR = T.StructType([T.StructField("file", T.StringType()), T.StructField("positions", T.ArrayType(T.LongType()))])


def steps(spark: SparkSession, location: str) -> list[str]:
    """The folders that count, oldest first: finished ones that no compaction stands for."""
    done = [n for n in children(spark, location) if n.startswith(STEP) and DONE in children(spark, f"{location}/{n}")]
    replaced: set[str] = set()
    for name in done:
        if REPLACES in children(spark, f"{location}/{name}"):
            replaced.update(read_text(spark, f"{location}/{name}/{REPLACES}").split("\n"))
    return [n for n in done if n not in replaced]


def new_step(spark: SparkSession, location: str) -> str:
    numbers = [int(n.removeprefix(STEP).split("-")[0]) for n in children(spark, location) if n.startswith(STEP)]
    return f"{STEP}{max(numbers, default=0) + 1:010d}-{uuid.uuid4().hex[:12]}"


def file_name(column: str = "_metadata.file_path"):
    """A file as step/part/name: the same whichever scheme a path is read by."""
    return F.substring_index(F.col(column), "/", -4)


def positioned(spark: SparkSession, location: str, names: Sequence[str], schema: T.StructType) -> DataFrame:
    """All stored rows of some steps with their key range, file and position."""
    fields = T.StructType([*schema.fields, T.StructField(RANGE, T.LongType())])
    if not names:
        return spark.createDataFrame([], T.StructType([*fields.fields, T.StructField("_file", T.StringType()), T.StructField("_position", T.LongType())]))
    paths = [f"{location}/{n}/{ROWS}" for n in names]
    parts = [
        spark.read.schema(fields).parquet(path).select("*", file_name().alias("_file"), F.col("_metadata.row_index").alias("_position"))
        for path in paths
    ]
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.unionByName(more)
    return rows


def deleted(spark: SparkSession, location: str, names: Sequence[str]) -> DataFrame | None:
    """(_gone_file, _block, _bits): the rows that do not count, a bit each, from the vectors of some steps."""
    paths = [f"{location}/{n}/{VECTORS}" for n in names if VECTORS in children(spark, f"{location}/{n}")]
    if not paths:
        return None
    vectors = spark.read.schema(VECTOR).parquet(*paths)
    gone = vectors.select(F.col("file").alias("_gone_file"), F.explode("positions").alias("_gone"))
    bits = F.bitmap_construct_agg(F.col("_gone") % BLOCK).alias("_bits")
    return gone.groupBy("_gone_file", F.expr(f"_gone div {BLOCK}").alias("_block")).agg(bits)


def live(spark: SparkSession, location: str, schema: T.StructType) -> DataFrame:
    """The rows that count, with key range, file and position."""
    names = steps(spark, location)
    rows, gone = positioned(spark, location, names, schema), deleted(spark, location, names)
    if gone is None:
        return rows
    if gone.count() <= BITMAPS:
        gone = F.broadcast(gone)
    byte = F.expr(f"cast(conv(hex(substring(_bits, cast(_position % {BLOCK} div 8 + 1 as int), 1)), 16, 10) as int)")
    bit = F.getbit(byte, (F.col("_position") % 8).cast("int")) == 1
    return rows.join(gone, (F.col("_file") == F.col("_gone_file")) & (F.expr(f"_position div {BLOCK}") == F.col("_block")) & bit, "left_anti")


def read(spark: SparkSession, location: str, schema: T.StructType = BRONZE) -> DataFrame:
    """The rows of the table: one per key."""
    return live(spark, location, schema).select(schema.names)


def merge(spark: SparkSession, batch: DataFrame, location: str, key: str = KEY, version: str = "extracted_at", schema: T.StructType = BRONZE, width: int = RANGE_WIDTH) -> int:
    """Insert new keys and replace rows of existing ones; the rows of the batch.

    What is written follows the batch: its rows, and the positions of the rows it replaces. The scan for those reads
    the keys of the batch's key ranges alone. A load that is stopped leaves the table as it was.
    """
    name = new_step(spark, location)
    rows = require_key(batch.select(schema.names), key).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        processed, most = copies(rows, key)
        if processed:
            dealt = few_copies(rows, key, version, most).repartitionByRange(key)
            kept = latest_per_key(dealt, key, version).withColumn(RANGE, key_range(key, width))
            with freed_shuffles(spark):
                kept.write.partitionBy(RANGE).parquet(f"{location}/{name}/{ROWS}")
            ranges = rows.select(key_range(key, width)).distinct()
            old = live(spark, location, schema).select(key, RANGE, "_file", "_position").join(ranges, RANGE, "left_semi")
            hit = old.join(rows.select(key).distinct(), key, "left_semi")
            vectors = hit.groupBy(F.col("_file").alias("file")).agg(F.sort_array(F.collect_list("_position")).alias("positions"))
            with freed_shuffles(spark):
                vectors.write.parquet(f"{location}/{name}/{VECTORS}")
            create_new(spark, f"{location}/{name}/{DONE}")
    finally:
        rows.unpersist()
    return processed


def compact(spark: SparkSession, location: str, schema: T.StructType = BRONZE) -> bool:
    """Rewrite the table as one step without vectors; False if it is one already.

    The rows do not change, so running it again, or after it was stopped, gives the same table.
    """
    names = steps(spark, location)
    if len(names) < 2:
        return False
    name = new_step(spark, location)
    rows = live(spark, location, schema).drop("_file", "_position").hint("rebalance", RANGE)
    with freed_shuffles(spark):
        rows.write.partitionBy(RANGE).parquet(f"{location}/{name}/{ROWS}")
    write_text(spark, f"{location}/{name}/{REPLACES}", "\n".join(names))
    create_new(spark, f"{location}/{name}/{DONE}")
    return True


def clean(spark: SparkSession, location: str) -> None:
    """Delete what does not count: steps that were stopped, and those that a compaction stands for, once no one reads them."""
    counting = set(steps(spark, location))
    for name in children(spark, location):
        if name.startswith(STEP) and name not in counting:
            delete(spark, f"{location}/{name}")
