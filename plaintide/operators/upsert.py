"""Keyed upsert into a Parquet table.

The table is partitioned by `key_range`, a fixed number of consecutive keys. A key always falls into the
same range, so a replaced row cannot leave a copy elsewhere, and no range outgrows its width. Complaint
keys grow with time: a daily batch touches a few ranges and the rest of the table is neither read nor
written.

A load writes the ranges it touches once, whole, into a folder of its own, and points the table's
partitions there. The folders tell the state without a catalog: a load counts from the moment its folder
holds the marker file that the load itself writes, and a range is where the latest such load has it.
A load of a stream's batch also leaves the batch's number in its folder, so the same batch is not loaded twice.

Claims and markers need a file system that creates a file only if it is absent, as HDFS and local ones do; an
object store needs one with conditional writes, or loads that are kept from running at the same time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plaintide.schemas import BRONZE, KEY
from plaintide.session import freed_shuffles
from plaintide.sources.files import children, create_new, delete, modified

RANGE = "key_range"
RANGE_WIDTH = 1_000_000
LOWEST_KEY = -(2**63)
LOAD = "load="
CLAIMS = "_claims"
LOADED, POINTED, WITHDRAWN = "_loaded", "_pointed", "_withdrawn"
BATCH = "_batch="
#: So many key ranges, a long each, go to every task rather than the table's rows to the ranges.
LISTED = 100_000
#: Copies of a key that one task may meet, and neighbouring keys whose rows are counted together to rule out more.
COPIES, NEIGHBOURS = 10_000, 5_000
STORED = "_stored"
#: Milliseconds after which a claim without a marker is that of a load that is dead.
LEASE = 60_000


class ConcurrentLoad(RuntimeError):
    """Another load of the same table ended, or was about to, while this one ran; this one changed nothing."""


def latest_per_key(df: DataFrame, key: str = KEY, version: str = "extracted_at", before: Sequence[str] = ()) -> DataFrame:
    """One row per key: least `before`, latest `version`, then the greatest remaining row by its columns in order.

    Catalyst turns `row_number() = 1` into a group limit on both sides of the exchange, so a key with very
    many copies leaves each map task as one row.
    """
    others = [c for c in df.columns if c not in {key, version, *before}]
    order = [*map(F.col, before), *[F.col(c).desc_nulls_last() for c in [version, *others]]]
    ranked = df.withColumn("_copy", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.filter(F.col("_copy") == 1).drop("_copy")


def copies(rows: DataFrame, key: str = KEY) -> tuple[int, int]:
    """How many rows there are, and at most how many of them share a key; evaluated now.

    Rows are counted by NEIGHBOURS consecutive keys, so a row per such bucket is shuffled and not the keys. Only if a bucket
    has over COPIES rows are its keys told apart.
    """
    buckets = rows.groupBy(key_range(key, NEIGHBOURS).alias("bucket")).count()
    total, most = buckets.agg(F.coalesce(F.sum("count"), F.lit(0)), F.coalesce(F.max("count"), F.lit(0))).first()
    if most > COPIES:
        most = rows.groupBy(key).count().agg(F.max("count")).first()[0]
    return total, most


def few_copies(rows: DataFrame, key: str = KEY, version: str = "extracted_at", most: int | None = None) -> DataFrame:
    """Rows that may be dealt by key as they are: if a key has over COPIES of them, one per key is left first.

    `most` is the second result of :func:`copies`, if it is known.
    """
    most = copies(rows, key)[1] if most is None else most
    return latest_per_key(rows, key, version) if most > COPIES else rows


def require_key(df: DataFrame, key: str = KEY) -> DataFrame:
    """Fail the query on a NULL key."""
    missing = F.raise_error(F.lit(f"NULL in key column {key}")).cast(df.schema[key].dataType)
    return df.withColumn(key, F.coalesce(F.col(key), missing))


def key_range(key: str = KEY, width: int = RANGE_WIDTH) -> Column:
    """Consecutive numbers of `width` keys, below zero too; whole-number arithmetic is exact for any key."""
    below = F.when(F.expr(f"`{key}` % {width} < 0"), 1).otherwise(0)
    return (F.expr(f"`{key}` div {width}") - below).alias(RANGE)


def merge_rows(target: DataFrame, batch: DataFrame, key: str = KEY, version: str = "extracted_at") -> DataFrame:
    """Target rows whose key is not in the batch, and one batch row per key, dealt by ranges of the key.

    The batch wins whatever its version. Dealt that way, the rows of a key meet and a task holds neighbouring keys, so
    neither the choice among them nor files by key range need another shuffle.
    """
    both = target.select(*batch.columns, F.lit(1).alias(STORED)).unionByName(batch.withColumn(STORED, F.lit(0)))
    return latest_per_key(both.repartitionByRange(key), key, version, before=[STORED]).drop(STORED)


def touched_rows(target: DataFrame, batch: DataFrame, key: str, width: int) -> DataFrame:
    """Target rows in the key ranges the batch touches.

    The semi join is on the partition column, so the ranges also prune the scan while it runs. The comparison
    drops NULL keys, which are refused elsewhere, and tells the optimizer that the join selects. The size of the
    ranges is not known to the optimizer, which would shuffle the rows of the table for them.
    """
    ranges = batch.filter(F.col(key) >= F.lit(LOWEST_KEY)).select(key_range(key, width)).distinct()
    if ranges.count() <= LISTED:
        ranges = F.broadcast(ranges)
    return target.join(ranges, RANGE, "left_semi")


def upsert_by_key(
    spark: SparkSession,
    batch: DataFrame,
    table: str,
    location: str,
    key: str = KEY,
    version: str = "extracted_at",
    width: int = RANGE_WIDTH,
    batch_of: tuple[str, int] | None = None,
) -> int:
    """Insert new keys and replace existing rows of `table`, stored below `location`; the rows of the batch.

    Running it twice changes nothing. A call that fails or is stopped leaves the table as it was. Of two
    calls at the same time the one that ends second fails with ConcurrentLoad and may be run again.
    `batch_of` names a stream and the number of its batch: a batch that is in the table already is not read, and
    has no rows. The batch is stored once, compressed, so that the shuffles it is made by are gone before it is merged and no
    executor has to keep its rows.
    """
    before = finished_loads(spark, location)
    if batch_of and batch_number(before, batch_of[0]) >= batch_of[1]:
        return 0
    point_partitions(spark, table, location, {n: c for n, c in before.items() if POINTED not in c})
    drop_replaced(spark, location, before)
    number = max((load_number(n) for n in children(spark, location) if n.startswith(LOAD)), default=0) + 1
    name = f"{LOAD}{number:010d}-{uuid.uuid4().hex[:12]}"
    staged = f"{location}/_staged-{name}"
    try:
        with freed_shuffles(spark):
            require_key(batch.select([f.name for f in BRONZE]), key).write.parquet(staged, compression="zstd")
        rows = spark.read.schema(BRONZE).parquet(staged)
        processed, most = copies(rows, key)
        if processed:
            target = touched_rows(spark.table(table), rows, key, width).drop(RANGE)
            merged = merge_rows(target, few_copies(rows, key, version, most), key, version).withColumn(RANGE, key_range(key, width))
            with freed_shuffles(spark):
                merged.write.partitionBy(RANGE).parquet(f"{location}/{name}")
            if batch_of:
                create_new(spark, f"{location}/{name}/{BATCH}{batch_of[0]}={batch_of[1]}")
            finish(spark, location, name, before)
            point_partitions(spark, table, location, {name: children(spark, f"{location}/{name}")})
    finally:
        delete(spark, staged)
    return processed


def load_number(name: str) -> int:
    return int(name.removeprefix(LOAD).split("-")[0])


def finished_loads(spark: SparkSession, location: str) -> dict[str, list[str]]:
    """The folders of finished loads and what they hold, oldest first."""
    found = {n: children(spark, f"{location}/{n}") for n in children(spark, location) if n.startswith(LOAD)}
    return {n: content for n, content in found.items() if LOADED in content and WITHDRAWN not in content}


def batch_number(found: dict[str, list[str]], stream: str) -> int:
    """The last batch of a stream that is in the table, -1 if there is none."""
    marks = [mark for content in found.values() for mark in content if mark.startswith(f"{BATCH}{stream}=")]
    return max([-1, *(int(mark.rpartition("=")[2]) for mark in marks)])


def finish(spark: SparkSession, location: str, name: str, before: dict[str, list[str]]) -> None:
    """Make a written load count, unless another one came between: this merge would undo that one.

    Every load announces itself before it looks for others, so of two at least one sees the other. A load
    that is killed between its claim and its marker leaves the claim: it is withdrawn once a later load has
    finished, or its lease is over.
    """
    claims = f"{location}/{CLAIMS}"
    create_new(spark, f"{claims}/{name}")
    finished = finished_loads(spark, location)
    rivals = [n for n in finished if n not in before]
    others = [n for n in children(spark, claims) if n != name and not n.startswith(".")]
    rivals += [f"{claims}/{n}" for n in others if not withdrawn(spark, location, n, name, finished)]
    if not rivals:
        create_new(spark, f"{location}/{name}/{LOADED}")
        if WITHDRAWN in children(spark, f"{location}/{name}"):
            rivals.append("a load that took it for dead")
    delete(spark, f"{claims}/{name}")
    if rivals:
        delete(spark, f"{location}/{name}")
        raise ConcurrentLoad(f"{name} is withdrawn because of {', '.join(rivals)}")


def withdrawn(spark: SparkSession, location: str, rival: str, name: str, finished: dict[str, list[str]]) -> bool:
    """Whether the claim of `rival` stands in the way no more.

    The mark of withdrawal comes before the look at the rival's marker, and the rival looks for the mark after
    it has set its marker: a rival that lives after all either counts here or gives way there. Ages are differences
    of two times of the file system's own clock.
    """
    claims = f"{location}/{CLAIMS}"
    claimed, now = modified(spark, f"{claims}/{rival}"), modified(spark, f"{claims}/{name}")
    if claimed is None or now is None:
        return False
    last = max(map(load_number, finished), default=0)
    if load_number(rival) > last and now - claimed < LEASE:
        return False
    create_new(spark, f"{location}/{rival}/{WITHDRAWN}")
    if LOADED in children(spark, f"{location}/{rival}"):
        delete(spark, f"{location}/{rival}/{WITHDRAWN}")
        return rival in finished
    delete(spark, f"{claims}/{rival}")
    return True


def point_partitions(spark: SparkSession, table: str, location: str, found: dict[str, list[str]]) -> None:
    """Let the table's partitions be the ranges of these loads, a later one before an earlier one."""
    latest = {part: name for name, content in found.items() for part in content if part.startswith(f"{RANGE}=")}
    if latest:
        known = {row[0] for row in spark.sql(f"SHOW PARTITIONS {table}").collect()}
        spec = {part: f"PARTITION ({RANGE} = {part.split('=')[1]})" for part in latest}
        new = [f"{spec[p]} LOCATION '{location}/{n}/{p}'" for p, n in latest.items() if p not in known]
        if new:
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(new)}")
        for part, name in latest.items():
            if part in known:
                spark.sql(f"ALTER TABLE {table} {spec[part]} SET LOCATION '{location}/{name}/{part}'")
        spark.catalog.refreshTable(table)
    for name in found:
        create_new(spark, f"{location}/{name}/{POINTED}")


def drop_replaced(spark: SparkSession, location: str, found: dict[str, list[str]]) -> None:
    """Delete ranges that were replaced before the last load; those that the last one replaced may still be read."""
    seen: set[str] = set()
    streams = {mark.split("=")[1] for content in found.values() for mark in content if mark.startswith(BATCH)}
    last = {f"{BATCH}{stream}={batch_number(found, stream)}" for stream in streams}
    for name in list(found)[-2::-1]:
        parts = [p for p in found[name] if p.startswith(f"{RANGE}=")]
        for part in parts:
            if part in seen:
                delete(spark, f"{location}/{name}/{part}")
        if seen.issuperset(parts) and last.isdisjoint(found[name]):
            delete(spark, f"{location}/{name}")
        seen.update(parts)
