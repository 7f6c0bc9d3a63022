"""A copy of the keyed table for lookups by company and received day.

Within each key range the rows lie along a Z-order curve over company and day, so each file holds few companies and few
days, and an index tells by company what days each file holds. A lookup reads the files that the index names and no
others; Parquet's own statistics and dictionaries skip row groups within them. Only key ranges that a load has replaced
since the last refresh are laid out anew, and all of a refresh is published at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plaintide.functions.scalar import utc_wall
from plaintide.operators.filters import filter_company, filter_received_range
from plaintide.operators.upsert import RANGE, key_range
from plaintide.plans.runs import touched_ranges
from plaintide.schemas import BRONZE, KEY
from plaintide.sources.files import children
from plaintide.sources.versions import Manifest, new_folder, publish, version_at
from plaintide.sources.warehouse import COMPLAINTS, Warehouse

LAYOUT = "_layout"
#: Files of a key range. Its million records with their texts come to one or two gigabytes.
FILES = 16
SIDE = 1 << 16
INDEX = "company string, path string, n bigint, first_day date, last_day date"


def interleaved(x: Column, y: Column) -> Column:
    """The place of (x, y), both below 2**16, on the Z-order curve."""

    def spread(c: Column) -> Column:
        c = c.cast("long")
        for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
            c = c.bitwiseOR(F.shiftleft(c, shift)).bitwiseAND(F.lit(mask).cast("long"))
        return c

    return F.shiftleft(spread(x), 1).bitwiseOR(spread(y))


def day_of(df: DataFrame) -> Column:
    return utc_wall(F.col("date_received")).cast("date")


def placed(rows: DataFrame) -> DataFrame:
    """`rows` with their key range and place on the curve of that range, which spans the range's own days.

    The spans are a row per key range; without the hint the rows would be shuffled for them before that is known.
    """
    rows = rows.withColumn(RANGE, key_range()).withColumn("_day", F.unix_date(day_of(rows)))
    spans = rows.groupBy(RANGE).agg(F.min("_day").alias("_low"), F.max("_day").alias("_high"))
    share = (F.col("_day") - F.col("_low")) * SIDE / (F.col("_high") - F.col("_low") + 1)
    place = interleaved(F.pmod(F.xxhash64("company"), F.lit(SIDE)), F.coalesce(F.floor(share), F.lit(0)))
    return rows.join(F.broadcast(spans), RANGE, "left").withColumn("_place", place).drop("_day", "_low", "_high")


def refresh_layout(warehouse: Warehouse, files: int = FILES, run_ts: str = "") -> Manifest:
    """Bring the layout up to date with the table.

    Rows are dealt by (range, place, key), so a company with a third of all rows, or a day of it, is split by its keys.
    """
    spark, root = warehouse.spark, warehouse.path("raw", LAYOUT)
    last = version_at(spark, root) or Manifest("")
    now = warehouse.ranges()
    fresh, _ = touched_ranges(last.parts, now)
    parts = {r: p for r, p in last.parts.items() if r in now and r not in fresh}
    folder = new_folder(root)
    if fresh:
        order = [RANGE, "_place", KEY]
        rows = placed(warehouse.range_rows(fresh)).repartitionByRange(len(fresh) * files, *order).sortWithinPartitions(*order)
        rows.drop("_place").write.partitionBy(RANGE).parquet(f"{folder}/data")
        stored = spark.read.schema(BRONZE).parquet(f"{folder}/data").withColumn("path", F.col("_metadata.file_path"))
        held = stored.withColumn(RANGE, key_range()).groupBy(RANGE, "company", "path").agg(
            F.count(F.lit(1)).alias("n"), F.min(day_of(stored)).alias("first_day"), F.max(day_of(stored)).alias("last_day")
        )
        held.repartitionByRange(len(fresh), RANGE).sortWithinPartitions(RANGE, "company").write.partitionBy(RANGE).parquet(f"{folder}/index")
        made = set(children(spark, f"{folder}/data"))
        for r in fresh:
            part = f"{RANGE}={r}"
            parts[r] = {"load": now[r]} | ({step: f"{folder}/{step}/{part}" for step in ("data", "index")} if part in made else {})
    return publish(spark, root, folder, Manifest(run_ts or last.run_ts, {}, parts))


def files_of(warehouse: Warehouse, company: str | None = None, first: str | None = None, last: str | None = None) -> list[str]:
    """The files that hold records of a company received in the days `first` to `last`: as many as there are, by name."""
    spark = warehouse.spark
    manifest = version_at(spark, warehouse.path("raw", LAYOUT))
    if manifest is None:
        raise LookupError(f"{COMPLAINTS} has no layout: call refresh_layout")
    paths = [p["index"] for p in manifest.parts.values() if "index" in p]
    if not paths:
        return []
    index = filter_company(spark.read.schema(INDEX).parquet(*paths), company)
    if first is not None:
        index = index.filter(F.col("last_day") >= F.lit(first).cast("date"))
    if last is not None:
        index = index.filter(F.col("first_day") <= F.lit(last).cast("date"))
    return sorted(row[0] for row in index.select("path").distinct().collect())


def find(warehouse: Warehouse, company: str | None = None, first: str | None = None, last: str | None = None) -> DataFrame:
    """The records of a company, or of all, received in the days `first` to `last`, as of the last refresh.

    An open bound is None; with both open undated records are found too.
    """
    paths = files_of(warehouse, company, first, last)
    reader = warehouse.spark.read.schema(BRONZE)
    rows = reader.parquet(*paths) if paths else warehouse.range_rows([])
    if first is not None or last is not None:
        rows = filter_received_range(rows, first or "0001-01-01", last or "9999-12-30")
    return filter_company(rows, company)
