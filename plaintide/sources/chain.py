"""Proof that a paged fetch is complete: the chain of its pages rebuilt from cursors.

Each hit has `sort` values, its place in the order of the fetch, and the next page is asked for with the cursor of the
last hit: its values joined with `_`. A landed page may carry that cursor as `search_after`. A page that was
asked for behind the place which the pages before it reach shows a gap; one that starts at or before that place, an
overlap. Totals alone cannot see a lost page and a doubled one of equal size.

Sort values are numbers, such as a time and a key. Places are compared as arrays of numbers, negated where the fetch is
in descending order. What a page says about its place is small; only that is shuffled, not the records. The
place reached before a page is a running maximum, taken within buckets of the first sort value (a day of
milliseconds by default) and then over the buckets, so no task sees all pages.

Findings, none of them raised:

- `doubled`: the same page more than once; `pages` and `records` count what is too much
- `gap`: hits behind the cursor `after` up to the cursor `before` are missing (`after` is NULL at the begin of a fetch)
- `overlap`: the hits from cursor `after` to cursor `before` came with an earlier page already
- `disorder`: the hits of a page are not in the order of the fetch
- `uncertain`: a later page that does not say what it was asked with, so a gap before it cannot be seen
- `unplaced`: a page with hits whose sort values are missing or not numbers; it is not part of the chain

Pages without hits end a fetch; one that was asked for behind the last place shows that nothing follows. No pages give no
rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY = 86_400_000
NUMBER = "decimal(38,6)"


def cursor(sort: Column) -> Column:
    """The text by which a client asks for what follows a hit."""
    return F.array_join(sort, "_")


def place(values: Column, descending: bool) -> Column:
    """Sort values as numbers that grow along the fetch; NULL if one is missing or not a number."""
    numbers = F.transform(values, lambda v: v.try_cast(NUMBER) * F.lit(-1 if descending else 1).cast("decimal(1,0)"))
    numbers = F.transform(numbers, lambda v: v.cast(NUMBER))
    return F.when((F.size(values) > 0) & ~F.exists(numbers, lambda v: v.isNull()), numbers)


def page_edges(pages: DataFrame, descending: bool = True) -> DataFrame:
    """One row per page: its fetch, what it was asked with, its first and last place, and its number of hits."""
    hits = F.col("hits.hits")
    spots = F.transform(hits, lambda h: F.struct(place(h["sort"], descending).alias("place"), cursor(h["sort"]).alias("cursor")))
    rows = pages.select(
        F.regexp_extract("_metadata.file_path", "/run=([^/]+)/", 1).alias("fetch"),
        F.col("hits.total.value").alias("total"),
        "search_after",
        F.coalesce(F.array_size(hits), F.lit(0)).cast("long").alias("records"),
        spots.alias("spots"),
    )
    return rows.select(
        "fetch",
        "total",
        "search_after",
        place(F.split("search_after", "_"), descending).alias("asked"),
        "records",
        F.array_min("spots").alias("low"),
        F.array_max("spots").alias("high"),
        F.coalesce(F.exists("spots", lambda s: s["place"].isNull()), F.lit(False)).alias("unplaced"),
        (F.col("spots") != F.sort_array("spots")).alias("disorder"),
    )


def placed_pages(edges: DataFrame, width: int = DAY) -> DataFrame:
    """Each different page with hits, how often it came, and the place that the pages before it reach."""
    same = ["fetch", "search_after", "asked", "records", "low", "high", "disorder"]
    rows = edges.filter((F.col("records") > 0) & ~F.col("unplaced")).groupBy(same).agg(F.count(F.lit(1)).alias("copies"))
    rows = rows.withColumn("bucket", F.floor(F.col("low.place")[0] / F.lit(width)))
    before = Window.partitionBy("fetch", "bucket").orderBy("low", "high", "search_after")
    rows = rows.withColumn("_within", F.max("high").over(before.rowsBetween(Window.unboundedPreceding, -1)))
    buckets = rows.groupBy("fetch", "bucket").agg(F.max("high").alias("_last"))
    earlier = Window.partitionBy("fetch").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.select("fetch", "bucket", F.max("_last").over(earlier).alias("_carried"))
    reached = F.greatest("_within", "_carried")
    return rows.join(buckets, ["fetch", "bucket"]).withColumn("reached", reached).drop("bucket", "_within", "_carried")


def is_gap() -> Column:
    asked, reached = F.col("asked"), F.col("reached.place")
    return asked.isNotNull() & (F.col("reached").isNull() | (asked > reached))


def findings(placed: DataFrame, edges: DataFrame) -> DataFrame:
    low, high = F.col("low.cursor"), F.col("high.cursor")
    surplus = F.col("copies") - 1
    repeats = F.col("reached").isNotNull() & (F.col("low.place") <= F.col("reached.place"))

    def kind(condition: Column, name: str, after: Column, before: Column, n_pages: Column | None, records: Column | None) -> Column:
        none = F.lit(None).cast("long")
        values = {"finding": F.lit(name), "after": after, "before": before, "pages": none if n_pages is None else n_pages}
        values["records"] = none if records is None else records
        return F.when(condition, F.struct(*[v.alias(k) for k, v in values.items()]))

    one = F.lit(1).cast("long")
    until = F.least("reached", "high")["cursor"]
    found = F.array_compact(
        F.array(
            kind(surplus > 0, "doubled", low, high, surplus, surplus * F.col("records")),
            kind(is_gap(), "gap", F.col("reached.cursor"), F.col("search_after"), None, None),
            kind(repeats, "overlap", low, until, one, None),
            kind(F.col("disorder"), "disorder", low, high, one, F.col("records")),
            kind(F.col("asked").isNull() & F.col("reached").isNotNull(), "uncertain", F.col("reached.cursor"), low, one, None),
        )
    )
    chained = placed.select("fetch", F.explode(found).alias("found")).select("fetch", "found.*")
    text = F.lit(None).cast("string")
    lost = edges.filter("unplaced").groupBy("fetch").agg(F.count(F.lit(1)).alias("pages"), F.sum("records").alias("records"))
    return chained.unionByName(
        lost.select("fetch", F.lit("unplaced").alias("finding"), text.alias("after"), text.alias("before"), "pages", "records")
    )


def chain_findings(pages: DataFrame, descending: bool = True, width: int = DAY) -> DataFrame:
    """(fetch, finding, after, before, pages, records): what is wrong with the chains of some fetches."""
    edges = page_edges(pages, descending)
    return findings(placed_pages(edges, width), edges)


def reconcile_chain(pages: DataFrame, descending: bool = True, width: int = DAY) -> DataFrame:
    """One row per fetch: announced and different records, pages, findings, and whether it is proved complete.

    A fetch is complete if no page is missing before another, and as many different hits are there as the first page
    announces. `is_closed` tells that an empty page was asked for behind the last hit.
    """
    edges = page_edges(pages, descending)
    placed = placed_pages(edges, width)
    chained = placed.groupBy("fetch").agg(
        F.sum("copies").alias("pages"),
        F.sum(F.col("copies") - 1).alias("doubled_pages"),
        F.count(F.when(is_gap(), 1)).alias("gaps"),
        F.count(F.when(F.col("low.place") <= F.col("reached.place"), 1)).alias("overlaps"),
        F.max("high.place").alias("_end"),
    )
    empty = F.col("records") == 0
    announced = edges.groupBy("fetch").agg(
        F.coalesce(F.min_by("total", F.struct(empty, F.col("low"))), F.lit(0).cast("long")).alias("expected"),
        F.sum("records").alias("records"),
        F.max(F.when(empty, F.col("asked"))).alias("_asked"),
    )
    hits = pages.select(
        F.regexp_extract("_metadata.file_path", "/run=([^/]+)/", 1).alias("fetch"), F.explode("hits.hits.sort").alias("sort")
    )
    different = hits.select("fetch", cursor(F.col("sort")).alias("cursor")).groupBy("fetch").agg(
        F.count_distinct("cursor").alias("different_records")
    )
    rows = announced.join(chained, "fetch", "left").join(different, "fetch", "left")
    rows = rows.fillna(0, ["pages", "doubled_pages", "gaps", "overlaps", "different_records"])
    return rows.select(
        "fetch",
        "expected",
        "records",
        "different_records",
        "pages",
        "doubled_pages",
        "gaps",
        "overlaps",
        F.coalesce(F.col("_asked") >= F.col("_end"), F.lit(False)).alias("is_closed"),
        ((F.col("gaps") == 0) & (F.col("expected") == F.col("different_records"))).alias("is_complete"),
    )
