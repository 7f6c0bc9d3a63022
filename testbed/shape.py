"""The driver's tables seen as complaint records: one record per (order, line)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plaintide.functions.scalar import utc_text
from plaintide.plans.models import int_complaint_metrics, stg_complaints
from plaintide.schemas import BRONZE
from plaintide.session import PARTS, freed_shuffles, part_of, parts, scratch_dir, store_parts
from plaintide.sources import files

LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]

# Each complaint column: its expression and the tables it needs besides lineitem.
COLUMNS: dict[str, tuple[str, tuple[str, ...]]] = {
    "product": ("CASE WHEN l_partkey % 79 <> 0 THEN p_type END", ("part",)),
    "complaint_what_happened": ("p_name", ("part",)),
    "date_sent_to_company": ("l_shipdate", ()),
    "issue": ("CASE WHEN l_partkey % 83 <> 0 THEN o_orderpriority END", ("orders",)),
    "sub_product": ("CASE WHEN p_size % 10 <> 0 THEN p_brand END", ("part",)),
    "zip_code": ("CAST(o_custkey % 1000 AS STRING)", ("orders",)),
    "tags": ("CASE WHEN l_quantity % 3 = 0 THEN c_mktsegment END", ("orders", "customer")),
    "has_narrative": ("l_discount >= 0.05D", ()),
    "complaint_id": ("l_orderkey * 8 + l_linenumber", ()),
    "timely": ("CASE WHEN l_tax <= 0.06D THEN CASE WHEN l_linestatus = 'F' THEN 'Yes' ELSE 'No' END END", ()),
    "company_response": ("CASE WHEN l_orderkey % 97 <> 0 THEN o_orderstatus END", ("orders",)),
    "submitted_via": ("l_returnflag", ()),
    "company": ("CASE WHEN l_suppkey % 41 <> 0 THEN s_name END", ("supplier",)),
    "date_received": ("CASE WHEN l_orderkey % 101 <> 0 THEN o_orderdate END", ("orders",)),
    "state": ("CASE WHEN o_custkey % 89 <> 0 THEN n_name END", ("orders", "customer", "nation")),
    "company_public_response": ("o_orderpriority", ("orders",)),
    "sub_issue": ("CASE WHEN l_quantity % 5 <> 0 THEN c_mktsegment END", ("orders", "customer")),
    "extracted_at": ("l_shipdate", ()),
}

# What orders lead to is joined to the orders, which are fewer and narrower than the lines.
ORDER_JOINS = {
    "customer": ("o_custkey", "c_custkey"),
    "nation": ("c_nationkey", "n_nationkey"),
}
LINE_JOINS = {
    "orders": ("l_orderkey", "o_orderkey"),
    "supplier": ("l_suppkey", "s_suppkey"),
    "part": ("l_partkey", "p_partkey"),
}


# The tables that lots of orders divide, and the order's key in each.
ORDER_KEYS = {"lineitem": "l_orderkey", "orders": "o_orderkey"}


def table(spark: SparkSession, sf_dir: str, name: str, lot: int | None = None) -> DataFrame:
    """A table; with `lot` only that lot of orders and lines, of PARTS lots."""
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if lot is None or name not in ORDER_KEYS:
        return rows
    return rows.filter(part_of(F.col(ORDER_KEYS[name]).cast("long")) == lot)


def lines(spark: SparkSession, sf_dir: str, by_order: bool = False, lot: int | None = None) -> DataFrame:
    """lineitem with one row per (order, line).

    `row_number() = 1` becomes a group limit before and after the exchange, so copies of one key are
    dropped map-side. With `by_order` the lines are dealt by order instead, and a join with the orders needs no other exchange.
    """
    newest = Window.partitionBy("l_orderkey", "l_linenumber").orderBy(*[F.col(c).desc() for c in LINE_ORDER])
    rows = table(spark, sf_dir, "lineitem", lot)
    rows = (rows.repartition("l_orderkey") if by_order else rows).withColumn("copy", F.row_number().over(newest))
    return rows.filter("copy = 1").drop("copy")


def complaints(
    spark: SparkSession,
    sf_dir: str,
    columns: Iterable[str] | None = None,
    source: DataFrame | None = None,
    lot: int | None = None,
) -> DataFrame:
    """Complaint records with the given columns (all by default); joins only the tables they need.

    The other tables are unique by key and joined from the left, so a join that is left out changes no row.
    Times stay zone-less, as in the files. With `lot` only the lines of that lot of orders.
    """
    names = [f.name for f in BRONZE if columns is None or f.name in set(columns)]
    needed = {name for column in names for name in COLUMNS[column][1]}

    def joined(rows: DataFrame, joins: dict[str, tuple[str, str]]) -> DataFrame:
        for name, (left, right) in joins.items():
            if name in needed:
                other = table(spark, sf_dir, name, lot)
                rows = rows.join(joined(other, ORDER_JOINS) if name == "orders" else other, F.col(left) == F.col(right), "left")
        return rows

    rows = joined(source if source is not None else lines(spark, sf_dir, "orders" in needed, lot), LINE_JOINS)

    def column(name: str) -> Column:
        value, target = F.expr(COLUMNS[name][0]), BRONZE[name].dataType
        return (value if isinstance(target, T.TimestampType) else value.cast(target)).alias(name)

    return rows.select(*[column(name) for name in names])


def complaint_lots(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """All complaint records in lots: stored one after another, the disk holds the shuffles of one lot's joins."""
    return [complaints(spark, sf_dir, lot=lot) for lot in range(PARTS)]


def metrics(spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None) -> DataFrame:
    """The metric relation; with `columns`, a column that is not listed is there but NULL."""
    rows = complaints(spark, sf_dir, columns)
    absent = [f for f in BRONZE if f.name not in rows.columns]
    rows = rows.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in absent])
    return int_complaint_metrics(stg_complaints(rows))


def raw_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line as a complaint version, several per key; `submitted_via` tells the batch."""
    return complaints(spark, sf_dir, source=table(spark, sf_dir, "lineitem"))


API_FIELDS = [f.name for f in BRONZE if f.name != "extracted_at"]
PAGE_KEYS = 4800  # complaint keys per page, so a page holds at most that many records


def land_pages(rows: DataFrame | Sequence[DataFrame], path: str, missing: int = 0) -> None:
    """Write complaints, one frame or several lots, as response pages, one page per line; each page announces the total.

    `missing` records are announced and not there, as in a fetch that was cut short. The rows are joined once, into columns
    compressed on the disk: the shuffles of a lot's joins are gone before the next lot is joined, those of the last before
    pages are dealt, and the total is the stored rows' number. Pages are landed a part at a time, so of the widest shuffle only
    one part is on the disk. The records are dealt by page before they are collected: lists made map-side would hold most
    pages of the fetch in every task. A page has its records in key order, where an order's lines compress better.
    """
    page = F.floor(F.col("complaint_id") / PAGE_KEYS)
    lots = [lot.withColumn("page", page) for lot in ([rows] if isinstance(rows, DataFrame) else rows)]
    spark, schema = lots[0].sparkSession, lots[0].schema
    times = {name: utc_text(F.col(name)) for name in ("date_received", "date_sent_to_company")}
    source = F.struct(*[times.get(name, F.col(name)).alias(name) for name in API_FIELDS])
    hit = F.struct(source.alias("_source"), F.array(F.col("complaint_id").cast("string")).alias("sort"))
    joined = scratch_dir(spark, "landing")
    try:
        with freed_shuffles(spark):
            for lot in lots:
                store_parts(lot, "page", joined)
            total = F.struct(F.lit(spark.read.schema(schema).parquet(joined).count() + missing).alias("value"))
            spark.createDataFrame([], "value string").write.text(path, compression="gzip")  # a fetch without records is a folder too
            for part in parts(spark, joined, schema):
                keyed = F.sort_array(F.collect_list(F.struct("complaint_id", hit.alias("hit"))))
                dealt = part.repartition("page").groupBy("page").agg(F.transform(keyed, lambda x: x["hit"]).alias("hits"))
                body = F.struct(F.struct(total.alias("total"), F.col("hits")).alias("hits"))
                texts = dealt.select(F.to_json(body, {"ignoreNullFields": "false"}))
                texts.write.mode("append").text(path, compression="gzip")
    finally:
        files.delete(spark, joined)


def land_chain(rows: DataFrame, path: str) -> None:
    """Write keys as pages in key order that name their cursors, with lost, doubled and overlapping pages.

    Of seven pages one is lost, of five one is landed twice, and of eleven one was asked for with the cursor of the page
    before, whose hits it has too.
    """
    page = F.floor(F.col("complaint_id") / PAGE_KEYS)
    keys = rows.select("complaint_id", page.alias("page"))
    again = keys.filter("(page + 1) % 11 = 4").withColumn("page", F.col("page") + 1)
    bounds = Window.orderBy("page")  # one row per page
    asked = F.when(F.col("page") % 11 == 4, F.lag("last", 2).over(bounds)).otherwise(F.lag("last").over(bounds))
    cursors = keys.groupBy("page").agg(F.max("complaint_id").alias("last")).select("page", asked.cast("string").alias("search_after"))
    hit = F.struct(F.lit("{}").alias("_source"), F.array("complaint_id").alias("sort"))
    hits = keys.union(again).groupBy("page").agg(F.sort_array(F.collect_list(hit)).alias("hits"))
    landed = hits.join(cursors, "page").filter("page % 7 <> 3")
    copies = F.explode(F.when(F.col("page") % 5 == 1, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    total = F.struct(keys.agg(F.count(F.lit(1))).scalar().alias("value"))
    body = F.struct("search_after", F.struct(total.alias("total"), "hits").alias("hits"))
    landed.select(copies, body.alias("body")).select(F.to_json("body")).write.text(path)
