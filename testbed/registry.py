"""Registered queries: every operator over the driver's whole tables.

The file layers (pages, raw, bronze, warehouse table) are written to the session's scratch folder the
first time a query of an application needs them; queries about one layer then read that layer, as a
run's later steps would.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plaintide.functions.scalar import utc_wall
from plaintide.operators import filters, merge_on_read, quality, relevance
from plaintide.operators.normalize import normalize_schema
from plaintide.plans import layout, marts, models, runs, serving
from plaintide.session import scratch_dir
from plaintide.sources import bronze, chain, files, pages, raw
from plaintide.sources.warehouse import COMPLAINTS, Warehouse, schema_for_layer
from plaintide.streaming.incremental import incremental_upsert, refresh_recent
from testbed import shape
from testbed.oracle import COMPANY, EARLIER_TS, FIRST, LAST, LOGICAL_DATE, MISSING, RUN_DATE, SEARCH, TOP, RUN_TS

Query = Callable[[SparkSession, str], DataFrame]

def shared_scratch(spark: SparkSession, label: str) -> str:
    """A scratch folder; a local session without a shared folder gets one of its own first."""
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.master.startswith("local["):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="testbed-"))
    return scratch_dir(spark, label)


def plain_times(df: DataFrame) -> DataFrame:
    """Instants shown as UTC wall-clock time, so a result reads the same in every session time zone."""
    instants = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({name: utc_wall(F.col(name)) for name in instants})


def new_warehouse(spark: SparkSession, label: str) -> Warehouse:
    root = shared_scratch(spark, label)
    return Warehouse(spark, root, root.rsplit("/", 1)[1].replace("-", "_") + "_")


class Layers:
    """Stored layers of one table set in one application."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        root = shared_scratch(spark, "layers")
        self.zones = runs.Zones(f"{root}/pages", f"{root}/raw", f"{root}/bronze", "gzip")
        self._done: set[str] = set()

    def _once(self, step: str, write: Callable[[], None]) -> None:
        if step not in self._done:
            write()
            self._done.add(step)

    def pages(self) -> str:
        fetch = pages.fetch_folder(self.zones.pages, RUN_TS)
        self._once("pages", lambda: shape.land_pages(shape.complaint_lots(self.spark, self.sf_dir), fetch))
        return fetch

    def raw(self) -> str:
        self.pages()
        self._once("raw", lambda: runs.land_raw(self.spark, self.zones, RUN_TS))
        return self.zones.raw

    def bronze(self) -> str:
        self.raw()
        self._once("bronze", lambda: runs.raw_to_bronze(self.spark, self.zones))
        return self.zones.bronze

    def batch(self) -> DataFrame:
        return bronze.scan_bronze(self.spark, self.bronze())


_stored: dict[tuple[str, str], Layers] = {}


def layers(spark: SparkSession, sf_dir: str) -> Layers:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stored:
        _stored[key] = Layers(spark, sf_dir)
    return _stored[key]


def metrics(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The metric relation of the given columns, with the ones every statistic uses."""
    shared = ["complaint_id", "timely", "has_narrative", "date_received", "date_sent_to_company"]
    return shape.metrics(spark, sf_dir, [*shared, *columns] if columns else None)


def on_complaints(build: Callable[[DataFrame], DataFrame], *columns: str) -> Query:
    return lambda spark, sf_dir: build(shape.complaints(spark, sf_dir, columns or None))


def on_metrics(build: Callable[[DataFrame], DataFrame], *columns: str) -> Query:
    return lambda spark, sf_dir: build(metrics(spark, sf_dir, *columns))


# Source tables

def flatten_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.parse_records(pages.flatten_pages(pages.read_pages(spark, layers(spark, sf_dir).pages())))


def reconcile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole fetch, and one that was cut short. The short one is counted, as in a run, and gone before the whole one is landed."""

    def counts(name: str, path: str) -> DataFrame:
        return pages.reconcile_counts(pages.read_pages(spark, path)).select(F.lit(name).alias("fetch"), "*")

    root = shared_scratch(spark, "short")
    try:
        fetch = pages.fetch_folder(root, RUN_TS)
        shape.land_pages(shape.complaint_lots(spark, sf_dir), fetch, MISSING)
        short = runs.values(counts("short", fetch))
    finally:
        files.delete(spark, root)
    return counts("whole", layers(spark, sf_dir).pages()).unionByName(short)


def broken_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages of a fetch that lost some and has others twice or in part."""
    fetch = pages.fetch_folder(shared_scratch(spark, "chain"), RUN_TS)
    shape.land_chain(shape.complaints(spark, sf_dir, ["complaint_id"]), fetch)
    return pages.read_pages(spark, fetch)


def chain_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chain.chain_findings(broken_chain(spark, sf_dir), descending=False, width=50_000)


def reconcile_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chain.reconcile_chain(broken_chain(spark, sf_dir), descending=False, width=50_000)


def indexed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """Records with a text of several fields, and their index after a load of other texts and one that replaces most."""
    location, rows = shared_scratch(spark, "index"), normalize_schema(shape.complaints(spark, sf_dir))
    rows = rows.withColumn(relevance.TEXT, F.concat_ws(" ", relevance.TEXT, "issue", "state", "tags"))
    relevance.update(rows.withColumn(relevance.TEXT, F.when(F.col("complaint_id") % 3 == 0, F.col(relevance.TEXT)).otherwise(F.col("product"))), location)
    relevance.update(rows.filter("complaint_id % 3 <> 0"), location)
    return rows, location


def sort_relevance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, location = indexed(spark, sf_dir)
    found = relevance.sort_relevance(rows.select("complaint_id", "company"), location, SEARCH)
    return found.withColumn("score", F.round("score", 6))


def top_relevant(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, location = indexed(spark, sf_dir)
    return relevance.search(spark, location, SEARCH, k=TOP).withColumn("score", F.round("score", 6))


def stamp_extracted_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = pages.flatten_pages(pages.read_pages(spark, layers(spark, sf_dir).pages()))
    return pages.parse_records(pages.stamp_extracted_at(records, RUN_TS)).select("complaint_id", "extracted_at")


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.option("wholetext", False).text(layers(spark, sf_dir).raw())


def chunk_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months as process dates, in files of at most half the records of the largest one."""
    lines = raw_lines(spark, sf_dir).select(F.col("value").alias("record"), F.trunc("process_date", "month").alias("process_date"))
    largest = lines.groupBy("process_date").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    root, size = shared_scratch(spark, "chunks"), max(1, largest // 2)
    raw.write_raw(lines, root, size, "gzip")
    chunks = spark.read.text(root).groupBy("process_date", "_metadata.file_path").agg(F.count(F.lit(1)).alias("n"))
    days = chunks.groupBy("process_date").agg(F.sum("n").alias("n"), F.max("n").alias("largest"))
    return days.agg(
        F.sum("n").alias("records"),
        (F.max("n") > size).alias("a_day_exceeds_it"),
        (F.max("largest") <= size).alias("within_chunk_size"),
    )


def write_raw_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = raw_lines(spark, sf_dir).withColumnRenamed("value", "record")
    return lines.select(
        pages.json_field("complaint_id").alias("complaint_id"),
        pages.json_field("sub_product").alias("sub_product"),
        "process_date",
        F.contains("record", F.lit('"sub_product":null')).alias("null_is_written"),
    )


def raw_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_lines(spark, sf_dir).groupBy("process_date").agg(F.count(F.lit(1)).alias("records"))


def read_raw_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw.read_raw(spark, layers(spark, sf_dir).raw()).drop("process_date")


def write_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(layers(spark, sf_dir).bronze())
    return rows.groupBy("process_date").agg(
        F.count(F.lit(1)).alias("records"), F.sum(F.col("has_narrative").cast("int")).alias("narratives")
    )


def scan_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_times(bronze.scan_bronze(spark, layers(spark, sf_dir).bronze(), FIRST, LAST))


# Warehouse

def create_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = new_warehouse(spark, "create")
    warehouse.create_if_absent()
    warehouse.upsert(normalize_schema(shape.complaints(spark, sf_dir)))
    warehouse.create_if_absent()
    source = warehouse.source_table()
    exists = quality.dq_table_exists(spark, warehouse.name("raw", COMPLAINTS), source)
    return exists.withColumn("n_columns", F.lit(len(source.columns)))


def upsert_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = new_warehouse(spark, "upsert")
    versions = shape.raw_versions(spark, sf_dir)
    for batch in ("A", "N", "R"):
        warehouse.upsert(normalize_schema(versions.filter(F.col("submitted_via") == batch)))
    return plain_times(warehouse.source_table())


def upsert_merge_on_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same batches by deletion vectors, with a compaction between two of them."""
    location, versions = shared_scratch(spark, "merge"), shape.raw_versions(spark, sf_dir)
    for batch in ("A", "N", "R"):
        merge_on_read.merge(spark, normalize_schema(versions.filter(F.col("submitted_via") == batch)), location)
        if batch == "N":
            merge_on_read.compact(spark, location)
    return plain_times(merge_on_read.read(spark, location))


def load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = new_warehouse(spark, "summary")
    return warehouse.load_summary(warehouse.upsert(layers(spark, sf_dir).batch()))


def source_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = new_warehouse(spark, "source")
    warehouse.upsert(layers(spark, sf_dir).batch())
    return plain_times(warehouse.source_table())


def materialize(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = marts.dim_companies(metrics(spark, sf_dir, "company"))
    return new_warehouse(spark, "materialize").materialize("marts", "dim_companies", mart)


def layer_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = new_warehouse(spark, "layer")
    mart = marts.agg_complaints_by_month(metrics(spark, sf_dir, "company", "product", "state"))
    warehouse.materialize("marts", "agg_complaints_by_month", mart)
    return spark.table(f"{warehouse.prefix}{schema_for_layer('marts')}.agg_complaints_by_month")


def process_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    logical = F.col("o_orderdate").cast("date")
    days = shape.table(spark, sf_dir, "orders").groupBy(logical.alias("logical_date")).agg(F.count(F.lit(1)).alias("runs"))
    return days.withColumn("process_date", runs.process_date(F.col("logical_date")))


def backfilled(spark: SparkSession, sf_dir: str, label: str) -> tuple[Warehouse, runs.RunResult]:
    stored = layers(spark, sf_dir)
    root = shared_scratch(spark, label)
    stored.pages()
    zones = runs.Zones(stored.zones.pages, f"{root}/raw", f"{root}/bronze", "gzip")
    warehouse = new_warehouse(spark, label)
    return warehouse, runs.run_backfill(warehouse, zones, None, None, RUN_TS)


def run_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backfilled(spark, sf_dir, "backfill")[1].summary


def resume_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backfill of some days, and one of all days of the same fetch, which does what is left."""
    stored, root, warehouse = layers(spark, sf_dir), shared_scratch(spark, "resume"), new_warehouse(spark, "resume")
    stored.pages()
    zones = runs.Zones(stored.zones.pages, f"{root}/raw", f"{root}/bronze", "gzip")
    calls = [runs.resume_backfill(warehouse, zones, *days, RUN_TS).summary for days in ((FIRST, LAST), (None, None))]
    return calls[0].withColumn("call", F.lit(1)).unionByName(calls[1].withColumn("call", F.lit(2)))


def find_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A company's records of some days by the layout, after a load of other rows, a refresh, and a load that replaces."""
    warehouse, rows = new_warehouse(spark, "layout"), normalize_schema(shape.complaints(spark, sf_dir))
    warehouse.upsert(rows.filter("complaint_id % 2 = 0").withColumn("company", F.lit(COMPANY)))
    layout.refresh_layout(warehouse)
    warehouse.upsert(rows)
    layout.refresh_layout(warehouse)
    return plain_times(layout.find(warehouse, COMPANY, FIRST, LAST))


def run_correction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day fetched twice: the later fetch corrects the earlier one, each run reads its own pages."""
    root, warehouse = shared_scratch(spark, "correction"), new_warehouse(spark, "correction")
    zones = runs.Zones(f"{root}/pages", f"{root}/raw", f"{root}/bronze", "gzip")
    day = runs.process_date(F.lit(LOGICAL_DATE))
    rows = shape.complaints(spark, sf_dir).filter(F.to_date("date_received") == day)
    shape.land_pages(rows.withColumn("company", F.lit("Old")), pages.fetch_folder(zones.pages, EARLIER_TS))
    runs.run_daily(warehouse, zones, LOGICAL_DATE, EARLIER_TS)
    shape.land_pages(rows, pages.fetch_folder(zones.pages, RUN_TS))
    runs.run_daily(warehouse, zones, LOGICAL_DATE, RUN_TS)
    return plain_times(warehouse.source_table())


def view(layer: str, model: str) -> Query:
    """A view read by its layer's name."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        warehouse = new_warehouse(spark, layer)
        warehouse.upsert(layers(spark, sf_dir).batch())
        runs.define_views(warehouse)
        return plain_times(spark.table(f"{warehouse.prefix}{schema_for_layer(layer)}.{model}"))

    return query


def listed(mart: str, *inputs: str) -> Query:
    """A mart in its stored order, with the position of each row in it."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = marts.listed(mart, marts.MARTS[mart](metrics(spark, sf_dir, *inputs)))
        placed = rows.withColumn("place", F.monotonically_increasing_id())
        return placed.withColumn("position", F.row_number().over(Window.orderBy("place")).cast("long")).drop("place")

    return query


def refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A re-extraction of all records: those of the lookback window are replaced, older ones stay."""
    warehouse, rows = new_warehouse(spark, "refresh"), shape.complaints(spark, sf_dir)
    warehouse.upsert(normalize_schema(rows))
    refresh_recent(warehouse, rows.withColumn("tags", F.lit("refreshed")), RUN_DATE)
    return plain_times(warehouse.source_table())


def run_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day on top of a loaded table: its summary, counts of the fetch, and check report."""
    stored = layers(spark, sf_dir)
    warehouse = new_warehouse(spark, "daily")
    warehouse.upsert(stored.batch())
    root = shared_scratch(spark, "daily")
    stored.pages()
    zones = runs.Zones(stored.zones.pages, f"{root}/raw", f"{root}/bronze", "gzip")
    run = runs.run_daily(warehouse, zones, LOGICAL_DATE, RUN_TS)
    counts = ["records_processed", "total_records_in_table"]
    checks = run.report.select(F.concat_ws(".", "model", "column_name", "test").alias("part"), F.col("failures").alias("n"))
    found = [(run.summary, counts), (run.reconciliation, ["expected", "actual"])]
    for frame, names in found:
        checks = checks.unionByName(frame.select(*names).unpivot([], names, "part", "n"))
    return checks


def read_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = new_warehouse(spark, "marts")
    warehouse.upsert(normalize_schema(shape.complaints(spark, sf_dir)))
    runs.build_models(warehouse)
    counts = [
        frame.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("frame"), "n_rows")
        for name, frame in runs.read_marts(warehouse).items()
    ]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionByName(count)
    return result


def marts_after_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The states mart after a load of other rows, a version of the marts, and a load that replaces and adds."""
    warehouse, rows = new_warehouse(spark, "change"), normalize_schema(shape.complaints(spark, sf_dir))
    other = {"company": F.lit("Other"), "timely": F.lit("No"), "state": F.lit("ZZ"), "issue": F.concat("issue", F.lit("?"))}
    warehouse.upsert(rows.filter("complaint_id % 3 <> 0").withColumns(other))
    runs.build_models(warehouse, EARLIER_TS)
    warehouse.upsert(rows)
    return runs.build_models(warehouse, RUN_TS)["dim_states"]


def read_marts_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The companies frame as an earlier run left it, after a later run changed it."""
    warehouse, rows = new_warehouse(spark, "as_of"), normalize_schema(shape.complaints(spark, sf_dir))
    warehouse.upsert(rows)
    runs.build_models(warehouse, EARLIER_TS)
    warehouse.upsert(rows.filter("complaint_id % 2 = 0").withColumn("company", F.lit("Other")))
    runs.build_models(warehouse, RUN_TS)
    return runs.read_marts(warehouse, as_of=EARLIER_TS)["companies"]


def between(frame: Callable[[dict[str, DataFrame]], DataFrame]) -> Query:
    """From the marts of some months, after a load that replaces rows of those months and others."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        warehouse, rows = new_warehouse(spark, "between"), normalize_schema(shape.complaints(spark, sf_dir))
        moved = F.col("date_received") + F.expr("INTERVAL 400 DAYS")
        warehouse.upsert(rows.filter("complaint_id % 2 = 0").withColumns({"date_received": moved, "state": F.lit("ZZ")}))
        runs.build_models(warehouse, EARLIER_TS)
        warehouse.upsert(rows)
        runs.build_models(warehouse, RUN_TS)
        return frame(runs.marts_between(warehouse, FIRST, LAST))

    return query


# Loads and checks

def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = new_warehouse(spark, "stream")
    warehouse.create_if_absent()
    stream = incremental_upsert(warehouse, layers(spark, sf_dir).raw(), shared_scratch(spark, "stream-checkpoint"))
    stream.awaitTermination()
    return plain_times(warehouse.source_table())


def table_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = new_warehouse(spark, "exists")
    mart = marts.dim_companies(metrics(spark, sf_dir, "company"))
    stored = warehouse.materialize("marts", "dim_companies", mart)
    there = quality.dq_table_exists(spark, warehouse.name("marts", "dim_companies"), stored)
    return there.unionByName(quality.dq_table_exists(spark, warehouse.name("marts", "dim_company"), stored))


def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = shape.complaints(spark, sf_dir, ["complaint_id"], shape.table(spark, sf_dir, "lineitem"))
    return quality.dq_unique(versions, "complaint_id")


def dq_key_unique_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = shape.complaints(spark, sf_dir, ["complaint_id"], shape.table(spark, sf_dir, "lineitem"))
    return quality.dq_key_unique_ratio(versions)


def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models of which some are broken: keys that repeat, a mart twice, a month that is NULL, a mart that is missing."""
    versions = shape.complaints(spark, sf_dir, ["complaint_id"], shape.table(spark, sf_dir, "lineitem"))
    relation = models.int_complaint_metrics(models.stg_complaints(shape.complaints(spark, sf_dir)))
    built = {name: build(relation) for name, build in marts.MARTS.items() if name != "dim_states"}
    built["dim_companies"] = built["dim_companies"].unionByName(built["dim_companies"])
    months = built["agg_complaints_by_month"].select("complaint_month_date")
    built["agg_complaints_by_month"] = months.union(spark.range(1).select(F.lit(None).cast("date")))
    base = {"complaints": versions, "stg_complaints": versions, "fct_complaints": models.fct_complaints(relation)}
    return runs.check_models({**base, **built})


def has_rows(complaints: DataFrame) -> DataFrame:
    parts = {"all": complaints, "none": complaints.filter("complaint_id < 0")}
    found = [quality.dq_has_rows(rows).select(F.lit(name).alias("part"), "*") for name, rows in parts.items()]
    return found[0].unionByName(found[1])


MONTH = ("company", "product", "state")
COMPANY_COLUMNS = ("company",)
STATE = ("state", "company", "product", "issue", "zip_code", "submitted_via")
RESPONSE = ("company_response", "company", "product", "state", "issue")
PRODUCT = ("product", "sub_product", "company", "state", "issue")
ISSUE = ("issue", "sub_issue", "company", "product", "state")


def served(frame: Callable[[DataFrame], DataFrame], mart: Callable[[DataFrame], DataFrame], *columns: str) -> Query:
    return lambda spark, sf_dir: frame(mart(metrics(spark, sf_dir, *columns)))


def not_null(column: str, *inputs: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return filters.not_null(metrics(spark, sf_dir, *inputs), column).select("complaint_id", column)

    return query


def queries() -> dict[str, Query]:
    product_totals = lambda m: marts.product_totals(marts.product_stats(m))
    issue_totals = lambda m: marts.issue_totals(marts.issue_stats(m))
    coverage = lambda m: serving.dash_coverage(models.fct_complaints(m))
    return {
        # sources, sinks, table lifecycle
        "flatten_pages": flatten_pages,
        "filter_received_range": on_complaints(lambda c: filters.filter_received_range(c, FIRST, LAST)),
        "filter_company": on_complaints(lambda c: filters.filter_company(c, COMPANY)),
        "find_company": find_company,
        "sort_created": on_complaints(filters.sort_created, "complaint_id", "date_received", "company", "product"),
        "chunk_records": chunk_records,
        "sort_relevance": sort_relevance,
        "top_relevant": top_relevant,
        "reconcile_counts": reconcile_counts,
        "chain_findings": chain_findings,
        "reconcile_chain": reconcile_chain,
        "stamp_extracted_at": stamp_extracted_at,
        "write_raw_jsonl": write_raw_jsonl,
        "raw_path": raw_path,
        "read_raw_jsonl": read_raw_jsonl,
        "write_bronze": write_bronze,
        "scan_bronze": scan_bronze,
        "create_if_absent": create_if_absent,
        "upsert_by_key": upsert_by_key,
        "upsert_merge_on_read": upsert_merge_on_read,
        "load_summary": load_summary,
        "materialize": materialize,
        "schema_for_layer": layer_table,
        "source_table": source_table,
        "process_date": process_date,
        "run_correction": run_correction,
        "staging_view": view("staging", "stg_complaints"),
        "metric_view": view("intermediate", "int_complaint_metrics"),
        "run_daily": run_daily,
        "run_backfill": run_backfill,
        "resume_backfill": resume_backfill,
        "read_marts": read_marts,
        "marts_after_change": marts_after_change,
        "read_marts_as_of": read_marts_as_of,
        "states_between": between(lambda found: found["dim_states"]),
        "products_between": between(lambda found: found["dim_products"]),
        # projections and predicates
        "normalize_schema": on_complaints(lambda c: plain_times(normalize_schema(c))),
        "stg_complaints": on_complaints(models.stg_complaints),
        "int_complaint_metrics": on_metrics(lambda m: m),
        "fct_complaints": on_metrics(models.fct_complaints),
        "not_null_company": not_null("company", "company"),
        "not_null_month": not_null("complaint_month_date"),
        "not_null_issue": not_null("issue", "issue"),
        "not_null_product": not_null("product", "product"),
        "not_null_response": not_null("company_response", "company_response"),
        "not_null_state": not_null("state", "state"),
        "is_rollup_row": served(lambda m: filters.rollup_rows(m, "sub_product"), marts.dim_products, *PRODUCT),
        "is_leaf_row": served(lambda m: filters.leaf_rows(m, "sub_product"), marts.dim_products, *PRODUCT),
        # marts
        "agg_complaints_by_month": on_metrics(marts.agg_complaints_by_month, *MONTH),
        "dim_companies": on_metrics(marts.dim_companies, *COMPANY_COLUMNS),
        "dim_states": on_metrics(marts.dim_states, *STATE),
        "dim_response_types": on_metrics(marts.dim_response_types, *RESPONSE),
        "product_stats": on_metrics(marts.product_stats, *PRODUCT),
        "product_totals": on_metrics(product_totals, *PRODUCT),
        "dim_products": on_metrics(marts.dim_products, *PRODUCT),
        "issue_stats": on_metrics(marts.issue_stats, *ISSUE),
        "issue_totals": on_metrics(issue_totals, *ISSUE),
        "dim_issues": on_metrics(marts.dim_issues, *ISSUE),
        "listed_months": listed("agg_complaints_by_month", *MONTH),
        "listed_states": listed("dim_states", *STATE),
        "listed_products": listed("dim_products", *PRODUCT),
        # serving
        "dash_monthly": served(serving.dash_monthly, marts.agg_complaints_by_month, *MONTH),
        "dash_companies": served(serving.dash_companies, marts.dim_companies, *COMPANY_COLUMNS),
        "dash_states": served(serving.dash_states, marts.dim_states, *STATE),
        "dash_products": served(serving.dash_products, marts.dim_products, *PRODUCT),
        "dash_issues": served(serving.dash_issues, marts.dim_issues, *ISSUE),
        "dash_responses": served(serving.dash_responses, marts.dim_response_types, *RESPONSE),
        "dash_coverage": on_metrics(coverage, *MONTH),
        "monthly_trend": served(serving.monthly_trend, marts.agg_complaints_by_month, *MONTH),
        "top_companies": served(serving.top_companies, marts.dim_companies, *COMPANY_COLUMNS),
        "top_products": served(serving.top_products, marts.dim_products, *PRODUCT),
        "top_issues": served(serving.top_issues, marts.dim_issues, *ISSUE),
        "product_mix": served(serving.product_mix, marts.dim_products, *PRODUCT),
        "product_mix_parent": served(serving.product_mix_parent, marts.dim_products, *PRODUCT),
        "top_states": served(serving.top_states, marts.dim_states, *STATE),
        "response_outcomes": served(serving.response_outcomes, marts.dim_response_types, *RESPONSE),
        "kpi_header": served(serving.kpi_header, coverage, *MONTH),
        # incremental loads
        "incremental_upsert": stream_upsert,
        "refresh_recent": refreshed,
        "lookback_window": on_complaints(lambda c: plain_times(normalize_schema(filters.lookback_window(c, RUN_DATE)))),
        # checks
        "dq_unique": dq_unique,
        "dq_not_null": on_complaints(
            lambda c: quality.dq_not_null(c, c.columns), "complaint_id", "sub_product", "sub_issue", "timely", "tags"
        ),
        "dq_table_exists": table_exists,
        "dq_required_columns": on_complaints(
            quality.dq_required_columns, "complaint_id", "company", "product", "date_received"
        ),
        "dq_has_rows": on_complaints(has_rows, "complaint_id"),
        "dq_key_unique_ratio": dq_key_unique_ratio,
        "dq_sample_required": on_complaints(
            quality.dq_sample_required, "complaint_id", "company", "product", "issue", "date_received"
        ),
        "dq_valid_ratio": on_complaints(lambda c: quality.dq_valid_ratio(c, "timely"), "complaint_id", "timely"),
        "dq_report": dq_report,
    }
