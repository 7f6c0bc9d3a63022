"""Whole runs: one day, a range of days, and the model build."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plaintide.functions.scalar import utc_date_sql
from plaintide.operators.ledger import WAS, cells, changed, counted, mart_of, tallied, within
from plaintide.operators.normalize import normalize_schema
from plaintide.operators.quality import clean_keys, dq_report
from plaintide.operators.upsert import RANGE, key_range
from plaintide.plans.marts import GROUPED
from plaintide.plans.models import METRICS, fct_complaints, int_complaint_metrics, staged_columns, stg_complaints
from plaintide.plans.serving import FRAMES
from plaintide.schemas import BRONZE
from plaintide.session import freed_shuffles
from plaintide.sources.bronze import scan_bronze, write_bronze
from plaintide.sources.files import children
from plaintide.sources.journal import Journal, fingerprints
from plaintide.sources.pages import (
    fetch_folder,
    flatten_pages,
    read_pages,
    reconcile_counts,
    stamp_extracted_at,
    with_process_date,
)
from plaintide.sources.raw import CHUNK_SIZE, PARTITION, dated, of_days, read_raw, write_raw
from plaintide.sources.versions import Manifest, new_folder, publish, version_at
from plaintide.sources.warehouse import COMPLAINTS, Warehouse

FACT = "fct_complaints"
VERSIONS = "_versions"
KEY_TYPES = {"complaint_month_date": "date"}
COUNTS = (
    "mart string, period date, k1 string, k2 string, source int, value string, days bigint, "
    "n bigint, timely bigint, timely_known bigint, narrative bigint, narrative_known bigint"
)
#: The groups by key range; `ranged` is their range, which the folder of a range does not tell its reader.
TALLIES, RANGED = "tallies", "ranged"
TALLIED = (
    f"{RANGED} bigint, period date, complaint_month_date date, company string, product string, state string, issue string, "
    "zip_code string, submitted_via string, company_response string, sub_product string, sub_issue string, "
    "days_to_response bigint, is_timely_response boolean, has_narrative boolean, date_received date, n bigint, was bigint"
)


@dataclass(frozen=True)
class Zones:
    """Root folders of the landed pages and the two file layers, and the codec of the raw files."""

    pages: str
    raw: str
    bronze: str
    compression: str = "none"


@dataclass(frozen=True)
class RunResult:
    """Counts of the fetch, load summary and check report: values, which later runs do not change."""

    reconciliation: DataFrame
    summary: DataFrame
    report: DataFrame


def values(df: DataFrame) -> DataFrame:
    """The few rows of a result, evaluated now."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def process_date(logical_date: Column) -> Column:
    """The day a run of `logical_date` handles: the day before."""
    return F.date_sub(logical_date.cast("date"), 1)


def land_raw(
    spark: SparkSession,
    zones: Zones,
    run_ts: str,
    first: str | None = None,
    last: str | None = None,
    chunk_size: int = CHUNK_SIZE,
) -> None:
    """Pages of the fetch of `run_ts` to raw JSON lines of the days `first` to `last`; None leaves a bound open.

    Records without a day go to `first`, or to the day of the run.
    """
    fetched = flatten_pages(read_pages(spark, fetch_folder(zones.pages, run_ts)))
    records = dated(with_process_date(fetched, undated=first or run_ts[:10]), first, last)
    write_raw(stamp_extracted_at(records, run_ts), zones.raw, chunk_size, zones.compression)


def raw_to_bronze(spark: SparkSession, zones: Zones, first: str | None = None, last: str | None = None) -> None:
    """Raw JSON lines to typed Parquet."""
    raw = read_raw(spark, zones.raw, first, last)
    write_bronze(normalize_schema(raw, keep=("process_date",)), zones.bronze)


def define_views(warehouse: Warehouse) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The stored table, and the staging and metric views over it as their layers' catalog objects."""
    source, name = warehouse.source_table(), warehouse.name
    columns = staged_columns(lambda column: utc_date_sql(source, column))
    staged = warehouse.create_view("staging", "stg_complaints", columns, name("raw", COMPLAINTS))
    metrics = warehouse.create_view("intermediate", "int_complaint_metrics", METRICS, name("staging", "stg_complaints"))
    return source, staged, metrics


def touched_ranges(before: dict[str, dict[str, str]], now: dict[str, str]) -> tuple[list[str], list[str]]:
    """Key ranges whose load is not the one their stored pieces were made from, and ranges that are no more."""
    fresh = [r for r, load in now.items() if before.get(r, {}).get("load") != load]
    return fresh, [r for r in before if r not in now]


def written(write: Callable[[str], None], names: Iterable[str]) -> None:
    """Small writes side by side: each alone would leave most of the cluster idle."""
    names = list(names)
    with ThreadPoolExecutor(len(names)) as pool:
        list(pool.map(write, names))


def tallies(spark: SparkSession, parts: Iterable[dict[str, str]]) -> DataFrame | None:
    """The stored groups of key ranges, without those that are no more; None if none are stored."""
    paths = [p[TALLIES] for p in parts if TALLIES in p]
    return spark.read.schema(TALLIED).parquet(*paths).filter("n > 0") if paths else None


def earlier_counts(spark: SparkSession, parts: Iterable[dict[str, str]]) -> DataFrame | None:
    """The cells by month that versions of before there were groups have stored of key ranges; None if none are."""
    paths = [p["counts"] for p in parts if "counts" in p]
    return spark.read.schema(COUNTS).parquet(*paths) if paths else None


def build_models(warehouse: Warehouse, run_ts: str | None = None) -> dict[str, DataFrame]:
    """Define the two views, bring the fact table and the marts up to date, and publish all seven at once.

    Only key ranges that a load has replaced since the last version are scanned: once for the groups of complaints that all
    marts count, and once for their part of the fact table. Groups whose number has changed since that version change
    the totals, which have no months; the marts are made from the new totals.
    """
    spark, root = warehouse.spark, warehouse.path("marts", VERSIONS)
    source, staged, _ = define_views(warehouse)
    last = version_at(spark, root) or Manifest("")
    now = warehouse.ranges()
    fresh, gone = touched_ranges(last.parts, now)
    folder = new_folder(root)
    rows = warehouse.range_rows(fresh)
    metrics = int_complaint_metrics(stg_complaints(rows)).withColumn(RANGE, key_range())
    before = tallies(spark, [last.parts[r] for r in fresh if r in last.parts])
    groups = tallied(metrics.withColumn(RANGED, F.col(RANGE)), GROUPED, [RANGED], before).withColumn(RANGE, F.col(RANGED))
    pieces = {TALLIES: groups, FACT: fct_complaints(metrics).withColumn(RANGE, key_range())}
    with freed_shuffles(spark):
        written(lambda step: pieces[step].write.partitionBy(RANGE).parquet(f"{folder}/{step}"), pieces)
    # A range without rows has no facts.
    made = {step: set(children(spark, f"{folder}/{step}")) for step in pieces}

    parts = {r: p for r, p in last.parts.items() if r in now and r not in fresh}
    for r in fresh:
        parts[r] = {"load": now[r]} | {step: f"{folder}/{step}/{RANGE}={r}" for step in made if f"{RANGE}={r}" in made[step]}
    number = [F.expr(f"n - {WAS}").alias("n")]
    come = spark.read.schema(TALLIED).parquet(f"{folder}/{TALLIES}")
    come = come.select(*[c for c in come.columns if c not in ("n", WAS)], *number).filter("n <> 0")
    lost = tallies(spark, [last.parts[r] for r in gone])
    if lost is not None:
        come = come.unionByName(lost.select(*[c for c in come.columns if c != "n"], (-F.col("n")).alias("n")))
    old = spark.read.schema(COUNTS).parquet(last.tables["totals"]) if "totals" in last.tables else None
    taken = earlier_counts(spark, [last.parts[r] for r in [*fresh, *gone] if r in last.parts])
    tables = {name: f"{folder}/{name}" for name in ["totals", *GROUPED]}

    def build(name: str) -> None:
        """The totals of one mart, and the mart."""
        own = [None if df is None else df.filter(F.col("mart") == name) for df in (old, taken)]
        totals = changed(own[0], cells(come, {name: GROUPED[name]}), own[1])
        path = f"{tables['totals']}/mart={name}"
        totals.drop("mart").write.parquet(path)
        stored = spark.read.schema(COUNTS).option("basePath", tables["totals"]).parquet(path)
        mart_of(stored, name, GROUPED[name], KEY_TYPES).write.parquet(tables[name])

    with freed_shuffles(spark):
        written(build, GROUPED)
    manifest = publish(spark, root, folder, Manifest(run_ts or last.run_ts, tables, parts))
    warehouse.point_marts(manifest, list(GROUPED), FACT)
    return {"complaints": source, "stg_complaints": staged, **frames_of(warehouse, manifest)}


def frames_of(warehouse: Warehouse, manifest: Manifest) -> dict[str, DataFrame]:
    """The fact table and the marts of one version."""
    spark = warehouse.spark
    facts = [p[FACT] for p in manifest.parts.values() if FACT in p]
    empty = fct_complaints(int_complaint_metrics(stg_complaints(warehouse.range_rows([]))))
    found = {FACT: spark.read.schema(empty.schema).parquet(*facts) if facts else empty}
    return found | {name: spark.read.parquet(manifest.tables[name]) for name in GROUPED}


def rebuild_models(warehouse: Warehouse, run_ts: str | None = None) -> dict[str, DataFrame]:
    """The same from the whole table, whatever the versions before hold."""
    spark, root = warehouse.spark, warehouse.path("marts", VERSIONS)
    publish(spark, root, new_folder(root), Manifest(run_ts or ""))
    return build_models(warehouse, run_ts)


def marts_between(
    warehouse: Warehouse,
    first: str | None,
    last: str | None,
    as_of: str | None = None,
) -> dict[str, DataFrame]:
    """The marts of the complaints received in the months `first` to `last`, as if there were no others.

    They are made from the groups of those months that are stored by key range; neither the table nor the fact table is read.
    With both bounds open they are the published marts. Counts stored before there were months have none: `rebuild_models`
    gives them theirs.
    """
    spark = warehouse.spark
    manifest = version_at(spark, warehouse.path("marts", VERSIONS), as_of)
    if manifest is None or not manifest.tables:
        raise LookupError(f"no marts were published up to {as_of or 'now'}")
    groups, earlier = tallies(spark, manifest.parts.values()), earlier_counts(spark, manifest.parts.values())
    stored = within(spark.createDataFrame([], TALLIED) if groups is None else groups, first, last)

    def mart(name: str) -> DataFrame:
        counts = counted(stored, {name: GROUPED[name]})
        if earlier is not None:
            counts = changed(within(earlier, first, last).filter(F.col("mart") == name), counts)
        return mart_of(counts, name, GROUPED[name], KEY_TYPES)

    return {name: mart(name) for name in GROUPED}


#: The staging view is a projection of the table, so one count of the keys serves both.
PROJECTIONS = {"stg_complaints": "complaints"}


def check_models(models: dict[str, DataFrame]) -> DataFrame:
    """The declared checks."""
    return dq_report(models, PROJECTIONS)


def checked(models: dict[str, DataFrame]) -> DataFrame:
    """The same as values; the keys are shuffled only where they repeat."""
    return values(dq_report(models, PROJECTIONS, clean_keys(models, PROJECTIONS)))


def run_backfill(
    warehouse: Warehouse,
    zones: Zones,
    first: str | None,
    last: str | None,
    run_ts: str,
    chunk_size: int = CHUNK_SIZE,
) -> RunResult:
    """One fetch to checked marts for all days of a range, as one job per step and not one per day.

    The fetch is the pages below `fetch_folder(zones.pages, run_ts)`. Running it again replaces the same files
    and rows. A day without records changes nothing.
    """
    spark = warehouse.spark
    fetched = values(reconcile_counts(read_pages(spark, fetch_folder(zones.pages, run_ts))))
    land_raw(spark, zones, run_ts, first, last, chunk_size)
    raw_to_bronze(spark, zones, first, last)
    processed = warehouse.upsert(scan_bronze(spark, zones.bronze, first, last))
    summary = warehouse.load_summary(processed)
    return RunResult(fetched, summary, checked(build_models(warehouse, run_ts)))


def resume_backfill(
    warehouse: Warehouse,
    zones: Zones,
    first: str | None,
    last: str | None,
    run_ts: str,
    chunk_size: int = CHUNK_SIZE,
) -> RunResult:
    """A backfill that goes on where an earlier call for the same fetch was stopped.

    Each step records the days it has finished with a fingerprint of the fetched records, and leaves out days whose
    records are those it was finished with. So a call after a stop does what is left, one after a correction of the
    landed pages the days that changed, and one after neither of them nothing but the checks. A step that was stopped
    is done again for its open days, which replaces the same files and rows. The summary counts the rows loaded by
    this call. Days that are no longer fetched stay as they are, as with `run_backfill`.
    """
    spark = warehouse.spark
    pages = read_pages(spark, fetch_folder(zones.pages, run_ts))
    fetched = dated(with_process_date(flatten_pages(pages), undated=first or run_ts[:10]), first, last)
    prints, reconciled = fingerprints(fetched), values(reconcile_counts(pages))
    journal = Journal(spark, fetch_folder(f"{zones.raw.rstrip('/')}/_journal", run_ts))
    processed = 0

    def load(days: list[str]) -> None:
        nonlocal processed
        bronze = spark.read.schema(T.StructType([*BRONZE.fields, PARTITION])).parquet(zones.bronze)
        processed = warehouse.upsert(of_days(bronze, days).drop("process_date"))

    steps = {
        "raw": lambda days: write_raw(stamp_extracted_at(of_days(fetched, days), run_ts), zones.raw, chunk_size, zones.compression),
        "bronze": lambda days: write_bronze(normalize_schema(of_days(read_raw(spark, zones.raw), days), keep=("process_date",)), zones.bronze),
        "load": load,
    }
    for step, work in steps.items():
        days = journal.open_days(step, prints)
        if days:
            work(days)
            journal.finish(step, {day: prints[day] for day in days})
    warehouse.create_if_absent()
    return RunResult(reconciled, warehouse.load_summary(processed), checked(build_models(warehouse, run_ts)))


def run_daily(
    warehouse: Warehouse,
    zones: Zones,
    logical_date: str,
    run_ts: str,
    chunk_size: int = CHUNK_SIZE,
) -> RunResult:
    """The same for the day before `logical_date`."""
    day = (date.fromisoformat(logical_date) - timedelta(days=1)).isoformat()
    return run_backfill(warehouse, zones, day, day, run_ts, chunk_size)


def read_marts(warehouse: Warehouse, as_of: str | None = None) -> dict[str, DataFrame]:
    """The serving frames of one version, cached: each is a mart or one row, not the complaints.

    The version is the latest, or the one that the runs up to the time `as_of` left.
    """
    manifest = version_at(warehouse.spark, warehouse.path("marts", VERSIONS), as_of)
    if manifest is None or not manifest.tables:
        raise LookupError(f"no marts were published up to {as_of or 'now'}")
    found = frames_of(warehouse, manifest)
    return {name: query(found[model]).cache() for name, (model, query) in FRAMES.items()}
