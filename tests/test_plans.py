"""Plans keep what makes them run at scale."""

from __future__ import annotations

import re

import pytest

from plaintide.operators import filters
from plaintide.operators.quality import dq_report
from plaintide.operators.upsert import RANGE, RANGE_WIDTH, key_range, latest_per_key, merge_rows, touched_rows
from plaintide.plans import marts, models, serving
from plaintide.plans.layout import placed
from plaintide.plans.runs import check_models
from plaintide.session import scratch_dir
from plaintide.sources import bronze as bronze_layer
from plaintide.sources import pages, raw
from testbed import registry
from tests.conftest import SF_DIR
from tests.rows import bronze, complaint


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.fixture(scope="module")
def stored(spark):
    path = scratch_dir(spark, "stored")
    bronze(spark, [complaint(complaint_id=i) for i in range(10)]).write.parquet(path)
    return path


def relation(spark, stored):
    return models.int_complaint_metrics(models.stg_complaints(spark.read.parquet(stored)))


@pytest.mark.parametrize("name", marts.MARTS)
def test_marts_read_only_their_columns_once(spark, stored, name):
    text = plan(marts.MARTS[name](relation(spark, stored)))
    assert text.count("Scan parquet") == 2  # the tree and its detail: one scan
    assert "complaint_what_happened" not in text and "tags" not in text
    if name != "agg_complaints_by_month":  # its key is computed from the received time
        assert "PushedFilters: [IsNotNull(" in text


@pytest.mark.parametrize("name", marts.MARTS)
def test_marts_combine_before_each_shuffle(spark, stored, name):
    keys = re.findall(r"hashpartitioning\(([^)]*), \d+\)", plan(marts.MARTS[name](relation(spark, stored))))
    # the first exchange spreads a group by its values; only counted values go to one task per group
    assert "value#" in keys[0] and "value#" not in keys[1]
    assert len(keys) == (3 if name in ("dim_products", "dim_issues") else 2)


def test_top_n_is_a_bounded_sort(spark, stored):
    assert "TakeOrderedAndProject" in plan(serving.top_companies(marts.dim_companies(relation(spark, stored))))


def test_copies_are_dropped_before_the_shuffle(spark, stored):
    text = plan(latest_per_key(spark.read.parquet(stored)))
    assert text.index("WindowGroupLimit") < text.index("Exchange") < text.rindex("WindowGroupLimit")
    assert len(re.findall(r"^\(\d+\) WindowGroupLimit", text, re.M)) == 2


def test_a_merge_shuffles_its_rows_once(spark, stored):
    """One exchange by ranges of the key serves the copies of a key, the stored rows they replace, and the files."""
    text = plan(merge_rows(spark.read.parquet(stored), spark.read.parquet(stored)))
    assert re.findall(r"Arguments: (\w+)partitioning\(complaint_id", text) == ["range"]
    assert "Join" not in text


def test_dates_and_ranges_prune_files(spark):
    root = scratch_dir(spark, "prune")
    rows = bronze(spark, [complaint(complaint_id=i) for i in range(4)])
    dated = rows.selectExpr("*", "date_add(date'2026-01-01', cast(complaint_id as int)) AS process_date")
    bronze_layer.write_bronze(dated, root)
    text = plan(bronze_layer.scan_bronze(spark, root, "2026-01-02", "2026-01-03"))
    assert re.search(r"PartitionFilters: \[.*process_date.*2026-01-02", text)
    lines = raw.to_json_records(dated.drop("date_received", "date_sent_to_company", "extracted_at"), ["complaint_id"])
    raw.write_raw(lines.select("record", "process_date"), root + "-raw")
    assert "PartitionFilters: [isnotnull(process_date" in plan(raw.read_raw(spark, root + "-raw", "2026-01-02", "2026-01-02"))


def test_upsert_reads_the_touched_ranges(spark, warehouse):
    warehouse.upsert(bronze(spark, [complaint(complaint_id=1), complaint(complaint_id=5_000_000)]))
    table = spark.table(warehouse.name("raw", "complaints"))
    assert re.search(rf"PartitionFilters: \[.*{RANGE}#\d+L = 5", plan(table.filter(table[RANGE].isin([5]))))
    assert bronze(spark, [complaint(complaint_id=2_999_999)]).select(key_range()).collect()[0][0] == 2


def test_the_ranges_of_a_batch_prune_the_table(spark, warehouse):
    warehouse.upsert(bronze(spark, [complaint(complaint_id=k) for k in (1, 5_000_000, 9_000_000)]))
    batch = bronze(spark, [complaint(complaint_id=5_000_001)]).persist()
    batch.count()
    target = touched_rows(spark.table(warehouse.name("raw", "complaints")), batch, "complaint_id", RANGE_WIDTH)
    assert re.search(rf"PartitionFilters: \[.*dynamicpruning.*{RANGE}", plan(target))
    assert [r["complaint_id"] for r in target.collect()] == [5_000_000]
    batch.unpersist()


def test_the_rows_of_the_table_are_not_shuffled_for_the_ranges(spark, warehouse):
    warehouse.upsert(bronze(spark, [complaint(complaint_id=k) for k in (1, 5_000_000, 9_000_000)]))
    batch = bronze(spark, [complaint(complaint_id=5_000_001), complaint(complaint_id=2)])
    table, limit = spark.table(warehouse.name("raw", "complaints")), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = [plan(touched_rows(table, batch, "complaint_id", RANGE_WIDTH)), plan(placed(bronze(spark, [complaint(complaint_id=2)])))]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert all("BroadcastHashJoin" in text and "SortMergeJoin" not in text for text in joined)


def test_date_filters_reach_the_scan(spark, stored):
    rows = spark.read.parquet(stored)
    text = plan(filters.filter_received_range(rows, "2026-01-01", "2026-01-31"))
    pushed = re.search(r"PushedFilters: \[(.*)\]", text)[1]
    assert "GreaterThanOrEqual(date_received,2026-01-01" in pushed and "LessThan(date_received,2026-02-01" in pushed
    text = plan(filters.lookback_window(rows, "2026-04-01"))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(date_received,2026-01-01", text)


def test_a_run_reads_its_own_fetch_only(spark, tmp_path):
    one = pages.fetch_folder(str(tmp_path), "2026-07-11T02:00:00Z")
    for run in ("2026-07-11T02:00:00Z", "2026-07-12T02:00:00Z"):
        spark.createDataFrame([('{"hits":{}}',)], "value string").write.text(pages.fetch_folder(str(tmp_path), run))
    files = pages.read_pages(spark, one).inputFiles()
    assert files and all("run=20260711T020000Z" in f for f in files)


def test_staging_keys_are_counted_with_the_table(spark, stored):
    source = spark.read.parquet(stored)
    built = {"complaints": source, "stg_complaints": models.stg_complaints(source)}
    assert len(re.findall(r"^\(\d+\) Scan parquet", plan(check_models(built)), re.M)) == 1


def test_no_python_in_any_plan(spark):
    for name in ["dim_states", "dim_products", "kpi_header", "dq_report", "upsert_by_key", "sort_created"]:
        text = plan(registry.queries()[name](spark, SF_DIR))
        assert "Python" not in text and "CartesianProduct" not in text, name


def test_report_counts_a_key_once_per_model(spark, stored):
    text = plan(dq_report({"complaints": spark.read.parquet(stored)}))
    assert len(re.findall(r"^\(\d+\) Scan parquet", text, re.M)) == 1
