from __future__ import annotations

import glob
import json
import os
import re
import time

import pytest
from pyspark.sql import functions as F

from plaintide.operators import filters
from plaintide.operators.normalize import normalize_schema
from plaintide.plans import runs
from plaintide.plans.models import int_complaint_metrics, stg_complaints
from plaintide.schemas import BRONZE
from plaintide.session import FREED, PARTS, scratch_dir, store_parts
from plaintide.sources import bronze as bronze_layer
from plaintide.sources import pages, raw
from plaintide.sources.journal import fingerprints
from plaintide.sources.warehouse import schema_for_layer
from testbed import registry, shape
from testbed.oracle import MISSING
from tests.conftest import SF_DIR
from tests.rows import bronze, by_key, complaint

RUN_TS = "2026-07-11T02:00:00.000Z"
LATER_TS = "2026-07-12T02:00:00.000Z"


def record(key, day="2026-07-01", **changes):
    fields = {
        "complaint_id": str(key),
        "product": "Loan",
        "company": "Acmé",
        "issue": "Fees",
        "sub_product": None,
        "date_received": f"{day}T12:00:00-05:00",
        "date_sent_to_company": f"{day}T12:00:00-05:00",
        "has_narrative": True,
        "timely": "Yes",
    }
    return {**fields, **changes}


def page(records, total=None):
    hits = [r if r is None else {"_source": r, "sort": [1, "x"]} for r in records]
    hits = [{"sort": ["1"]} if h is None else h for h in hits]
    return {"took": 1, "hits": {"total": {"value": len(records) if total is None else total}, "hits": hits}}


def write_pages(folder, *found, indent=None):
    os.makedirs(folder, exist_ok=True)
    for i, p in enumerate(found):
        with open(os.path.join(folder, f"page_{i}.json"), "w", encoding="utf-8") as f:
            f.write(json.dumps(p, ensure_ascii=False, indent=indent) + "\n")
    return folder


def write_lines(folder, lines, name="part_1.jsonl"):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.writelines(line if isinstance(line, str) else json.dumps(line) + "\n" for line in lines)
    return folder


@pytest.fixture
def zones(spark):
    root = scratch_dir(spark, "zones")
    return runs.Zones(f"{root}/pages", f"{root}/raw", f"{root}/bronze")


def test_flatten_keeps_every_hit(spark, zones):
    write_pages(zones.pages, page([record(1), None]), page([]), page([record(2, extra=[1, {"a": "ü"}])]))
    found = [json.loads(r[0]) for r in pages.flatten_pages(pages.read_pages(spark, zones.pages)).collect()]
    assert sorted(map(len, found)) == [0, 9, 10]
    assert next(r for r in found if "extra" in r)["extra"] == [1, {"a": "ü"}]


def test_pretty_printed_pages(spark, zones):
    write_pages(zones.pages, page([record(1), record(2)]), indent=2)
    found = pages.parse_records(pages.flatten_pages(pages.read_pages(spark, zones.pages, multi_line=True)))
    assert sorted(r["complaint_id"] for r in found.collect()) == ["1", "2"]
    with pytest.raises(Exception, match="(?i)malformed"):
        pages.read_pages(spark, zones.pages).collect()


@pytest.mark.parametrize(("total", "complete"), [(3, True), (4, False)])
def test_reconcile_uses_the_first_page(spark, zones, total, complete):
    write_pages(zones.pages, page([record(1), record(2)], total), page([record(3)], 99))
    found = pages.reconcile_counts(pages.read_pages(spark, zones.pages)).collect()
    assert tuple(found[0]) == (total, 3, complete)


def test_reconcile_without_pages_with_hits(spark, zones):
    write_pages(zones.pages, {"hits": {}}, {})
    assert tuple(pages.reconcile_counts(pages.read_pages(spark, zones.pages)).collect()[0]) == (0, 0, True)


def test_stamp(spark):
    texts = ['{"complaint_id":"1","extracted_at":"x"}', "{}", '{ "complaint_id": "2" } ']
    df = spark.createDataFrame([(t,) for t in texts], "record string")
    found = pages.parse_records(pages.stamp_extracted_at(df, RUN_TS)).select("complaint_id", "extracted_at")
    assert [tuple(r) for r in found.collect()] == [("1", RUN_TS), (None, RUN_TS), ("2", RUN_TS)]


def test_raw_lines_are_the_source_text(spark, zones):
    write_pages(zones.pages, page([record(1, extra=7)]))
    records = pages.with_process_date(pages.flatten_pages(pages.read_pages(spark, zones.pages)), "2026-07-09")
    raw.write_raw(pages.stamp_extracted_at(records, RUN_TS), zones.raw)
    files = glob.glob(raw.raw_path(zones.raw, "2026-07-01") + "/part-*")
    text = open(files[0], encoding="utf-8").read()
    assert len(files) == 1 and text.count("\n") == 1
    assert "Acmé" in text
    assert json.loads(text) == {**record(1, extra=7), "extracted_at": RUN_TS}


def test_chunks(spark, zones):
    records = spark.range(0, 12, 1, 1).select(
        F.lit("{}").alias("record"), F.lit("2026-07-01").cast("date").alias("process_date")
    )
    raw.write_raw(records, zones.raw, 5)
    files = glob.glob(raw.raw_path(zones.raw, "2026-07-01") + "/part-*")
    assert sorted(open(f).read().count("\n") for f in files) == [2, 5, 5]


def test_read_raw_dir_takes_lines_of_json_files_only(spark, zones):
    folder = write_lines(zones.raw, [{"complaint_id": 1}, {"complaint_id": "2", "tags": ["a"]}])
    for name in ("notes.md", "notes.txt", "part_1.json.bak"):
        write_lines(folder, ["not json\n"], name)
    write_lines(os.path.join(folder, "deeper"), [{"complaint_id": 3}])
    found = raw.read_raw_dir(spark, folder).select("complaint_id", "tags", "product").collect()
    assert sorted(map(tuple, found)) == [("1", None, None), ("2", '["a"]', None)]


def test_broken_line_fails(spark, zones):
    folder = write_lines(zones.raw, [{"complaint_id": 1}, '{"complaint_id": 2\n'])
    with pytest.raises(Exception, match="(?i)malformed"):
        raw.read_raw_dir(spark, folder).collect()


def test_normalize_absent_extra_and_mixed_fields(spark, zones):
    folder = write_lines(
        zones.raw,
        [
            {"complaint_id": "12", "has_narrative": True, "date_received": "2026-07-01T23:30:00.1239Z", "extra": 1},
            {"complaint_id": 13, "has_narrative": "false", "date_received": "2026-07-01T23:30:00-05:00"},
        ],
    )
    df = normalize_schema(raw.read_raw_dir(spark, folder))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in BRONZE]
    found = by_key(df)
    assert found[12]["has_narrative"] is True and found[13]["has_narrative"] is False
    assert found[12]["date_received"] % 1_000_000 == 123_000
    assert found[13]["date_received"] - found[12]["date_received"] == 5 * 3600 * 1_000_000 - 123_000
    assert found[12]["product"] is None
    narrow = normalize_schema(spark.range(1).select(F.col("id").alias("complaint_id"), F.lit(1).alias("extra")))
    assert narrow.columns == [f.name for f in BRONZE] and by_key(narrow)[0]["date_received"] is None


@pytest.mark.parametrize(
    ("field", "value"), [("complaint_id", "abc"), ("has_narrative", "maybe"), ("date_received", "yesterday")]
)
def test_value_that_cannot_be_cast_fails(spark, zones, field, value):
    folder = write_lines(zones.raw, [{"complaint_id": 1, field: value}])
    with pytest.raises(Exception, match=f"{field}: cannot cast"):
        normalize_schema(raw.read_raw_dir(spark, folder)).collect()


def test_filters(spark):
    rows = [
        complaint(complaint_id=1, date_received="2026-01-01T23:30:00.000Z", company="A"),
        complaint(complaint_id=2, date_received="2026-01-02T00:00:00.000Z", company="a"),
        complaint(complaint_id=3, date_received="2026-01-03T23:59:59.999Z", company="A"),
        complaint(complaint_id=4, date_received="2026-01-04T00:00:00.000Z", company=None),
        complaint(complaint_id=5, date_received=None, company="A"),
    ]
    df = bronze(spark, rows)

    def ids(frame):
        return [r["complaint_id"] for r in frame.collect()]

    assert sorted(ids(filters.filter_received_range(df, "2026-01-02", "2026-01-03"))) == [2, 3]
    assert sorted(ids(filters.filter_company(df, "A"))) == [1, 3, 5]
    assert sorted(ids(filters.filter_company(df))) == [1, 2, 3, 4, 5]
    assert ids(filters.sort_created(df)) == [4, 3, 2, 1, 5]
    assert ids(filters.sort_created(df, ascending=True)) == [1, 2, 3, 4, 5]
    assert sorted(ids(filters.lookback_window(df, "2026-04-02"))) == [2, 3, 4]


def test_received_day_is_utc(spark, new_york):
    df = bronze(spark, [complaint(date_received="2026-01-02T03:00:00.000Z")])
    assert filters.filter_received_range(df, "2026-01-02", "2026-01-02").count() == 1


def fetch(zones, run_ts, *found):
    """Land the pages of one fetch."""
    write_pages(pages.fetch_folder(zones.pages, run_ts), *found)
    return run_ts


def test_rerun_replaces_the_files_of_a_date(spark, zones):
    first = fetch(zones, RUN_TS, page([record(i) for i in range(12)] + [record(99, "2026-07-02")]))
    runs.land_raw(spark, zones, first, "2026-07-01", "2026-07-02", 5)
    second = fetch(zones, LATER_TS, page([record(1)]))
    runs.land_raw(spark, zones, second, "2026-07-01", "2026-07-01", 5)
    found = raw.read_raw(spark, zones.raw, "2026-07-01", "2026-07-02").select("complaint_id").collect()
    assert sorted(r[0] for r in found) == ["1", "99"]
    assert raw.read_raw(spark, zones.raw).count() == 2 and raw.read_raw(spark, zones.raw, "2026-07-02").count() == 1


def test_daily_run_end_to_end(spark, zones, warehouse):
    ts = fetch(zones, RUN_TS, page([record(1), record(2, company="Beta"), record(4, "2026-06-30")], 3))
    result = runs.run_daily(warehouse, zones, "2026-07-02", ts)
    assert tuple(result.summary.collect()[0]) == (2, 2, "success")
    assert tuple(result.reconciliation.collect()[0]) == (3, 3, True)
    report = result.report.collect()
    assert len(report) == 16 and all(r["failures"] == 0 for r in report)
    # the next day, then a backfill of both
    ts = fetch(zones, LATER_TS, page([record(3, "2026-07-02")], 2))
    later = runs.run_daily(warehouse, zones, "2026-07-03", ts)
    assert tuple(later.summary.collect()[0]) == (1, 3, "success")
    assert tuple(later.reconciliation.collect()[0]) == (2, 1, False)
    ts = fetch(zones, "2026-07-13T02:00:00Z", page([record(1), record(2, company="Beta"), record(3, "2026-07-02")]))
    again = runs.run_backfill(warehouse, zones, "2026-07-01", "2026-07-02", ts)
    assert tuple(again.summary.collect()[0]) == (3, 3, "success")
    assert warehouse.table("marts", "fct_complaints").count() == 3
    frames = runs.read_marts(warehouse)
    assert [r["total_complaints"] for r in frames["companies"].collect()] == [2, 1]
    assert frames["coverage"].collect()[0]["total_complaints"] == 3
    # results of earlier runs are values
    assert tuple(result.summary.collect()[0]) == (2, 2, "success") and result.report.collect() == report
    # the views are objects of their layers, and follow the table
    staged, metrics = warehouse.name("staging", "stg_complaints"), warehouse.name("intermediate", "int_complaint_metrics")
    assert spark.table(staged).count() == 3
    warehouse.upsert(normalize_schema(spark.createDataFrame([("77",)], "complaint_id string")))
    source = warehouse.source_table()
    assert sorted(spark.table(metrics).collect(), key=str) == sorted(int_complaint_metrics(stg_complaints(source)).collect(), key=str)
    assert spark.table(metrics).schema == int_complaint_metrics(stg_complaints(source)).schema


def test_a_later_fetch_corrects_an_earlier_one(spark, zones, warehouse):
    first = fetch(zones, RUN_TS, page([record(1, company="Old"), record(7, date_received=None, company="Undated")]))
    runs.run_daily(warehouse, zones, "2026-07-02", first)
    second = fetch(zones, LATER_TS, page([record(1, company="New"), record(7, company="Dated")]))
    assert tuple(runs.run_daily(warehouse, zones, "2026-07-02", second).summary.collect()[0]) == (2, 2, "success")
    third = fetch(zones, "2026-07-13T02:00:00Z", page([record(9, "2026-07-02")]))
    assert tuple(runs.run_daily(warehouse, zones, "2026-07-03", third).summary.collect()[0]) == (1, 3, "success")
    found = by_key(warehouse.source_table())
    assert {k: r["company"] for k, r in found.items()} == {1: "New", 7: "Dated", 9: "Acmé"}
    assert found[1]["extracted_at"] < found[9]["extracted_at"]


class Stopped(Exception):
    pass


def test_a_stopped_backfill_goes_on(spark, zones, warehouse, monkeypatch):
    """Stopped in each step in turn: finished steps and days are not done again, and the table is that of a whole run."""
    records = [record(k, f"2026-07-0{1 + k % 3}") for k in range(9)]
    ts = fetch(zones, RUN_TS, page(records[:5]), page([*records[5:], record(20, date_received=None)]))
    done = []

    def watch(step, real, stop):
        def call(df, *rest):
            days = sorted(str(r[0]) for r in df.select("process_date").distinct().collect()) if "process_date" in df.columns else df.count()
            done.append((step, days))
            if stop:
                raise Stopped(step)
            return real(df, *rest)

        return call

    real = {"write_raw": runs.write_raw, "write_bronze": runs.write_bronze}
    upsert = warehouse.__class__.upsert

    def resume(stop=None):
        done.clear()
        for step in real:
            monkeypatch.setattr(runs, step, watch(step, real[step], step == stop))
        monkeypatch.setattr(warehouse.__class__, "upsert", lambda self, df: watch("upsert", lambda rows: upsert(self, rows), stop == "upsert")(df))
        result = runs.resume_backfill(warehouse, zones, "2026-07-01", "2026-07-05", ts)
        return tuple(result.summary.collect()[0])

    days = ["2026-07-01", "2026-07-02", "2026-07-03"]
    for stop, steps in [("write_raw", ["write_raw"]), ("write_bronze", ["write_raw", "write_bronze"]), ("upsert", ["write_bronze", "upsert"])]:
        with pytest.raises(Stopped):
            resume(stop)
        assert [s for s, _ in done] == steps and done[0][1] == days
    assert resume() == (10, 10, "success") and done == [("upsert", 10)]
    assert resume() == (0, 10, "success") and done == []
    first = by_key(warehouse.source_table())

    # a page of the fetch is landed again with another record of one day
    write_pages(pages.fetch_folder(zones.pages, ts), page([*records[:4], record(4, "2026-07-02", company="Beta")]))
    assert resume() == (3, 10, "success")
    assert done == [("write_raw", days[1:2]), ("write_bronze", days[1:2]), ("upsert", 3)]
    found = by_key(warehouse.source_table())
    assert found[4]["company"] == "Beta" and {k: r for k, r in found.items() if k != 4} == {k: r for k, r in first.items() if k != 4}
    assert raw.read_raw(spark, zones.raw).count() == 10
    assert sorted(r["total_complaints"] for r in runs.read_marts(warehouse)["companies"].collect()) == [1, 9]


def test_fingerprints_do_not_depend_on_order(spark):
    rows = [("a", "2026-07-01"), ("b", "2026-07-01"), ("b", "2026-07-01"), ("a", "2026-07-02")]
    found = [fingerprints(spark.createDataFrame(r, "record string, process_date string").repartition(n)) for r, n in ((rows, 1), (rows[::-1], 3))]
    assert found[0] == found[1] and len(set(found[0].values())) == 2
    other = fingerprints(spark.createDataFrame([("a", "2026-07-01"), ("b", "2026-07-01"), ("a", "2026-07-01")], "record string, process_date string"))
    assert other["2026-07-01"] != found[0]["2026-07-01"]


def test_a_broken_fetch_fails_its_own_run_only(spark, zones, warehouse):
    ts = fetch(zones, RUN_TS, page([record(1), record(2, date_received=None)]))
    assert tuple(runs.run_daily(warehouse, zones, "2026-07-02", ts).summary.collect()[0]) == (2, 2, "success")
    broken = fetch(zones, LATER_TS, page([record(3), None]))
    with pytest.raises(Exception, match="NULL in key column complaint_id"):
        runs.run_daily(warehouse, zones, "2026-07-02", broken)
    assert sorted(by_key(warehouse.source_table())) == [1, 2]
    good = fetch(zones, "2026-07-13T02:00:00Z", page([record(3)]))
    runs.run_daily(warehouse, zones, "2026-07-02", good)
    assert sorted(by_key(warehouse.source_table())) == [1, 2, 3]


def test_day_without_records_changes_nothing(spark, zones, warehouse):
    runs.run_daily(warehouse, zones, "2026-07-02", fetch(zones, RUN_TS, page([record(1)])))
    empty = fetch(zones, LATER_TS, page([]))
    assert tuple(runs.run_daily(warehouse, zones, "2026-07-05", empty).summary.collect()[0]) == (0, 1, "success")


def test_first_day_without_records(spark, zones, warehouse):
    empty = fetch(zones, RUN_TS, page([]))
    assert tuple(runs.run_daily(warehouse, zones, "2026-07-05", empty).summary.collect()[0]) == (0, 0, "success")


def test_run_times_are_checked():
    assert pages.fetch_folder("s3a://x/pages/", RUN_TS) == "s3a://x/pages/run=20260711T020000000Z"
    for wrong in ('2026-07-11","x":"', "2026-07-11", "now", "2026-07-11T02:00:00+02:00"):
        with pytest.raises(ValueError, match="UTC time"):
            pages.fetch_folder("s3a://x", wrong)


def test_typed_layer_round_trip(spark, zones):
    rows = bronze(spark, [complaint(), complaint(complaint_id=2, date_received=None, tags="é")])
    dated = rows.withColumn("process_date", F.lit("2026-01-01").cast("date"))
    bronze_layer.write_bronze(dated, zones.bronze)
    assert by_key(bronze_layer.scan_bronze(spark, zones.bronze, "2026-01-01", "2026-01-01")) == by_key(rows)
    assert bronze_layer.scan_bronze(spark, zones.bronze, "2026-01-02", "2026-01-09").count() == 0


def test_names():
    assert schema_for_layer("marts ") == "marts"
    assert schema_for_layer() == "main"
    assert raw.raw_path("s3a://x/raw/", "2026-07-01") == "s3a://x/raw/process_date=2026-07-01"


def test_process_date(spark):
    df = spark.createDataFrame([("2026-03-01",)], "d string")
    assert str(df.select(runs.process_date(F.col("d"))).collect()[0][0]) == "2026-02-28"


def test_pages_are_dealt_before_they_are_collected_and_gzipped(spark, zones):
    """Lists made map-side hold the fetch in every task; plain text takes ten times the disk."""
    rows = bronze(spark, [complaint(complaint_id=k) for k in range(1, 200)])
    shape.land_pages(rows, zones.pages)
    files = glob.glob(zones.pages + "/part-*")
    assert files and all(f.endswith(".gz") for f in files)
    found = pages.flatten_pages(pages.read_pages(spark, zones.pages))
    assert sorted(json.loads(r.record)["complaint_id"] for r in found.collect()) == list(range(1, 200))


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in (files.apply(i).getName() for i in range(files.size())) if f.startswith("shuffle_")}


def test_landing_reads_its_rows_once_and_leaves_no_shuffle_files(spark, zones):
    """The total counted apart joins all tables again, and shuffles kept until a garbage collection add up over steps."""
    read, before = spark.sparkContext.accumulator(0), shuffle_files(spark)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = bronze(spark, [complaint(complaint_id=k) for k in range(1, 200)])
    shape.land_pages(rows.mapInArrow(counted, rows.schema), zones.pages, 3)
    assert read.value == 199
    kept = spark.range(20).select(F.lit("{}").alias("record"), F.expr("date_add(date'2026-07-01', cast(id % 3 as int))").alias("process_date"))
    raw.write_raw(kept.repartition(3), zones.raw)
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(FREED) == "false"
    assert pages.reconcile_counts(pages.read_pages(spark, zones.pages)).collect() == [(202, 199, False)]


def test_raw_files_may_be_gzipped(spark, zones):
    records = spark.range(0, 12, 1, 1).select(F.lit('{"complaint_id":1}').alias("record"), F.lit("2026-07-01").cast("date").alias("process_date"))
    raw.write_raw(records, zones.raw, 5, "gzip")
    files = glob.glob(raw.raw_path(zones.raw, "2026-07-01") + "/part-*")
    assert len(files) == 3 and all(f.endswith(".gz") for f in files)
    assert raw.read_raw(spark, zones.raw).select("complaint_id").collect() == [("1",)] * 12


def jobs_of(files):
    """The writes that made part files: each names its files by an id of its own."""
    return {re.match(r"part-\d+-([0-9a-f-]{36})", os.path.basename(f))[1] for f in files}


def test_pages_are_landed_a_part_at_a_time(spark, zones):
    """One shuffle of all pages, beside those of the joins, is most of the disk that a landing needs."""
    keys = [k * shape.PAGE_KEYS + i for k in range(40) for i in range(3)]
    shape.land_pages(bronze(spark, [complaint(complaint_id=k) for k in keys] + [complaint(complaint_id=None)]), zones.pages)
    found = pages.read_pages(spark, zones.pages)
    assert [tuple(r) for r in pages.reconcile_counts(found).collect()] == [(len(keys) + 1, len(keys) + 1, True)]
    assert sorted(found.selectExpr("size(hits.hits) AS n").toPandas()["n"]) == [1] + [3] * 40
    got = pages.parse_records(pages.flatten_pages(found)).select("complaint_id").collect()
    assert sorted(r[0] or "" for r in got) == sorted([""] + [str(k) for k in keys])
    assert 2 < len(jobs_of(glob.glob(f"{zones.pages}/part-*.gz"))) <= PARTS + 1  # and the one that makes the folder
    assert not glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/landing-*")


def test_a_fetch_without_records_is_landed(spark, zones):
    shape.land_pages(bronze(spark, []), zones.pages)
    assert pages.reconcile_counts(pages.read_pages(spark, zones.pages)).collect() == [(0, 0, True)]
    with pytest.raises(Exception, match="(?i)already exists"):
        shape.land_pages(bronze(spark, []), zones.pages)


def test_raw_days_are_written_a_part_at_a_time(spark, zones):
    day = F.expr("date_add(date'2026-07-01', cast(id % 30 as int))")
    records = spark.range(0, 300, 1, 3).select(F.to_json(F.struct(F.col("id").alias("complaint_id"))).alias("record"), day.alias("process_date"))
    for _ in range(2):  # the second write replaces every file of the first
        raw.write_raw(records, zones.raw, 4)
        files = glob.glob(f"{zones.raw}/process_date=*/part-*")
        assert 1 < len(jobs_of(files)) <= PARTS
        assert all(len(jobs_of(glob.glob(f"{d}/part-*"))) == 1 for d in glob.glob(f"{zones.raw}/process_date=*"))
        assert all(len(open(f).readlines()) <= 4 for f in files)
        found = raw.read_raw(spark, zones.raw).select(F.col("complaint_id").cast("long"), "process_date").collect()
        assert sorted(map(tuple, found)) == sorted(map(tuple, records.select(F.get_json_object("record", "$.complaint_id").cast("long"), "process_date").collect()))
    assert not glob.glob(f"{zones.raw}/_staged-*")


def test_a_broken_record_replaces_no_day(spark, zones):
    records = spark.range(0, 9, 1, 3).select(F.lit("{}").alias("record"), F.expr("date_add(date'2026-07-01', cast(id as int))").alias("process_date"))
    raw.write_raw(records, zones.raw)
    before = sorted(glob.glob(f"{zones.raw}/*/*"))
    with pytest.raises(Exception, match="broken"):
        raw.write_raw(records.withColumn("record", F.expr("if(day(process_date) = 9, raise_error('broken'), record)")), zones.raw)
    assert sorted(glob.glob(f"{zones.raw}/*/*")) == before


def test_lines_are_dealt_once_for_copies_and_orders(spark, tmp_path):
    """The exchange that brings the copies of a line together serves the join with the orders."""
    for name in ("lineitem", "orders"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").limit(50).write.parquet(f"{tmp_path}/{name}.parquet")
    rows = shape.complaints(spark, str(tmp_path), ["complaint_id", "issue", "date_received"])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("SortMergeJoin") == 1 and plan.count("Exchange hashpartitioning") == 2


def write_tables(spark, folder):
    """Lines of 40 orders, one of them unknown, with a line that comes twice and keys that are null."""
    day = "timestamp_ntz'1996-01-01 00:00:00'"
    orders = spark.range(40).selectExpr(
        "nullif(id, 7) AS o_orderkey", "id % 5 AS o_custkey", "'F' AS o_orderstatus", f"{day} AS o_orderdate", "'1-URGENT' AS o_orderpriority"
    )
    lines = spark.range(164).selectExpr(
        "nullif(id div 4, 3) AS l_orderkey", "id % 6 AS l_partkey", "id % 4 AS l_suppkey", "nullif(cast(id % 4 AS int), 2) AS l_linenumber",
        "cast(id AS double) AS l_quantity", "cast(id AS double) AS l_extendedprice", "0.05D AS l_discount", "0.02D AS l_tax",
        "'R' AS l_returnflag", "'F' AS l_linestatus", f"{day} AS l_shipdate",
    )
    tables = {
        "orders": orders,
        "lineitem": lines.union(lines.limit(1)),
        "customer": spark.range(5).selectExpr("id AS c_custkey", "cast(id % 2 AS int) AS c_nationkey", "'BUILDING' AS c_mktsegment"),
        "nation": spark.range(2).selectExpr("cast(id AS int) AS n_nationkey", "concat('N', id) AS n_name"),
        "supplier": spark.range(4).selectExpr("id AS s_suppkey", "concat('S', id) AS s_name"),
        "part": spark.range(6).selectExpr("id AS p_partkey", "'red' AS p_name", "'Brand#1' AS p_brand", "'SMALL' AS p_type", "3 AS p_size"),
    }
    for name, df in tables.items():
        df.coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_lots_hold_every_complaint_once(spark, tmp_path):
    folder = write_tables(spark, str(tmp_path))
    whole, lots = shape.complaints(spark, folder), shape.complaint_lots(spark, folder)
    assert len(lots) == PARTS and sum(not lot.isEmpty() for lot in lots) > 1
    union = lots[0]
    for lot in lots[1:]:
        union = union.unionByName(lot)
    assert whole.count() == union.count() > 100
    assert whole.filter("complaint_id IS NULL").count() > 1
    assert whole.exceptAll(union).isEmpty() and union.exceptAll(whole).isEmpty()


def test_a_landing_joins_lot_after_lot(spark, tmp_path, zones, monkeypatch):
    """The shuffles of joins over all lines, there at once, were three quarters of the disk that a landing needs."""
    folder, before, kept, real = write_tables(spark, str(tmp_path)), shuffle_files(spark), [], shape.store_parts

    def store(df, key, path):
        for _ in range(50):
            if not shuffle_files(spark) - before:
                break
            time.sleep(0.1)
        kept.append(len(shuffle_files(spark) - before))
        real(df, key, path)

    monkeypatch.setattr(shape, "store_parts", store)
    monkeypatch.setattr(registry, "layers", lambda *_: stored)
    stored = registry.Layers(spark, folder)
    found = pages.flatten_pages(pages.read_pages(spark, stored.pages()))
    assert kept == [0] * PARTS
    assert found.count() == shape.complaints(spark, folder).count()


def test_the_short_fetch_is_gone_before_the_whole_one_is_landed(spark, tmp_path, monkeypatch):
    folder, root, there, real = write_tables(spark, str(tmp_path)), spark.conf.get("spark.checkpoint.dir"), [], shape.land_pages

    def land(rows, path, missing=0):
        there.append(len(glob.glob(f"{root}/short-*/run=*")))
        real(rows, path, missing)

    monkeypatch.setattr(shape, "land_pages", land)
    before, n = len(glob.glob(f"{root}/short-*/run=*")), shape.complaints(spark, folder).count()
    found = registry.reconcile_counts(spark, folder)
    assert sorted(map(tuple, found.collect())) == [("short", n + MISSING, n, False), ("whole", n, n, True)]
    assert there == [before, before]
    assert len(glob.glob(f"{root}/short-*/run=*")) == before


def test_a_page_has_its_records_in_key_order(spark, zones):
    keys = [9, 2, 7, 4, 1, 8, 3, 6, 5]
    rows = bronze(spark, [complaint(complaint_id=k) for k in [*keys, *[k + shape.PAGE_KEYS for k in keys]]])
    shape.land_pages(rows, zones.pages)
    found = [[int(c) for c in r[0]] for r in pages.read_pages(spark, zones.pages).selectExpr("transform(hits.hits, h -> h.sort[0])").collect()]
    assert sorted(found) == [sorted(keys), [k + shape.PAGE_KEYS for k in sorted(keys)]]


def test_staged_lines_are_compressed_well(spark, tmp_path):
    """JSON lines at the writer's usual level take half as much again, beside the pages and the raw files."""
    words = F.expr("transform(sequence(1, 12), i -> concat('word', pmod(xxhash64(id, i), 40)))")
    lines = spark.range(0, 4000, 1, 1).select(F.to_json(F.struct("id", words.alias("words"))).alias("record"))
    lines.write.parquet(f"{tmp_path}/usual", compression="zstd")
    store_parts(lines.withColumn("day", F.lit(1)), "day", f"{tmp_path}/staged")
    usual, staged = (sum(map(os.path.getsize, glob.glob(f"{tmp_path}/{name}/**/part-*", recursive=True))) for name in ("usual", "staged"))
    assert 0 < staged < 0.9 * usual
    assert spark.read.parquet(f"{tmp_path}/staged").select("record").exceptAll(lines).isEmpty()


def test_stamping_cuts_a_record_by_octets(spark):
    """The time goes before the last brace of any text; a record is not walked through for its last character."""
    texts = ['{"a":"é}"}', ' {"a":1} ', "{}", "{ }", '{"a":{"b":"ü"}}', "é", None]
    stamped = pages.stamp_extracted_at(spark.createDataFrame([(t,) for t in texts], "record string"), "2026-07-11T02:00:00.000Z")
    end = '"extracted_at":"2026-07-11T02:00:00.000Z"}'
    assert [r.record for r in stamped.collect()] == [
        '{"a":"é}",' + end, '{"a":1,' + end, "{" + end, "{" + end, '{"a":{"b":"ü"},' + end, "," + end, None,
    ]
    assert "octet_length(" in stamped._jdf.queryExecution().optimizedPlan().toString()
