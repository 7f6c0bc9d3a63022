"""Marts kept by change against marts built anew, and what readers see of versions."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from plaintide.operators.ledger import CELL, PERIOD, counted
from plaintide.operators.upsert import RANGE, RANGE_WIDTH, key_range
from plaintide.plans import runs
from plaintide.plans.marts import GROUPED, MARTS
from plaintide.plans.models import fct_complaints, int_complaint_metrics, stg_complaints
from plaintide.sources import versions
from plaintide.sources.warehouse import COMPLAINTS
from tests.rows import bronze, complaint

DAY_1, DAY_2, DAY_3 = (f"2026-07-0{d}T02:00:00.000Z" for d in (1, 2, 3))


def some(r, keys):
    """Complaints with few values, so that groups, modes and extremes come and go; some columns are NULL."""
    day = lambda: f"2026-0{r.randint(1, 9)}-{r.randint(10, 28)}T00:00:00.000Z"
    return [
        complaint(
            complaint_id=k, company=r.choice(["A", "B", "C", None]), state=r.choice(["NY", "CA", None]), product=r.choice(["Loan", "Card", None]),
            sub_product=r.choice(["x", "y", None]), issue=r.choice(["i", "j", None]), sub_issue=r.choice(["s", None]),
            zip_code=r.choice(["1", "2", "3"]), timely=r.choice(["Yes", "No", None, None]), has_narrative=r.choice([True, False, None]),
            date_received=r.choice([day(), None]), date_sent_to_company=r.choice([day(), None]), company_response=r.choice(["Closed", None]),
        )
        for k in keys
    ]


def sorted_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def built_anew(warehouse):
    metrics = int_complaint_metrics(stg_complaints(warehouse.source_table()))
    return {"fct_complaints": sorted_rows(fct_complaints(metrics))} | {name: sorted_rows(build(metrics)) for name, build in MARTS.items()}


def published_rows(warehouse):
    manifest = versions.version_at(warehouse.spark, warehouse.path("marts", runs.VERSIONS))
    return {name: sorted_rows(df) for name, df in runs.frames_of(warehouse, manifest).items()}


def root_of(warehouse):
    return warehouse.path("marts", runs.VERSIONS)


def test_marts_follow_changes(spark, warehouse, monkeypatch):
    """Inserts, replacements and a range that vanishes; a run scans the rows of the ranges it must, and no others."""
    r = random.Random(1)
    scanned = []
    real = warehouse.__class__.range_rows

    def counted(self, ranges):
        rows = real(self, ranges)
        if ranges:
            scanned.append(rows.count())
        return rows

    monkeypatch.setattr(warehouse.__class__, "range_rows", counted)
    far = RANGE_WIDTH
    steps = [
        (some(r, [*range(40), *range(far, far + 30)]), 70),
        (some(r, range(2 * far, 2 * far + 5)), 5),
        (some(r, [*range(far, far + 10), far + 100]), 31),
        (some(r, range(40)), 40),
    ]
    for rows, expected in steps:
        warehouse.upsert(bronze(spark, rows))
        scanned.clear()
        runs.build_models(warehouse, DAY_1)
        assert scanned == [expected]
        assert published_rows(warehouse) == built_anew(warehouse)
    scanned.clear()
    runs.build_models(warehouse, DAY_2)
    assert scanned == [] and published_rows(warehouse) == built_anew(warehouse)

    table, location = warehouse.name("raw", COMPLAINTS), warehouse.path("raw", COMPLAINTS)
    ranges = warehouse.ranges()
    monkeypatch.setattr(warehouse.__class__, "ranges", lambda self: {k: v for k, v in ranges.items() if k != "0"})
    spark.sql(f"ALTER TABLE {table} DROP PARTITION ({RANGE} = 0)")
    assert os.path.isdir(location)
    runs.build_models(warehouse, DAY_3)
    assert published_rows(warehouse) == built_anew(warehouse)
    assert warehouse.table("marts", "fct_complaints").count() == warehouse.source_table().count() == 36
    assert sorted_rows(warehouse.table("marts", "dim_states")) == published_rows(warehouse)["dim_states"]


def test_a_killed_run_publishes_nothing(spark, warehouse, monkeypatch):
    """Stopped between two marts, all seven are those of the run before."""
    r = random.Random(2)
    warehouse.upsert(bronze(spark, some(r, range(30))))
    runs.build_models(warehouse, DAY_1)
    before, stored = published_rows(warehouse), {m: sorted_rows(warehouse.table("marts", m)) for m in GROUPED}
    warehouse.upsert(bronze(spark, some(r, range(30))))
    real = runs.mart_of

    def killed(totals, name, *rest):
        if name == "dim_states":
            raise KeyboardInterrupt
        return real(totals, name, *rest)

    monkeypatch.setattr(runs, "mart_of", killed)
    with pytest.raises(KeyboardInterrupt):
        runs.build_models(warehouse, DAY_2)
    assert published_rows(warehouse) == before and {m: sorted_rows(warehouse.table("marts", m)) for m in GROUPED} == stored
    monkeypatch.setattr(runs, "mart_of", real)
    runs.build_models(warehouse, DAY_2)
    assert published_rows(warehouse) == built_anew(warehouse) != before


def test_earlier_versions_are_read_and_restored(spark, warehouse):
    r = random.Random(3)
    states = {}
    for day in (DAY_1, DAY_2, DAY_3):
        warehouse.upsert(bronze(spark, some(r, range(25))))
        runs.build_models(warehouse, day)
        states[day] = published_rows(warehouse)
    for day in states:
        frames = runs.read_marts(warehouse, as_of=day)
        assert frames["coverage"].first().total_complaints == 25
        shown = {c: n for c, n in frames["companies"].select("company", "total_complaints").collect()}
        assert shown == {row[0]: row[1] for row in states[day]["dim_companies"]}
    with pytest.raises(LookupError):
        runs.read_marts(warehouse, as_of="2026-06-30T00:00:00.000Z")

    versions.roll_back(spark, root_of(warehouse), 1)
    assert published_rows(warehouse) == states[DAY_1]
    runs.build_models(warehouse, DAY_3)
    assert published_rows(warehouse) == states[DAY_3] == built_anew(warehouse)
    runs.rebuild_models(warehouse, DAY_3)
    assert published_rows(warehouse) == states[DAY_3]

    versions.expire(spark, root_of(warehouse), keep=1)
    assert len(versions.published(spark, root_of(warehouse))) == 1
    assert published_rows(warehouse) == states[DAY_3]
    warehouse.upsert(bronze(spark, some(r, range(10))))
    runs.build_models(warehouse, DAY_3)
    assert published_rows(warehouse) == built_anew(warehouse)


def test_an_empty_table_has_empty_marts(spark, warehouse):
    warehouse.create_if_absent()
    runs.build_models(warehouse, DAY_1)
    assert published_rows(warehouse) == built_anew(warehouse)
    assert runs.read_marts(warehouse)["companies"].collect() == []


@pytest.mark.parametrize(("first", "last"), [("2026-03-17", "2026-05-01"), ("2026-04-01", None), (None, "2026-02-28"), (None, None), ("2027-01-01", None)])
def test_marts_of_some_months(spark, warehouse, monkeypatch, first, last):
    """From stored counts alone, after rows moved between months, against marts of the rows of those months."""
    r = random.Random(4)
    for keys in (range(60), range(20, 50)):
        warehouse.upsert(bronze(spark, some(r, keys)))
        runs.build_models(warehouse, DAY_1)
    metrics = int_complaint_metrics(stg_complaints(warehouse.source_table()))
    if first:
        metrics = metrics.filter(f"complaint_month_date >= trunc(date'{first}', 'month')")
    if last:
        metrics = metrics.filter(f"complaint_month_date <= trunc(date'{last}', 'month')")
    expected = {name: sorted_rows(build(metrics)) for name, build in MARTS.items()}
    monkeypatch.setattr(warehouse.__class__, "range_rows", None)
    found = runs.marts_between(warehouse, first, last)
    assert {name: sorted_rows(df) for name, df in found.items()} == expected
    assert bool(expected["dim_states"]) == (first != "2027-01-01")
    with pytest.raises(LookupError):
        runs.marts_between(warehouse, first, last, as_of="2026-06-30T00:00:00.000Z")


def test_two_writers_get_two_numbers(spark, warehouse):
    root = f"{warehouse.root}/set"
    first, second = versions.new_folder(root), versions.new_folder(root)
    assert versions.publish(spark, root, second, versions.Manifest(DAY_2, {"t": "two"})).number == 1
    assert versions.publish(spark, root, first, versions.Manifest(DAY_1, {"t": "one"})).number == 2
    assert versions.version_at(spark, root).tables == {"t": "one"}
    assert versions.version_at(spark, f"{root}-none") is None


def test_complaints_are_dealt_and_not_their_cells(spark, warehouse):
    """One shuffle, of complaints, below the dozen rows that each is counted by; totals have a cell once, not by month."""
    r = random.Random(6)
    warehouse.upsert(bronze(spark, some(r, range(40))))
    metrics = int_complaint_metrics(stg_complaints(warehouse.source_table())).withColumn(RANGE, key_range())
    text = counted(metrics, GROUPED, by=[RANGE])._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    assert text.count("Exchange") == 1 and text.index("Generate") < text.index("Exchange")
    runs.build_models(warehouse, DAY_1)
    manifest = versions.version_at(spark, warehouse.path("marts", runs.VERSIONS))
    totals = spark.read.schema(runs.COUNTS).parquet(manifest.tables["totals"])
    assert totals.count() == totals.select(CELL).distinct().count()


def test_a_range_stores_groups_and_a_load_counts_those_it_changed(spark, warehouse, monkeypatch):
    """At most a row per complaint is kept of a range, in place of a dozen cells; groups that stay are not counted again."""
    r = random.Random(7)
    rows, come = some(r, range(40)), []
    real = runs.cells

    def cells(groups, marts, *by):
        if "dim_states" in marts:
            come.append((groups.count(), groups.agg(F.sum("n")).first()[0]))
        return real(groups, marts, *by)

    monkeypatch.setattr(runs, "cells", cells)
    warehouse.upsert(bronze(spark, rows))
    runs.build_models(warehouse, DAY_1)
    part = versions.version_at(spark, root_of(warehouse)).parts["0"]
    assert spark.read.parquet(part[runs.TALLIES]).count() <= 40
    assert come.pop()[1] == 40
    warehouse.upsert(bronze(spark, [{**rows[3], "company": "New"}, *rows[4:], {**rows[0], "complaint_id": 99, "state": "TX"}]))
    runs.build_models(warehouse, DAY_2)
    assert come == [(3, 1)]
    assert published_rows(warehouse) == built_anew(warehouse)


def test_versions_that_stored_cells_are_followed(spark, warehouse):
    """A version of before there were groups: its cells by range and month are taken back, and give the marts of months."""
    r = random.Random(8)
    warehouse.upsert(bronze(spark, some(r, range(40))))
    runs.build_models(warehouse, DAY_1)
    manifest = versions.version_at(spark, root_of(warehouse))
    metrics = int_complaint_metrics(stg_complaints(warehouse.source_table()))
    counted(metrics.withColumn(PERIOD, F.trunc("date_received", "month")), GROUPED, [PERIOD]).write.parquet(f"{warehouse.root}/cells")
    manifest.parts["0"] = {k: v for k, v in manifest.parts["0"].items() if k != runs.TALLIES} | {"counts": f"{warehouse.root}/cells"}
    versions.publish(spark, root_of(warehouse), versions.new_folder(root_of(warehouse)), versions.Manifest(DAY_1, manifest.tables, manifest.parts))
    some_months = metrics.filter("complaint_month_date >= date'2026-04-01'")
    assert {n: sorted_rows(df) for n, df in runs.marts_between(warehouse, "2026-04-09", None).items()} == {n: sorted_rows(b(some_months)) for n, b in MARTS.items()}
    warehouse.upsert(bronze(spark, some(r, range(20, 60))))
    runs.build_models(warehouse, DAY_2)
    assert published_rows(warehouse) == built_anew(warehouse)
