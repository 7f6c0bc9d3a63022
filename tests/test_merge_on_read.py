"""The table that loads write by deletion vectors, against the upsert that rewrites ranges."""

from __future__ import annotations

import os
import random

import pytest

from plaintide.operators import merge_on_read as mor
from plaintide.operators.upsert import RANGE_WIDTH
from plaintide.session import scratch_dir
from tests.rows import bronze, by_key, complaint


def size(path):
    return sum(os.path.getsize(f"{d}/{f}") for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def test_loads_and_compaction_keep_the_upserts_rows(spark, warehouse):
    r = random.Random(5)
    location = scratch_dir(spark, "mor")
    keys = [*range(30), *range(RANGE_WIDTH, RANGE_WIDTH + 10), *range(-5, 0)]
    for step in range(4):
        chosen = r.sample(keys, 20) + r.choices(keys, k=5)
        times = [f"2026-01-{r.randint(10, 12)}T00:00:00.000Z" for _ in chosen]
        rows = bronze(spark, [complaint(complaint_id=k, company=f"{step}-{i}", extracted_at=t) for i, (k, t) in enumerate(zip(chosen, times, strict=True))])
        assert mor.merge(spark, rows, location) == warehouse.upsert(rows) == 25
        assert by_key(mor.read(spark, location)) == by_key(warehouse.source_table())
        if step == 2:
            assert mor.compact(spark, location) and not mor.compact(spark, location)
            assert by_key(mor.read(spark, location)) == by_key(warehouse.source_table())
            mor.clean(spark, location)
            assert len(os.listdir(location)) == len(mor.steps(spark, location)) == 1
    assert by_key(mor.read(spark, location)) == by_key(warehouse.source_table())


def test_bytes_written_follow_the_batch(spark):
    location = scratch_dir(spark, "mor")
    mor.merge(spark, bronze(spark, [complaint(complaint_id=k, complaint_what_happened=f"{k} " * 200) for k in range(3000)]), location)
    first = size(location)
    mor.merge(spark, bronze(spark, [complaint(complaint_id=7, company="New")]), location)
    assert size(location) - first < first / 10
    assert mor.read(spark, location).count() == 3000
    vector = spark.read.schema(mor.VECTOR).parquet(f"{location}/{mor.steps(spark, location)[-1]}/{mor.VECTORS}").collect()
    assert [len(v.positions) for v in vector] == [1]
    text = mor.read(spark, location).select("company")._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in text and "Python" not in text


def test_rows_are_not_shuffled_for_the_vectors(spark, monkeypatch):
    location, limit = scratch_dir(spark, "mor"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    mor.merge(spark, bronze(spark, [complaint(complaint_id=k) for k in range(300)]), location)
    mor.merge(spark, bronze(spark, [complaint(complaint_id=k, company="New") for k in range(0, 300, 7)]), location)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = []
        for most in (mor.BITMAPS, 0):
            monkeypatch.setattr(mor, "BITMAPS", most)
            rows = mor.read(spark, location)
            found.append(rows._jdf.queryExecution().executedPlan().toString())
            assert sorted((r.complaint_id, r.company == "New") for r in rows.collect()) == [(k, k % 7 == 0) for k in range(300)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "SortMergeJoin" not in found[0] and "SortMergeJoin" in found[1]


@pytest.mark.parametrize("marker", [mor.DONE, mor.REPLACES])
def test_a_stopped_step_does_not_count(spark, monkeypatch, marker):
    location = scratch_dir(spark, "mor")
    for company in "AB":
        mor.merge(spark, bronze(spark, [complaint(complaint_id=1, company=company), complaint(complaint_id=2)]), location)
    before = by_key(mor.read(spark, location))

    def stopped(*args):
        raise KeyboardInterrupt

    monkeypatch.setattr(mor, "create_new" if marker == mor.DONE else "write_text", stopped)
    with pytest.raises(KeyboardInterrupt):
        mor.compact(spark, location)
    if marker == mor.DONE:
        with pytest.raises(KeyboardInterrupt):
            mor.merge(spark, bronze(spark, [complaint(complaint_id=1, company="C")]), location)
    monkeypatch.undo()
    assert by_key(mor.read(spark, location)) == before
    assert mor.compact(spark, location) and by_key(mor.read(spark, location)) == before


def test_edges(spark):
    location = scratch_dir(spark, "mor")
    assert mor.read(spark, location).collect() == [] and not mor.compact(spark, location)
    assert mor.merge(spark, bronze(spark, []), location) == 0
    with pytest.raises(Exception, match="NULL in key column"):
        mor.merge(spark, bronze(spark, [complaint(complaint_id=None)]), location)
    assert mor.read(spark, location).collect() == []
