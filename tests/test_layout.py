"""Lookups by company and day against a filter of the whole table, and the files they read."""

from __future__ import annotations

import random

import pytest

from plaintide.operators.filters import filter_company, filter_received_range
from plaintide.operators.upsert import RANGE_WIDTH
from plaintide.plans import layout
from tests.rows import bronze, by_key, complaint


def some(r, keys):
    """A third of all rows belongs to one company; some have no company or no day."""
    company = lambda: r.choice(["Hot"] * 4 + [f"C{r.randint(1, 40)}"] * 7 + [None])
    day = lambda: f"2026-0{r.randint(1, 9)}-{r.randint(10, 28)}T{r.choice(['00', '23'])}:30:00.000Z"
    return [complaint(complaint_id=k, company=company(), date_received=r.choice([day()] * 9 + [None])) for k in keys]


LOOKUPS = [("Hot", None, None), ("C7", None, None), ("C7", "2026-03-01", "2026-04-15"), ("Hot", "2026-09-15", None),
           (None, "2026-02-10", "2026-02-12"), ("Nobody", None, None), (None, None, "2026-01-10"), (None, None, None)]


def expected(source, company, first, last):
    if first or last:
        source = filter_received_range(source, first or "0001-01-01", last or "9999-12-30")
    return by_key(filter_company(source, company))


def test_lookups_find_the_same_rows(spark, warehouse):
    r = random.Random(5)
    warehouse.upsert(bronze(spark, some(r, [*range(-50, 350), *range(2 * RANGE_WIDTH, 2 * RANGE_WIDTH + 200)])))
    with pytest.raises(LookupError):
        layout.find(warehouse, "Hot")
    first = layout.refresh_layout(warehouse, files=8)
    warehouse.upsert(bronze(spark, some(r, range(100, 400))))
    assert layout.find(warehouse).count() == 600  # as of the last refresh
    second = layout.refresh_layout(warehouse, files=8)
    assert {k: first.parts[k] == second.parts[k] for k in first.parts} == {"-1": True, "0": False, "2": True}
    source = warehouse.source_table()
    for lookup in LOOKUPS:
        assert by_key(layout.find(warehouse, *lookup)) == expected(source, *lookup), lookup
    files = {lookup: len(layout.files_of(warehouse, *lookup)) for lookup in LOOKUPS}
    assert files[("Nobody", None, None)] == 0 and files[("C7", None, None)] < files[(None, None, None)] / 2
    assert files[("C7", "2026-03-01", "2026-04-15")] <= files[("C7", None, None)]
    assert files[(None, "2026-02-10", "2026-02-12")] < files[(None, None, None)]


def test_an_empty_table(spark, warehouse):
    warehouse.create_if_absent()
    layout.refresh_layout(warehouse)
    assert layout.find(warehouse, "Hot").collect() == [] and layout.find(warehouse).collect() == []


def test_days_are_utc_days(new_york, warehouse):
    times = ["2026-03-08T00:00:00.000Z", "2026-03-08T23:59:59.000Z", "2026-03-09T00:00:00.000Z"]
    warehouse.upsert(bronze(new_york, [complaint(complaint_id=i, date_received=t) for i, t in enumerate(times)]))
    layout.refresh_layout(warehouse)
    assert sorted(by_key(layout.find(warehouse, "Acme", "2026-03-08", "2026-03-08"))) == [0, 1]
    assert sorted(by_key(layout.find(warehouse, None, "2026-03-09"))) == [2]


def test_places_on_the_curve(spark):
    """Against the bits laid out one by one."""
    r = random.Random(6)
    points = [(r.randrange(1 << 16), r.randrange(1 << 16)) for _ in range(50)] + [(0, 0), (65535, 65535), (65535, 0)]
    found = spark.createDataFrame(points, "x int, y int").select("x", "y", layout.interleaved(layout.F.col("x"), layout.F.col("y"))).collect()
    for x, y, z in found:
        assert z == sum(((x >> i & 1) << (2 * i + 1)) | ((y >> i & 1) << (2 * i)) for i in range(16))
