from __future__ import annotations

import json
import os

import pytest

from plaintide.session import scratch_dir
from plaintide.sources.chain import DAY, chain_findings, reconcile_chain
from plaintide.sources.pages import fetch_folder, read_pages

RUN_TS = "2026-07-11T02:00:00.000Z"
FETCH = "20260711T020000000Z"
SIZE = 10


def fetch(n, descending=True):
    """Pages of a whole fetch of `n` records over several days, an empty one last."""
    days = sorted((100 - i // 25 for i in range(n)), reverse=descending)
    step = -1 if descending else 1
    sorts = [[day * DAY, str(5000 + step * i)] for i, day in enumerate(days)]
    pages, cursor = [], None
    for first in range(0, n + 1, SIZE):
        hits = [{"_source": {"complaint_id": int(s[1])}, "sort": s} for s in sorts[first : first + SIZE]]
        pages.append({"search_after": cursor, "hits": {"total": {"value": n}, "hits": hits}})
        cursor = f"{hits[-1]['sort'][0]}_{hits[-1]['sort'][1]}" if hits else cursor
    return pages


def landed(spark, pages, run_ts=RUN_TS, root=None):
    root = root or scratch_dir(spark, "chain")
    folder = fetch_folder(root, run_ts)
    os.makedirs(folder)
    for i, page in enumerate(pages):
        with open(f"{folder}/{(i * 7) % 101:03d}.json", "w") as out:
            out.write(json.dumps(page) + "\n")
    return read_pages(spark, root), root


def found(spark, pages, descending=True):
    rows, _ = landed(spark, pages)
    return sorted(tuple(r)[1:] for r in chain_findings(rows, descending).collect())


def summary(spark, pages, descending=True):
    rows, _ = landed(spark, pages)
    return reconcile_chain(rows, descending).first().asDict()


def edge(page, at):
    return "_".join(map(str, page["hits"]["hits"][at]["sort"]))


@pytest.mark.parametrize("descending", [True, False])
def test_whole_fetch(spark, descending):
    pages = fetch(95, descending)
    assert found(spark, pages, descending) == []
    counts = summary(spark, pages, descending)
    assert (counts["is_complete"], counts["is_closed"]) == (True, False)


def test_closed_by_an_empty_page(spark):
    pages = fetch(90)
    assert pages[-1]["hits"]["hits"] == []
    assert summary(spark, pages) == {
        "fetch": FETCH,
        "expected": 90,
        "records": 90,
        "different_records": 90,
        "pages": 9,
        "doubled_pages": 0,
        "gaps": 0,
        "overlaps": 0,
        "is_closed": True,
        "is_complete": True,
    }


def test_lost_and_doubled_pages_of_equal_size_do_not_balance(spark):
    pages = fetch(90)
    broken = [p for i, p in enumerate(pages) if i != 4] + [pages[6]]
    assert found(spark, broken) == [
        ("doubled", edge(pages[6], 0), edge(pages[6], -1), 1, 10),
        ("gap", edge(pages[3], -1), edge(pages[4], -1), None, None),
    ]
    counts = summary(spark, broken)
    assert counts["expected"] == counts["records"] == 90
    assert (counts["different_records"], counts["gaps"], counts["is_complete"]) == (80, 1, False)


def test_lost_first_and_last_page(spark):
    pages = fetch(90)
    assert found(spark, pages[1:]) == [("gap", None, edge(pages[0], -1), None, None)]
    cut = pages[:-2]
    assert found(spark, cut) == []
    assert (summary(spark, cut)["is_closed"], summary(spark, cut)["is_complete"]) == (False, False)


def test_gap_at_the_border_of_days(spark):
    """Places before a gap come from earlier buckets."""
    pages = fetch(250)
    assert found(spark, pages[:3] + pages[12:]) == [("gap", edge(pages[2], -1), edge(pages[11], -1), None, None)]


def test_overlap_and_disorder(spark):
    pages = fetch(90)
    late = pages[5]["hits"]["hits"]
    pages[5] = {**pages[5], "hits": {**pages[5]["hits"], "hits": [pages[4]["hits"]["hits"][-1], *late]}}
    assert found(spark, pages) == [("overlap", edge(pages[4], -1), edge(pages[4], -1), 1, None)]
    pages = fetch(90)
    pages[5]["hits"]["hits"].reverse()
    assert found(spark, pages) == [("disorder", edge(pages[5], -1), edge(pages[5], 0), 1, 10)]


def test_pages_without_cursors_or_places(spark):
    pages = fetch(30)
    bare = [{"hits": p["hits"]} for p in pages]
    assert [f[0] for f in found(spark, bare)] == ["uncertain", "uncertain"]
    assert summary(spark, bare)["is_complete"] is True
    del pages[1]["hits"]["hits"][3]["sort"]
    pages[2]["hits"]["hits"][0]["sort"] = ["soon", "1"]
    assert found(spark, pages) == [("unplaced", None, None, 2, 20)]
    assert summary(spark, pages)["is_complete"] is False


def test_no_pages_and_several_fetches(spark):
    rows, root = landed(spark, fetch(90)[2:])
    assert chain_findings(rows.limit(0)).count() == 0 and reconcile_chain(rows.limit(0)).count() == 0
    both, _ = landed(spark, fetch(60), "2026-07-12T02:00:00.000Z", root)
    counts = {r.fetch: (r.pages, r.gaps, r.is_complete) for r in reconcile_chain(both).collect()}
    assert counts == {FETCH: (7, 1, False), "20260712T020000000Z": (6, 0, True)}


def test_only_edges_are_shuffled(spark):
    """No exchange carries the hits of a page, and no window lies over all rows."""
    rows, _ = landed(spark, fetch(90))
    plan = chain_findings(rows)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert not any("hits" in line or "spots" in line for line in plan.splitlines() if " Exchange " in line)
