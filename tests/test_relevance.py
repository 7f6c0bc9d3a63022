from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from plaintide.operators import relevance
from plaintide.session import scratch_dir
from tests.rows import bronze, complaint

WORDS = ["late", "fee", "bank", "loan", "card", "Größe", "fraud", "x1"]


def texts(n, seed, frequent="the"):
    """Texts of which nearly all have a frequent word and few have a rare one."""
    rng = random.Random(seed)
    return [
        " ".join([frequent] * rng.randint(0, 4) + rng.choices(WORDS, weights=[8, 6, 5, 4, 3, 2, 1, 1], k=rng.randint(0, 12)))
        for _ in range(n)
    ]


def plain(records, query):
    """BM25 of all records by the formula."""
    docs = {key: re.findall(r"[^\W_]+", text.lower()) for key, text in records.items() if text}
    docs = {key: words for key, words in docs.items() if words}
    mean = sum(map(len, docs.values())) / max(1, len(docs))
    scores = {}
    for term in set(re.findall(r"[^\W_]+", query.lower())):
        df = sum(term in words for words in docs.values())
        for key, words in docs.items():
            tf = Counter(words)[term]
            if tf:
                weight = math.log(1 + (len(docs) - df + 0.5) / (df + 0.5))
                norm = tf + relevance.K1 * (1 - relevance.B + relevance.B * len(words) / mean)
                scores[key] = scores.get(key, 0.0) + weight * tf * (relevance.K1 + 1) / norm
    return sorted(((k, round(s, relevance.DIGITS)) for k, s in scores.items()), key=lambda r: (-r[1], r[0]))


def load(spark, location, records):
    relevance.update(bronze(spark, [complaint(complaint_id=k, complaint_what_happened=t) for k, t in records.items()]), location)


def found(df):
    return [(r.complaint_id, r.score) for r in df.collect()]


def near(got, want):
    assert [k for k, _ in got] == [k for k, _ in want]
    assert [s for _, s in got] == pytest.approx([s for _, s in want], abs=1e-8)


@pytest.fixture(scope="module")
def index(spark):
    """An index after three loads: new records, replaced ones, texts that are no more."""
    location = scratch_dir(spark, "index")
    first = dict(enumerate(texts(300, 1)))
    second = {k: t for k, t in zip(range(250, 400), texts(150, 2))}
    third = {5: None, 6: "", 7: "!?", 8: "fraud " * 500, 399: "fraud"}
    for records in (first, second, third):
        load(spark, location, records)
    return location, first | second | third


@pytest.mark.parametrize("query", ["fraud", "the fraud", "THE, the late größe!", "x1 unknown"])
def test_all_matches_by_formula(spark, index, query):
    location, records = index
    near(found(relevance.search(spark, location, query)), plain(records, query))


@pytest.mark.parametrize("k", [1, 7, 60, 1000])
@pytest.mark.parametrize("query", ["the x1", "the late fraud x1", "bank"])
def test_best_k(spark, index, query, k):
    location, records = index
    near(found(relevance.search(spark, location, query, k=k)), plain(records, query)[:k])


def test_frequent_terms_are_left_out_of_the_candidates(spark, index):
    location, _ = index
    postings = relevance.live_postings(spark, location, "the x1")
    n, total = relevance.corpus(spark, location)
    terms = relevance.weighed(postings, n, total / n)
    assert [t.text for t in terms] == ["x1", "the"]
    assert relevance.needed(postings, terms, total / n, 3)[0] == 1
    assert relevance.needed(postings, terms, total / n, 10_000)[0] == 2


def test_ascending(spark, index):
    location, records = index
    want = sorted(plain(records, "late fee"), key=lambda r: (r[1], r[0]))
    near(found(relevance.search(spark, location, "late fee", ascending=True)), want)
    near(found(relevance.search(spark, location, "late fee", k=9, ascending=True)), want[:9])


def test_counts_follow_loads(spark, index):
    location, records = index
    lengths = [len(re.findall(r"[^\W_]+", t)) for t in records.values() if t]
    assert relevance.corpus(spark, location) == (sum(n > 0 for n in lengths), sum(lengths))


def test_nothing_found(spark, index):
    location, _ = index
    for where in (location, scratch_dir(spark, "none")):
        for query in ("", "?!", "nowhere"):
            assert found(relevance.search(spark, where, query, k=3)) == []


def test_empty_load_and_unfinished_load(spark):
    location = scratch_dir(spark, "index")
    load(spark, location, {1: "fee", 2: "late fee"})
    relevance.update(bronze(spark, []), location)
    bronze(spark, []).write.parquet(f"{location}/step=0000000009-dead/postings")
    near(found(relevance.search(spark, location, "late")), plain({1: "fee", 2: "late fee"}, "late"))


def test_equal_scores_go_by_key(spark):
    location, records = scratch_dir(spark, "index"), {k: "fee" for k in (9, 3, 7, 1)}
    load(spark, location, records)
    assert [k for k, _ in found(relevance.search(spark, location, "fee", k=3))] == [1, 3, 7]


def test_latest_of_a_load_counts_and_null_keys_fail(spark):
    location = scratch_dir(spark, "index")
    versions = [("fee", "2026-01-01"), ("late", "2026-01-03"), ("loan", "2026-01-02")]
    rows = [complaint(complaint_what_happened=t, extracted_at=f"{day}T00:00:00Z") for t, day in versions]
    relevance.update(bronze(spark, rows), location)
    assert [len(found(relevance.search(spark, location, t))) for t in ("fee", "late", "loan")] == [0, 1, 0]
    with pytest.raises(Exception, match="NULL in key"):
        relevance.update(bronze(spark, [complaint(complaint_id=None)]), location)


def test_records_in_order(spark, index):
    location, records = index
    rows = bronze(spark, [complaint(complaint_id=k) for k in records])
    got = relevance.sort_relevance(rows, location, "fraud late")
    near(found(got), plain(records, "fraud late"))
    assert {"company", "state"} <= set(got.columns)


def test_only_buckets_of_the_terms_are_read(spark, index):
    location, _ = index
    plan = relevance.live_postings(spark, location, "fraud")._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line and "tf#" in line]
    filters = [scan.split("PartitionFilters: [")[1].split("]")[0] for scan in scans]
    assert scans and all("bucket#" in f for f in filters)


def test_the_words_of_a_load_are_made_once(spark):
    """Lengths and postings come from the same kept rows."""
    location, seen = scratch_dir(spark, "index"), spark.sparkContext.accumulator(0)
    rows = bronze(spark, [complaint(complaint_id=k, complaint_what_happened="late fee") for k in range(7)])

    def counting(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    relevance.update(rows.mapInArrow(counting, rows.schema), location)
    assert seen.value == 7
    assert relevance.search(spark, location, "fee").count() == 7
