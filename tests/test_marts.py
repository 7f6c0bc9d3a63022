"""Marts against brute force in plain Python, on random and hand-made rows."""

from __future__ import annotations

import random
import statistics
from collections import Counter
from datetime import date, datetime

import pytest

from plaintide.plans import marts, models, serving
from tests.rows import bronze, complaint


def metrics(spark, rows):
    return models.int_complaint_metrics(models.stg_complaints(bronze(spark, rows)))


def day(text):
    return None if text is None else datetime.fromisoformat(text.replace("Z", "+00:00")).date()


def facts(rows):
    for r in rows:
        received, sent = day(r["date_received"]), day(r["date_sent_to_company"])
        yield {
            **r,
            "received": received,
            "days": (sent - received).days if sent and received else None,
            "is_timely": {"Yes": True, "No": False}.get(r["timely"]),
            "month": received.replace(day=1) if received else None,
        }


def mode(values):
    counts = Counter(v for v in values if v is not None)
    return min((v for v in counts if counts[v] == max(counts.values())), default=None)


def true_count(values):
    known = [v for v in values if v is not None]
    return sum(known) if known else None


def pct(part, whole):
    return None if part is None else round(100.0 * part / whole * 100.0) / 100.0


def near(a, b):
    return a == b or (a is not None and b is not None and abs(a - b) < 0.0101)


def group(rows, *keys):
    groups = {}
    for r in facts(rows):
        groups.setdefault(tuple(r[k] for k in keys), []).append(r)
    return groups


def check(found, members, distinct, modes, extremes):
    days = [m["days"] for m in members if m["days"] is not None]
    timely, narrative = true_count(m["is_timely"] for m in members), true_count(m["has_narrative"] for m in members)
    received = [m["received"] for m in members if m["received"]]
    assert found["total_complaints"] == len(members)
    assert found["timely_responses"] == timely
    assert found["complaints_with_narrative"] == narrative
    assert near(found["pct_timely"], pct(timely, len(members)))
    assert near(found["pct_with_narrative"], pct(narrative, len(members)))
    assert near(found["avg_days_to_response"], statistics.fmean(days) if days else None)
    assert found["median_days_to_response"] == (statistics.median(days) if days else None)
    if extremes:
        assert found["min_days_to_response"] == min(days, default=None)
        assert found["max_days_to_response"] == max(days, default=None)
    if "first_complaint_date" in found:
        assert found["first_complaint_date"] == min(received, default=None)
        assert found["last_complaint_date"] == max(received, default=None)
    for name, column in distinct.items():
        assert found[name] == len({m[column] for m in members} - {None}), name
    for name, column in modes.items():
        assert found[name] == mode(m[column] for m in members), name


def random_rows(seed, n=400):
    rng = random.Random(seed)

    def pick(*values):
        # the first value holds a third of all rows
        return values[0] if rng.random() < 0.34 else rng.choice([*values, None])

    return [
        complaint(
            complaint_id=i,
            product=pick("Loan", "Card", "Debt"),
            sub_product=pick("Auto", "Home"),
            issue=pick("Fees", "Fraud", "Other"),
            sub_issue=pick("Late", "Lost"),
            company=pick("Acme", "Beta", "Cyan", "Dune"),
            state=pick("NY", "CA", "TX"),
            zip_code=pick("10001", "94110", "73301"),
            submitted_via=pick("Web", "Phone"),
            company_response=pick("Closed", "In progress"),
            timely=pick("Yes", "No", "yes"),
            has_narrative=pick(True, False),
            date_received=pick("2026-01-31T23:30:00.000Z", "2026-02-01T00:00:00.000Z", "2025-12-15T05:00:00.000Z"),
            date_sent_to_company=pick("2026-02-03T01:00:00.000Z", "2025-12-01T00:00:00.000Z", "2026-06-01T00:00:00.000Z"),
        )
        for i in range(n)
    ]


PLANS = {
    "agg_complaints_by_month": (["month"], marts.COUNTS, {}, False),
    "dim_companies": (["company"], {}, {}, True),
    "dim_states": (
        ["state"],
        {"unique_companies": "company", "unique_products": "product", "unique_issues": "issue",
         "unique_zip_codes": "zip_code"},
        {"most_common_issue": "issue", "most_common_product": "product",
         "most_common_submission_method": "submitted_via", "most_complained_company": "company"},
        True,
    ),
    "dim_response_types": (
        ["company_response"],
        marts.COUNTS,
        {"most_common_product": "product", "most_common_issue": "issue", "most_complained_company": "company"},
        True,
    ),
    "product_stats": (["product", "sub_product"], marts.PRODUCT_COUNTS, marts.PRODUCT_MODES, False),
    "issue_stats": (["issue", "sub_issue"], marts.COUNTS, marts.ISSUE_MODES, False),
}


@pytest.mark.parametrize("name", PLANS)
@pytest.mark.parametrize("seed", [1, 2])
def test_mart_equals_brute_force(spark, name, seed):
    rows = random_rows(seed)
    keys, distinct, modes, extremes = PLANS[name]
    mart = getattr(marts, name)(metrics(spark, rows))
    columns = mart.columns[: len(keys)]
    found = {tuple(r[c] for c in columns): r.asDict() for r in mart.collect()}
    expected = {k: v for k, v in group(rows, *keys).items() if k[0] is not None}
    assert found.keys() == expected.keys()
    for key, members in expected.items():
        check(found[key], members, distinct, modes, extremes)


def test_totals_follow_the_children(spark):
    relation = metrics(spark, random_rows(3))
    for leaf_mart, both_mart, total_mart, parent, child in [
        (marts.product_stats, marts.dim_products, marts.product_totals, "product", "sub_product"),
        (marts.issue_stats, marts.dim_issues, marts.issue_totals, "issue", "sub_issue"),
    ]:
        leaves = leaf_mart(relation)
        leaf_rows = [r.asDict() for r in leaves.collect()]
        totals = {r[parent]: r.asDict() for r in total_mart(leaves).collect()}
        both = [r.asDict() for r in both_mart(relation).collect()]
        assert sorted(map(repr, both)) == sorted(map(repr, [*leaf_rows, *totals.values()]))
        for name, total in totals.items():
            children = [r for r in leaf_rows if r[parent] == name]
            assert total[child] is None
            assert total["total_complaints"] == sum(c["total_complaints"] for c in children)
            assert total["unique_companies"] == len({c["unique_companies"] for c in children})
            assert total["most_complained_company"] == mode(c["most_complained_company"] for c in children)
            assert near(
                total["avg_days_to_response"], statistics.fmean(c["avg_days_to_response"] for c in children)
            )
            assert near(
                total["median_days_to_response"], statistics.fmean(c["median_days_to_response"] for c in children)
            )


def test_missing_child_stands_beside_the_total(spark):
    rows = [complaint(complaint_id=i, sub_product=s) for i, s in enumerate([None, None, "Auto"])]
    found = marts.dim_products(metrics(spark, rows))
    assert sorted((r["sub_product"] or "", r["total_complaints"]) for r in found.collect()) == [
        ("", 2),
        ("", 3),
        ("Auto", 1),
    ]
    top = serving.top_products(found).collect()
    assert [r["total_complaints"] for r in top] == [3, 2]


def test_flags_and_days_of_a_group_without_values(spark):
    rows = [complaint(complaint_id=i, timely=None, has_narrative=None, date_sent_to_company=None) for i in range(2)]
    found = marts.dim_companies(metrics(spark, rows)).collect()[0].asDict()
    assert found["total_complaints"] == 2
    absent = ["timely_responses", "pct_timely", "complaints_with_narrative", "pct_with_narrative",
              "avg_days_to_response", "median_days_to_response", "min_days_to_response", "max_days_to_response"]
    assert [found[c] for c in absent] == [None] * len(absent)


def test_negative_days_even_median_and_timely_case(spark):
    rows = [
        complaint(complaint_id=1, date_sent_to_company="2025-12-30T00:00:00.000Z", timely="yes"),
        complaint(complaint_id=2, date_sent_to_company="2026-01-04T00:00:00.000Z", timely="No"),
    ]
    found = marts.dim_companies(metrics(spark, rows)).collect()[0]
    assert (found["min_days_to_response"], found["max_days_to_response"]) == (-2, 3)
    assert (found["avg_days_to_response"], found["median_days_to_response"]) == (0.5, 0.5)
    assert (found["timely_responses"], found["pct_timely"]) == (0, 0.0)


def test_month_is_the_utc_month(spark, new_york):
    rows = [complaint(date_received="2026-02-01T03:00:00.000Z")]
    found = marts.agg_complaints_by_month(metrics(new_york, rows)).collect()[0]
    assert (found["complaint_month_date"], found["year"], found["month"]) == (date(2026, 2, 1), 2026, 2)


def test_empty_input(spark):
    relation = metrics(spark, [])
    for build in marts.MARTS.values():
        assert build(relation).collect() == []
    coverage = serving.dash_coverage(models.fct_complaints(relation))
    assert tuple(coverage.collect()[0]) == (0, 0, 0, 0, None, None, None, None)
    assert tuple(serving.kpi_header(coverage).collect()[0]) == ("0", "0", "0", "-", "-")


def test_serving_order_and_limits(spark):
    rows = [complaint(complaint_id=i, company=f"C{i % 20:02d}") for i in range(50)]
    companies = marts.dim_companies(metrics(spark, rows))
    top = [r["company"] for r in serving.top_companies(companies, 5).collect()]
    assert top == ["C00", "C01", "C02", "C03", "C04"]
    drawn = serving.ascending(serving.top_companies(companies, 12), "company").collect()
    assert [r["total_complaints"] for r in drawn] == [2, 2] + [3] * 10


def test_listing_order(spark):
    relation = metrics(spark, random_rows(4))

    def first(name, *columns):
        return [tuple(r[c] for c in columns) for r in marts.listed(name, marts.MARTS[name](relation)).collect()]

    months = [m for (m,) in first("agg_complaints_by_month", "complaint_month_date")]
    assert months == sorted(months, reverse=True)
    products = first("dim_products", "product", "sub_product")
    assert products == sorted(products, key=lambda r: (r[0], r[1] is not None, r[1] or ""))
    totals = [n for (n,) in first("dim_states", "total_complaints")]
    assert totals == sorted(totals, reverse=True)


def test_mix_parent_is_weighted(spark):
    rows = [
        complaint(complaint_id=1, sub_product="A", timely="Yes"),
        complaint(complaint_id=2, sub_product="B", timely="No"),
        complaint(complaint_id=3, sub_product="B", timely="No"),
        complaint(complaint_id=4, sub_product="B", timely="Yes"),
        complaint(complaint_id=5, sub_product=None, timely="No"),
    ]
    found = serving.product_mix_parent(marts.dim_products(metrics(spark, rows))).collect()
    assert [(r["product"], r["total_complaints"]) for r in found] == [("Loan", 4)]
    assert found[0]["pct_timely"] == pytest.approx((100.0 + 3 * 33.33) / 4)
