"""Aggregate marts over the metric relation.

Rows of a stored Spark table have no order, so a mart is stored as it comes and sorted when it is listed
(:func:`listed`) or served (`plans.serving`).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaintide.functions.scalar import share_percent
from plaintide.operators.profile import child_totals, profile

COUNTS = {
    "unique_companies": "company",
    "unique_products": "product",
    "unique_states": "state",
}
FLAGS = ["timely_responses", "pct_timely", "complaints_with_narrative", "pct_with_narrative"]
DAYS = ["avg_days_to_response", "median_days_to_response"]
EXTREMES = ["min_days_to_response", "max_days_to_response"]
DATES = ["first_complaint_date", "last_complaint_date"]


def _counts(*names: str) -> dict[str, str]:
    return {name: COUNTS[name] for name in names}


@dataclass(frozen=True)
class Mart:
    """A grouped mart: its keys (the first is never NULL), what it counts and votes on, and its final projection."""

    keys: tuple[str, ...]
    distinct: dict[str, str]
    modes: dict[str, str]
    finish: Callable[[DataFrame], DataFrame]

    def stats(self, metrics: DataFrame) -> DataFrame:
        return profile(metrics.filter(F.col(self.keys[0]).isNotNull()), self.keys, self.distinct, self.modes)

    def build(self, metrics: DataFrame) -> DataFrame:
        return self.finish(self.stats(metrics))


STATE_COUNTS = {
    "unique_companies": "company",
    "unique_products": "product",
    "unique_issues": "issue",
    "unique_zip_codes": "zip_code",
}
STATE_MODES = {
    "most_common_issue": "issue",
    "most_common_product": "product",
    "most_common_submission_method": "submitted_via",
    "most_complained_company": "company",
}
RESPONSE_MODES = {
    "most_common_product": "product",
    "most_common_issue": "issue",
    "most_complained_company": "company",
}
PRODUCT_COUNTS = _counts("unique_companies", "unique_states")
PRODUCT_MODES = {"most_common_issue": "issue", "most_complained_company": "company"}
ISSUE_MODES = {"most_common_product": "product", "most_complained_company": "company"}


def _months(stats: DataFrame) -> DataFrame:
    month = F.col("complaint_month_date")
    return stats.select(
        "complaint_month_date",
        F.year(month).cast("long").alias("year"),
        F.month(month).cast("long").alias("month"),
        "total_complaints",
        *COUNTS,
        *FLAGS,
        *DAYS,
    )


def _companies(stats: DataFrame) -> DataFrame:
    return stats.withColumn("pct_timely", share_percent(F.col("timely_responses"), F.col("total_complaints"))).select(
        "company",
        "total_complaints",
        "timely_responses",
        "complaints_with_narrative",
        "pct_timely",
        "pct_with_narrative",
        *DAYS,
        *EXTREMES,
        *DATES,
    )


def _states(stats: DataFrame) -> DataFrame:
    return stats.select("state", "total_complaints", *STATE_COUNTS, *FLAGS, *DAYS, *EXTREMES, *DATES, *STATE_MODES)


def _responses(stats: DataFrame) -> DataFrame:
    return stats.select("company_response", "total_complaints", *COUNTS, *FLAGS, *DAYS, *EXTREMES, *DATES, *RESPONSE_MODES)


def _product_leaves(stats: DataFrame) -> DataFrame:
    return stats.select(
        "product", "sub_product", "total_complaints", *PRODUCT_COUNTS, *FLAGS, *DAYS, *DATES, *PRODUCT_MODES
    )


def _issue_leaves(stats: DataFrame) -> DataFrame:
    return stats.select("issue", "sub_issue", "total_complaints", *COUNTS, *FLAGS, *DAYS, *DATES, *ISSUE_MODES)


def _products(stats: DataFrame) -> DataFrame:
    leaves = _product_leaves(stats)
    return child_totals(leaves, "product", "sub_product", list(PRODUCT_COUNTS), list(PRODUCT_MODES), keep_children=True)


def _issues(stats: DataFrame) -> DataFrame:
    leaves = _issue_leaves(stats)
    return child_totals(leaves, "issue", "sub_issue", list(COUNTS), list(ISSUE_MODES), keep_children=True)


GROUPED = {
    "agg_complaints_by_month": Mart(("complaint_month_date",), COUNTS, {}, _months),
    "dim_companies": Mart(("company",), {}, {}, _companies),
    "dim_states": Mart(("state",), STATE_COUNTS, STATE_MODES, _states),
    "dim_response_types": Mart(("company_response",), COUNTS, RESPONSE_MODES, _responses),
    "dim_products": Mart(("product", "sub_product"), PRODUCT_COUNTS, PRODUCT_MODES, _products),
    "dim_issues": Mart(("issue", "sub_issue"), COUNTS, ISSUE_MODES, _issues),
}

#: Name and builder from complaints. Products and issues have leaf rows and total rows; a leaf without a child name
#: looks like a total, as the mart defines it.
MARTS = {name: mart.build for name, mart in GROUPED.items()}

agg_complaints_by_month = MARTS["agg_complaints_by_month"]
dim_companies = MARTS["dim_companies"]
dim_states = MARTS["dim_states"]
dim_response_types = MARTS["dim_response_types"]
dim_products = MARTS["dim_products"]
dim_issues = MARTS["dim_issues"]


def product_stats(metrics: DataFrame) -> DataFrame:
    """Leaf level; a NULL sub-product is a group of its own."""
    return _product_leaves(GROUPED["dim_products"].stats(metrics))


def product_totals(leaves: DataFrame) -> DataFrame:
    return child_totals(leaves, "product", "sub_product", list(PRODUCT_COUNTS), list(PRODUCT_MODES), keep_children=False)


def issue_stats(metrics: DataFrame) -> DataFrame:
    """Leaf level; a NULL sub-issue is a group of its own."""
    return _issue_leaves(GROUPED["dim_issues"].stats(metrics))


def issue_totals(leaves: DataFrame) -> DataFrame:
    return child_totals(leaves, "issue", "sub_issue", list(COUNTS), list(ISSUE_MODES), keep_children=False)


def listed(name: str, mart: DataFrame) -> DataFrame:
    """A mart in its listing order: newest month, parent then child (the total before a leaf without a child), or largest total first."""
    if name == "agg_complaints_by_month":
        return mart.orderBy(F.col("complaint_month_date").desc_nulls_last())
    key = F.col(mart.columns[0]).asc_nulls_last()
    if name in ("dim_products", "dim_issues"):
        return mart.orderBy(key, F.col(mart.columns[1]).asc_nulls_first(), F.col("total_complaints").desc())
    return mart.orderBy(F.col("total_complaints").desc_nulls_last(), key)
