"""Serving frames over the marts.

Every frame is cut on the cluster, before anything is collected. Equal totals are ordered by key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaintide.functions.scalar import count_text, flag, percent, percent_text
from plaintide.operators.filters import leaf_rows, rollup_rows

TOP_N = 15
MIX_ROWS = 80


def _largest_first(mart: DataFrame, *keys: str) -> DataFrame:
    return mart.orderBy(F.col("total_complaints").desc_nulls_last(), *[F.col(k).asc_nulls_first() for k in keys])


# The output columns of every frame below, in order.


def dash_monthly(mart: DataFrame) -> DataFrame:
    return mart.select(
        "complaint_month_date",
        "total_complaints",
        "unique_companies",
        "unique_products",
        "unique_states",
        "pct_timely",
        "pct_with_narrative",
        "avg_days_to_response",
    ).orderBy(F.col("complaint_month_date").asc_nulls_last())


def dash_companies(mart: DataFrame) -> DataFrame:
    rows = mart.select(
        "company",
        "total_complaints",
        "pct_timely",
        "pct_with_narrative",
        "avg_days_to_response",
        "median_days_to_response",
        "first_complaint_date",
        "last_complaint_date",
    )
    return _largest_first(rows, "company")


def dash_states(mart: DataFrame) -> DataFrame:
    rows = mart.select(
        "state",
        "total_complaints",
        "unique_companies",
        "unique_products",
        "unique_issues",
        "pct_timely",
        "pct_with_narrative",
        "avg_days_to_response",
        "most_common_product",
        "most_common_issue",
        "most_complained_company",
    )
    return _largest_first(rows, "state")


def dash_products(mart: DataFrame) -> DataFrame:
    rows = mart.select(
        "product",
        "sub_product",
        "total_complaints",
        "unique_companies",
        "unique_states",
        "pct_timely",
        "pct_with_narrative",
        "avg_days_to_response",
        "most_common_issue",
        "most_complained_company",
    )
    return _largest_first(rows, "product", "sub_product")


def dash_issues(mart: DataFrame) -> DataFrame:
    rows = mart.select(
        "issue",
        "sub_issue",
        "total_complaints",
        "unique_companies",
        "unique_products",
        "unique_states",
        "pct_timely",
        "pct_with_narrative",
        "avg_days_to_response",
        "most_common_product",
        "most_complained_company",
    )
    return _largest_first(rows, "issue", "sub_issue")


def dash_responses(mart: DataFrame) -> DataFrame:
    rows = mart.select(
        "company_response",
        "total_complaints",
        "unique_companies",
        "unique_products",
        "unique_states",
        "pct_timely",
        "pct_with_narrative",
        "avg_days_to_response",
        "most_common_product",
        "most_common_issue",
        "most_complained_company",
    )
    return _largest_first(rows, "company_response")


def dash_coverage(fact: DataFrame) -> DataFrame:
    """One row of headline figures, also for an empty fact table."""
    rows = F.count(F.lit(1))
    return fact.agg(
        rows.alias("total_complaints"),
        F.count_distinct("company").alias("total_companies"),
        F.count_distinct("product").alias("total_products"),
        F.count_distinct("state").alias("total_states"),
        F.min("date_received").alias("first_complaint_date"),
        F.max("date_received").alias("last_complaint_date"),
        percent(F.sum(flag(F.col("is_timely_response"))), rows).alias("pct_timely"),
        percent(F.sum(flag(F.col("has_narrative"))), rows).alias("pct_with_narrative"),
    )


def monthly_trend(monthly: DataFrame) -> DataFrame:
    rows = monthly.select("complaint_month_date", "total_complaints", "pct_timely")
    return rows.orderBy(F.col("complaint_month_date").asc_nulls_last())


def top_companies(companies: DataFrame, top_n: int = TOP_N) -> DataFrame:
    return dash_companies(companies).limit(top_n).drop("median_days_to_response")


def ascending(frame: DataFrame, key: str) -> DataFrame:
    """Smallest total first, the order a horizontal bar chart is drawn in."""
    return frame.orderBy(F.col("total_complaints").asc_nulls_last(), F.col(key).asc_nulls_last())


def top_products(products: DataFrame, top_n: int = TOP_N) -> DataFrame:
    """Rows without a sub-product, largest first; includes leaf groups whose sub-product is missing."""
    rows = rollup_rows(products, "sub_product").select("product", "total_complaints", "avg_days_to_response")
    return rows.orderBy(
        F.col("total_complaints").desc_nulls_last(),
        F.col("product").asc_nulls_first(),
        F.col("avg_days_to_response").asc_nulls_first(),
    ).limit(top_n)


def top_issues(issues: DataFrame, top_n: int = TOP_N) -> DataFrame:
    """Rows without a sub-issue, largest first; includes leaf groups whose sub-issue is missing."""
    rows = rollup_rows(issues, "sub_issue").select(
        "issue",
        "total_complaints",
        "unique_companies",
        "unique_products",
        "pct_timely",
        "pct_with_narrative",
        "avg_days_to_response",
        "most_common_product",
        "most_complained_company",
    )
    return rows.orderBy(
        F.col("total_complaints").desc_nulls_last(),
        F.col("issue").asc_nulls_first(),
        F.col("unique_companies").asc_nulls_first(),
        F.col("unique_products").asc_nulls_first(),
    ).limit(top_n)


def product_mix(products: DataFrame, rows: int = MIX_ROWS) -> DataFrame:
    """Largest product / sub-product leaves."""
    leaves = _largest_first(leaf_rows(products, "sub_product"), "product", "sub_product")
    return leaves.limit(rows).select("product", "sub_product", "total_complaints", "pct_timely")


def product_mix_parent(products: DataFrame, rows: int = MIX_ROWS) -> DataFrame:
    """Parents of the mix: sum of the shown totals, timely percent weighted by total."""
    weighted = F.sum(F.col("total_complaints") * F.col("pct_timely").cast("decimal(18,2)")).cast("double")
    total = F.sum("total_complaints")
    return (
        product_mix(products, rows)
        .groupBy("product")
        .agg(total.alias("total_complaints"), (weighted / F.nullif(total, F.lit(0).cast("long"))).alias("pct_timely"))
    )


def top_states(states: DataFrame, top_n: int = TOP_N) -> DataFrame:
    return dash_states(states).limit(top_n).drop("pct_with_narrative")


def response_outcomes(responses: DataFrame) -> DataFrame:
    return ascending(dash_responses(responses), "company_response")


def kpi_header(coverage: DataFrame) -> DataFrame:
    """The five headline values as text."""
    return coverage.select(
        count_text(F.col("total_complaints")).alias("complaints"),
        count_text(F.col("total_companies")).alias("companies"),
        count_text(F.col("total_products")).alias("products"),
        percent_text(F.col("pct_timely")).alias("timely"),
        percent_text(F.col("pct_with_narrative")).alias("narratives"),
    )


# Serving frame, the stored model it reads, and the query.
FRAMES = {
    "monthly": ("agg_complaints_by_month", dash_monthly),
    "companies": ("dim_companies", dash_companies),
    "states": ("dim_states", dash_states),
    "products": ("dim_products", dash_products),
    "issues": ("dim_issues", dash_issues),
    "responses": ("dim_response_types", dash_responses),
    "coverage": ("fct_complaints", dash_coverage),
}
