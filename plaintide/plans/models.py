"""Staging, metric and fact projections; no shuffle in any of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaintide.functions.scalar import utc_date_sql


# Columns of the two views as SQL, so that a frame and a view of the catalog are the same projection.
def staged_columns(utc_days: Callable[[str], str]) -> dict[str, str]:
    """18 columns of the warehouse table, timestamps cut to UTC days."""
    same = ["complaint_id", "product", "sub_product", "issue", "sub_issue", "company", "state", "zip_code", "submitted_via"]
    days = ["date_received", "date_sent_to_company"]
    rest = [
        "company_response", "company_public_response", "timely", "has_narrative", "complaint_what_happened", "tags",
    ]
    columns = {name: name for name in same} | {name: utc_days(name) for name in days} | {name: name for name in rest}
    return columns | {"dbt_extracted_at": "extracted_at"}


STAGED = list(staged_columns(str))

METRICS = {name: name for name in STAGED} | {
    "days_to_response": "CAST(date_diff(date_sent_to_company, date_received) AS BIGINT)",
    "is_timely_response": "CASE WHEN timely = 'Yes' THEN true WHEN timely = 'No' THEN false END",
    "complaint_year": "CAST(year(date_received) AS BIGINT)",
    "complaint_month": "CAST(month(date_received) AS BIGINT)",
    "complaint_month_date": "trunc(date_received, 'month')",
}


def selected(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.select(*[F.expr(expression).alias(name) for name, expression in columns.items()])


def stg_complaints(source: DataFrame) -> DataFrame:
    return selected(source, staged_columns(lambda name: utc_date_sql(source, name)))


def int_complaint_metrics(staged: DataFrame) -> DataFrame:
    """The staged columns and five derived ones."""
    return selected(staged, METRICS)


def fct_complaints(metrics: DataFrame) -> DataFrame:
    """One row per complaint, 21 columns."""
    return metrics.select(
        "complaint_id",
        "product",
        "sub_product",
        "issue",
        "sub_issue",
        "company",
        "state",
        "zip_code",
        "submitted_via",
        "company_response",
        "company_public_response",
        "date_received",
        "date_sent_to_company",
        "complaint_year",
        "complaint_month",
        "complaint_month_date",
        "days_to_response",
        "is_timely_response",
        "has_narrative",
        "complaint_what_happened",
        "tags",
    )
