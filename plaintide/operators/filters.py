"""Row filters and result order of a fetch."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaintide.functions.scalar import day_start


def filter_received_range(df: DataFrame, first: str, last: str) -> DataFrame:
    """Records received between two UTC days, both included."""
    received, after = F.col("date_received"), date.fromisoformat(last) + timedelta(days=1)
    begin, end = (day_start(df, "date_received", d) for d in (date.fromisoformat(first), after))
    return df.filter((received >= begin) & (received < end))


def filter_company(df: DataFrame, company: str | None = None) -> DataFrame:
    """Records of one company, or all if none is given."""
    return df.filter(F.col("company") == company) if company else df


def lookback_window(df: DataFrame, run_date: str, days: int = 90) -> DataFrame:
    """Records received on or after `run_date` minus `days`."""
    begin = date.fromisoformat(run_date) - timedelta(days=days)
    return df.filter(F.col("date_received") >= day_start(df, "date_received", begin))


def sort_created(df: DataFrame, ascending: bool = False) -> DataFrame:
    """By received time (newest first unless `ascending`), then by key."""
    received = F.col("date_received")
    return df.orderBy(received.asc_nulls_last() if ascending else received.desc_nulls_last(), "complaint_id")


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def rollup_rows(mart: DataFrame, child: str) -> DataFrame:
    """Rows without a child: the totals, and the leaf group whose child is missing."""
    return mart.filter(F.col(child).isNull())


def leaf_rows(mart: DataFrame, child: str) -> DataFrame:
    return mart.filter(F.col(child).isNotNull())
