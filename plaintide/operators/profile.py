"""Grouped complaint statistics in two counting passes.

A direct `groupBy(state)` with exact distinct counts, modes and a median keeps one value table per group
and merges every map task's copy of it in a single reducer: a state with a third of all rows makes that
reducer the whole job. Here the first pass counts each (group, value) pair. It combines map-side, and
its shuffle spreads one hot group over all reducers by value. The second pass sees one row per distinct
value, so its size follows the number of values in a group, never the number of complaints.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plaintide.functions.scalar import percent, round2

DAYS = "days_to_response"


def value_counts(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Rows per (keys, value) for each value column and for the response days, in one scan.

    `source` is the position of the value column in `values`, or -1 for the days. The sums and extremes of
    a group are taken from the day rows, which cover every complaint once; other rows leave them NULL.
    """
    measures = f"{DAYS}, CAST(is_timely_response AS BIGINT), CAST(has_narrative AS BIGINT), date_received"
    absent = "CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS DATE)"
    pairs = [f"{position}, {column}, {absent}" for position, column in enumerate(values)]
    pairs.append(f"-1, CAST(NULL AS STRING), {measures}")
    names = ["source", "value", "days", "timely", "narrative", "date"]
    long = df.select(*keys, F.expr(f"stack({len(pairs)}, {', '.join(pairs)})").alias(*names))
    return long.groupBy(*keys, "source", "value", "days").agg(
        F.expr("count(1)").alias("n"),
        F.expr("sum(timely)").alias("timely"),
        F.expr("sum(narrative)").alias("narrative"),
        F.expr("min(date)").alias("first_date"),
        F.expr("max(date)").alias("last_date"),
    )


def commonest(position: int) -> Column:
    """Value with the greatest count `n`, the smallest value on a tie, NULL only if there is no value."""
    return F.expr(f"min(struct(-n, value)) FILTER (WHERE source = {position} AND value IS NOT NULL).value")


def values_of(distinct: dict[str, str], modes: dict[str, str]) -> list[str]:
    """The value columns that distinct counts and modes look at; a value's source is its place here."""
    return list(dict.fromkeys([*distinct.values(), *modes.values()]))


def statistics(
    counts: DataFrame,
    keys: Sequence[str],
    distinct: dict[str, str],
    modes: dict[str, str] | None = None,
) -> DataFrame:
    """All statistics of one mart per `keys` from the rows of :func:`value_counts`.

    `distinct` and `modes` name the output columns and the columns they look at. Callers select what they
    need; Catalyst drops the rest from both passes.
    """
    modes = modes or {}
    position = {column: i for i, column in enumerate(values_of(distinct, modes))}
    measures = {
        "total_complaints": "sum(n) FILTER (WHERE source = -1)",
        **{name: f"count(value) FILTER (WHERE source = {position[column]})" for name, column in distinct.items()},
        "timely_responses": "sum(timely) FILTER (WHERE source = -1)",
        "complaints_with_narrative": "sum(narrative) FILTER (WHERE source = -1)",
        "sum_days": "sum(days * n)",
        "rows_with_days": "sum(n) FILTER (WHERE days IS NOT NULL)",
        "median_days_to_response": "percentile(days, 0.5D, n)",
        "min_days_to_response": "min(days)",
        "max_days_to_response": "max(days)",
        "first_complaint_date": "min(first_date) FILTER (WHERE source = -1)",
        "last_complaint_date": "max(last_date) FILTER (WHERE source = -1)",
    }
    grouped = counts.groupBy(*keys).agg(
        *[F.expr(sql).alias(name) for name, sql in measures.items()],
        *[commonest(position[column]).alias(name) for name, column in modes.items()],
    )
    total = F.col("total_complaints")
    return grouped.withColumns(
        {
            "pct_timely": percent(F.col("timely_responses"), total),
            "pct_with_narrative": percent(F.col("complaints_with_narrative"), total),
            "avg_days_to_response": round2(F.expr("sum_days / rows_with_days")),
        }
    )


def profile(
    df: DataFrame,
    keys: Sequence[str],
    distinct: dict[str, str],
    modes: dict[str, str] | None = None,
) -> DataFrame:
    """All statistics of one mart per `keys` from complaints."""
    counts = value_counts(df, keys, values_of(distinct, modes or {}))
    return statistics(counts, keys, distinct, modes)


def average_of_rounded(x: str) -> Column:
    """Average of two-decimal doubles, summed as DECIMAL: the result does not depend on row order."""
    return F.sum(F.col(x).cast("decimal(18,2)")).cast("double") / F.nullif(F.count(x), F.lit(0).cast("long"))


def child_totals(
    children: DataFrame,
    parent: str,
    child: str,
    distinct: Sequence[str],
    modes: Sequence[str],
    keep_children: bool,
) -> DataFrame:
    """One row per parent from its child rows, child NULL; with `keep_children` the child rows as well.

    This is not a rollup of complaints: every child has one vote in the averages and modes, and a distinct
    count is the number of different child counts. Both kinds of row come from one pass over the children,
    where a child is a group of one and keeps its own values. The input is a finished mart, so the sets and
    modes hold at most one entry per child row of a parent, whatever the number of complaints.
    """
    sets = [[parent, child], [parent]] if keep_children else [[parent]]
    is_child = F.grouping(child) == 0

    def row(name: str, total: Column) -> Column:
        return F.when(is_child, F.max(name)).otherwise(total).alias(name)

    total = F.sum("total_complaints")
    timely = F.sum("timely_responses")
    narrative = F.sum("complaints_with_narrative")
    columns = {
        "total_complaints": total.alias("total_complaints"),
        "timely_responses": timely.alias("timely_responses"),
        "pct_timely": percent(timely, total).alias("pct_timely"),
        "complaints_with_narrative": narrative.alias("complaints_with_narrative"),
        "pct_with_narrative": percent(narrative, total).alias("pct_with_narrative"),
        "avg_days_to_response": row("avg_days_to_response", round2(average_of_rounded("avg_days_to_response"))),
        "median_days_to_response": row("median_days_to_response", round2(F.avg("median_days_to_response"))),
        "first_complaint_date": F.min("first_complaint_date").alias("first_complaint_date"),
        "last_complaint_date": F.max("last_complaint_date").alias("last_complaint_date"),
        **{name: row(name, F.size(F.collect_set(name)).cast("long")) for name in distinct},
        **{name: F.mode(name, deterministic=True).alias(name) for name in modes},
    }
    rows = children.groupingSets(sets, parent, child).agg(*[columns[c] for c in children.columns[2:]])
    return rows.select(children.columns)
