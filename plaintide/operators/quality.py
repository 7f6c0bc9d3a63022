"""Data checks as DataFrames; a failed check is a row, not an exception."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plaintide.schemas import KEY, REQUIRED

MIN_VALID_RATIO = 0.9

# Model, column and tests of the declared checks.
MODEL_TESTS: list[tuple[str, str, tuple[str, ...]]] = [
    ("complaints", "complaint_id", ("unique", "not_null")),
    ("stg_complaints", "complaint_id", ("unique", "not_null")),
    ("fct_complaints", "complaint_id", ("unique", "not_null")),
    ("agg_complaints_by_month", "complaint_month_date", ("unique", "not_null")),
    ("dim_companies", "company", ("unique", "not_null")),
    ("dim_issues", "issue", ("not_null",)),
    ("dim_products", "product", ("not_null",)),
    ("dim_response_types", "company_response", ("unique", "not_null")),
    ("dim_states", "state", ("unique", "not_null")),
]


def _rows(condition: Column | None = None) -> Column:
    one = F.lit(1) if condition is None else F.when(condition, 1)
    return F.count(one)


def key_buckets(df: DataFrame, key: str) -> DataFrame:
    """Rows `n` and different keys `distinct` per bucket of 32,768 consecutive whole-number keys; NULL keys have bucket NULL.

    A map task turns the keys of a bucket into one bitmap of 4 KB, so bitmaps are shuffled and not keys. Where rows lie
    by ranges of keys, as in the stored table, a range of a million keys has at most 31 bitmaps, however many rows repeat.
    """
    bucket, place = F.bitmap_bucket_number(key), F.bitmap_bit_position(key)
    distinct = F.bitmap_count(F.bitmap_construct_agg(place))
    return df.groupBy(bucket.alias("bucket")).agg(_rows().alias("n"), distinct.alias("distinct"))


def has_whole_numbers(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.IntegralType)


def dq_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their row count; NULL is not a value."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(_rows().alias("n"))
    return counts.filter(F.col("n") > 1)


def dq_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL rows per column, all columns in one pass."""
    counts = df.agg(*[_rows(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "failures")


def dq_table_exists(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    """Whether the catalog knows table `name`, next to the rows of `df`."""
    return df.agg(_rows().alias("n_rows")).withColumn("table_exists", F.lit(spark.catalog.tableExists(name)))


def dq_required_columns(df: DataFrame, required: Sequence[str] = REQUIRED) -> DataFrame:
    """Each required column: is it there, and how many rows have a value."""
    values = [F.count(c).alias(c) if c in df.columns else F.lit(0).cast("long").alias(c) for c in required]
    counts = df.agg(*values).unpivot([], list(required), "column_name", "rows_with_value")
    return counts.withColumn("is_present", F.col("column_name").isin([c for c in required if c in df.columns]))


def dq_has_rows(df: DataFrame) -> DataFrame:
    """One row; for a stored table the count comes from the Parquet footers."""
    return df.agg((_rows() > 0).alias("has_rows"))


def dq_key_unique_ratio(df: DataFrame, key: str = KEY) -> DataFrame:
    """Different keys against rows. Whole-number keys are counted by bitmaps, others are shuffled."""
    if has_whole_numbers(df, key):
        zero = F.lit(0).cast("long")
        found = key_buckets(df, key).agg(F.sum("distinct").alias("unique_count"), F.sum("n").alias("total_count"))
        counts = found.select(*[F.coalesce(c, zero).alias(c) for c in found.columns])
    else:
        counts = df.agg(F.count_distinct(key).alias("unique_count"), _rows().alias("total_count"))
    return counts.withColumn("is_unique", F.col("unique_count") == F.col("total_count"))


def dq_sample_required(df: DataFrame, key: str = KEY, required: Sequence[str] = REQUIRED) -> DataFrame:
    """Rows with a key, and how many of them miss each required field; looks at every row, not a sample."""
    keyed = df.filter(F.col(key).isNotNull())
    missing = [_rows(F.col(c).isNull()).alias(f"missing_{c}") for c in required if c != key]
    return keyed.agg(_rows().alias("rows_checked"), *missing)


def dq_valid_ratio(df: DataFrame, column: str = "date_received", minimum: float = MIN_VALID_RATIO) -> DataFrame:
    """Share of rows with a value, against a minimum; NULL for an empty table."""
    counts = df.agg(F.count(column).alias("valid_rows"), _rows().alias("total_rows"))
    ratio = F.col("valid_rows") / F.nullif(F.col("total_rows"), F.lit(0).cast("long"))
    return counts.withColumn("valid_ratio", ratio).withColumn("passed", F.col("valid_ratio") >= F.lit(minimum))


def _failures(df: DataFrame, column: str, tests: Sequence[str]) -> DataFrame:
    """Failures of the tests of one column: uniqueness and NULLs from the same grouped count."""
    if "unique" not in tests:
        return df.agg(_rows(F.col(column).isNull()).alias("not_null")).unpivot([], ["not_null"], "test", "failures")
    counts = df.groupBy(F.col(column).alias("value")).agg(_rows().alias("n"))
    found = counts.agg(
        _rows(F.col("value").isNotNull() & (F.col("n") > 1)).alias("unique"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0).cast("long")).alias("not_null"),
    )
    return found.unpivot([], list(tests), "test", "failures")


def clean_keys(models: Mapping[str, DataFrame], projections: Mapping[str, str] | None = None) -> dict[str, int]:
    """The models whose whole-number keys do not repeat, and their NULL keys; evaluated now, in one job.

    Most runs find all keys clean and need no more; keys that repeat have to be shuffled to be told apart.
    """
    parts = []
    for model, column, tests in MODEL_TESTS:
        known = model in models and model not in (projections or {}) and "unique" in tests
        if known and has_whole_numbers(models[model], column):
            repeats = _rows(F.col("bucket").isNotNull() & (F.col("n") > F.col("distinct")))
            nulls = F.coalesce(F.sum(F.when(F.col("bucket").isNull(), F.col("n"))), F.lit(0).cast("long"))
            parts.append(key_buckets(models[model], column).agg(F.lit(model).alias("model"), repeats.alias("repeats"), nulls.alias("nulls")))
    rows = reduce(DataFrame.unionByName, parts).collect() if parts else []
    return {row["model"]: row["nulls"] for row in rows if row["repeats"] == 0}


def _absent(spark: SparkSession, tests: Sequence[str]) -> DataFrame:
    rows = F.explode(F.array(*map(F.lit, tests))).alias("test")
    return spark.range(1).select(rows, F.lit(1).cast("long").alias("failures"))


def _clean(spark: SparkSession, tests: Sequence[str], nulls: int) -> DataFrame:
    counts = F.lit(0).cast("long").alias("unique"), F.lit(nulls).cast("long").alias("not_null")
    return spark.range(1).select(*counts).unpivot([], list(tests), "test", "failures")


def dq_report(
    models: Mapping[str, DataFrame],
    projections: Mapping[str, str] | None = None,
    clean: Mapping[str, int] | None = None,
) -> DataFrame:
    """All declared checks: model, column, test, number of failures.

    A model that is not given fails each of its tests once. `projections` names models that show another
    one's rows unchanged: their keys are counted with that one's. `clean` are the results of :func:`clean_keys`, whose
    models are not read again.
    """
    spark = next(iter(models.values())).sparkSession
    shown = {m: s for m, s in (projections or {}).items() if m in models and s in models}
    parts = []
    for model, column, tests in MODEL_TESTS:
        if model in shown:
            continue
        names = [model, *[m for m, s in shown.items() if s == model]]
        if model not in models:
            found = _absent(spark, tests)
        elif model in (clean or {}):
            found = _clean(spark, tests, clean[model])
        else:
            found = _failures(models[model], column, tests)
        found = found.withColumn("model", F.explode(F.array(*map(F.lit, names))))
        parts.append(found.select("model", F.lit(column).alias("column_name"), "test", "failures"))
    return reduce(DataFrame.unionByName, parts)
