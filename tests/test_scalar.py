from __future__ import annotations

from datetime import datetime, timedelta, timezone

import duckdb
import pytest
from pyspark.sql import functions as F

from plaintide.functions import scalar


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_round2_agrees_with_scale_round_unscale(spark):
    pairs = [(n, m) for m in range(1, 260, 7) for n in range(0, m + 1)]
    df = spark.createDataFrame(pairs, "n long, m long")
    ours = values(
        df,
        "n",
        "m",
        scalar.percent(F.col("n"), F.col("m")).alias("p"),
        scalar.share_percent(F.col("n"), F.col("m")).alias("s"),
        scalar.round2(F.col("n") / F.col("m")).alias("a"),
    )
    connection = duckdb.connect()
    connection.execute("CREATE TABLE t (n BIGINT, m BIGINT)")
    connection.executemany("INSERT INTO t VALUES (?, ?)", pairs)
    theirs = connection.execute(
        "SELECT n, m, round(100.0 * n / m, 2), round(n / m * 100.0, 2), round(n / m, 2) FROM t"
    ).fetchall()
    assert sorted(ours) == sorted(theirs)


def test_percent_of_nothing_is_null(spark):
    df = spark.createDataFrame([(0, 0)], "n long, m long")
    assert values(df, scalar.percent(F.col("n"), F.col("m")), scalar.share_percent(F.col("n"), F.col("m"))) == [
        (None, None)
    ]


def test_percent_text_rounds_like_exact_binary(spark):
    numbers = [i / 100 for i in range(0, 10001)]
    df = spark.createDataFrame([(x,) for x in numbers], "x double")
    ours = dict(values(df, "x", scalar.percent_text(F.col("x"))))
    assert {x: t for x, t in ours.items() if t != f"{x:.1f}%"} == {}


def test_missing_headline_values_show_a_dash(spark):
    df = spark.createDataFrame([(None, None), (1234567, 0.0)], "n long, x double")
    assert values(df, scalar.count_text(F.col("n")), scalar.percent_text(F.col("x"))) == [
        ("-", "-"),
        ("1,234,567", "0.0%"),
    ]


TIMES = [
    ("2026-07-11T23:30:00.000Z", "2026-07-11", "2026-07-11T23:30:00.000Z"),
    ("2026-07-11T23:30:00-05:00", "2026-07-12", "2026-07-12T04:30:00.000Z"),
    ("2026-07-11T23:30:00.1239", "2026-07-11", "2026-07-11T23:30:00.123Z"),
    ("2026-03-08 02:30:00", "2026-03-08", "2026-03-08T02:30:00.000Z"),
    ("2026-07-11", "2026-07-11", "2026-07-11T00:00:00.000Z"),
    ("1965-02-03T04:05:06.7Z", "1965-02-03", "1965-02-03T04:05:06.700Z"),
]


@pytest.mark.parametrize("session", ["spark", "new_york"])
def test_times_do_not_depend_on_the_session_zone(session, request):
    spark = request.getfixturevalue(session)
    df = spark.createDataFrame([(t,) for t, _, _ in TIMES], "t string")
    df = df.withColumn("ts", scalar.strict_cast(scalar.instant(F.col("t")), df.sparkSession.range(1).select(
        F.lit(None).cast("timestamp").alias("x")).schema["x"].dataType, "t"))
    wall = scalar.utc_wall(F.col("ts"))
    found = values(df, "t", F.expr(scalar.utc_date_sql(df, "ts")).cast("string"), scalar.utc_text(wall))
    assert found == TIMES
    assert values(df, scalar.from_utc_wall(wall) == F.col("ts")) == [(True,)] * len(TIMES)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_cast_fails_on_a_bad_value_in_every_mode(spark, ansi):
    df = spark.createDataFrame([("12",), ("abc",)], "t string")
    kind = spark.range(1).schema["id"].dataType
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        good = df.filter("t = '12'").select(scalar.strict_cast(F.col("t"), kind, "complaint_id")).collect()
        assert good[0][0] == 12
        with pytest.raises(Exception, match="complaint_id: cannot cast to bigint: abc"):
            df.select(scalar.strict_cast(F.col("t"), kind, "complaint_id")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
