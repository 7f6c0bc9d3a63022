"""Time the headline queries and print one JSON line.

The driver's tables are shaped into complaints and stored once (`load_complaints`); the models then read
the stored table, as the marts of a warehouse do. Every query is built anew for each run; the figure is
the median of BENCH_RUNS runs after one warm-up run. With BENCH_DUCKDB=1 the same SQL is timed in DuckDB
on the same stored files and reported under "duckdb".
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaintide.operators.normalize import normalize_schema
from plaintide.operators.quality import dq_report
from plaintide.operators.upsert import latest_per_key
from plaintide.plans import marts, models, runs, serving
from plaintide.schemas import BRONZE
from plaintide.session import get_session, scratch_dir
from plaintide.sources.pages import fetch_folder
from plaintide.sources.warehouse import Warehouse
from testbed import oracle, shape

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def timed(action: Callable[[], object]) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def median_time(action: Callable[[], object]) -> float:
    action()
    return round(statistics.median(timed(action) for _ in range(RUNS)), 3)


def main() -> None:
    spark = get_session(
        "bench",
        **{
            "spark.master": f"local[{CPUS}]",
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "12g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    stored, versions = scratch_dir(spark, "bench"), scratch_dir(spark, "bench-versions")

    def load() -> None:
        normalize_schema(shape.complaints(spark, SF_DIR)).write.mode("overwrite").parquet(stored)

    seconds = {"load_complaints": median_time(load)}
    normalize_schema(shape.raw_versions(spark, SF_DIR)).write.parquet(versions)
    root = scratch_dir(spark, "bench-warehouse")
    warehouse = Warehouse(spark, root, "bench_")

    def table() -> DataFrame:
        return spark.read.schema(BRONZE).parquet(stored)

    def batch(flag: str) -> DataFrame:
        return spark.read.schema(BRONZE).parquet(versions).filter(F.col("submitted_via") == flag)

    def metrics() -> DataFrame:
        return models.int_complaint_metrics(models.stg_complaints(table()))

    def drained(df: DataFrame) -> None:
        df.write.format("noop").mode("overwrite").save()

    queries: dict[str, Callable[[], object]] = {
        **{name: (lambda build=build: build(metrics()).collect()) for name, build in marts.MARTS.items()},
        "product_stats": lambda: marts.product_stats(metrics()).collect(),
        "issue_stats": lambda: marts.issue_stats(metrics()).collect(),
        "fct_complaints": lambda: drained(models.fct_complaints(metrics())),
        "dash_coverage": lambda: serving.dash_coverage(models.fct_complaints(metrics())).collect(),
        "top_companies": lambda: serving.top_companies(marts.dim_companies(metrics())).collect(),
        "dq_report": lambda: dq_report({"complaints": table()}).collect(),
        "latest_per_key": lambda: drained(latest_per_key(spark.read.schema(BRONZE).parquet(versions))),
        "upsert_by_key": lambda: warehouse.upsert(batch("R")),
    }
    zones = runs.Zones(*[scratch_dir(spark, f"bench-{layer}") for layer in ("pages", "raw", "bronze")])
    shape.land_pages(spark.read.schema(BRONZE).parquet(stored), fetch_folder(zones.pages, oracle.RUN_TS))
    month = ("1996-01-01", "1996-01-31")
    queries |= {
        "land_raw_month": lambda: runs.land_raw(spark, zones, oracle.RUN_TS, *month),
        "raw_to_bronze_month": lambda: runs.raw_to_bronze(spark, zones, *month),
        "run_daily": lambda: runs.run_daily(warehouse, zones, "1996-01-10", oracle.RUN_TS),
    }
    warehouse.upsert(batch("A"))
    warehouse.upsert(batch("N"))
    for name, query in queries.items():
        seconds[name] = median_time(query)
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }
    if os.environ.get("BENCH_DUCKDB"):
        result["duckdb"] = duckdb_times(stored)
    spark.stop()
    print(json.dumps(result))


def duckdb_times(stored: str) -> dict[str, float]:
    import duckdb

    connection = duckdb.connect()
    connection.execute(f"SET threads = {CPUS}")
    connection.execute("SET TimeZone = 'UTC'")
    connection.execute(f"CREATE VIEW stored AS SELECT * FROM read_parquet('{stored}/*.parquet')")
    sql = oracle.oracle_sql()
    names = [*marts.MARTS, "product_stats", "issue_stats", "dash_coverage", "top_companies"]
    return {
        name: median_time(
            lambda name=name: connection.execute(
                "WITH shaped AS (SELECT * FROM stored)" + sql[name][len("WITH " + oracle.SHAPED):]
            ).fetchall()
        )
        for name in names
    }


if __name__ == "__main__":
    main()
