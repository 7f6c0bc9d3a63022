"""Run registered queries against their SQL twins in DuckDB: `python -m testbed.compare SF_DIR [KEY …]`."""

from __future__ import annotations

import datetime
import sys
import tempfile
import time

import duckdb

from plaintide.session import get_session
from testbed import oracle, registry

TABLES = "region nation customer supplier part orders lineitem events".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def cell(value):
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, float):
        return repr(value)
    return value


def canonical(columns: list[str], rows: list[tuple]) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([cell(row[i]) for i in order]) for row in rows)


def differences(spark, connection, sf_dir: str, key: str) -> list[str]:
    frame = registry.queries()[key](spark, sf_dir)
    ours = canonical(frame.columns, [tuple(r) for r in frame.collect()])
    result = connection.execute(oracle.oracle_sql()[key])
    names = [d[0] for d in result.description]
    theirs = canonical(names, result.fetchall())
    if sorted(frame.columns) != sorted(names):
        return [f"columns {sorted(frame.columns)} / {sorted(names)}"]
    if ours == theirs:
        return [] if ours else ["no rows"]
    extra, absent = sorted(set(ours) - set(theirs)), sorted(set(theirs) - set(ours))
    return [f"{len(ours)} rows / {len(theirs)}", *[f"ours   {r}" for r in extra[:3]], *[f"theirs {r}" for r in absent[:3]]]


def main(sf_dir: str, keys: list[str]) -> int:
    spark = get_session(
        "compare",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="compare-"),
            "spark.hadoop.fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, failed = connect(sf_dir), 0
    for key in keys or registry.queries():
        start = time.time()
        try:
            found = differences(spark, connection, sf_dir, key)
        except Exception as error:
            found = [f"{type(error).__name__}: {str(error)[:500]}"]
        failed += bool(found)
        print(f"{'DIFF' if found else 'ok  '} {key} {time.time() - start:.1f}s", *found, sep="\n     ", flush=True)
    print(f"{failed} differ")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
