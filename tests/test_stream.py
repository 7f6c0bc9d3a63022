from __future__ import annotations

import os

from pyspark.sql import functions as F

from plaintide.session import scratch_dir
from plaintide.sources import raw
from plaintide.sources.warehouse import COMPLAINTS
from plaintide.streaming.incremental import incremental_upsert, refresh_recent
from tests.rows import bronze, by_key, complaint


def land(spark, folder, rows, day):
    text = spark.createDataFrame([tuple(r.values()) for r in rows], "struct<" + ",".join(
        f"{k}:{'boolean' if k == 'has_narrative' else 'bigint' if k == 'complaint_id' else 'string'}" for k in rows[0]
    ) + ">")
    records = raw.to_json_records(text, text.columns)
    raw.write_raw(records.withColumn("process_date", F.lit(day).cast("date")), folder, 2)


def test_new_files_are_loaded_once_and_replays_change_nothing(spark, warehouse):
    folder, state = scratch_dir(spark, "raw"), scratch_dir(spark, "state")
    land(spark, folder, [complaint(complaint_id=i) for i in range(5)], "2026-01-01")
    warehouse.create_if_absent()
    incremental_upsert(warehouse, folder, state, max_files=1).awaitTermination()
    assert sorted(by_key(warehouse.source_table())) == [0, 1, 2, 3, 4]
    land(spark, folder, [complaint(complaint_id=4, company="New"), complaint(complaint_id=9)], "2026-01-02")
    incremental_upsert(warehouse, folder, state).awaitTermination()
    loaded = by_key(warehouse.source_table())
    assert sorted(loaded) == [0, 1, 2, 3, 4, 9] and loaded[4]["company"] == "New"
    query = incremental_upsert(warehouse, folder, state)
    query.awaitTermination()
    assert query.lastProgress is None or query.lastProgress["numInputRows"] == 0
    incremental_upsert(warehouse, folder, scratch_dir(spark, "state")).awaitTermination()
    assert by_key(warehouse.source_table()) == loaded


def test_refresh_takes_the_lookback_window(spark, warehouse):
    warehouse.upsert(bronze(spark, [complaint(complaint_id=1, date_received="2025-06-01T00:00:00.000Z")]))
    again = bronze(
        spark,
        [
            complaint(complaint_id=1, company="Late change", date_received="2025-06-01T00:00:00.000Z"),
            complaint(complaint_id=2, date_received="2026-01-01T00:00:00.000Z"),
        ],
    )
    refresh_recent(warehouse, again, "2026-04-01")
    assert {k: r["company"] for k, r in by_key(warehouse.source_table()).items()} == {1: "Acme", 2: "Acme"}


def test_a_replayed_batch_is_skipped(spark, warehouse, tmp_path):
    """The last batch is handed over again after its commit is lost: no load comes of it."""
    raw_root, checkpoint = str(tmp_path / "raw"), str(tmp_path / "checkpoint")
    day = tmp_path / "raw" / "process_date=2026-01-01"
    day.mkdir(parents=True)
    (day / "a.json").write_text('{"complaint_id":1,"company":"A"}\n')
    incremental_upsert(warehouse, raw_root, checkpoint).awaitTermination()
    loads = [c for c in os.listdir(warehouse.path("raw", COMPLAINTS)) if c.startswith("load=")]
    for name in os.listdir(f"{checkpoint}/commits"):
        os.remove(f"{checkpoint}/commits/{name}")
    incremental_upsert(warehouse, raw_root, checkpoint).awaitTermination()
    assert [c for c in os.listdir(warehouse.path("raw", COMPLAINTS)) if c.startswith("load=")] == loads
    (day / "b.json").write_text('{"complaint_id":2,"company":"B"}\n')
    incremental_upsert(warehouse, raw_root, checkpoint).awaitTermination()
    assert sorted(r.complaint_id for r in warehouse.source_table().collect()) == [1, 2]
