"""Available-now stream ingestion: loads everything once, picks up new files, never loads a file twice."""

import json
import os

from gridline.session import scratch_path
from gridline.streaming.ingest import ingest_available

ROW = {"date": "2024-03-02", "raceName": "r", "round": 1, "season": 2024, "url": "u", "constructorId": "c",
       "driverId": "d", "grid": 1, "laps": 50, "number": 1, "points": 25.0, "position": 1, "positionText": "1",
       "status": "Finished"}


def _land(root, batch, n, name):
    d = f"{root}/results/batch_id={batch}"
    os.makedirs(d, exist_ok=True)
    with open(f"{d}/{name}.json", "w") as f:
        for i in range(n):
            f.write(json.dumps(dict(ROW, driverId=f"d{i}")) + "\n")


def test_available_now_is_incremental(spark, tmp_dir):
    landing, target, ckpt = tmp_dir, scratch_path(spark, "bronze"), scratch_path(spark, "stream-ckpt")
    _land(landing, "2024-01", 3, "a")
    ingest_available(spark, landing, "results", target, ckpt)
    assert spark.read.parquet(target).count() == 3
    ingest_available(spark, landing, "results", target, ckpt)          # nothing new: unchanged
    assert spark.read.parquet(target).count() == 3
    _land(landing, "2024-02", 2, "b")
    ingest_available(spark, landing, "results", target, ckpt)
    df = spark.read.parquet(target)
    assert sorted((r.batch_id, r.n) for r in df.groupBy("batch_id").count().withColumnRenamed("count", "n")
                  .collect()) == [("2024-01", 3), ("2024-02", 2)]
    assert df.filter("source_file IS NULL OR ingestion_timestamp IS NULL").count() == 0


def test_a_batch_in_several_files_stays_whole(spark, tmp_dir):
    landing, target, ckpt = tmp_dir, scratch_path(spark, "bronze"), scratch_path(spark, "stream-ckpt")
    _land(landing, "2024-01", 3, "a")
    _land(landing, "2024-01", 4, "b")
    ingest_available(spark, landing, "results", target, ckpt, max_files_per_trigger=1)
    assert spark.read.parquet(target).count() == 7
    _land(landing, "2024-01", 2, "c")
    ingest_available(spark, landing, "results", target, ckpt)
    assert spark.read.parquet(target).count() == 9


def test_stale_rows_are_dropped_after_a_restart(spark, tmp_dir):
    from gridline.sinks.snapshots import read_table, versions
    from gridline.streaming.guard import upsert_stream

    target, ckpt = scratch_path(spark, "silver"), scratch_path(spark, "guard-ckpt")
    keys = ["season", "round", "constructorId", "driverId"]
    run = lambda **kw: upsert_stream(spark, tmp_dir, "results", target, ckpt, keys, ["season", "round"], **kw)

    def stored():
        return {(r.driverId, r.batch_id) for r in read_table(spark, target).collect()}

    _land(tmp_dir, "2024-05", 2, "a")
    run()
    assert stored() == {("d0", "2024-05"), ("d1", "2024-05")}
    _land(tmp_dir, "2024-04", 3, "late")               # older for d0 and d1, the first of d2
    run()
    assert stored() == {("d0", "2024-05"), ("d1", "2024-05"), ("d2", "2024-04")}
    _land(tmp_dir, "2024-06", 1, "b")
    _land(tmp_dir, "2024-03", 1, "older")
    assert run(max_files_per_trigger=1) == 2
    assert stored() == {("d0", "2024-06"), ("d1", "2024-05"), ("d2", "2024-04")}
    n = len(versions(spark, target))
    assert run() == 0 and len(versions(spark, target)) == n


def test_stale_guard_keeps_its_state_in_spark(spark, tmp_dir):
    from gridline.streaming.guard import drop_stale
    from gridline.streaming.ingest import landed_stream

    _land(tmp_dir, "2024-01", 1, "a")
    stream = drop_stale(landed_stream(spark, tmp_dir, "results").drop("source_file", "ingestion_timestamp"), ["driverId"])
    plan = stream._jdf.queryExecution().analyzed().toString()
    assert "Aggregate" in plan and "Pandas" not in plan        # no Python call per key


def test_of_a_batch_landed_again_the_later_rows_count(spark, tmp_dir):
    from gridline.sinks.snapshots import read_table
    from gridline.streaming.guard import upsert_stream

    target, ckpt = scratch_path(spark, "silver"), scratch_path(spark, "guard-ckpt")
    for n, laps in enumerate(([7, 30], [8, 9], [2])):
        d = f"{tmp_dir}/results/batch_id=2024-0{5 if n < 2 else 4}"
        os.makedirs(d, exist_ok=True)
        with open(f"{d}/{n}.json", "w") as f:
            f.writelines(json.dumps(dict(ROW, laps=x)) + "\n" for x in laps)
        upsert_stream(spark, tmp_dir, "results", target, ckpt, ["season", "round", "driverId"], ["season", "round"])
        assert [r.laps for r in read_table(spark, target).collect()] == [[30], [8], [8]][n]    # texts: "30" < "7"
