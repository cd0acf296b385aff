"""Upsert properties: create, update, guard, idempotence, unique keys, null keys, partition scope."""

import pytest
from pyspark.sql import functions as F

from gridline.session import scratch_path
from gridline.sinks.upsert import merge_frames, newer_batch_guard, update_matched_only, upsert

SCHEMA = "k INT, season INT, v STRING, batch_id STRING"
KEYS, COLS, PART = ["k"], ["v", "batch_id"], ["season"]


def read(spark, path):
    return {r.k: (r.v, r.batch_id) for r in spark.read.parquet(path).collect()}


def test_guarded_upsert(spark):
    path = scratch_path(spark, "t-upsert")
    src = spark.createDataFrame([(1, 2024, "a", "2024-05"), (2, 2024, "b", "2024-05")], SCHEMA)
    assert upsert(src, path, KEYS, COLS, PART, newer_batch_guard) == "created"
    again = upsert(src, path, KEYS, COLS, PART, newer_batch_guard)        # rerun: same content
    assert again == "merged" and read(spark, path) == {1: ("a", "2024-05"), 2: ("b", "2024-05")}
    older = spark.createDataFrame([(1, 2024, "OLD", "2024-04"), (3, 2024, "c", "2024-04")], SCHEMA)
    upsert(older, path, KEYS, COLS, PART, newer_batch_guard)
    assert read(spark, path) == {1: ("a", "2024-05"), 2: ("b", "2024-05"), 3: ("c", "2024-04")}
    newer = spark.createDataFrame([(2, 2024, "NEW", "2024-06")], SCHEMA)
    upsert(newer, path, KEYS, COLS, PART, newer_batch_guard)
    assert read(spark, path)[2] == ("NEW", "2024-06")
    assert spark.read.parquet(path).groupBy("k").count().filter("count > 1").count() == 0


def test_unguarded_upsert_updates_every_match_and_keeps_created(spark):
    path = scratch_path(spark, "t-upsert")
    upsert(spark.createDataFrame([(1, 2024, "a", "2024-05")], SCHEMA), path, KEYS, COLS, PART)
    created = spark.read.parquet(path).collect()[0].created_timestamp
    upsert(spark.createDataFrame([(1, 2024, "OLD", "2020-01")], SCHEMA), path, KEYS, COLS, PART)
    row = spark.read.parquet(path).collect()[0]
    assert (row.v, row.batch_id, row.created_timestamp) == ("OLD", "2020-01", created)


def test_only_touched_partitions_are_rewritten(spark):
    path = scratch_path(spark, "t-upsert")
    upsert(spark.createDataFrame([(1, 2023, "a", "b1"), (2, 2024, "b", "b1")], SCHEMA), path, KEYS, COLS, PART)
    before = set(spark.read.parquet(path).filter("season = 2023").select(F.input_file_name()).collect())
    upsert(spark.createDataFrame([(2, 2024, "B", "b2")], SCHEMA), path, KEYS, COLS, PART)
    after = set(spark.read.parquet(path).filter("season = 2023").select(F.input_file_name()).collect())
    assert before == after and read(spark, path) == {1: ("a", "b1"), 2: ("B", "b2")}


def test_duplicate_source_keys_are_refused(spark):
    path = scratch_path(spark, "t-upsert")
    dup = spark.createDataFrame([(1, 2024, "a", "b"), (1, 2024, "b", "b")], SCHEMA)
    with pytest.raises(ValueError, match="duplicate keys"):
        upsert(dup, path, KEYS, COLS, PART)


def test_null_keys_never_match(spark):
    t = spark.createDataFrame([(None, 2024, "t", "b1")], SCHEMA)
    s = spark.createDataFrame([(None, 2024, "s", "b2")], SCHEMA)
    out = merge_frames(t, s, KEYS, COLS, newer_batch_guard).collect()
    assert sorted(r.v for r in out) == ["s", "t"]


def test_update_matched_only(spark):
    t = spark.createDataFrame([("b1", "in_progress"), ("b1", "completed"), ("b2", "in_progress")],
                              "batch_id STRING, status STRING")
    s = spark.createDataFrame([("b1", "completed"), ("b9", "completed")], "batch_id STRING, status STRING")
    out = update_matched_only(t, s, ["batch_id"], ["status"],
                              extra=lambda tc, sc: tc("status") == F.lit("in_progress"))
    assert sorted((r.batch_id, r.status) for r in out.collect()) == [
        ("b1", "completed"), ("b1", "completed"), ("b2", "in_progress")]


def test_null_partition_values_stay(spark):
    path = scratch_path(spark, "t-upsert")
    for rows in ([(1, 2024, "a", "b1"), (2, None, "b", "b1")], [(3, None, "c", "b2")]):
        upsert(spark.createDataFrame(rows, SCHEMA), path, KEYS, COLS, PART)
    assert read(spark, path) == {1: ("a", "b1"), 2: ("b", "b1"), 3: ("c", "b2")}


def test_text_partition_keys_keep_their_text(spark):
    path = scratch_path(spark, "t-upsert")
    schema = "k STRING, v STRING, batch_id STRING"
    for v in ("a", "b"):
        upsert(spark.createDataFrame([("007", v, "b1")], schema), path, ["k"], COLS, ["k"])
    rows = spark.read.schema(schema).parquet(path).collect()
    assert [(r.k, r.v) for r in rows] == [("007", "b")]


def test_a_key_matches_in_any_partition(spark):
    path = scratch_path(spark, "t-upsert")
    upsert(spark.createDataFrame([(1, 2024, "a", "b1"), (2, 2024, "b", "b1")], SCHEMA), path, KEYS, COLS, PART)
    upsert(spark.createDataFrame([(1, 2025, "new", "b2")], SCHEMA), path, KEYS, COLS, PART)
    assert read(spark, path) == {1: ("new", "b2"), 2: ("b", "b1")}
    assert spark.read.parquet(path).count() == 2
