"""The medallion batch job: incremental runs, control table, audit trail, and equality with a backfill."""

import pytest
from pyspark.sql import functions as F

from gridline.plans import medallion as PL
from gridline.plans.io_queries import landed
from gridline.plans.standin import nationality_region
from gridline.session import scratch_path
from gridline.sinks import ledger
from gridline.sinks.snapshots import read_table, version
from gridline.sources.tables import load_table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def region(spark):
    return nationality_region(load_table(spark, SF, "nation"), load_table(spark, SF, "region"))


def _fact(spark, lake, batches=None):
    df = read_table(spark, lake.gold("fact_session_results")).drop("created_timestamp", "updated_timestamp")
    if batches:
        df = df.filter(F.format_string("%d-%02d", "season", "round").isin(*batches))
    return sorted(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def test_incremental_equals_backfill(spark, region):
    landing = landed(spark, SF)
    inc = PL.Lake(scratch_path(spark, "lake"))
    ids = PL.run_pending(spark, landing, inc, region, max_batches=2)
    assert len(ids) == 2 and ids == sorted(ids)
    ctl = {r.batch_id: r.status for r in read_table(spark, inc.control).collect()}
    assert ctl == {ids[0]: "completed", ids[1]: "completed"}
    assert PL.next_batch_id(spark, landing, inc) > ids[1]
    audit = read_table(spark, inc.audit)
    assert audit.select("table_name").distinct().count() == 6 and audit.filter("fail_count = -1").count() == 0

    full = PL.Lake(scratch_path(spark, "lake"))
    PL.backfill(spark, landing, full, region)
    assert _fact(spark, inc) == _fact(spark, full, ids)


def test_rerun_of_a_batch_is_idempotent(spark, region):
    landing = landed(spark, SF)
    lake = PL.Lake(scratch_path(spark, "lake"))
    b = PL.next_batch_id(spark, landing, lake)
    PL.run_batch(spark, landing, lake, b, region, control=False)
    first = _fact(spark, lake)
    PL.run_batch(spark, landing, lake, b, region, control=False)
    assert _fact(spark, lake) == first
    silver = read_table(spark, lake.silver("results"))
    assert silver.groupBy("season", "round", "constructor_id", "driver_id").count().filter("count > 1").count() == 0


def test_a_failed_batch_goes_on_where_it_failed(spark, region, monkeypatch):
    landing = landed(spark, SF)
    lake = PL.Lake(scratch_path(spark, "lake"))
    b = PL.next_batch_id(spark, landing, lake)
    loads, cleaned = [], PL.clean_table
    load_raw = PL.load_raw
    monkeypatch.setattr(PL, "load_raw", lambda *a: (loads.append(a[3]), load_raw(*a)))

    def failing(spark, lake, name, *a):
        if name == "results":
            raise RuntimeError("lost")
        return cleaned(spark, lake, name, *a)

    monkeypatch.setattr(PL, "clean_table", failing)
    with pytest.raises(RuntimeError, match="lost"):
        PL.run_batch(spark, landing, lake, b, region)
    assert len(loads) == 6 and version(spark, lake.gold("fact_session_results")) is None
    assert PL.next_batch_id(spark, landing, lake) > b                 # it stays claimed
    with pytest.raises(ledger.BatchTaken):
        PL.run_batch(spark, landing, lake, b, region)
    monkeypatch.setattr(PL, "clean_table", cleaned)
    assert PL.retry_failed(spark, landing, lake, region) == [b]
    assert len(loads) == 6                                            # finished steps aren't done again
    assert {r.batch_id: r.status for r in read_table(spark, lake.control).collect()} == {b: "completed"}
    whole = PL.Lake(scratch_path(spark, "lake"))
    PL.run_batch(spark, landing, whole, b, region)
    assert _fact(spark, lake) == _fact(spark, whole)
    assert PL.retry_failed(spark, landing, lake, region) == []


def test_two_runs_never_own_one_batch(spark, monkeypatch):
    path = scratch_path(spark, "ledger")
    first = ledger.claim(spark, path, "2024-01")
    with pytest.raises(ledger.BatchTaken):
        ledger.claim(spark, path, "2024-01")
    other = ledger.claim(spark, path, "2024-02")                      # another batch is free
    ledger.run_step(spark, path, first, "a", lambda: None)
    # A claim published between another run's look and its own claim.
    rows = ledger.ledger_rows

    def late(spark, path, batch_id):
        found = rows(spark, path, batch_id)
        if batch_id == "2024-03":
            monkeypatch.setattr(ledger, "ledger_rows", rows)
            ledger.claim(spark, path, "2024-03")
        return found

    monkeypatch.setattr(ledger, "ledger_rows", late)
    with pytest.raises(ledger.BatchTaken):
        ledger.claim(spark, path, "2024-03")
    # A retry takes the batch over: the first run notices before its next step.
    again = ledger.claim(spark, path, "2024-01", retry=True)
    assert ledger.finished_steps(spark, path, "2024-01") == {"a"}
    with pytest.raises(ledger.BatchTaken):
        ledger.run_step(spark, path, first, "b", lambda: None)
    ledger.run_step(spark, path, again, "b", lambda: None)
    ledger.run_step(spark, path, other, "a", lambda: None)
    assert ledger.finished_steps(spark, path, "2024-01") == {"a", "b"}
    with pytest.raises(ValueError):
        ledger.claim(spark, path, "")


def test_buckets_follow_the_size_of_a_table(spark):
    path = scratch_path(spark, "bucketed")
    rows = spark.range(0, 100).selectExpr("id k", "'a' v")
    PL.upsert_bucketed(rows, path, ["k"], ["v"], bucket_rows=50)
    assert version(spark, path).properties == {"buckets": "2"}
    PL.upsert_bucketed(spark.range(50, 1000).selectExpr("id k", "'b' v"), path, ["k"], ["v"], bucket_rows=50)
    PL.upsert_bucketed(spark.range(0, 10).selectExpr("id k", "'c' v"), path, ["k"], ["v"], bucket_rows=50)
    assert version(spark, path).properties == {"buckets": "40"}
    got = {(r.v, r.n) for r in read_table(spark, path).groupBy("v").agg(F.count("*").alias("n")).collect()}
    assert got == {("a", 40), ("b", 950), ("c", 10)} and read_table(spark, path).select("k").distinct().count() == 1000
