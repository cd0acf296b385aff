"""Live ranking and top rows against SQL windows: skew, ties, nulls, odd numbers; plans without jobs."""

import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridline.functions.sortkey import packed_key, sortable_number
from gridline.operators import live_ranking as L
from gridline.operators.ranking import sort_col

NUMBERS = [0.0, -0.0, 1.0, 1.5, -1.5, 0.1, 1e-300, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308,
           1e300, -1e300, 1.7976931348623157e308, math.inf, -math.inf, math.nan, 3.0, 2.9999999999999996, 4503599627370497.5,
           8.0, 7.999999999999999, None, 1023.9999999999999, 1024.0]


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(4)
    rows = []
    for i in range(3000):
        g = rng.choice(["hot", "hot", "hot", "a", "b", None])
        x = rng.choice([*NUMBERS, rng.gauss(0, 1e6), float(rng.randrange(5))])
        rows.append((i, g, x, rng.choice([None, 0, 1, -5, 2**40, -(2**63), 2**63 - 1]), rng.choice([None, "", "a", "ab", "é", "b~"])))
    return spark.createDataFrame(rows, "id long, g string, x double, n long, t string").repartition(5)


ORDERS = [[("x", "desc")], [("x", "asc")], [("n", "asc_nulls_last")], [("t", "desc"), ("n", "desc_nulls_first")],
          [("n", "desc"), ("t", "asc"), ("x", "asc")]]


@pytest.mark.parametrize("order", ORDERS)
@pytest.mark.parametrize("fan", [4, 4096])
def test_equals_windows(spark, frame, order, fan, monkeypatch):
    monkeypatch.setattr(L, "FAN", fan)
    w = Window.partitionBy("g").orderBy(*[sort_col(c, d) for c, d in order])
    for method, fn in (("rank", F.rank()), ("dense_rank", F.dense_rank())):
        got = {r.id: r.out for r in L.rank_live(frame, ["g"], order, method, "out").collect()}
        assert got == {r.id: r.out for r in frame.withColumn("out", fn.over(w)).collect()}
    unique = [*order, ("id", "asc")]
    w = Window.partitionBy("g").orderBy(*[sort_col(c, d) for c, d in unique])
    want = {r.id: r.out for r in frame.withColumn("out", F.row_number().over(w)).collect()}
    assert want == {r.id: r.out for r in L.rank_live(frame, ["g"], unique, "row_number", "out", unique=True).collect()}
    top = {r.id: r.place for r in L.top_n(frame, ["g"], unique, 7).collect()}
    assert top == {i: n for i, n in want.items() if n <= 7}


@pytest.mark.parametrize("order", ORDERS)
def test_top_with_ties(frame, order):
    w = Window.partitionBy("g").orderBy(*[sort_col(c, d) for c, d in order])
    want = {r.id: r.out for r in frame.withColumn("out", F.rank().over(w)).filter("out <= 3").collect()}
    assert {r.id: r.out for r in L.top_n_ties(frame, ["g"], order, 3, "out").collect()} == want
    assert L.top_n(frame, [], [*order, ("id", "asc")], 5).count() == 5
    assert L.top_n_ties(frame.limit(0), ["g"], order, 3).count() == 0


@pytest.mark.parametrize("order", ORDERS)
def test_packed_key_sorts_as_the_columns(frame, order):
    keyed = frame.withColumn("key", packed_key(frame, order))
    cols = Window.orderBy(*[sort_col(c, d) for c, d in order])
    both = keyed.select(F.dense_rank().over(cols).alias("a"), F.dense_rank().over(Window.orderBy("key")).alias("b"))
    assert both.filter("a <> b").count() == 0


def test_doubles_as_numbers(spark):
    df = spark.createDataFrame([(x,) for x in NUMBERS], "x double").withColumn("v", sortable_number(F.col("x"), frame_type(spark)))
    import struct
    for r in df.collect():
        if r.x is None:
            assert r.v is None
            continue
        bits = struct.unpack("<q", struct.pack("<d", abs(r.x)))[0]
        assert r.v == (-bits if r.x < 0 else bits)


def frame_type(spark):
    return spark.range(1).selectExpr("cast(id as double) x").schema["x"].dataType


def test_other_types(spark):
    df = spark.range(40).selectExpr("id", "id % 2 = 0 b", "date_add(date'2020-01-01', cast(id % 7 as int)) d",
                                    "timestamp_micros(id % 11 * 1000003 - 5) ts", "cast(id % 5 - 2 as decimal(9,2)) dec",
                                    "cast(id % 3 - 1 as float) f", "cast(id % 6 - 3 as decimal(38,0)) big")
    for c in ("b", "d", "ts", "dec", "f", "big"):
        order = [(c, "desc"), ("id", "asc")]
        w = Window.partitionBy().orderBy(F.col(c).desc(), "id")
        want = {r.id: r.n for r in df.withColumn("n", F.row_number().over(w)).collect()}
        assert {r.id: r.n for r in L.rank_live(df, [], order, "row_number", "n", unique=True).collect()} == want
        keyed = df.select(F.row_number().over(Window.orderBy(packed_key(df, order))).alias("k"), "id")
        assert {r.id: r.k for r in keyed.collect()} == want


def test_no_job_at_planning_and_no_one_task_group(spark, frame):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("live-plan", "planning")
    try:
        ranked = L.rank_live(frame, ["g"], [("x", "desc")], "rank", "out")
        top = L.top_n(frame, ["g"], [("x", "desc"), ("id", "asc")], 3)
        assert list(tracker.getJobIdsForGroup("live-plan")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert "SinglePartition" not in ranked._jdf.queryExecution().executedPlan().toString()


def test_exact_sums(spark):
    rng = random.Random(2)
    values = [rng.choice([0.1, 0.7, 1e6, -1e6, 12.5]) for _ in range(5000)]
    rows = spark.createDataFrame([(i % 3, v) for i, v in enumerate(values)], "k int, v double")
    sums = {tuple(sorted(map(tuple, rows.repartition(n).groupBy("k").agg(L.exact_sum(rows, "v").alias("s")).collect()))) for n in (1, 3, 7, 11)}
    assert len(sums) == 1
    for k, s in next(iter(sums)):
        assert s == pytest.approx(math.fsum(v for i, v in enumerate(values) if i % 3 == k), abs=1e-6)
    odd = spark.createDataFrame([(1, math.nan), (1, 1.0), (2, math.inf), (2, 1.0), (3, None), (4, 1e30), (4, 1.0)], "k int, v double")
    got = {r.k: r.s for r in odd.groupBy("k").agg(L.exact_sum(odd, "v").alias("s")).collect()}
    assert math.isnan(got[1]) and got[2] == math.inf and got[3] is None and got[4] == 1e30
