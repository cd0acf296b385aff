"""The distributed ranking equals SQL window ranking, including hot groups, ties and nulls."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridline.operators.ranking import group_extreme, keep_group_max, rank_within, running_total


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(6000):
        g = "hot" if i % 3 else rnd.choice(["a", "b", None])     # one group holds 2/3 of the rows
        v = rnd.choice([None, 0, 0, 1, 2, 3, 5, 8])               # heavy ties and nulls
        rows.append((i, g, rnd.randint(1, 3), v))
    return spark.createDataFrame(rows, "id INT, g STRING, h INT, v INT")


@pytest.mark.parametrize("method", ["rank", "dense_rank"])
@pytest.mark.parametrize("direction", ["asc", "desc", "asc_nulls_last", "desc_nulls_first"])
def test_rank_with_ties_matches_window(spark, skewed, method, direction):
    got = rank_within(skewed, ["g", "h"], [("v", direction)], method=method, out="r", partitions=5)
    col = {"asc": F.col("v").asc(), "desc": F.col("v").desc(), "asc_nulls_last": F.col("v").asc_nulls_last(),
           "desc_nulls_first": F.col("v").desc_nulls_first()}[direction]
    fn = F.rank() if method == "rank" else F.dense_rank()
    want = skewed.withColumn("r", fn.over(Window.partitionBy("g", "h").orderBy(col)))
    assert sorted(got.select("id", "r").collect()) == sorted(want.select("id", "r").collect())


def test_row_number_unique_matches_window(spark, skewed):
    got = rank_within(skewed, ["g"], [("v", "desc"), ("id", "asc")], method="row_number", out="r",
                      unique=True, partitions=7)
    want = skewed.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy(F.col("v").desc(), "id")))
    assert sorted(got.select("id", "r").collect()) == sorted(want.select("id", "r").collect())


def test_global_rank_without_groups(spark, skewed):
    got = rank_within(skewed, [], [("v", "desc")], method="rank", out="r", partitions=3)
    want = skewed.withColumn("r", F.rank().over(Window.orderBy(F.col("v").desc())))
    assert sorted(got.select("id", "r").collect()) == sorted(want.select("id", "r").collect())


def test_row_number_requires_unique_order(spark, skewed):
    with pytest.raises(ValueError):
        rank_within(skewed, ["g"], [("v", "desc")], method="row_number")


def test_keep_group_max_keeps_ties_and_all_null_groups(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("a", 3), ("b", None), ("b", None), (None, 2)],
                               "g STRING, v INT")
    got = sorted(((r.g, r.v) for r in keep_group_max(df, ["g"], "v").collect()), key=repr)
    assert got == sorted([("a", 3), ("a", 3), ("b", None), ("b", None), (None, 2)], key=repr)


def test_group_extreme_and_running_total(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 2, 1.0), ("a", 3, 2.0), ("b", 1, 7.0)],
                               "g STRING, step INT, x DOUBLE")
    got = running_total(group_extreme(df, ["g"], "x", "mx"), ["g"], "step", "x", "cum")
    assert sorted((r.g, r.step, r.mx, r.cum) for r in got.collect()) == [
        ("a", 1, 5.0, 5.0), ("a", 2, 5.0, 6.0), ("a", 3, 5.0, 8.0), ("b", 1, 7.0, 7.0)]
    whole = group_extreme(df, [], "x", "mx").select("mx").distinct().collect()
    assert [r.mx for r in whole] == [7.0]


def test_fractional_ranks_keep_every_row(spark):
    """Sums of doubles change with the order of addition; ranks must not depend on computing them twice."""
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    li = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    rev = li.groupBy("l_suppkey").agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("rev"))
    for method in ("rank", "dense_rank"):
        out = rank_within(rev, [], [("rev", "desc")], method=method, out="r")
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        try:
            assert out.count() == rev.count()
            assert sorted(r.r for r in out.collect()) == list(range(1, rev.count() + 1))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
