"""Round 3, figures that grew faster than the input: what is shuffled and stored, beside the results."""

import random

from gridline.operators import ranking as R
from gridline.operators.clean import dedupe_hash_first, dedupe_keep_first
from gridline.plans import registry
from gridline.plans.gold_queries import GOLD_QUERIES
from gridline.plans.standin import Gold
from gridline.sinks import snapshots as S


def test_f13_dedupe_hash_first_shuffles_the_rows_once(spark):
    rng = random.Random(13)
    rows = [(rng.choice([None, 1, 2, 3]), rng.choice([None, "a", "b"]), rng.randrange(9), rng.choice([None, 0.0, -0.0, 1.5]))
            for _ in range(300)] + [(i, "alone", 1, 1.0) for i in range(50)]
    df = spark.createDataFrame(rows, "k int, t string, n int, x double").repartition(5)
    for args in ({}, {"order": ["x"]}, {"last_by": "n"}):
        got = dedupe_hash_first(df, ["k", "t"], **args)
        assert sorted(map(str, got.collect())) == sorted(map(str, dedupe_keep_first(df, ["k", "t"], **args).collect()))
    plan = dedupe_hash_first(spark.range(1000).selectExpr("id % 7 k", "id v"), ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan and "SortAggregate" not in plan
    assert plan.count("WindowGroupLimit") == 2          # a task's first row of a key before the shuffle


def test_f22_rank_packed_key_moves_the_key_without_its_columns(spark, tmp_dir, monkeypatch):
    rng = random.Random(22)
    rows = [(i // 3, i % 3, float(rng.randrange(9)), rng.choice([None, 0.0, 0.05]), rng.choice("ANR"), rng.choice("FO"), None)
            for i in range(90)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_quantity double, l_discount double, l_returnflag string, "
                                "l_linestatus string, l_shipdate timestamp").write.parquet(f"{tmp_dir}/lineitem.parquet")
    seen, numbered = [], R._row_numbers
    monkeypatch.setattr(R, "_row_numbers", lambda df, *a: (seen.append(df.dtypes), numbered(df, *a))[1])
    got = GOLD_QUERIES["rank_packed_key"][0](Gold(spark, tmp_dir), registry.CFG).collect()
    assert seen == [[("l_linestatus", "string"), ("l_orderkey", "bigint"), ("l_linenumber", "int"), ("key", "binary")]]
    want = {}
    for s in "FO":
        mine = sorted((r for r in rows if r[5] == s),
                      key=lambda r: (-ord(r[4]), (r[3] is not None, r[3] or 0), -r[2], -r[0], r[1]))
        want.update({(r[0], r[1]): i for i, r in enumerate(mine, 1)})
    assert {(r.l_orderkey, r.l_linenumber): r.place for r in got} == want


def test_f20_an_upsert_of_new_partitions_joins_nothing(spark, tmp_dir, monkeypatch):
    joined, merge = [], S.merge_frames
    monkeypatch.setattr(S, "merge_frames", lambda *a: (joined.append(1), merge(*a))[1])
    path, schema = f"{tmp_dir}/t", "p int, k int, v string"
    for rows in ([(1, 1, "a"), (1, None, "n")], [(2, 1, "b"), (3, None, "c"), (None, 5, "d")]):
        S.upsert_table(spark.createDataFrame(rows, schema), path, ["p", "k"], ["v"], ["p"])
    assert not joined                                   # new partitions alone
    S.upsert_table(spark.createDataFrame([(2, 1, "B"), (4, 1, "e")], schema), path, ["p", "k"], ["v"], ["p"])
    assert joined == [1]                                # a stored partition among them
    got = sorted(map(str, ((r.p, r.k, r.v) for r in S.read_table(spark, path).collect())))
    assert got == sorted(map(str, [(1, 1, "a"), (1, None, "n"), (2, 1, "B"), (3, None, "c"), (None, 5, "d"), (4, 1, "e")]))
