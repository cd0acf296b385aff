"""Round 3: landed datasets are written one by one, packed, from the stored star schema; slices aren't shuffled."""

from pathlib import Path

import pytest

from gridline.operators.ranking import rank_within
from gridline.plans.io_queries import IO_QUERIES, landed
from gridline.plans.landing import DATASETS
from gridline.plans.standin import GOLD_TABLES, materialize_gold


def _orders(spark, folder):
    """Two orders of two customers with a line each, and the other tables the star schema is made of."""
    rows = {"orders": "select id o_orderkey, id o_custkey, timestamp'2000-05-01' o_orderdate from range(1, 3)",
            "lineitem": "select id l_orderkey, id l_partkey, id l_suppkey, 5D l_quantity, 'A' l_returnflag, "
                        "if(id = 1, 'F', 'O') l_linestatus from range(1, 3)",
            "customer": "select id c_custkey, 'c' || id c_name, 1 c_nationkey, 1D c_acctbal, 'AUTO' c_mktsegment from range(1, 3)",
            "supplier": "select id s_suppkey, 's#' || id s_name, 1 s_nationkey, 1D s_acctbal from range(1, 3)",
            "nation": "select cast(id as int) n_nationkey, 'N' || id n_name, 1 n_regionkey from range(25)",
            "region": "select 1 r_regionkey, 'R' r_name"}
    for name, sql in rows.items():
        spark.sql(sql).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_a_query_lands_the_datasets_it_reads_and_no_others(spark, tmp_dir):
    sf = _orders(spark, tmp_dir)
    assert IO_QUERIES["clean_results"][0](spark, sf).count() == 1
    root = Path(landed(spark, sf, "results").removeprefix("file:"))
    assert [p.name for p in root.iterdir()] == ["results"]
    stored = Path(materialize_gold(spark, sf).root.removeprefix("file:"))
    assert {p.name for p in stored.iterdir() if not p.name.endswith("-done")} < set(GOLD_TABLES)
    assert IO_QUERIES["stream_ingest"][0](spark, sf).count() == 1
    assert [p.name for p in root.iterdir()] == ["results"]          # nothing was landed again
    assert landed(spark, sf) == str(root)                           # all of them, by default
    for name in DATASETS:
        files = [p for p in (root / name).rglob("part-*") if p.is_file()]
        assert files and (name in ("races", "circuits") or all(p.suffix == ".gz" for p in files)), name


@pytest.fixture()
def small_broadcasts(spark):
    """Tables are broadcast up to 20 kB: the rows below count as large, their slices' values as small."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "20000")
    yield
    spark.conf.set(name, before)


def test_numbered_rows_are_not_shuffled_for_their_slices_offsets(spark, small_broadcasts):
    df = spark.range(4000).selectExpr("id % 3 as g", "id")
    ranked = rank_within(df, ["g"], [("id", "desc")], method="row_number", out="n", unique=True)
    assert "Exchange hashpartitioning" not in ranked._jdf.queryExecution().executedPlan().toString()
    assert [(r["g"], r["id"]) for r in ranked.filter("n = 1").orderBy("g").collect()] == [(0, 3999), (1, 3997), (2, 3998)]


def test_a_slice_wide_value_does_not_bring_a_slice_to_one_task(spark, small_broadcasts):
    """Neither the maxima of slices nor the ranks of tied rows are joined by shuffling all rows on them."""
    from gridline.operators.charts import cumulative_series

    evo = spark.range(3000).selectExpr(
        "int(id % 3) season", "int(id % 5) round", "id driver_id", "0D cumulative_points", "0D round_points",
        "'n' name", "'r' short_race_name", "'c' circuit_name")
    ranked = rank_within(evo, ["season", "round"], [("cumulative_points", "desc")], out="driver_rank")
    assert "Exchange" not in ranked._jdf.queryExecution().executedPlan().toString().replace("BroadcastExchange", "")
    assert {r[0] for r in ranked.select("driver_rank").distinct().collect()} == {1}
    plan = cumulative_series(ranked, "driver_id", "round", "driver_rank", 5, "name")._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert all("driver_id" in line for line in exchanges)
