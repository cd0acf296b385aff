"""Registered queries over the stand-in star schema: views, operators and chart datasets.

Each entry pairs a Spark function of the ``Gold`` tables with the body of its DuckDB
oracle, written against the CTEs of ``oracle_sql`` (``fact``, ``dim_*``, ``ref_*``,
``v_*``). Column names match on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import batch_id, short_name, title_case, weighted_score
from ..functions.sortkey import packed_key
from ..operators import analytics as A
from ..operators import charts as C
from ..operators.batch import race_in_lookback, validate_batches
from ..operators.clean import dedupe_hash_first, dedupe_keep_first, drop_null_keys, rename_select
from ..operators.joins import orphans, set_difference
from ..operators.live_ranking import rank_live, top_n
from ..operators.model import union_sessions
from ..operators.ranking import group_extreme, keep_group_max, rank_within, running_total
from ..session import scratch_path
from ..sinks.snapshots import append_table, read_table, upsert_table
from . import race_views as V
from .incremental import ViewState as IncrementalState
from .incremental import refresh, series, standing_parts
from .oracle_sql import short, tc
from .standin import GOLD_TABLES, Gold

GoldFn = Callable[[Gold, V.RaceConfig], DataFrame]

# name -> (spark function, oracle body)
GOLD_QUERIES: dict[str, tuple[GoldFn, str]] = {}


def q(name: str, sql: str):
    def deco(fn: GoldFn) -> GoldFn:
        GOLD_QUERIES[name] = (fn, sql)
        return fn
    return deco


def _scope(g: Gold, cfg: V.RaceConfig, sessions=("RACE", "SPRINT")) -> DataFrame:
    return A.in_scope(g.fact, "season", cfg.min_season, list(sessions))


# --- star schema (D-1..D-4) -----------------------------------------------------------
for _name, _attr in (("fact_session_results", "fact"), ("dim_races", "dim_races"),
                     ("dim_drivers", "dim_drivers"), ("dim_constructors", "dim_constructors"),
                     ("ref_nationality_region", "ref_nationality_region")):
    GOLD_QUERIES[_name] = ((lambda a: (lambda g, cfg: getattr(g, a)))(_attr),
                           f"SELECT * FROM {'ref_region' if _attr == 'ref_nationality_region' else _attr}")

# --- the eleven views (V1-V11) ---------------------------------------------------------
for _name, _fn in (("v_dim_seasons", V.dim_seasons), ("v_constructor_reference", V.constructor_reference),
                   ("v_constructor_evolution", V.constructor_evolution),
                   ("v_driver_evolution", V.driver_evolution),
                   ("v_constructor_round_wins", V.constructor_round_wins),
                   ("v_driver_round_wins", V.driver_round_wins), ("v_driver_standings", V.driver_standings),
                   ("v_constructor_standings", V.constructor_standings), ("v_driver_stats", V.driver_stats),
                   ("v_constructor_stats", V.constructor_stats),
                   ("v_constructor_drivers_distribution", V.constructor_drivers_distribution)):
    GOLD_QUERIES[_name] = ((lambda f: (lambda g, cfg: f(g, cfg)))(_fn), f"SELECT * FROM {_name}")


# --- aggregation / window operators ---------------------------------------------------
@q("agg_sum", "SELECT * FROM drv_round_points")
def _agg_sum(g, cfg):
    return A.step_totals(_scope(g, cfg), ["season", "round", "driver_id"], "points", "round_points")


@q("agg_nested_sum", """
SELECT season, constructor_id, sum(driver_points) AS constructor_points
FROM (SELECT season, constructor_id, driver_id, sum(points) AS driver_points FROM scoped GROUP BY 1, 2, 3)
GROUP BY 1, 2""")
def _agg_nested(g, cfg):
    per = A.step_totals(_scope(g, cfg), ["season", "constructor_id", "driver_id"], "points", "driver_points")
    return A.step_totals(per, ["season", "constructor_id"], "driver_points", "constructor_points")


@q("running_sum", """
SELECT *, sum(round_points) OVER (PARTITION BY season, driver_id ORDER BY round
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative_points
FROM drv_round_points""")
def _running(g, cfg):
    return running_total(_agg_sum(g, cfg), ["season", "driver_id"], "round", "round_points", "cumulative_points")


@q("rank_per_step", """
SELECT *, CAST(rank() OVER (PARTITION BY season, round ORDER BY round_points DESC) AS INTEGER) AS step_rank
FROM drv_round_points""")
def _rank_step(g, cfg):
    return rank_within(_agg_sum(g, cfg), ["season", "round"], [("round_points", "desc")], "rank", "step_rank")


@q("dense_rank_per_period", """
SELECT *, CAST(dense_rank() OVER (PARTITION BY season ORDER BY total_points DESC) AS INTEGER) AS points_rank
FROM (SELECT season, driver_id, sum(points) AS total_points FROM scoped GROUP BY 1, 2)""")
def _dense(g, cfg):
    t = A.step_totals(_scope(g, cfg), ["season", "driver_id"], "points", "total_points")
    return rank_within(t, ["season"], [("total_points", "desc")], "dense_rank", "points_rank")


@q("row_number_per_session", """
SELECT season, round, session_type, driver_id, points,
       CAST(row_number() OVER (PARTITION BY season, round, session_type
                               ORDER BY points DESC, driver_id) AS INTEGER) AS place
FROM fact""")
def _rownum(g, cfg):
    f = g.fact.select("season", "round", "session_type", "driver_id", "points")
    return rank_within(f, ["season", "round", "session_type"], [("points", "desc"), ("driver_id", "asc")],
                       "row_number", "place", unique=True)


@q("rank_one_ties", """
SELECT season, round, driver_id, round_points FROM drv_round_points
QUALIFY rank() OVER (PARTITION BY season, round ORDER BY round_points DESC) = 1""")
def _rank_one(g, cfg):
    return keep_group_max(_agg_sum(g, cfg), ["season", "round"], "round_points")


@q("max_over_sum", """
SELECT season, constructor_id, sum(points) AS constructor_points,
       max(sum(points)) OVER (PARTITION BY season) AS season_max
FROM scoped GROUP BY 1, 2""")
def _max_over(g, cfg):
    t = A.step_totals(_scope(g, cfg), ["season", "constructor_id"], "points", "constructor_points")
    return group_extreme(t, ["season"], "constructor_points", "season_max", "max")


@q("top_n_score", """
SELECT season, driver_id, score, place FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY season ORDER BY score DESC, driver_id) AS INTEGER) AS place
  FROM (SELECT season, driver_id, wins * 1000000 + podiums * 10000 + finish_in_points * 100 + pole_positions AS score
        FROM v_driver_stats)) WHERE place <= 10""")
def _top_n(g, cfg):
    score = weighted_score(C.STAT_WEIGHTS).alias("score")
    return top_n(V.driver_stats(g, cfg).select("season", "driver_id", score), ["season"],
                 [("score", "desc"), ("driver_id", "asc")], 10)


_PACKED = [("l_returnflag", "desc"), ("l_discount", "asc"), ("l_quantity", "desc"), ("l_shipdate", "asc_nulls_last"),
           ("l_orderkey", "desc"), ("l_linenumber", "asc")]


@q("rank_packed_key", """
SELECT l_linestatus, l_orderkey, l_linenumber, CAST(row_number() OVER (
  PARTITION BY l_linestatus ORDER BY l_returnflag DESC NULLS LAST, l_discount NULLS FIRST, l_quantity DESC NULLS LAST,
               l_shipdate NULLS LAST, l_orderkey DESC, l_linenumber) AS INTEGER) AS place FROM lineitem""")
def _rank_packed(g, cfg):
    rows = g.table("lineitem").select("l_linestatus", *[c for c, _ in _PACKED])
    # The key stands for the columns it is made of, so these don't travel beside it.
    keyed = rows.select("l_linestatus", "l_orderkey", "l_linenumber", packed_key(rows, _PACKED).alias("key"))
    ranked = rank_within(keyed, ["l_linestatus"], [("key", "asc")], "row_number", "place", unique=True)
    return ranked.select("l_linestatus", "l_orderkey", "l_linenumber", "place")


@q("rank_live_ties", """
SELECT *, CAST(rank() OVER (PARTITION BY season, round ORDER BY round_points DESC) AS INTEGER) AS step_rank,
       CAST(dense_rank() OVER (PARTITION BY season, round ORDER BY round_points DESC) AS INTEGER) AS step_dense
FROM drv_round_points""")
def _rank_live_ties(g, cfg):
    by, order = ["season", "round"], [("round_points", "desc")]
    return rank_live(rank_live(_agg_sum(g, cfg), by, order, "rank", "step_rank"), by, order, "dense_rank", "step_dense")


@q("densify_grid", "SELECT season, round, driver_id, round_points FROM drv_cumulative")
def _densify(g, cfg):
    return A.densify(_agg_sum(g, cfg), "season", "round", "driver_id", {"round_points": 0})


@q("cumulative_rank_dense", """
SELECT season, round, driver_id, round_points, cumulative_points,
       CAST(rank() OVER (PARTITION BY season, round ORDER BY cumulative_points DESC) AS INTEGER) AS driver_rank
FROM drv_cumulative""")
def _cum_dense(g, cfg):
    return A.cumulative_rank(_agg_sum(g, cfg), "season", "round", "driver_id", "round_points",
                             "cumulative_points", "driver_rank", densify_steps=True)


@q("finish_histogram", "SELECT * FROM drv_finish")
def _hist(g, cfg):
    return A.finish_histogram(V._classified(_scope(g, cfg)), ["season", "driver_id"], "final_position", "round")


@q("latest_attribution_one", """
SELECT season, driver_id, min(constructor_id) AS constructor_id FROM v_constructor_reference GROUP BY 1, 2""")
def _latest_one(g, cfg):
    return A.latest_attribution(_scope(g, cfg, ["RACE"]), ["season", "driver_id"], "round", "constructor_id",
                                ties="one")


@q("outcome_counts_group", """
SELECT season, constructor_id, wins, podiums, finish_in_points, pole_positions, "dnf/dns/dsq"
FROM v_constructor_stats""")
def _outcome(g, cfg):
    return A.outcome_counts(_scope(g, cfg, ["RACE"]), ["season", "constructor_id"], V._FLAGS, "status",
                            V._OK_STATUS, V._OK_LIKE, V.DNF)


# --- live and incremental views ----------------------------------------------------------
def _stored_fact(g, rows: DataFrame, keys=("season", "round", "session_type", "driver_id", "constructor_id")) -> str:
    path = scratch_path(g.spark, "fact-versions")
    upsert_table(rows, path, keys, [c for c in rows.columns if c not in keys], ["season", "round"])
    return path


class _WithFact:
    """A star schema with its fact in a versioned table."""

    def __init__(self, g: Gold, path: str):
        self.__dict__.update({n: getattr(g, n) for n in GOLD_TABLES if n != "fact"})
        self.fact = read_table(g.spark, path).select(*g.fact.columns)


@q("view_after_append", "SELECT * FROM v_constructor_evolution")
def _view_after_append(g, cfg):
    """The views are registered on half of the fact; the other half is appended afterwards."""
    path = _stored_fact(g, g.fact.filter("round <= 6"))
    views = V.LiveViews(g.spark, lambda: _WithFact(g, path), cfg).refresh()
    append_table(g.fact.filter("round > 6"), path)
    return views.sql("SELECT * FROM v_constructor_evolution")


def _advanced(g, entity: str, densify: bool) -> tuple[IncrementalState, _WithFact]:
    """Three batches, the first one wrong for one season and corrected by the third; a refresh after each."""
    keys = ["season", "round", "session_type", "driver_id", "constructor_id"]
    wrong = g.fact.filter("round <= 6").withColumn("points", F.when(F.col("season") == 1998, F.col("points") + 7).otherwise(F.col("points")))
    path = _stored_fact(g, wrong, keys)
    st = IncrementalState(scratch_path(g.spark, "view-state"), path, entity, densify)
    refresh(g.spark, st)
    cols = [c for c in g.fact.columns if c not in keys]
    for batch in (g.fact.filter("round > 6"), g.fact.filter("round <= 6 and season = 1998")):
        upsert_table(batch, path, keys, cols, ["season", "round"])
        refresh(g.spark, st)
    return st, _WithFact(g, path)


@q("standings_incremental", "SELECT * FROM v_driver_standings")
def _standings_incremental(g, cfg):
    st, now = _advanced(g, "driver_id", True)
    return V.driver_standings(now, cfg, parts=standing_parts(g.spark, st, cfg))


@q("evolution_incremental", "SELECT * FROM v_constructor_evolution")
def _evolution_incremental(g, cfg):
    st, now = _advanced(g, "constructor_id", False)
    return V.constructor_evolution(now, cfg, ranked=series(g.spark, st, cfg, "constructor_rank"))


# --- row-level operators ---------------------------------------------------------------
@q("title_case_short_name", f"""
SELECT c_custkey AS driver_id, {tc("lower(c_mktsegment) || ' ' || lower(c_name)")} AS driver_name,
       {short(tc("lower(c_mktsegment) || ' ' || lower(c_name)"))} AS short_name,
       {tc('c_name')} AS one_word, {short(tc('c_name'))} AS one_word_short
FROM customer""")
def _names(g, cfg):
    c = g.table("customer")
    full = title_case(F.concat_ws(" ", F.lower("c_mktsegment"), F.lower("c_name")))
    return c.select(F.col("c_custkey").alias("driver_id"), full.alias("driver_name"),
                    short_name(full).alias("short_name"), title_case("c_name").alias("one_word"),
                    short_name(title_case("c_name")).alias("one_word_short"))


@q("batch_id_format", """
SELECT season, round, season_txt, round_txt,
       CASE WHEN err IS NULL THEN season_txt || '-' || lpad(round_txt, 2, '0') END AS batch_id, err AS error
FROM (SELECT season, round, CAST(season AS VARCHAR) AS season_txt, CAST(round * 3 AS VARCHAR) AS round_txt,
             CASE WHEN round * 3 > 30 THEN 'p_round_no=' || CAST(round * 3 AS VARCHAR)
                                          || ' is out of range. Must be between 1 and 30.' END AS err
      FROM dim_races)""")
def _batch_ids(g, cfg):
    b = g.dim_races.select("season", "round", F.col("season").cast("string").alias("season_txt"),
                           (F.col("round") * 3).cast("string").alias("round_txt"))
    return validate_batches(b, "season_txt", "round_txt", max_year=2100).select(
        "season", "round", "season_txt", "round_txt", "batch_id", "error")


@q("lookback_window", """
SELECT season, round, race_name, race_date FROM dim_races
WHERE race_date BETWEEN DATE '1998-06-03' - INTERVAL 6 DAY AND DATE '1998-06-03' - INTERVAL 1 DAY
ORDER BY race_date LIMIT 1""")
def _lookback(g, cfg):
    return race_in_lookback(g.dim_races, "race_date", "1998-06-03", days=6).select(
        "season", "round", "race_name", "race_date")


@q("rename_select", """
SELECT l_orderkey AS order_key, l_linenumber AS line_number, l_returnflag AS return_flag,
       l_linestatus AS line_status, l_quantity FROM lineitem""")
def _rename(g, cfg):
    return rename_select(g.table("lineitem"), ["l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus",
                                                "l_quantity"],
                         {"l_orderkey": "order_key", "l_linenumber": "line_number", "l_returnflag": "return_flag",
                          "l_linestatus": "line_status"})


@q("null_key_filter", """
SELECT l_orderkey, l_linenumber, p_partkey, p_size
FROM lineitem LEFT JOIN (SELECT p_partkey, p_size FROM part WHERE p_size > 10) ON l_partkey = p_partkey
WHERE l_orderkey IS NOT NULL AND p_partkey IS NOT NULL""")
def _null_keys(g, cfg):
    parts = g.table("part").filter(F.col("p_size") > 10).select("p_partkey", "p_size")
    li = g.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    j = li.join(parts, li.l_partkey == parts.p_partkey, "left").drop("l_partkey")
    return drop_null_keys(j, ["l_orderkey", "p_partkey"])


@q("unpivot_metrics", """
SELECT season, constructor_id, metric_key, value,
       CASE metric_key WHEN 'wins' THEN 'Wins' WHEN 'podiums' THEN 'Podiums' WHEN 'finish_in_points'
            THEN 'Pts finishes' WHEN 'pole_positions' THEN 'Poles' ELSE 'DNF/DNS/DSQ' END AS metric,
       CAST(CASE metric_key WHEN 'wins' THEN 1 WHEN 'podiums' THEN 2 WHEN 'finish_in_points' THEN 3
            WHEN 'pole_positions' THEN 4 ELSE 5 END AS INTEGER) AS metric_sort
FROM (UNPIVOT (SELECT season, constructor_id, wins, podiums, finish_in_points, pole_positions, "dnf/dns/dsq"
               FROM v_constructor_stats)
      ON wins, podiums, finish_in_points, pole_positions, "dnf/dns/dsq" INTO NAME metric_key VALUE value)""")
def _unpivot(g, cfg):
    stats = V.constructor_stats(g, cfg).select("season", "constructor_id", *C.STAT_METRICS)
    return C.unpivot_metrics(stats, ["season", "constructor_id"], C.STAT_METRICS)


@q("dedupe_keep_first", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_partkey, l_suppkey, l_quantity, l_returnflag) AS rn
  FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag FROM lineitem))
WHERE rn = 1""")
def _dedupe(g, cfg):
    li = g.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag")
    return dedupe_keep_first(li, ["l_orderkey", "l_linenumber"])


@q("dedupe_hash_first", """
SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY l_orderkey, l_linenumber, l_quantity) AS rn
  FROM lineitem) WHERE rn = 1""")
def _dedupe_hash(g, cfg):
    li = g.table("lineitem").select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_quantity")
    return dedupe_hash_first(li, ["l_partkey", "l_suppkey"])


@q("join_anti_orphans", """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'HOUSEHOLD')""")
def _orphans(g, cfg):
    o = g.table("orders").select("o_orderkey", "o_custkey")
    c = g.table("customer").filter(F.col("c_mktsegment") == "HOUSEHOLD")
    return orphans(o, "o_custkey", c, "c_custkey")


@q("set_difference", """
SELECT batch_id FROM (SELECT DISTINCT CAST(year(o_orderdate) AS VARCHAR) || '-' ||
                             lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') AS batch_id FROM orders)
EXCEPT
SELECT batch_id FROM (SELECT DISTINCT CAST(year(l_shipdate) AS VARCHAR) || '-' ||
                             lpad(CAST(month(l_shipdate) AS VARCHAR), 2, '0') AS batch_id FROM lineitem)""")
def _setdiff(g, cfg):
    landed = g.table("orders").select(
        batch_id(F.year("o_orderdate"), F.month("o_orderdate")).alias("batch_id"))
    tracked = g.table("lineitem").select(
        batch_id(F.year("l_shipdate"), F.month("l_shipdate")).alias("batch_id"))
    return set_difference(landed, tracked, ["batch_id"])


@q("union_by_name", """
SELECT season, round, driver_id, constructor_id, points, session_type FROM fact""")
def _union(g, cfg):
    race = g.fact.filter(F.col("session_type") == "RACE").drop("session_type")
    sprint = g.fact.filter(F.col("session_type") == "SPRINT").drop("session_type")
    u = union_sessions({"RACE": race, "SPRINT": sprint.select(*reversed(sprint.columns))})
    return u.select("season", "round", "driver_id", "constructor_id", "points", "session_type")


# --- chart / dashboard datasets (H1-H10) ----------------------------------------------
_TT = "metric || '  :  ' || CAST(abs(value) AS VARCHAR)"
_METRIC = ("CASE metric_key WHEN 'wins' THEN 'Wins' WHEN 'podiums' THEN 'Podiums' "
           "WHEN 'finish_in_points' THEN 'Pts finishes' WHEN 'pole_positions' THEN 'Poles' ELSE 'DNF/DNS/DSQ' END")
_METRIC_SORT = ("CASE metric_key WHEN 'wins' THEN 1 WHEN 'podiums' THEN 2 WHEN 'finish_in_points' THEN 3 "
                "WHEN 'pole_positions' THEN 4 ELSE 5 END")
_SAFE = "CASE WHEN color_code IN ('#FFFFFF', '#ffffff') THEN '#888780' ELSE color_code END"


def _long_sql(src: str, ids: str, top: str, zero: bool = True) -> str:
    metrics = ["wins", "podiums", "finish_in_points", "pole_positions", "dnf/dns/dsq"]
    folds = " UNION ALL ".join(f"SELECT {ids}, color_code, sort_key, rank, '{m}' AS metric_key, \"{m}\" AS value "
                               f"FROM scored" for m in metrics)
    return f"""
WITH scored AS (
  SELECT *, CAST(rank() OVER (PARTITION BY season ORDER BY sort_key DESC) AS INTEGER) AS rank
  FROM (SELECT *, wins * 1000000 + podiums * 10000 + finish_in_points * 100 + pole_positions AS sort_key
        FROM {src})),
folded AS ({folds})
SELECT *, CAST({_METRIC_SORT} AS INTEGER) AS metric_sort, abs(value) AS abs_value,
       {_TT} AS tooltip_metric_value, CASE WHEN color_code IN ('#FFFFFF', '#ffffff') THEN '#888780'
       ELSE color_code END AS safe_color
FROM (SELECT *, {_METRIC} AS metric FROM folded WHERE rank <= {top})
{"WHERE value <> 0" if zero else ""}"""


@q("chart_driver_metrics", _long_sql("v_driver_stats", "season, driver_id, driver_name, driver_code", "10"))
def _chart_driver(g, cfg):
    return C.metric_long(V.driver_stats(g, cfg), ["driver_id", "driver_name", "driver_code"], "color_code", top_n=10)


@q("chart_constructor_metrics",
   _long_sql("(SELECT * EXCLUDE (cons_logo) FROM v_constructor_stats)", "season, constructor_id, constructor_name",
             "2147483647"))
def _chart_cons(g, cfg):
    stats = V.constructor_stats(g, cfg).drop("cons_logo")
    return C.metric_long(stats, ["constructor_id", "constructor_name"], "color_code")


@q("chart_label_position", f"""
SELECT *, CAST(global_min AS DOUBLE) - 1.5 AS label_y FROM (
  SELECT *, CASE WHEN raw_color IN ('#FFFFFF', '#ffffff') THEN '#888780' ELSE raw_color END AS safe_color,
         min(min_value) OVER (PARTITION BY season) AS global_min
  FROM (SELECT season, driver_id, min(value) AS min_value, max(sort_key) AS sort_key, max(color_code) AS raw_color
        FROM ({_long_sql("v_driver_stats", "season, driver_id, driver_name, driver_code", "10", zero=False)})
        GROUP BY 1, 2))""")
def _chart_label(g, cfg):
    long = C.metric_long(V.driver_stats(g, cfg), ["driver_id", "driver_name", "driver_code"], "color_code",
                         top_n=10, drop_zero=False)
    return C.label_position(long, ["driver_id"], "color_code", 1.5)


def _num_sql(c: str) -> str:
    return (f"COALESCE(CASE WHEN CAST({c} AS DOUBLE) = floor(CAST({c} AS DOUBLE)) "
            f"THEN CAST(CAST({c} AS BIGINT) AS VARCHAR) ELSE CAST(CAST({c} AS DOUBLE) AS VARCHAR) END, 'null')")


@q("chart_cumulative_series", f"""
SELECT *, CASE WHEN current_rank <= 10 THEN 2.25 ELSE 1.0 END::DOUBLE AS line_width,
       CASE WHEN current_rank <= 10 THEN 0.95 ELSE 0.3 END::DOUBLE AS line_opacity,
       CASE WHEN current_rank <= 10 THEN 16 ELSE 6 END AS pt_size,
       'Season: ' || {_num_sql('season')} || '   ●   Round: ' || {_num_sql('round')} AS tt_row1,
       'Race: ' || COALESCE(short_race_name, 'null') AS tt_row2,
       'Circuit: ' || COALESCE(circuit_name, 'null') AS tt_row3,
       'Driver: ' || COALESCE(driver_name, 'null') || '   ●   Points: ' || {_num_sql('round_points')} AS tt_row4,
       'Total Points: ' || {_num_sql('cumulative_points')} || '   ●   Rank: ' || {_num_sql('driver_rank')} AS tt_row5
FROM (SELECT *, min(rank_at_latest) OVER (PARTITION BY season, driver_id) AS current_rank
      FROM (SELECT *, CASE WHEN round_num = max_round_num THEN driver_rank END AS rank_at_latest
            FROM (SELECT *, CAST(round AS INTEGER) AS round_num,
                         max(cumulative_points) OVER (PARTITION BY season) AS global_max,
                         max(CAST(round AS INTEGER)) OVER (PARTITION BY season) AS max_round_num
                  FROM v_driver_evolution)))""")
def _chart_cum(g, cfg):
    ranked = V.driver_series(g, cfg)
    return C.cumulative_series(V.driver_evolution(g, cfg, ranked=ranked), "driver_id", "round", "driver_rank", 10,
                               "driver_name", series=ranked)


@q("chart_constructor_cumulative_series", f"""
SELECT *, CASE WHEN current_rank <= 7 THEN 2.25 ELSE 1.0 END::DOUBLE AS line_width,
       CASE WHEN current_rank <= 7 THEN 0.95 ELSE 0.3 END::DOUBLE AS line_opacity,
       CASE WHEN current_rank <= 7 THEN 16 ELSE 6 END AS pt_size,
       'Season: ' || {_num_sql('season')} || '   ●   Round: ' || {_num_sql('round')} AS tt_row1,
       'Race: ' || COALESCE(short_race_name, 'null') AS tt_row2,
       'Circuit: ' || COALESCE(circuit_name, 'null') AS tt_row3,
       'Constructor: ' || COALESCE(constructor_name, 'null') || '   ●   Points: ' || {_num_sql('round_points')}
         AS tt_row4,
       'Total Points: ' || {_num_sql('cumulative_points')} || '   ●   Rank: ' || {_num_sql('constructor_rank')}
         AS tt_row5
FROM (SELECT *, min(rank_at_latest) OVER (PARTITION BY season, constructor_id) AS current_rank
      FROM (SELECT *, CASE WHEN round_num = max_round_num THEN constructor_rank END AS rank_at_latest
            FROM (SELECT *, constructor_rank AS rank_position, CAST(round AS INTEGER) AS round_num,
                         max(cumulative_points) OVER (PARTITION BY season) AS global_max,
                         max(CAST(round AS INTEGER)) OVER (PARTITION BY season) AS max_round_num
                  FROM v_constructor_evolution)))""")
def _chart_cons_cum(g, cfg):
    ranked = V.constructor_series(g, cfg)
    return C.cumulative_series(V.constructor_evolution(g, cfg, ranked=ranked), "constructor_id", "round",
                               "constructor_rank", 7, "constructor_name", entity_label="Constructor",
                               rank_alias="rank_position", series=ranked)


@q("chart_constructor_rank_series", f"""
SELECT *, constructor_rank AS rank_position, 'Round ' || {_num_sql('round')} AS round_label,
       'P' || {_num_sql('constructor_rank')} || '  •  ' || {_num_sql('cumulative_points')} || ' pts' AS pos_points
FROM v_constructor_evolution WHERE constructor_rank <= 10""")
def _chart_cons_rank(g, cfg):
    return C.rank_series(V.constructor_evolution(g, cfg), "constructor_rank", 10)


@q("chart_series_endpoints", """
SELECT * FROM v_constructor_evolution
WHERE round = (SELECT max(round) FROM v_constructor_evolution e WHERE e.season = v_constructor_evolution.season)""")
def _chart_end(g, cfg):
    return C.series_endpoints(V.constructor_evolution(g, cfg), "round")


@q("chart_rank_series", f"""
SELECT *, driver_rank AS rank_position, 'Round ' || {_num_sql('round')} AS round_label,
       'P' || {_num_sql('driver_rank')} || '  •  ' || {_num_sql('cumulative_points')} || ' pts' AS pos_points
FROM v_driver_evolution WHERE driver_rank <= 7""")
def _chart_rank(g, cfg):
    return C.rank_series(V.driver_evolution(g, cfg), "driver_rank", 7)


@q("dashboard_leader", "SELECT * FROM v_driver_standings WHERE standing = 1")
def _leader(g, cfg):
    return V.driver_standings(g, cfg, first=1)


@q("dashboard_gap_to_leader", """
SELECT *, leader_points - total_points AS gap_to_leader FROM (
  SELECT *, max(total_points) OVER (PARTITION BY season) AS leader_points FROM v_constructor_standings)""")
def _gap(g, cfg):
    return C.gap_to_leader(V.constructor_standings(g, cfg))


@q("dashboard_recent_results", """
SELECT w.* FROM v_driver_round_wins w
JOIN (SELECT season, round FROM (SELECT season, round, dense_rank() OVER (PARTITION BY season ORDER BY round DESC) AS k
                                 FROM (SELECT DISTINCT season, round FROM v_driver_round_wins)) WHERE k <= 7) r
  ON r.season = w.season AND r.round = w.round
WHERE w.final_position BETWEEN 1 AND 5""")
def _recent(g, cfg):
    return C.recent_results(V.driver_round_wins(g, cfg))


@q("dashboard_slice", "SELECT * FROM v_driver_evolution WHERE season = 1999")
def _slice(g, cfg):
    return C.slice_by(V.driver_evolution(g, replace(cfg, season=1999)), season=1999)
