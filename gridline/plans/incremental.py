"""Incremental views (V3, V4, V7, V8): state that is advanced by the change set of a stored fact.

The fact is a versioned table partitioned by (season, round), so the difference between two of its
versions names the changed (season, round) folders: that is the change set of the upserts between. State,
per kind of entity, in versioned tables:

* ``totals``: per (season, round, entity) the points and the finish histogram, from the fact's
  partition alone. A refresh reads the changed folders of the fact and replaces these partitions;
* ``series``: the cumulative points and rank of each round. Of a changed season, the rounds from the first
  changed one on are made anew, starting from the sums kept for the round before; a densified series with a
  new member ranks all rounds of its season again, as the member has a place in each;
* ``seasons``: per (season, entity) the sums that the standings rank, folded from the season's totals.

Seasons without a change are neither read nor written. Each table carries the fact's version it reflects; a
refresh that dies half-way leaves some tables at an older version, and the next one advances each from
its own. Views take the state in place of their aggregation and join names and colours as ever.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import analytics as A
from ..operators.joins import join_null_safe
from ..operators.live_ranking import exact_sum
from ..sinks import snapshots as S
from . import race_views as V

DEPTH, TIMING = 20, 3
SEEN = "fact_version"


@dataclass(frozen=True)
class ViewState:
    """The state of one kind of entity: drivers densified, constructors not."""
    root: str
    fact: str
    entity: str
    densify: bool

    @property
    def totals(self) -> str:
        return f"{self.root}/{self.entity}/totals"

    @property
    def series(self) -> str:
        return f"{self.root}/{self.entity}/series"

    @property
    def seasons(self) -> str:
        return f"{self.root}/{self.entity}/seasons"


def _seen(spark: SparkSession, path: str) -> int | None:
    v = S.version(spark, path)
    return int(v.properties[SEEN]) if v else None


def _changes(spark: SparkSession, st: ViewState, table: str, now: int) -> DataFrame | None:
    """(season, first): seasons of the fact that changed since ``table`` was refreshed, and the first changed
    round of each; None where nothing did. As many rows as the change set has folders."""
    seen = _seen(spark, table)
    if seen == now:
        return None
    folders = [dict(p.split("=") for p in f.split("/")) for f in S.changed_partitions(spark, st.fact, seen)]
    rows = [(int(f["season"]), int(f["round"])) for f in folders]
    if not rows:
        return None
    return spark.createDataFrame(rows, "season int, first int").groupBy("season").agg(F.min("first").alias("first"))


def _histogram_columns() -> tuple[list[str], list[str]]:
    return [f"p{i}" for i in range(1, DEPTH + 1)], [f"first_p{i}_round" for i in range(1, TIMING + 1)]


def _round_totals(fact: DataFrame, entity: str) -> DataFrame:
    """Per (season, round, entity): points and finishes. A round's finish counts have its round as first."""
    by = ["season", "round", entity]
    points = A.step_totals(fact.filter(F.col("session_type").isin(V.RACE, V.SPRINT)), by, "points", "round_points")
    finishes = A.finish_histogram(V._classified(fact), by, "final_position", "round", DEPTH, TIMING)
    finishes = finishes.withColumn("classified", F.lit(True))
    return join_null_safe(points, finishes, by, "left")


def _replace(df: DataFrame, path: str, partition_by: list[str], now: int, drop: DataFrame | None = None) -> None:
    """Replace the partitions of ``df`` and remove the others that ``drop`` names; then record the version."""
    if S.version(df.sparkSession, path) is None:
        S.overwrite_table(df, path, partition_by, {SEEN: str(now)})
    else:
        S.replace_partitions(df, path, partition_by, drop, {SEEN: str(now)})


def _advance_totals(spark: SparkSession, st: ViewState, now: int) -> None:
    seen = _seen(spark, st.totals)
    changed = S.changed_partitions(spark, st.fact, seen)
    if seen == now or not changed:
        return
    totals = _round_totals(S.read_partitions(spark, st.fact, changed, now), st.entity)
    folders = [dict(p.split("=") for p in f.split("/")) for f in changed]
    gone = spark.createDataFrame([(int(f["season"]), int(f["round"])) for f in folders], "season int, round int")
    _replace(totals, st.totals, ["season", "round"], now, gone)


def _in_seasons(spark: SparkSession, path: str, changes: DataFrame) -> DataFrame:
    """The rows of a state table in the changed seasons; only their folders are opened."""
    v = S.version(spark, path)
    seasons = {str(r["season"]) for r in changes.select("season").collect()}
    return S.read_partitions(spark, path, [k for k in v.folders if k.split("/")[0].removeprefix("season=") in seasons])


def _advance_series(spark: SparkSession, st: ViewState, now: int, ranker) -> None:
    changes = _changes(spark, st, st.series, now)
    if changes is None:
        return
    key = ["season", st.entity]
    totals = _in_seasons(spark, st.totals, changes).select("season", "round", st.entity, "round_points")
    marked = totals.join(F.broadcast(changes), "season")        # a row per changed season
    late = marked.filter(F.col("round") >= F.col("first")).drop("first")
    if S.table_exists(spark, st.series):
        old = _in_seasons(spark, st.series, changes).join(F.broadcast(changes), "season").filter(F.col("round") < F.col("first"))
    else:
        old = spark.createDataFrame([], S.read_table(spark, st.totals).select(*key, "round", "round_points").schema).withColumns(
            {"cumulative_points": F.lit(0.0), "entity_rank": F.lit(0), "first": F.lit(0)})
    before = old.groupBy(*key).agg(F.max(F.struct("round", "cumulative_points")).alias("m"))
    before = before.select(*key, F.col("m.cumulative_points").alias("carried"))
    early = old.select("season", "round", st.entity, "round_points", "cumulative_points")
    if st.densify:
        members = totals.select(*key).distinct()
        steps = totals.select("season", "round").distinct().join(F.broadcast(changes), "season")
        late_steps = steps.filter(F.col("round") >= F.col("first")).select("season", "round")
        late = members.join(late_steps, "season").join(late, ["season", "round", st.entity], "left")
        late = late.withColumn("round_points", F.coalesce("round_points", F.lit(0)))
        # A new member has rows without points in the rounds before; one that is gone has none any more.
        known = early.select(*key).distinct()
        added = members.join(known, key, "left_anti").join(
            steps.filter(F.col("round") < F.col("first")).select("season", "round"), "season")
        early = early.join(members, key, "left_semi").unionByName(
            added.withColumns({"round_points": F.lit(0.0), "cumulative_points": F.lit(0.0)}))
    w = Window.partitionBy(*key).orderBy("round").rowsBetween(Window.unboundedPreceding, Window.currentRow)   # a season's rounds
    late = late.join(before, key, "left").withColumn(
        "cumulative_points", F.coalesce("carried", F.lit(0.0)) + F.sum("round_points").over(w)).drop("carried")
    rows = late.select(*early.columns)
    if st.densify:
        # Only seasons whose members differ have other ranks in early rounds.
        moved = (early.select(*key).distinct().join(old.select(*key).distinct().withColumn("was", F.lit(True)), key, "left")
                 .filter("was is null").select("season").distinct())
        lost = old.select(*key).distinct().join(members, key, "left_anti").select("season").distinct()
        rows = rows.unionByName(early.join(moved.union(lost).distinct(), "season", "left_semi"))
    ranked = ranker(rows, ["season", "round"], [("cumulative_points", "desc")], method="rank", out="entity_rank")
    gone = _in_seasons(spark, st.series, changes).join(F.broadcast(changes), "season").filter(
        F.col("round") >= F.col("first")).select("season", "round").distinct() if S.table_exists(spark, st.series) else None
    _replace(ranked.select("season", "round", st.entity, "round_points", "cumulative_points", "entity_rank"),
             st.series, ["season", "round"], now, gone)


def _advance_seasons(spark: SparkSession, st: ViewState, now: int) -> None:
    changes = _changes(spark, st, st.seasons, now)
    if changes is None:
        return
    counts, firsts = _histogram_columns()
    totals = _in_seasons(spark, st.totals, changes)
    folded = totals.groupBy("season", st.entity).agg(
        exact_sum(totals, "round_points").alias("total_points"), F.bool_or("classified").alias("classified"),
        F.min("best_finish").alias("best_finish"), *[F.sum(c).alias(c) for c in counts], *[F.min(c).alias(c) for c in firsts])
    _replace(folded, st.seasons, ["season"], now, changes.select("season"))


def refresh(spark: SparkSession, st: ViewState, ranker=None) -> int:
    """Bring the state to the fact's newest version, which is returned."""
    from ..operators.ranking import rank_within
    now = S.version(spark, st.fact).number
    _advance_totals(spark, st, now)
    _advance_series(spark, st, now, ranker or rank_within)
    _advance_seasons(spark, st, now)
    return now


def series(spark: SparkSession, st: ViewState, cfg: V.RaceConfig, rank_col: str) -> DataFrame:
    """The ranked series that ``constructor_evolution`` and ``driver_evolution`` take."""
    return S.read_table(spark, st.series).filter(F.col("season") >= cfg.min_season).withColumnRenamed("entity_rank", rank_col)


def standing_parts(spark: SparkSession, st: ViewState, cfg: V.RaceConfig) -> tuple[DataFrame, DataFrame]:
    """Points and finish histogram per (season, entity), as the standings take them."""
    counts, firsts = _histogram_columns()
    s = S.read_table(spark, st.seasons).filter(F.col("season") >= cfg.min_season)
    return (s.select("season", st.entity, "total_points"),
            s.filter("classified").select("season", st.entity, "best_finish", *counts, *firsts))
