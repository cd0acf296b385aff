"""Generic ranking / standings operators (V1-V11 of the survey, domain-free).

Column names are parameters; ``gridline.plans.race_views`` binds them to the
race domain. Every operator is a composition of aggregations, joins and the exact
distributed ranking in ``ranking.py``:

* per-entity windows (running totals) only ever see one row per step of a period,
  a calendar bound (rounds of a season), so a plain window is safe there;
* per-period windows (rank of everybody in a round / season) go through a ``ranker``, which never
  gives one period group to one task: ``rank_within`` (the default) samples and pins its numbering
  when it is called; ``rank_live`` only plans, so a view made with it ranks the rows there are when it is read;
* "rank = 1" and "max over period" become partial aggregates + joins.

Sums that are compared or ranked are exact (``exact_sum``), so that all reads of them agree.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import join_null_safe
from .live_ranking import exact_sum, top_n
from .ranking import OrderSpec, keep_group_max, rank_within, running_total

Ranker = Callable[..., DataFrame]


def in_scope(fact: DataFrame, period: str, min_period, sessions: Sequence[str] | None = None,
             session_col: str = "session_type") -> DataFrame:
    """Threshold + IN-list filter (P9/P10); both reach the parquet scan as pushed filters."""
    cond = F.col(period) >= F.lit(min_period)
    if sessions is not None:
        cond = cond & F.col(session_col).isin(*sessions)
    return fact.filter(cond)


def distinct_periods(fact: DataFrame, period: str, min_period) -> DataFrame:
    """V1: distinct periods at or after ``min_period``."""
    return fact.filter(F.col(period) >= F.lit(min_period)).select(period).distinct()


def step_totals(df: DataFrame, by: Sequence[str], measure: str, out: str) -> DataFrame:
    """A1: SUM(measure) per group (map-side partial aggregation), the same however rows are dealt."""
    return df.groupBy(*by).agg(exact_sum(df, measure).alias(out))


def latest_attribution(base: DataFrame, keys: Sequence[str], step: str, attr: str,
                       ties: str = "all") -> DataFrame:
    """V2 core: the ``attr`` of each key at its latest ``step``.

    ``ties='all'`` keeps every attribute seen at the latest step (the view's
    behaviour, which can fan out consumers); ``ties='one'`` keeps the smallest. A key has as many
    rows as the calendar has steps, and of these each task shuffles the latest ones only.
    """
    w = Window.partitionBy(*keys).orderBy(F.col(step).desc())
    latest = (base.select(*keys, step, attr).withColumn("__recent", F.rank().over(w))
              .filter(F.col("__recent") == 1).select(*keys, attr))
    if ties == "one":
        return latest.groupBy(*keys).agg(F.min(attr).alias(attr))
    if ties != "all":
        raise ValueError("ties must be 'all' or 'one'")
    return latest


def densify(df: DataFrame, period: str, step: str, entity: str, fill: Mapping[str, object]) -> DataFrame:
    """One row per (step of the period) x (entity seen in the period), gaps filled.

    The calendar side (distinct period, step) has one row per step; the join on the
    period is planned as a shuffle join and AQE broadcasts the calendar once its
    measured size is known, so the big member side never lands on one task.
    """
    steps = df.select(period, step).distinct()
    members = df.select(period, entity).distinct()
    grid = members.join(steps, period, "inner")
    out = grid.join(df, [period, step, entity], "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fill.items()})


def cumulative_rank(step_pts: DataFrame, period: str, step: str, entity: str, measure: str,
                    cumulative: str, rank_col: str, densify_steps: bool = False,
                    ranker: Ranker = rank_within) -> DataFrame:
    """V3/V4 core: running total per (period, entity) by step, then RANK per (period, step)."""
    if densify_steps:
        step_pts = densify(step_pts, period, step, entity, {measure: 0})
    cum = running_total(step_pts, [period, entity], step, measure, cumulative)
    return ranker(cum, [period, step], [(cumulative, "desc")], method="rank", out=rank_col)


def group_winners(df: DataFrame, group: Sequence[str], entity: str, measure: str, total: str,
                  rank_col: str) -> DataFrame:
    """V5 core: per group, entities with the top summed measure (RANK() = 1, ties kept)."""
    totals = step_totals(df, [*group, entity], measure, total)
    return keep_group_max(totals, list(group), total).withColumn(rank_col, F.lit(1))


def top_k_per_group(df: DataFrame, position: str, k: int) -> DataFrame:
    """V6/L2: rows whose recorded position is 1..k."""
    return df.filter(F.col(position).isin(*range(1, k + 1)))


def finish_histogram(df: DataFrame, by: Sequence[str], position: str, step: str,
                     depth: int = 20, timing: int = 3) -> DataFrame:
    """Best finish, count of each finish 1..depth, first step of finishes 1..timing."""
    pos = F.col(position)
    aggs: list[Column] = [F.min(position).alias("best_finish")]
    aggs += [F.sum(F.when(pos == i, 1).otherwise(0)).alias(f"p{i}") for i in range(1, depth + 1)]
    aggs += [F.min(F.when(pos == i, F.col(step))).alias(f"first_p{i}_{step}") for i in range(1, timing + 1)]
    return df.groupBy(*by).agg(*aggs)


def _countback(points: DataFrame, finishes: DataFrame, period: str, entity: str, total: str, step: str,
               depth: int, timing: int, missing: int) -> tuple[DataFrame, OrderSpec, list[str]]:
    """The rows to rank, their 26-column ordering, and the helper columns in it."""
    merged = join_null_safe(points, finishes, [period, entity], "left")
    keys = {"__best": F.coalesce(F.col("best_finish"), F.lit(missing))}
    keys.update({f"__first{i}": F.coalesce(F.col(f"first_p{i}_{step}"), F.lit(missing))
                 for i in range(1, timing + 1)})
    order = [(total, "desc")] + [(f"p{i}", "desc") for i in range(1, depth + 1)]
    order += [("__best", "asc")] + [(f"__first{i}", "asc") for i in range(1, timing + 1)]
    return merged.withColumns(keys), [*order, (entity, "asc")], list(keys)


def countback_standings(points: DataFrame, finishes: DataFrame, period: str, entity: str,
                        total: str, standing: str, step: str, depth: int = 20, timing: int = 3,
                        missing: int = 999, ranker: Ranker = rank_within) -> DataFrame:
    """V7/V8 core: DENSE_RANK within the period by total, then p1..p<depth> counts, best finish,
    earliest step of the first ``timing`` finishes, then the entity id.

    ``points`` holds one row per (period, entity) (a dimension key is unique, as the
    upsert guarantees), so the ordering ends in a unique key and DENSE_RANK equals the
    row number. Null counts (no classified finish) sort last on DESC, as in SQL; missing best finish /
    timings become ``missing``. (One packed key for the 26 columns, ``functions.sortkey``, sorts the
    same; building it took longer than it saved, as the first column decides nearly all comparisons.)
    """
    merged, order, helpers = _countback(points, finishes, period, entity, total, step, depth, timing, missing)
    return ranker(merged, [period], order, method="dense_rank", out=standing, unique=True).drop(*helpers)


def countback_leaders(points: DataFrame, finishes: DataFrame, period: str, entity: str,
                      total: str, standing: str, step: str, k: int = 1, depth: int = 20, timing: int = 3,
                      missing: int = 999) -> DataFrame:
    """H7/L3: the first ``k`` of ``countback_standings`` per period, found in two phases without ranking the rest."""
    merged, order, helpers = _countback(points, finishes, period, entity, total, step, depth, timing, missing)
    return top_n(merged, [period], order, k, standing).drop(*helpers)


def outcome_counts(df: DataFrame, by: Sequence[str], flags: Mapping[str, str], status: str,
                   ok_status: Sequence[str], ok_like: str, dnf_col: str) -> DataFrame:
    """V9/V10 core: COUNT_IF per flag, and the negated count of non-finishes.

    A null status is neither a finish nor a non-finish (three-valued NOT IN / NOT LIKE).
    """
    st = F.col(status)
    dnf = F.count_if(~st.isin(*ok_status) & ~st.like(ok_like))
    aggs = [F.count_if(F.col(c)).alias(name) for name, c in flags.items()]
    return df.groupBy(*by).agg(*aggs, (F.lit(-1) * dnf).alias(dnf_col))


def winner_breakdown(df: DataFrame, period: str, group: str, member: str, measure: str,
                     member_total: str, group_max: str) -> DataFrame:
    """V11 core: for the group(s) with the period's top total (ties kept), each member's share."""
    per_member = step_totals(df, [period, group, member], measure, member_total)
    per_group = step_totals(per_member, [period, group], member_total, "__group_total")
    top = keep_group_max(per_group, [period], "__group_total").select(
        period, group, F.col("__group_total").alias(group_max))
    return per_member.join(top, [period, group], "inner")
