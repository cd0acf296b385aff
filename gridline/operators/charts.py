"""Chart-ready and dashboard datasets (H1-H10, X1, X3) as DataFrames.

The chart specs computed these inside the renderer over one season's slice; here
each takes ``partition_cols`` (default: the season) so that many slices are built in
one distributed job. Whole-slice values (global max/min, latest round, ranks over the
slice) are aggregates joined back or ``rank_within`` -- never a window that puts a
whole slice on one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import weighted_score
from .joins import join_null_safe, sized
from .live_ranking import top_n_ties
from .ranking import group_extreme, rank_within

# Fixed values of the stats charts: metric order, labels and score weights.
STAT_METRICS = {"wins": "Wins", "podiums": "Podiums", "finish_in_points": "Pts finishes",
                "pole_positions": "Poles", "dnf/dns/dsq": "DNF/DNS/DSQ"}
STAT_WEIGHTS = {"wins": 1_000_000, "podiums": 10_000, "finish_in_points": 100, "pole_positions": 1}
WHITE_VARIANTS = ("#FFFFFF", "#ffffff")
WHITE_REPLACEMENT = "#888780"


def num_text(c) -> Column:
    """A number as a chart label renders it: whole values without '.0', null as 'null'."""
    c = F.col(c) if isinstance(c, str) else c
    d = c.cast("double")
    txt = F.when(d == F.floor(d), d.cast("long").cast("string")).otherwise(d.cast("string"))
    return F.coalesce(txt, F.lit("null"))


def str_text(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("string"), F.lit("null"))


def safe_color(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isin(*WHITE_VARIANTS), F.lit(WHITE_REPLACEMENT)).otherwise(c)


def _scope_keys(partition_cols: Sequence[str]) -> list[str]:
    return list(partition_cols)


def unpivot_metrics(df: DataFrame, ids: Sequence[str], metrics: Mapping[str, str],
                    key: str = "metric_key", value: str = "value") -> DataFrame:
    """Fold wide metric columns into (key, value) with a label and a sort index."""
    names = list(metrics)
    long = df.unpivot(list(ids), names, key, value)
    label, sort = F, F          # CASE chains: the last metric is the ELSE branch
    items = list(metrics.items())
    for i, (k, lab) in enumerate(items[:-1], start=1):
        label = label.when(F.col(key) == k, F.lit(lab))
        sort = sort.when(F.col(key) == k, F.lit(i))
    label = label.otherwise(F.lit(items[-1][1])) if len(items) > 1 else F.lit(items[-1][1])
    sort = sort.otherwise(F.lit(len(items))) if len(items) > 1 else F.lit(1)
    return long.withColumns({"metric": label, "metric_sort": sort})


def metric_long(stats: DataFrame, ids: Sequence[str], color: str, top_n: int | None = None,
                partition_cols: Sequence[str] = ("season",), metrics: Mapping[str, str] = STAT_METRICS,
                weights: Mapping[str, float] = STAT_WEIGHTS, drop_zero: bool = True) -> DataFrame:
    """H1/H2: score, rank in the slice, optional top-N, fold, |value|, tooltip, safe colour."""
    scored = stats.withColumn("sort_key", weighted_score(weights))
    scope, order = _scope_keys(partition_cols), [("sort_key", "desc")]
    if top_n is not None:                   # the others are never ranked
        scored = top_n_ties(scored, scope, order, top_n, out="rank")
    else:
        scored = rank_within(scored, scope, order, method="rank", out="rank")
    keep = list(dict.fromkeys([*partition_cols, *ids, color, "sort_key", "rank"]))
    long = unpivot_metrics(scored.select(*keep, *metrics.keys()), keep, metrics)
    long = long.withColumns({
        "abs_value": F.abs("value"),
        "tooltip_metric_value": F.concat(F.col("metric"), F.lit("  :  "), num_text(F.abs("value"))),
        "safe_color": safe_color(color),
    })
    return long.filter(F.col("value") != 0) if drop_zero else long


def chart_order(long: DataFrame, partition_cols: Sequence[str] = ("season",)) -> DataFrame:
    """L4: rows in display order -- score descending, then the fixed metric order."""
    return long.orderBy(*[F.col(c) for c in partition_cols], F.col("sort_key").desc(), F.col("metric_sort"))


def label_position(long: DataFrame, entity: Sequence[str], color: str, offset: float,
                   partition_cols: Sequence[str] = ("season",)) -> DataFrame:
    """H3: per entity the minimum value, score and colour; label height = slice minimum - offset."""
    keys = list(dict.fromkeys([*partition_cols, *entity]))
    per = long.groupBy(*keys).agg(F.min("value").alias("min_value"), F.max("sort_key").alias("sort_key"),
                                  F.max(color).alias("raw_color"))
    per = per.withColumn("safe_color", safe_color("raw_color"))
    per = group_extreme(per, list(partition_cols), "min_value", "global_min", "min")
    return per.withColumn("label_y", F.col("global_min") - F.lit(offset))


def cumulative_series(evo: DataFrame, entity: str, step: str, rank_col: str, highlight_n: int,
                      name_col: str, partition_cols: Sequence[str] = ("season",),
                      entity_label: str = "Driver", rank_alias: str | None = None,
                      series: DataFrame | None = None) -> DataFrame:
    """H4: slice maximum, latest step, each entity's rank at the latest step, styling and tooltips.

    ``series`` is what ``evo`` was made of before its lookups (the same slices, steps and cumulative points):
    the slice-wide values are taken from it, so that the lookups are joined once.

    ``rank_alias`` exposes the rank under a second name (the constructor charts read it
    as ``rank_position``).
    """
    if rank_alias:
        evo = evo.withColumn(rank_alias, F.col(rank_col))
    pc = list(partition_cols)
    s = evo.withColumn("round_num", F.col(step).cast("int"))
    # slice-wide values: one partial aggregate per slice, joined back (the slice is never one task)
    if pc:
        whole = s if series is None else series.withColumn("round_num", F.col(step).cast("int"))
        agg = whole.groupBy(*pc).agg(F.max("cumulative_points").alias("global_max"),
                                     F.max("round_num").alias("max_round_num"))
        s = join_null_safe(s, sized(agg), pc)
    else:                                   # whole dataset: two scalar sub-queries
        s = s.withColumns({"global_max": s.agg(F.max("cumulative_points")).scalar(),
                           "max_round_num": s.agg(F.max("round_num")).scalar()})
    s = s.withColumn("rank_at_latest", F.when(F.col("round_num") == F.col("max_round_num"), F.col(rank_col)))
    # per-entity series hold one row per step of the slice (a calendar bound): a plain window
    s = s.withColumn("current_rank", F.min("rank_at_latest").over(Window.partitionBy(*pc, entity)))
    hi = F.col("current_rank") <= highlight_n
    dot = "   ●   "
    return s.withColumns({
        "line_width": F.when(hi, 2.25).otherwise(1.0),
        "line_opacity": F.when(hi, 0.95).otherwise(0.3),
        "pt_size": F.when(hi, 16).otherwise(6),
        "tt_row1": F.concat(F.lit("Season: "), num_text("season"), F.lit(dot + "Round: "), num_text(step)),
        "tt_row2": F.concat(F.lit("Race: "), str_text("short_race_name")),
        "tt_row3": F.concat(F.lit("Circuit: "), str_text("circuit_name")),
        "tt_row4": F.concat(F.lit(f"{entity_label}: "), str_text(name_col), F.lit(dot + "Points: "),
                            num_text("round_points")),
        "tt_row5": F.concat(F.lit("Total Points: "), num_text("cumulative_points"), F.lit(dot + "Rank: "),
                            num_text(rank_col)),
    })


def series_endpoints(evo: DataFrame, step: str, partition_cols: Sequence[str] = ("season",)) -> DataFrame:
    """H5: the rows at each slice's last step."""
    pc = list(partition_cols)
    s = group_extreme(evo, pc, step, "__max_step", "max")
    return s.filter(F.col(step) == F.col("__max_step")).drop("__max_step")


def rank_series(evo: DataFrame, rank_col: str, n: int, step: str = "round") -> DataFrame:
    """H6: entities ranked 1..n at each step, with the hover labels."""
    return (evo.filter(F.col(rank_col) <= n)
            .withColumns({"rank_position": F.col(rank_col),
                          "round_label": F.concat(F.lit("Round "), num_text(step)),
                          "pos_points": F.concat(F.lit("P"), num_text(rank_col), F.lit("  •  "),
                                                 num_text("cumulative_points"), F.lit(" pts"))}))


def leader(standings: DataFrame, standing: str = "standing") -> DataFrame:
    """H7: standing 1 of each period."""
    return standings.filter(F.col(standing) == 1)


def gap_to_leader(standings: DataFrame, period: str = "season", points: str = "total_points") -> DataFrame:
    """H8: leader's points minus each entity's points (0 for the leader)."""
    s = group_extreme(standings, [period], points, "leader_points", "max")
    return s.withColumn("gap_to_leader", F.col("leader_points") - F.col(points))


def recent_results(df: DataFrame, period: str = "season", step: str = "round", steps: int = 7,
                   position: str = "final_position", k: int = 5) -> DataFrame:
    """The last ``steps`` steps of each period x the first ``k`` positions.

    The window ranks the distinct (period, step) calendar only: at most one row per
    step of a period.
    """
    cal = df.select(period, step).distinct()
    cal = cal.withColumn("__recent", F.dense_rank().over(Window.partitionBy(period).orderBy(F.col(step).desc())))
    keep = cal.filter(F.col("__recent") <= steps).select(period, step)
    return join_null_safe(df.filter(F.col(position).between(1, k)), keep, [period, step], "left_semi")


def slice_by(df: DataFrame, **equals) -> DataFrame:
    """Filter on any (column = value) pairs; ``None`` values are ignored."""
    for c, v in equals.items():
        if v is not None:
            df = df.filter(F.col(c) == F.lit(v))
    return df
