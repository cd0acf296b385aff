"""The eleven analytic views of the race domain, as DataFrame functions over a ``Gold``.

Each function keeps the view's exact semantics (session scope, ties, nulls,
defaults) and is built from the generic operators in ``gridline.operators``.
``constructor_reference`` (V2) is computed once and passed to its four consumers.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import default_to, short_name, shorten
from ..operators import analytics as A
from ..operators.live_ranking import rank_live
from ..operators.ranking import rank_within
from .standin import FLAG_BASE, SVG_BASE, Gold


@dataclass(frozen=True)
class RaceConfig:
    min_season: int = 2020
    # Default colour and default asset names used when a lookup misses.
    default_color: str = "#7C8AA5"
    default_logo: str = SVG_BASE + "/default.svg"
    default_flag: str = FLAG_BASE + "/default-32px.png"
    # One season only, so that nothing else is read or ranked (None: all from ``min_season`` on).
    season: int | None = None
    # How ranks are found: ``rank_live`` makes every view a plan that no job has gone into.
    ranker: Callable[..., DataFrame] = rank_within


RACE, SPRINT = "RACE", "SPRINT"


def _base(g: Gold, cfg: RaceConfig, sessions) -> DataFrame:
    base = A.in_scope(g.fact, "season", cfg.min_season, sessions)
    return base if cfg.season is None else base.filter(F.col("season") == cfg.season)


def _races(g: Gold) -> DataFrame:
    return g.dim_races.select("season", "round", "race_name", "circuit_name", "country",
                              shorten("race_name", "Grand Prix", "GP").alias("short_race_name"))


def dim_seasons(g: Gold, cfg: RaceConfig) -> DataFrame:
    """V1 v_dim_seasons."""
    return A.distinct_periods(g.fact, "season", cfg.min_season)


def constructor_reference(g: Gold, cfg: RaceConfig, ties: str = "all") -> DataFrame:
    """V2 v_constructor_reference: constructor of each driver's last RACE of the season.

    The view's left join to dim_races adds no column and (season, round) is its key,
    so it is left out.
    """
    latest = A.latest_attribution(_base(g, cfg, [RACE]), ["season", "driver_id"], "round",
                                  "constructor_id", ties=ties)
    cc = g.ref_color.select("constructor_id", "color_code", "logo_svg")
    return (latest.join(cc, "constructor_id", "left")
            .select("season", "driver_id", "constructor_id",
                    default_to("color_code", cfg.default_color).alias("color_code"),
                    default_to("logo_svg", cfg.default_logo).alias("cons_logo")))


def constructor_series(g: Gold, cfg: RaceConfig) -> DataFrame:
    """Cumulative points and rank of constructors per round: V3 before names and colours are looked up."""
    pts = A.step_totals(_base(g, cfg, [RACE, SPRINT]), ["season", "round", "constructor_id"], "points", "round_points")
    return A.cumulative_rank(pts, "season", "round", "constructor_id", "round_points", "cumulative_points",
                             "constructor_rank", ranker=cfg.ranker)


def driver_series(g: Gold, cfg: RaceConfig) -> DataFrame:
    """Densified cumulative points and rank of drivers per round: V4 before its lookups."""
    pts = A.step_totals(_base(g, cfg, [RACE, SPRINT]), ["season", "round", "driver_id"], "points", "round_points")
    return A.cumulative_rank(pts, "season", "round", "driver_id", "round_points", "cumulative_points", "driver_rank",
                             densify_steps=True, ranker=cfg.ranker)


def constructor_evolution(g: Gold, cfg: RaceConfig, ranked: DataFrame | None = None) -> DataFrame:
    """V3 v_constructor_evolution: cumulative points and rank per round (no densify).

    ``ranked`` is the ranked series kept elsewhere (``plans.incremental``)."""
    ranked = constructor_series(g, cfg) if ranked is None else ranked
    c = g.dim_constructors.select("constructor_id", F.col("constructor_name").alias("cons_name"),
                                  shorten("constructor_name", " Team", "").alias("constructor_name"))
    r = _races(g).select("season", "round", "circuit_name", "short_race_name")
    cc = g.ref_color.select("constructor_id", "color_code")
    out = ranked.join(c, "constructor_id", "left").join(r, ["season", "round"], "left").join(cc, "constructor_id", "left")
    return out.select("season", "round", "constructor_id", "round_points", "cons_name", "constructor_name",
                      "constructor_rank", "cumulative_points", "circuit_name", "short_race_name",
                      default_to("color_code", cfg.default_color).alias("color_code"))


def driver_evolution(g: Gold, cfg: RaceConfig, cref: DataFrame | None = None,
                     ranked: DataFrame | None = None) -> DataFrame:
    """V4 v_driver_evolution: densified (0 for missed rounds) cumulative points and rank."""
    cref = cref if cref is not None else constructor_reference(g, cfg)
    ranked = driver_series(g, cfg) if ranked is None else ranked
    d = g.dim_drivers.select("driver_id", "driver_name", short_name("driver_name").alias("short_name"))
    dc = g.ref_driver_code.select("driver_id", F.col("fia_driver_code").alias("driver_code"))
    r = _races(g).select("season", "round", "race_name", "short_race_name", "circuit_name")
    out = (ranked.join(cref.select("season", "driver_id", "color_code", "cons_logo"), ["season", "driver_id"], "left")
           .join(dc, "driver_id", "left").join(d, "driver_id", "left").join(r, ["season", "round"], "left"))
    return out.select("season", "round", "driver_id", "driver_code", "driver_name", "short_name", "round_points",
                      "cumulative_points", "driver_rank", "race_name", "short_race_name", "circuit_name",
                      "color_code", "cons_logo")


def constructor_round_wins(g: Gold, cfg: RaceConfig) -> DataFrame:
    """V5 v_constructor_round_wins: top constructor(s) of each RACE by summed points."""
    win = A.group_winners(_base(g, cfg, [RACE]), ["season", "round"], "constructor_id", "points",
                          "round_points", "final_position")
    c = g.dim_constructors.select("constructor_id", "constructor_name")
    r = _races(g).select("season", "round", "circuit_name", "short_race_name", "country")
    cc = g.ref_color.select("constructor_id", "color_code", "logo_svg")
    ci = g.ref_country_image.select("country", "flag_32_png")
    out = (win.join(c, "constructor_id", "left").join(r, ["season", "round"], "left")
           .join(cc, "constructor_id", "left").join(ci, "country", "left"))
    return out.select("season", "round", "constructor_id", "final_position", "constructor_name", "circuit_name",
                      "short_race_name", default_to("color_code", cfg.default_color).alias("color_code"),
                      F.col("logo_svg").alias("cons_logo"),
                      default_to("flag_32_png", cfg.default_flag).alias("flag_png"))


def driver_round_wins(g: Gold, cfg: RaceConfig, cref: DataFrame | None = None, k: int = 5) -> DataFrame:
    """V6 v_driver_round_wins: the first ``k`` finishers of every RACE."""
    cref = cref if cref is not None else constructor_reference(g, cfg)
    top = A.top_k_per_group(_base(g, cfg, [RACE]), "final_position", k).select(
        "season", "round", "driver_id", "constructor_id", "final_position")
    d = g.dim_drivers.select("driver_id", "driver_name", short_name("driver_name").alias("short_name"))
    r = _races(g).select("season", "round", "circuit_name", "short_race_name", "country")
    dc = g.ref_driver_code.select("driver_id", F.col("fia_driver_code").alias("driver_code"))
    cr = cref.select("season", "driver_id", "color_code", "cons_logo")
    ci = g.ref_country_image.select("country", "flag_32_png")
    out = (top.join(d, "driver_id", "left").join(r, ["season", "round"], "left").join(dc, "driver_id", "left")
           .join(cr, ["season", "driver_id"], "left").join(ci, "country", "left"))
    return out.select("season", "round", "driver_id", "constructor_id", "final_position", "driver_name",
                      "driver_code", "short_name", "circuit_name", "short_race_name", "color_code", "cons_logo",
                      default_to("flag_32_png", cfg.default_flag).alias("flag_png"))


def _classified(base: DataFrame) -> DataFrame:
    """Finishes that count for the histogram: RACE, position > 0, Finished or '+…' status."""
    st = F.col("status")
    return base.filter((F.col("session_type") == RACE) & F.col("final_position").isNotNull()
                       & (F.col("final_position") > 0) & ((st == "Finished") | st.like("+%")))


def _standings(g: Gold, cfg: RaceConfig, entity: str, dim: DataFrame, dim_cols: list[str],
               parts: tuple[DataFrame, DataFrame] | None = None, first: int | None = None) -> DataFrame:
    """Points are added per (season, entity) before the dimension is joined: it is unique per entity,
    so the shuffle of the fact carries its sums only. ``parts`` are sums and histogram kept elsewhere;
    ``first`` asks for the first so many of each season only."""
    base = _base(g, cfg, [RACE, SPRINT])
    if parts is None:
        parts = (A.step_totals(base, ["season", entity], "points", "total_points"),
                 A.finish_histogram(_classified(base), ["season", entity], "final_position", "round"))
    pts = parts[0].join(dim.select(entity, *dim_cols), entity, "inner")
    args = (pts, parts[1], "season", entity, "total_points", "standing", "round")
    return A.countback_standings(*args, ranker=cfg.ranker) if first is None else A.countback_leaders(*args, k=first)


def driver_standings(g: Gold, cfg: RaceConfig, cref: DataFrame | None = None, parts=None,
                     first: int | None = None) -> DataFrame:
    """V7 v_driver_standings (the first ``first`` of each season, if given)."""
    cref = cref if cref is not None else constructor_reference(g, cfg)
    st = _standings(g, cfg, "driver_id", g.dim_drivers, ["driver_name", "nationality"], parts, first)
    out = st.join(cref.select("season", "driver_id", "constructor_id", "color_code", "cons_logo"),
                  ["season", "driver_id"], "left")
    return out.select("season", "driver_id", "driver_name", short_name("driver_name").alias("short_name"),
                      "nationality", "standing", "total_points", "constructor_id", "color_code", "cons_logo")


def constructor_standings(g: Gold, cfg: RaceConfig, parts=None, first: int | None = None) -> DataFrame:
    """V8 v_constructor_standings (the first ``first`` of each season, if given)."""
    st = _standings(g, cfg, "constructor_id", g.dim_constructors, ["constructor_name", "nationality"], parts, first)
    cc = g.ref_color.select("constructor_id", "color_code", "logo_svg")
    out = st.join(cc, "constructor_id", "left")
    return out.select("season", "constructor_id", "constructor_name", "nationality", "standing", "total_points",
                      default_to("color_code", cfg.default_color).alias("color_code"),
                      default_to("logo_svg", cfg.default_logo).alias("cons_logo"))


_FLAGS = {"wins": "is_win", "podiums": "is_podium", "finish_in_points": "has_points",
          "pole_positions": "is_pole"}
_OK_STATUS = ("Finished", "Lapped")
_OK_LIKE = "+% Lap%"
DNF = "dnf/dns/dsq"


def driver_stats(g: Gold, cfg: RaceConfig, cref: DataFrame | None = None) -> DataFrame:
    """V9 v_driver_stats."""
    cref = cref if cref is not None else constructor_reference(g, cfg)
    s = A.outcome_counts(_base(g, cfg, [RACE]), ["season", "driver_id"], _FLAGS, "status",
                         _OK_STATUS, _OK_LIKE, DNF)
    out = (s.join(cref.select("season", "driver_id", "color_code"), ["season", "driver_id"], "left")
           .join(g.ref_driver_code.select("driver_id", F.col("fia_driver_code").alias("driver_code")),
                 "driver_id", "left")
           .join(g.dim_drivers.select("driver_id", "driver_name"), "driver_id", "left"))
    return out.select("season", "driver_id", "driver_name", "driver_code", "wins", "podiums", "finish_in_points",
                      "pole_positions", DNF, "color_code")


def constructor_stats(g: Gold, cfg: RaceConfig) -> DataFrame:
    """V10 v_constructor_stats."""
    s = A.outcome_counts(_base(g, cfg, [RACE]), ["season", "constructor_id"], _FLAGS, "status",
                         _OK_STATUS, _OK_LIKE, DNF)
    out = (s.join(g.ref_color.select("constructor_id", "color_code", "logo_svg"), "constructor_id", "left")
           .join(g.dim_constructors.select("constructor_id", "constructor_name"), "constructor_id", "left"))
    return out.select("season", "constructor_id", "constructor_name",
                      default_to("color_code", cfg.default_color).alias("color_code"),
                      default_to("logo_svg", cfg.default_logo).alias("cons_logo"),
                      "wins", "podiums", "finish_in_points", "pole_positions", DNF)


def constructor_drivers_distribution(g: Gold, cfg: RaceConfig) -> DataFrame:
    """V11 v_constructor_drivers_distribution."""
    wb = A.winner_breakdown(_base(g, cfg, [RACE, SPRINT]), "season", "constructor_id", "driver_id", "points",
                            "total_driver_points_for_his_constructor", "max_constructor_points")
    out = (wb.join(g.dim_drivers.select("driver_id", "driver_name"), "driver_id", "left")
           .join(g.ref_color.select("constructor_id", "color_code"), "constructor_id", "left"))
    return out.select("season", "constructor_id", "max_constructor_points", "driver_id", "driver_name",
                      short_name("driver_name").alias("short_name"), "total_driver_points_for_his_constructor",
                      default_to("color_code", cfg.default_color).alias("color_code"))


def all_views(g: Gold, cfg: RaceConfig) -> dict[str, DataFrame]:
    cref = constructor_reference(g, cfg)
    return {
        "v_dim_seasons": dim_seasons(g, cfg),
        "v_constructor_reference": cref,
        "v_constructor_evolution": constructor_evolution(g, cfg),
        "v_driver_evolution": driver_evolution(g, cfg, cref),
        "v_constructor_round_wins": constructor_round_wins(g, cfg),
        "v_driver_round_wins": driver_round_wins(g, cfg, cref),
        "v_driver_standings": driver_standings(g, cfg, cref),
        "v_constructor_standings": constructor_standings(g, cfg),
        "v_driver_stats": driver_stats(g, cfg, cref),
        "v_constructor_stats": constructor_stats(g, cfg),
        "v_constructor_drivers_distribution": constructor_drivers_distribution(g, cfg),
    }


class LiveViews:
    """The views as ``CREATE OR REPLACE VIEW`` gives them -- each read sees the tables as they are.

    ``source`` opens the star schema. A temp view keeps the file list it was made with, so the views are
    planned anew on the newest tables when a query is run through ``sql`` or ``table``; planning them
    runs no job (``rank_live``). ``refresh`` does it for sessions that call ``spark.sql`` themselves.
    """

    def __init__(self, spark: SparkSession, source: Callable[[], Gold], cfg: RaceConfig):
        self.spark, self.source, self.cfg = spark, source, replace(cfg, ranker=rank_live)

    def refresh(self) -> LiveViews:
        for name, df in all_views(self.source(), self.cfg).items():
            df.createOrReplaceTempView(name)
        return self

    def sql(self, text: str) -> DataFrame:
        return self.refresh().spark.sql(text)

    def table(self, name: str) -> DataFrame:
        return all_views(self.source(), self.cfg)[name]


def register_views(g: Gold, cfg: RaceConfig) -> None:
    """Every view as a temp view on one opened star schema."""
    for name, df in all_views(g, cfg).items():
        df.createOrReplaceTempView(name)
