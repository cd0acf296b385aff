"""Registered queries (Spark) and their DuckDB oracles, keyed by the same names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_conf
from . import oracle_sql as O
from . import race_views as V
from .gold_queries import GOLD_QUERIES
from .standin import build_gold, materialize_gold

# The test data covers seasons 1995-2001; 1996 keeps the threshold filter meaningful.
MIN_SEASON = 1996
CFG = V.RaceConfig(min_season=MIN_SEASON)
FLAGSHIP = "v_driver_standings"

Query = Callable[[SparkSession, str], DataFrame]


# Queries that build the star schema itself run from the source tables every time; all
# others read the stored star schema (written once per session), as views do.
FROM_SOURCE = {"fact_session_results", "dim_races", "dim_drivers", "dim_constructors", "ref_nationality_region",
               "row_number_per_session"}


def _gold_query(name: str, fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_conf(spark)
        g = build_gold(spark, sf_dir) if name in FROM_SOURCE else materialize_gold(spark, sf_dir)
        return fn(g, CFG)
    return run


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_conf(spark)
    return V.driver_standings(build_gold(spark, sf_dir), CFG)


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {name: _gold_query(name, fn) for name, (fn, _) in GOLD_QUERIES.items()}
    from .io_queries import IO_QUERIES
    q.update({name: fn for name, (fn, _) in IO_QUERIES.items()})
    return q


def oracle_sql() -> dict[str, str]:
    o = {name: O.with_gold(MIN_SEASON, body) for name, (_, body) in GOLD_QUERIES.items()}
    from .io_queries import IO_QUERIES
    o.update({name: sql for name, (_, sql) in IO_QUERIES.items() if sql is not None})
    return o
