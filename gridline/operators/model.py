"""Star-schema building blocks (D-1..D-4, U1, P14)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SILVER_ONLY = ("race_name", "race_date", "ingestion_timestamp", "source_file", "batch_id",
                "created_timestamp", "updated_timestamp")


def add_flags(fact: DataFrame) -> DataFrame:
    """Nullable Boolean outcome flags."""
    return fact.withColumns({
        "is_win": F.col("final_position") == 1,
        "is_podium": F.col("final_position").between(1, 3),
        "has_points": F.col("points") > 0,
        "is_pole": F.col("grid_position") == 1,
    })


def union_sessions(parts: Mapping[str, DataFrame], type_col: str = "session_type",
                   drop: Sequence[str] = _SILVER_ONLY) -> DataFrame:
    """Union by column name, each part tagged with its session type."""
    tagged = [df.drop(*[c for c in drop if c in df.columns]).withColumn(type_col, F.lit(t))
              for t, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b), tagged)


def session_fact(parts: Mapping[str, DataFrame]) -> DataFrame:
    """D-4: fact_session_results = union of the session tables + flags."""
    return add_flags(union_sessions(parts))


def build_dim(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], how: str,
              cols: Sequence) -> DataFrame:
    """D-1..D-3: join a cleaned table with another (inner for races⋈circuits, left for region lookups)."""
    cond = reduce(lambda a, b: a & b, [left[lc] == right[rc] for lc, rc in on])
    return left.join(right, cond, how).select(*[c(left, right) if callable(c) else c for c in cols])


def dim_races(races: DataFrame, circuits: DataFrame) -> DataFrame:
    """D-1: races ⋈ circuits (inner: a race whose circuit is missing from the batch drops out)."""
    return build_dim(races, circuits, [("circuit_id", "circuit_id")], "inner", [
        lambda r, c: r.season, lambda r, c: r["round"], lambda r, c: r.race_name, lambda r, c: r.race_date,
        lambda r, c: c.circuit_name, lambda r, c: c.locality, lambda r, c: c.country])


def dim_with_region(entities: DataFrame, ref_region: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """D-2/D-3: left lookup of the nationality's region."""
    ref = ref_region.select(F.col("nationality").alias("__nat"), F.col("region").alias("nationality_region"))
    return (entities.join(ref, entities["nationality"] == ref["__nat"], "left")
            .select(key, *cols, "nationality", "nationality_region"))
