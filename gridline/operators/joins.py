"""Join helpers.

No broadcast hints on tables that grow with the data: AQE replans a shuffle join
into a broadcast hash join once the small side's measured size is under
``spark.sql.adaptive.autoBroadcastJoinThreshold`` and splits skewed partitions of
a sort-merge join, so the size check happens at run time with a shuffle join as the
way beyond it. ``broadcast()`` is used only for sides with a proven bound (one-row
constant tables, per-partition summaries).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path


def sized(small: DataFrame) -> DataFrame:
    """Rows to be joined to all rows (offsets or maxima of slices, ranks of distinct keys) as a stored table.

    Their size is known when the join is planned, so where they are few they are broadcast and the
    big side isn't shuffled for them; adaptive execution finds that out only after it has shuffled both, and
    then a hot key's rows have met in one task. Where they are many it is a shuffle join.
    """
    if "void" in small.schema.simpleString():       # parquet has no such type
        return small
    path = scratch_path(small.sparkSession, "rank-joined")
    small.write.parquet(path)
    return small.sparkSession.read.schema(small.schema).parquet(path)


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """``USING``-style equi-join on ``keys`` with ``<=>`` (null matches null); keys kept once."""
    keys = list(keys)
    if not keys:
        raise ValueError("join_null_safe needs at least one key")
    r_alias = {k: f"__r_{k}" for k in keys}
    r = right.select(*[F.col(c).alias(r_alias[c]) if c in r_alias else F.col(c) for c in right.columns])
    cond: Column = reduce(lambda a, b: a & b, [left[k].eqNullSafe(r[r_alias[k]]) for k in keys])
    out = left.join(r, cond, how)
    if how in ("left_semi", "left_anti", "semi", "anti", "leftsemi", "leftanti"):
        return out
    if how in ("right", "right_outer", "full", "full_outer", "outer"):
        out = out.select(*[F.coalesce(left[k], F.col(r_alias[k])).alias(k) if k in r_alias else left[k]
                           for k in left.columns],
                         *[F.col(c) for c in r.columns if c not in r_alias.values()])
        return out
    return out.drop(*r_alias.values())


def orphans(df: DataFrame, column: str, ref: DataFrame, ref_column: str) -> DataFrame:
    """Rows of ``df`` whose non-null ``column`` has no parent in ``ref``.

    The parent keys are de-duplicated (partial aggregation) before the anti join.
    """
    parents = ref.select(F.col(ref_column).alias("__parent")).distinct()
    return (df.filter(F.col(column).isNotNull())
              .join(parents, F.col(column) == F.col("__parent"), "left_anti"))


def set_difference(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct ``keys`` of ``left`` absent from ``right``."""
    return left.select(*keys).distinct().join(right.select(*keys).distinct(), list(keys), "left_anti")


def with_constants(df: DataFrame, **consts) -> DataFrame:
    """Cross join with a one-row constants table (J7) expressed as literals: no join at all."""
    return df.withColumns({k: F.lit(v) for k, v in consts.items()})
