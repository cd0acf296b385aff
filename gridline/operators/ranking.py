"""Exact ranking over groups of any size.

A plain ``rank().over(Window.partitionBy(g).orderBy(k))`` sends every row of a group
to one task. Groups such as "all drivers of a season" or "all rows of one round"
grow with the data, so one such group can hold a large share of all rows. The
operators here compute the same numbers without that single task:

1. ``repartitionByRange`` on (group, order keys) splits a hot group over many
   contiguous range partitions (Spark samples the bounds);
2. a sort inside each range partition numbers its rows (``monotonically_increasing_id``);
   the numbered rows are checkpointed so that both reads below see one assignment;
3. per (partition id, group) totals (at most partitions + groups rows) give each
   slice the count of its group's rows in earlier partitions;
4. slice offset + local number = the global number.

Ties (RANK / DENSE_RANK) are collapsed first with a partially aggregated
``groupBy(group, keys).count()`` -- a hot tie is combined map-side -- and the ranks
of the distinct keys are joined back to the checkpointed input. AQE turns that join into
a broadcast when the distinct-key table is small at run time and splits skewed partitions
otherwise. There is one path for all sizes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root, shuffle_partitions
from .joins import join_null_safe, sized

OrderSpec = Sequence[tuple[str, str]]   # (column, "asc" | "desc" | "asc_nulls_last" | "desc_nulls_first")

_PID, _OFF, _LOC, _W, _G = "__rk_pid", "__rk_off", "__rk_loc", "__rk_w", "__rk_g"
_MID, _POS, _FIRST = "__rk_mid", "__rk_pos", "__rk_first"


def sort_col(name: str, direction: str = "asc") -> Column:
    """Spark default null order: ASC → nulls first, DESC → nulls last."""
    c = F.col(name)
    return {
        "asc": c.asc(), "desc": c.desc(),
        "asc_nulls_last": c.asc_nulls_last(), "asc_nulls_first": c.asc_nulls_first(),
        "desc_nulls_first": c.desc_nulls_first(), "desc_nulls_last": c.desc_nulls_last(),
    }[direction]


def _order_cols(order: OrderSpec) -> list[Column]:
    return [sort_col(c, d) for c, d in order]


def _group_token(by: Sequence[str]) -> Column:
    # One non-null token per group: struct equality compares fields null-safely, so the
    # group can be used as a plain equi-join / partition key even when a column is null.
    return F.struct(*[F.col(b) for b in by]) if by else F.lit(0)


def _row_numbers(df: DataFrame, by: Sequence[str], order: OrderSpec, out: str,
                 partitions: int | None) -> DataFrame:
    """ROW_NUMBER over ``by`` in ``order``, ``(by, order)`` unique, without a single-task group.

    Range partitioning on (group, order) + a sort inside each partition give every row
    its position in its range partition (``monotonically_increasing_id`` = partition id
    << 33 | position). The checkpoint pins these ids: range bounds are sampled, so a
    second evaluation of the exchange need not assign the same rows to the same ids,
    and the numbers are read twice below (slice totals and the final join). It also
    lets a lost executor restart from the files instead of the whole lineage.
    """
    spark = df.sparkSession
    checkpoint_root(spark)
    n = partitions or shuffle_partitions(spark)
    ordering = [F.col(_G).asc()] + _order_cols(order)
    ck = (df.withColumn(_G, _group_token(by)).repartitionByRange(n, *ordering).sortWithinPartitions(*ordering)
          .withColumn(_MID, F.monotonically_increasing_id())
          .checkpoint(eager=True))
    ck = ck.withColumns({_PID: F.shiftright(_MID, 33), _POS: F.col(_MID).bitwiseAND(F.lit((1 << 33) - 1))})
    # slice summary: one row per (range partition, group) -- at most partitions + groups
    # rows and at most `n` rows per group, so the offset window is bounded by `n`
    tot = ck.groupBy(_PID, _G).agg(F.count(F.lit(1)).alias(_W), F.min(_POS).alias(_FIRST))
    off = tot.select(
        _PID, _G, _FIRST,
        F.coalesce(F.sum(_W).over(Window.partitionBy(_G).orderBy(_PID)
                                  .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(_OFF))
    res = ck.join(sized(off), [_PID, _G], "inner")
    num = F.col(_OFF) + F.col(_POS) - F.col(_FIRST) + 1
    return res.withColumn(out, num.cast("long")).drop(_PID, _POS, _OFF, _FIRST, _MID, _G)


def _weighted_prefix(df: DataFrame, by: Sequence[str], order: OrderSpec, weight: str, out: str,
                     partitions: int | None) -> DataFrame:
    """Exclusive running sum of ``weight`` over (by, order) across range partitions.

    Used on tie-collapsed keys (one row per distinct (group, key)), so its input is
    already reduced. Inside a range partition a window keyed by (partition id, group)
    sums the weights -- its largest window is one range partition, not one group.
    """
    spark = df.sparkSession
    checkpoint_root(spark)
    n = partitions or shuffle_partitions(spark)
    ordering = [F.col(_G).asc()] + _order_cols(order)
    keyed = df.withColumn(_G, _group_token(by))
    r = keyed.repartitionByRange(n, *ordering).withColumn(_PID, F.spark_partition_id())
    frame = (Window.partitionBy(_PID, _G).orderBy(*_order_cols(order))
             .rowsBetween(Window.unboundedPreceding, -1))
    loc = r.withColumn(_LOC, F.coalesce(F.sum(weight).over(frame), F.lit(0))).checkpoint(eager=True)
    tot = loc.groupBy(_PID, _G).agg(F.sum(weight).alias(_W))
    off = tot.select(
        _PID, _G,
        F.coalesce(F.sum(_W).over(Window.partitionBy(_G).orderBy(_PID)
                                  .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(_OFF))
    res = loc.join(sized(off), [_PID, _G], "inner")
    return res.withColumn(out, (F.col(_OFF) + F.col(_LOC)).cast("long")).drop(_PID, _OFF, _LOC, _G)


def rank_within(df: DataFrame, by: Sequence[str], order: OrderSpec, method: str = "rank",
                out: str = "rank", unique: bool = False, partitions: int | None = None) -> DataFrame:
    """Adds ``out`` = RANK / DENSE_RANK / ROW_NUMBER over ``by`` ordered by ``order``.

    ``unique=True`` states that (by, order columns) is a key of ``df`` (e.g. the order
    ends with the entity id); then all three methods coincide and no tie collapse is
    needed. ROW_NUMBER over non-unique keys is not deterministic in SQL either, so it
    is only offered with ``unique=True``.
    """
    by = list(by)
    if method not in ("rank", "dense_rank", "row_number"):
        raise ValueError(f"unknown ranking method {method!r}")
    if unique:
        return _row_numbers(df, by, order, out, partitions).withColumn(out, F.col(out).cast("int"))
    if method == "row_number":
        raise ValueError("row_number needs a unique ordering; pass unique=True with a tie-breaker")
    keys = [c for c, _ in order]
    # The ranks are joined back by equality on the ordering columns. A sum of doubles computed twice
    # may differ in its last bits, so both sides read one evaluation.
    checkpoint_root(df.sparkSession)
    df = df.checkpoint(eager=True)
    if method == "dense_rank":       # number the distinct keys; equal keys share the number
        distinct = df.select(*by, *keys).distinct()
        ranked = _row_numbers(distinct, by, order, out, partitions)
    else:                            # RANK = 1 + rows with a smaller key in the group
        distinct = df.groupBy(*by, *keys).agg(F.count(F.lit(1)).alias(_W))
        ranked = _weighted_prefix(distinct, by, order, _W, out, partitions)
        ranked = ranked.withColumn(out, F.col(out) + 1)
    ranked = ranked.select(*by, *keys, F.col(out).cast("int").alias(out))
    return join_null_safe(df, sized(ranked), [*by, *keys])


def running_total(df: DataFrame, by: Sequence[str], step: str, measure: str, out: str) -> DataFrame:
    """SUM(measure) OVER (PARTITION BY by ORDER BY step ROWS UNBOUNDED PRECEDING..CURRENT ROW).

    Meant for per-entity series after pre-aggregation to one row per step: a window
    group then holds at most one row per step (rounds of a season), a bound set by the
    calendar, not by the data volume.
    """
    w = (Window.partitionBy(*by).orderBy(F.col(step).asc())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumn(out, F.sum(measure).over(w))


def group_extreme(df: DataFrame, by: Sequence[str], col: str, out: str, fn: str = "max") -> DataFrame:
    """MAX/MIN(col) OVER (PARTITION BY by) as aggregate + join (partial aggregation, no single-task group)."""
    agg = {"max": F.max, "min": F.min}[fn]
    if not by:                                         # scalar sub-query: one value, computed once
        return df.withColumn(out, df.agg(agg(col)).scalar())
    g = df.groupBy(*by).agg(agg(col).alias(out))
    return join_null_safe(df, g, list(by))


def keep_group_max(df: DataFrame, by: Sequence[str], col: str) -> DataFrame:
    """Rows whose ``col`` equals the group maximum (RANK() = 1, ties kept).

    The maximum is a partial aggregate joined back, however many rows tie; ``<=>`` keeps every row of
    a group whose values are all null (RANK puts them all first there as well). Both sides evaluate
    ``df``: sums of doubles among its columns must be exact (``live_ranking.exact_sum``).
    """
    g = df.groupBy(*by).agg(F.max(col).alias("__gmax"))
    return (join_null_safe(df, g, list(by))
            .filter(F.col(col).eqNullSafe(F.col("__gmax"))).drop("__gmax"))
