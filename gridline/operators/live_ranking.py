"""Exact ranking that plans without running a job, and top rows of a group.

``ranking.rank_within`` samples range bounds and pins its numbering with a checkpoint, so it works when
it is called. A view must not: it has to rank whatever rows there are when it is read. ``rank_live``
gives the same numbers by DataFrame steps alone, without a single-task group:

* rows of a group hang on a tree over the ordering's sortable numbers. A node looks at the first
  ordering column in which its rows differ (a radix tree with compressed paths) and splits the range
  of its values there into ``FAN`` digits;
* counts per node and digit, summed over the digits before (a window of at most ``FAN`` rows), say how
  many rows come before a cell;
* inside a cell of the last level a window numbers the rows in exact order.

A row's digit only has to follow the order weakly, so the tree's shape affects how even the cells
are and never the result. Ties (RANK, DENSE_RANK) are collapsed before, map-side. Counts and rows come
from two evaluations of the input, which agree as long as it is deterministic: sums of doubles must
be made exact first (``exact_sum``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.sortkey import as_distance, at_end, level_numbers
from .joins import join_null_safe
from .ranking import OrderSpec, _group_token, _order_cols

FAN = 4096        # digits of a node
DEPTH = 2         # levels of the tree, where several columns order the rows
_G, _W, _N = "__lr_g", "__lr_w", "__lr_n"


def exact_sum(df: DataFrame, measure: str) -> Column:
    """SUM whose result doesn't depend on the order of the rows, nor on how they are partitioned.

    Floating-point values are added as decimals of ten places, and the total is a double again. A group with a
    value that these can't hold (NaN, infinite, or of 10^27 and more) is summed as doubles.
    """
    kind = df.schema[measure].dataType
    c = F.col(measure)
    if not isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.sum(c)
    wide = F.isnan(c) | (F.abs(c) >= F.lit(1e27))
    decimal = F.when(wide, F.lit(None)).otherwise(c).cast("decimal(38,10)")
    return F.when(F.bool_or(wide), F.sum(c.cast("double"))).otherwise(F.sum(decimal).cast("double"))


def _split(rows: DataFrame, node: Sequence[str], numbers: Sequence[str], digit: str, before: str) -> DataFrame:
    """Adds each row's ``digit`` in its node, and the weight of the node's rows in smaller digits.

    Two aggregates: the ranges of a node's numbers, then the weights of its digits.
    """
    ranges = rows.groupBy(*node).agg(*[F.min(c).alias(f"{c}_lo") for c in numbers], *[F.max(c).alias(f"{c}_hi") for c in numbers])
    value = low = high = F.lit(0.0)
    for c in reversed(numbers):               # the first number that differs decides
        kind = rows.schema[c].dataType
        differs = ~F.col(f"{c}_lo").eqNullSafe(F.col(f"{c}_hi"))
        end = at_end(f"{c}_lo", kind)          # values may differ unseen: the node isn't split by what follows
        value, low, high = (F.when(differs, as_distance(x, kind)).when(end, F.lit(0.0)).otherwise(y)
                            for x, y in ((c, value), (f"{c}_lo", low), (f"{c}_hi", high)))
    # Each step keeps the order weakly.
    share = F.when(high > low, (value - low) / (high - low)).otherwise(0.0)
    placed = rows.join(ranges, list(node)).withColumn(digit, F.least(F.floor(share * FAN), F.lit(FAN - 1)).cast("int"))
    placed = placed.drop(*[f"{c}_{x}" for c in numbers for x in ("lo", "hi")])
    cells = placed.groupBy(*node, digit).agg(F.sum(_W).alias("__lr_cell"))
    ahead = Window.partitionBy(*node).orderBy(digit).rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(*node, digit, F.coalesce(F.sum("__lr_cell").over(ahead), F.lit(0)).alias(before))
    return placed.join(cells, [*node, digit])


def _numbered(rows: DataFrame, order: OrderSpec) -> DataFrame:
    """Adds ``_N``: the weight of the rows of the group that come before."""
    levels = level_numbers(rows, order)
    numbers = [f"__lr_c{i}" for i in range(len(levels))]
    rows = rows.withColumns(dict(zip(numbers, levels)))
    node, parts = [_G], []
    # One column's values are split well by its range; rows that tie in a first of several need its node split again.
    for level in range(1 if len(order) == 1 else DEPTH):
        digit, before = f"__lr_d{level}", f"__lr_b{level}"
        rows = _split(rows, node, numbers, digit, before)
        node, parts = [*node, digit], [*parts, before]
    ahead = Window.partitionBy(*node).orderBy(*_order_cols(order)).rowsBetween(Window.unboundedPreceding, -1)
    local = F.coalesce(F.sum(_W).over(ahead), F.lit(0))
    total = sum((F.col(b) for b in parts), local)
    return rows.withColumn(_N, total).drop(*numbers, *node[1:], *parts)


def rank_live(df: DataFrame, by: Sequence[str], order: OrderSpec, method: str = "rank", out: str = "rank",
              unique: bool = False) -> DataFrame:
    """Adds ``out`` = RANK / DENSE_RANK / ROW_NUMBER over ``by`` ordered by ``order``; runs no job itself.

    As ``rank_within``, ROW_NUMBER is offered for an ordering that is unique in its group
    (``unique=True``), where all three coincide and nothing is joined back.
    """
    by = list(by)
    if method not in ("rank", "dense_rank", "row_number"):
        raise ValueError(f"unknown ranking method {method!r}")
    if method == "row_number" and not unique:
        raise ValueError("row_number needs a unique ordering; pass unique=True with a tie-breaker")
    if unique:
        rows = df.withColumns({_G: _group_token(by), _W: F.lit(1).cast("long")})
        return _numbered(rows, order).withColumn(out, (F.col(_N) + 1).cast("int")).drop(_G, _W, _N)
    keys = [c for c, _ in order]
    weight = F.count(F.lit(1)) if method == "rank" else F.first(F.lit(1).cast("long"))
    distinct = df.groupBy(*by, *keys).agg(weight.alias(_W)).withColumn(_G, _group_token(by))
    ranked = _numbered(distinct, order)
    ranked = ranked.select(*by, *keys, (F.col(_N) + 1).cast("int").alias(out))
    return join_null_safe(df, ranked, [*by, *keys])


def top_n(df: DataFrame, by: Sequence[str], order: OrderSpec, n: int, out: str = "place") -> DataFrame:
    """The first ``n`` rows of each group in an ordering that is unique in it, numbered 1..n.

    Two phases: each task keeps the first n rows it has of a group, and only these are shuffled and
    merged (Spark plans the filtered row number as WindowGroupLimit before and after the exchange;
    without groups as TakeOrderedAndProject). So a group of any size costs a task n rows per task before it.
    """
    cols = _order_cols(order)
    if not by:
        first = df.orderBy(*cols).limit(n)
        return first.withColumn(out, F.row_number().over(Window.orderBy(*cols)).cast("int"))
    w = Window.partitionBy(*by).orderBy(*cols)
    return df.withColumn(out, F.row_number().over(w).cast("int")).filter(F.col(out) <= n)


def top_n_ties(df: DataFrame, by: Sequence[str], order: OrderSpec, n: int, out: str = "rank") -> DataFrame:
    """The rows of each group whose RANK is ``n`` or less (ties kept), without ranking the others.

    Ties are collapsed to one row with their count, the first n of these are found in two phases
    as in ``top_n``, and the rows are joined back: however many rows tie, none of them is sorted.
    """
    keys = [c for c, _ in order]
    values = df.groupBy(*by, *keys).agg(F.count(F.lit(1)).alias(_W))
    first = top_n(values, by, order, n, "__lr_place")
    w = Window.partitionBy(*by) if by else Window.partitionBy()
    ahead = w.orderBy("__lr_place").rowsBetween(Window.unboundedPreceding, -1)      # n rows a group
    ranked = first.withColumn(out, (F.coalesce(F.sum(_W).over(ahead), F.lit(0)) + 1).cast("int"))
    ranked = ranked.filter(F.col(out) <= n).drop(_W, "__lr_place")
    return join_null_safe(df, ranked, [*by, *keys])
