"""Keyed upsert without a table format (K2-K4, K10, Q12 enforcement).

``MERGE INTO`` needs a transactional table format; on plain parquet the same result
is built from DataFrame operations and written back with dynamic partition
overwrite:

* the target is partitioned by ``partition_by`` (columns of the key, e.g. season and
  round, or a hash bucket of the key), so one batch touches few partitions and only
  those are read, merged and rewritten -- work grows with the batch, not the table. Only where
  a key may be stored in another partition than its row's are the table's keys searched;
* matched rows: when the guard holds, the listed columns (and ``updated_timestamp``)
  come from the source, otherwise the target row stays as it was;
* target-only rows stay; source-only rows are inserted whole; null keys never match
  (``=`` semantics), exactly as in MERGE;
* the merged partitions are checkpointed to the shared checkpoint folder before the
  overwrite, so the write never reads the files it replaces, and a lost executor
  restarts from the checkpoint instead of the half-written table.

The overwrite itself isn't atomic on a plain folder; ``sinks.snapshots`` has the same merge on versioned tables.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..session import checkpoint_root
from .writes import balanced, overwrite_partitions, path_exists

Guard = Callable[[Callable[[str], Column], Callable[[str], Column]], Column]
BUCKET = "key_bucket"


def newer_batch_guard(t: Callable[[str], Column], s: Callable[[str], Column]) -> Column:
    """K3: an older batch never overwrites a newer one (padded ids compare as text)."""
    return s("batch_id") >= t("batch_id")


def with_key_bucket(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """Partition column for tables whose key has no natural coarse part (dimensions)."""
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


class ConstraintViolation(Exception):
    pass


def enforce_constraints(df: DataFrame, constraints: Sequence[Mapping[str, str]],
                        unique_keys: Sequence[str] | None = None) -> None:
    """Refuse a write: CHECK predicates and (optionally) one row per key, in one aggregation job."""
    aggs = [F.count_if(~F.coalesce(F.expr(c["condition"]), F.lit(False))).alias(c["name"]) for c in constraints]
    if unique_keys:
        aggs.append((F.count(F.lit(1)) - F.count_distinct(F.struct(*[F.col(k) for k in unique_keys])))
                    .alias("__dup_keys"))
    if not aggs:
        return
    row = df.agg(*aggs).first()
    if unique_keys and row["__dup_keys"]:
        raise ValueError(f"source has duplicate keys on {list(unique_keys)}; MERGE needs one source row per key")
    bad = {c["name"]: int(row[c["name"]]) for c in constraints if row[c["name"]]}
    if bad:
        raise ConstraintViolation(f"CHECK constraints violated: {bad}")


def merge_frames(target: DataFrame, source: DataFrame, keys: Sequence[str], update_cols: Sequence[str],
                 guard: Guard | None = None) -> DataFrame:
    """The MERGE result of ``source`` into ``target`` as a DataFrame (target schema order)."""
    keys = list(keys)
    t = target.select(*[F.col(c).alias(f"t__{c}") for c in target.columns]).withColumn("t__present", F.lit(True))
    s = source.select(*[F.col(c).alias(f"s__{c}") for c in source.columns]).withColumn("s__present", F.lit(True))
    cond = None
    for k in keys:
        c = F.col(f"t__{k}") == F.col(f"s__{k}")
        cond = c if cond is None else cond & c
    j = t.join(s, cond, "full_outer")
    tc = lambda c: F.col(f"t__{c}")
    sc = lambda c: F.col(f"s__{c}")
    matched = F.col("t__present").isNotNull() & F.col("s__present").isNotNull()
    take = matched if guard is None else matched & F.coalesce(guard(tc, sc), F.lit(False))
    source_only = F.col("t__present").isNull()
    updated = set(update_cols) | {"updated_timestamp"}
    out = []
    for c in target.columns:
        if c in updated and c in source.columns:
            v = F.when(source_only, sc(c)).when(take, sc(c)).otherwise(tc(c))
        elif c in source.columns:
            v = F.when(source_only, sc(c)).otherwise(tc(c))
        else:
            v = F.when(source_only, F.lit(None)).otherwise(tc(c))
        out.append(v.cast(target.schema[c].dataType).alias(c))   # keep the table's types
    return j.select(*out)


def stored_schema(spark: SparkSession, path: str, like: DataFrame, partition_by: Sequence[str]) -> StructType:
    """The table's schema with the written types of its partition columns.

    Reading infers the types of partition columns from their folder names, which turns '007' into 7;
    the types of ``like``, the rows about to be written, are the ones that were written before.
    """
    found = spark.read.parquet(path).schema
    return StructType([StructField(f.name, like.schema[f.name].dataType if f.name in partition_by else f.dataType)
                       for f in found])


def upsert(source: DataFrame, path: str, keys: Sequence[str], update_cols: Sequence[str],
           partition_by: Sequence[str], guard: Guard | None = None,
           constraints: Sequence[Mapping[str, str]] = (), check_unique: bool = True,
           key_decides: bool | None = None) -> str:
    """K2: create the table on first write, else MERGE ``source`` into it. Returns 'created'/'merged'.

    ``key_decides`` states that a key's partition is a function of the key (the default where the
    partition columns are part of it): then the partitions of the source's rows are all there is to open.

    ``constraints`` are enforced on the rows to be written (refusing the write), which
    is what a CHECK constraint on the table would do.
    """
    spark: SparkSession = source.sparkSession
    final = source.withColumns({"created_timestamp": F.current_timestamp(),
                                "updated_timestamp": F.current_timestamp()})
    if not path_exists(spark, path):
        enforce_constraints(final, constraints, keys if check_unique else None)
        balanced(final, partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)
        return "created"
    if check_unique:
        enforce_constraints(final, (), keys)
    moved = sorted(set(partition_by) & set(update_cols))
    if moved:
        raise ValueError(f"partition columns {moved} can't be updated in place")
    target = spark.read.schema(stored_schema(spark, path, final, partition_by)).parquet(path)
    place = list(dict.fromkeys(partition_by))
    touched = final.select(*[F.col(c).cast(target.schema[c].dataType).alias(c) for c in place])
    if not (set(place) <= set(keys) if key_decides is None else key_decides):
        # A key matches wherever it is stored; the search reads key and partition columns only.
        touched = touched.union(target.select(*dict.fromkeys([*place, *keys])).join(
            final.select(*keys).distinct(), list(keys), "left_semi").select(*place))
    touched = touched.distinct()
    # Each partition column's values, as many as the batch has partitions at most, prune the scan.
    values = touched.agg(*[F.collect_set(c).alias(c) for c in place],
                         *[F.bool_or(F.col(c).isNull()).alias(f"null {c}") for c in place]).first()
    for c in place:
        known = target[c].isin(values[c])
        target = target.filter(known | target[c].isNull() if values[f"null {c}"] else known)
    # Null-safe: rows whose partition value is null are a partition too.
    touched = touched.select(*[F.col(c).alias(f"__in_{c}") for c in place])
    same = reduce(lambda a, b: a & b, [target[c].eqNullSafe(F.col(f"__in_{c}")) for c in place])
    t_part = target.join(touched, same, "left_semi")
    merged = merge_frames(t_part, final.select(*target.columns) if set(target.columns) <= set(final.columns)
                          else final, keys, update_cols, guard)
    enforce_constraints(merged, constraints)
    checkpoint_root(spark)
    merged = merged.checkpoint(eager=True)
    overwrite_partitions(merged, path, partition_by)
    return "merged"


def upsert_guarded(source: DataFrame, path: str, keys, update_cols, partition_by, constraints=()) -> str:
    """K3 (cleaned layer): newer-or-equal batches only."""
    return upsert(source, path, keys, update_cols, partition_by, newer_batch_guard, constraints)


def upsert_unguarded(source: DataFrame, path: str, keys, update_cols, partition_by, constraints=()) -> str:
    """K4 (star schema): every matched row is updated."""
    return upsert(source, path, keys, update_cols, partition_by, None, constraints)


def update_matched_only(target: DataFrame, source: DataFrame, keys: Sequence[str], set_cols: Sequence[str],
                        extra: Callable[[Callable[[str], Column], Callable[[str], Column]], Column] | None = None
                        ) -> DataFrame:
    """MERGE with only an update branch: matched rows take ``set_cols`` from the source;
    unmatched target rows stay; source rows without a match are ignored."""
    keys = list(keys)
    s = source.select(*keys, *[F.col(c).alias(f"s__{c}") for c in set_cols]).withColumn("s__hit", F.lit(True))
    j = target.join(s, keys, "left")
    hit = F.col("s__hit").isNotNull()
    if extra is not None:
        hit = hit & F.coalesce(extra(F.col, lambda c: F.col(f"s__{c}")), F.lit(False))
    return j.select(*[F.when(hit, F.col(f"s__{c}")).otherwise(F.col(c)).alias(c) if c in set_cols else F.col(c)
                      for c in target.columns])
