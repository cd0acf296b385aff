"""Cleaning operators (P1-P8, A7, F1) and the cleaning job as data (T-1..T-6)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import full_name, title_case


def rename_select(df: DataFrame, select: Sequence[str] | None = None, rename: Mapping[str, str] | None = None,
                  drop: Sequence[str] = ()) -> DataFrame:
    """Keep a column subset, drop columns, rename (camelCase → snake_case map)."""
    if select is not None:
        df = df.select(*select)
    if drop:
        df = df.drop(*drop)
    return df.withColumnsRenamed(dict(rename)) if rename else df


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Reject rows with a null in any business key column."""
    return df.dropna(how="any", subset=list(keys))


def dedupe_keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None,
                      last_by: str | None = None) -> DataFrame:
    """One row per key; the survivor is the smallest row in ``order`` (default: all other columns).

    ``last_by`` instead keeps the row with the greatest value of that column (e.g. the
    newest ``batch_id``), remaining ties broken by the other columns.

    ``dropDuplicates`` keeps an arbitrary row; this keeps a deterministic one. It is a
    ``min(struct)`` aggregate, so a hot key is reduced map-side (partial aggregation)
    before the shuffle and never gathered into one task. Null keys form one group, as in
    ``dropDuplicates``.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    lead = [last_by] if last_by else (list(order) if order is not None else [])
    fields = lead + [c for c in rest if c not in lead]
    packed = F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(fields)])
    pick = F.max if last_by else F.min
    agg = df.groupBy(*keys).agg(pick(packed).alias("__row"))
    return agg.select(*keys, *[F.col(f"__row._{fields.index(c)}").alias(c) for c in rest])


def dedupe_hash_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None,
                      last_by: str | None = None) -> DataFrame:
    """The rows of ``dedupe_keep_first``, comparing rows only where a key has several.

    ``dedupe_keep_first`` aggregates structs, which Spark sorts by key on both sides of the shuffle. Here the
    keys' hash, a number, leads the ordering: rows of different hashes are told apart by it alone, and only those
    of one hash (repeated keys, and keys that share a hash by chance) are compared in full. Each task orders its own rows
    and shuffles its first row of a key only; this is the only shuffle, so it grows with the input and no more.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    lead = [last_by] if last_by else (list(order) if order is not None else [])
    fields = lead + [c for c in rest if c not in lead]
    order_by = [F.col(c).desc() if last_by else F.col(c).asc() for c in fields]
    w = Window.partitionBy("__key", *keys).orderBy(*order_by)
    first = (df.withColumn("__key", F.xxhash64(*keys)).withColumn("__place", F.row_number().over(w))
             .filter("__place = 1"))
    return first.select(*keys, *rest)


def title_case_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """F1 on several columns."""
    return df.withColumns({c: title_case(c) for c in cols})


@dataclass(frozen=True)
class CleanSpec:
    """One cleaning job: what to keep, how to name it, its key and its text fixes."""
    select: Sequence[str] | None = None
    drop: Sequence[str] = ()
    rename: Mapping[str, str] = field(default_factory=dict)
    keys: Sequence[str] = ()
    require_keys: bool = True
    title_case: Sequence[str] = ()
    derived: Mapping[str, Callable[[], Column]] = field(default_factory=dict)   # built at run time
    drop_after: Sequence[str] = ()


def clean(raw: DataFrame, spec: CleanSpec, batch_id: str | None = None, batch_col: str = "batch_id") -> DataFrame:
    """T-1..T-6: batch filter (partition pruning) → select/rename → derived → null keys → dedupe → title case."""
    df = raw.filter(F.col(batch_col) == F.lit(batch_id)) if batch_id is not None else raw
    df = rename_select(df, spec.select, spec.rename, spec.drop)
    if spec.derived:
        df = df.withColumns({name: make() for name, make in spec.derived.items()})
    if spec.drop_after:
        df = df.drop(*spec.drop_after)
    if spec.keys and spec.require_keys:
        df = drop_null_keys(df, spec.keys)
    if spec.keys:
        df = dedupe_keep_first(df, spec.keys)
    return title_case_columns(df, spec.title_case)


_META = ["ingestion_timestamp", "source_file", "batch_id"]
_RESULT_COLS = ["season", "round", "constructorId", "driverId", "date", "raceName", "grid", "laps", "number",
                "points", "position", "positionText", "status", *_META]
_RESULT_RENAME = {"constructorId": "constructor_id", "driverId": "driver_id", "raceName": "race_name",
                  "date": "race_date", "grid": "grid_position", "laps": "completed_laps", "number": "car_number",
                  "position": "final_position", "positionText": "final_position_text"}
_RESULT_KEYS = ["season", "round", "constructor_id", "driver_id"]

# The six cleaning jobs of the race pipeline.
CLEAN_SPECS: dict[str, CleanSpec] = {
    "circuits": CleanSpec(
        select=["circuitId", "circuitName", "lat", "long", "locality", "country", *_META],
        rename={"circuitId": "circuit_id", "circuitName": "circuit_name", "lat": "latitude", "long": "longitude"},
        keys=["circuit_id"], title_case=["circuit_name", "locality"]),
    "races": CleanSpec(
        select=["season", "round", "raceName", "date", "circuitId", *_META],
        rename={"circuitId": "circuit_id", "raceName": "race_name", "date": "race_date"},
        keys=["season", "round"], require_keys=False, title_case=["race_name"]),
    "constructors": CleanSpec(
        drop=["url"], rename={"constructorId": "constructor_id", "name": "constructor_name"},
        keys=["constructor_id"], require_keys=False, title_case=["nationality"]),
    "drivers": CleanSpec(
        drop=["url"], rename={"driverId": "driver_id", "dateOfBirth": "date_of_birth"},
        derived={"driver_name": lambda: full_name(F.col("name.givenName"), F.col("name.familyName"))},
        drop_after=["name"], keys=["driver_id"], require_keys=False, title_case=["nationality"]),
    "results": CleanSpec(select=_RESULT_COLS, rename=_RESULT_RENAME, keys=_RESULT_KEYS, title_case=["race_name"]),
    "sprints": CleanSpec(select=_RESULT_COLS, rename=_RESULT_RENAME, keys=_RESULT_KEYS, title_case=["race_name"]),
}
