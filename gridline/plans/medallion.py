"""The medallion batch job (M5): landed files → raw → cleaned (+ quality, guarded upsert) → star schema.

Every step works on one batch (``batch_id``) or, for a backfill, on all landed
batches at once (``batch_id=None``): the same DataFrame jobs then process every
batch in one pass instead of a driver loop over batches. Raw tables are parquet folders
under ``lake`` with a partition per batch; cleaned, star, control and audit tables are
versioned (``sinks.snapshots``), so a reader never sees half a write. Runs claim their batch
and record finished steps in a ledger (``sinks.ledger``): a retry goes on where a run failed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import batch as B
from ..operators import model as M
from ..operators.clean import CLEAN_SPECS, clean, dedupe_keep_first
from ..operators.quality import check_suites, constraint_suites, run_checks
from ..session import checkpoint_root
from ..sinks.ledger import claim, finished_steps, run_step
from ..sinks.snapshots import append_table, overwrite_table, read_table, table_exists, update_table, upsert_table, version
from ..sinks.upsert import BUCKET, newer_batch_guard, with_key_bucket
from ..sinks.writes import overwrite_partitions, replace_partition
from ..sources.files import add_ingestion_metadata, list_landing_batches, scan_landed

DATASETS = ("circuits", "races", "constructors", "drivers", "results", "sprints")
# Parents first, so that referential checks see their parent tables; each level runs concurrently.
CLEAN_LEVELS = (("circuits", "constructors", "drivers"), ("races", "results", "sprints"))
KEYS = {"circuits": ["circuit_id"], "races": ["season", "round"], "constructors": ["constructor_id"],
        "drivers": ["driver_id"], "results": ["season", "round", "constructor_id", "driver_id"],
        "sprints": ["season", "round", "constructor_id", "driver_id"]}
# Partitioning of the cleaned tables: results by their (season, round) key part, the others by a hash
# bucket of the key, so an upsert rewrites only touched partitions. A table gets a bucket per so many rows.
BUCKET_ROWS = 1 << 20


@dataclass(frozen=True)
class Lake:
    root: str

    def raw(self, name: str) -> str:
        return f"{self.root}/bronze/{name}"

    def silver(self, name: str) -> str:
        return f"{self.root}/silver/{name}"

    def gold(self, name: str) -> str:
        return f"{self.root}/gold/{name}"

    @property
    def control(self) -> str:
        return f"{self.root}/control/batch_control"

    @property
    def ledger(self) -> str:
        return f"{self.root}/control/batch_steps"

    @property
    def audit(self) -> str:
        return f"{self.root}/silver/data_quality_results"


def _partitioning(name: str) -> list[str]:
    return ["season", "round"] if name in ("results", "sprints", "races") else [BUCKET]


# --- raw ("bronze") ---------------------------------------------------------------------
def load_raw(spark: SparkSession, landing: str, lake: Lake, name: str, batch_id: str | None) -> None:
    """Scan the landed dataset with its fixed schema, stamp load time/file, replace the batch partition(s)."""
    df = add_ingestion_metadata(scan_landed(spark, landing, name, batch_id))
    if batch_id is not None:
        replace_partition(df.drop("batch_id"), lake.raw(name), batch_id)
    else:                                    # backfill: dynamic overwrite of every landed batch
        overwrite_partitions(df, lake.raw(name), ["batch_id"])


# --- cleaned ("silver") -------------------------------------------------------------------
def cleaned(spark: SparkSession, lake: Lake, name: str, batch_id: str | None) -> DataFrame:
    raw = spark.read.parquet(lake.raw(name))
    if batch_id is None:
        # several batches carry the same key: the newest batch wins, as successive
        # guarded upserts would decide
        raw = dedupe_keep_first(raw, KEYS_RAW[name], last_by="batch_id")
    return clean(raw, CLEAN_SPECS[name], batch_id)


KEYS_RAW = {"circuits": ["circuitId"], "races": ["season", "round"], "constructors": ["constructorId"],
            "drivers": ["driverId"], "results": ["season", "round", "constructorId", "driverId"],
            "sprints": ["season", "round", "constructorId", "driverId"]}


def upsert_bucketed(df: DataFrame, path: str, keys: Sequence[str], update_cols: Sequence[str],
                    bucket_rows: int = BUCKET_ROWS, **kw) -> None:
    """Upsert into a table partitioned by hash buckets of its key, whose number follows its size.

    The number is kept with the table. Once its rows are four times what the buckets are meant for, the
    whole table is dealt anew, to twice as many buckets as needed: that costs a rewrite each time
    the table has grown by some factor, and a bucket stays of one size.
    """
    spark = df.sparkSession
    v = version(spark, path)
    if v is None:
        buckets = _buckets_for(df.count(), bucket_rows)
    else:
        buckets, rows = int(v.properties["buckets"]), read_table(spark, path).count()
        if rows > 4 * buckets * bucket_rows:
            buckets = _buckets_for(2 * rows, bucket_rows)
            overwrite_table(with_key_bucket(read_table(spark, path).drop(BUCKET), keys, buckets), path, [BUCKET],
                            {"buckets": str(buckets)})
    upsert_table(with_key_bucket(df, keys, buckets), path, keys, update_cols, [BUCKET], key_decides=True,
                 properties={"buckets": str(buckets)}, **kw)


def _buckets_for(rows: int, bucket_rows: int) -> int:
    return max(1, -(-rows // bucket_rows))


def clean_table(spark: SparkSession, lake: Lake, name: str, batch_id: str | None,
                raise_on_critical: bool = True) -> list[dict]:
    """T-n: clean → quality suite (audited, may raise) → guarded upsert with the table's constraints."""
    df = cleaned(spark, lake, name, batch_id)
    # the checks, the constraint test and the write all read this one materialization
    # (shared checkpoint folder), instead of re-running scan + dedupe + clean three times
    df = df.checkpoint(eager=True)

    def parent(ref: str) -> DataFrame:
        tbl = ref.split(".")[-1]
        p = lake.silver(tbl)
        if not table_exists(spark, p):
            raise LookupError(f"Table or view not found: {ref}")
        return read_table(spark, p)

    results = run_checks(df, check_suites()[name], lake.silver(name), batch_id or "*", ref_tables=parent,
                         raise_on_critical=raise_on_critical,
                         audit=lambda r: append_table(r, lake.audit))
    spec_cols = [c for c in df.columns if c not in KEYS[name] and c not in _partitioning(name)]
    # the suite's critical `unique` check has already refused duplicate keys
    kw = {"guard": newer_batch_guard, "constraints": constraint_suites()[name], "check_unique": False}
    if _partitioning(name) == [BUCKET]:
        upsert_bucketed(df, lake.silver(name), KEYS[name], spec_cols, **kw)
    else:
        upsert_table(df, lake.silver(name), KEYS[name], spec_cols, _partitioning(name), **kw)
    return results


# --- star schema ("gold") ---------------------------------------------------------------
def gold_frames(spark: SparkSession, lake: Lake, batch_id: str | None,
                ref_region: DataFrame) -> dict[str, DataFrame]:
    def silver(name: str) -> DataFrame:
        df = read_table(spark, lake.silver(name))
        return df if batch_id is None else df.filter(F.col("batch_id") == batch_id)

    races, circuits = silver("races"), silver("circuits")
    parts = {"RACE": silver("results"), "SPRINT": silver("sprints")}
    fact = M.session_fact({t: p.drop("key_bucket") for t, p in parts.items()})
    return {
        "dim_races": M.dim_races(races, circuits),
        "dim_constructors": M.dim_with_region(silver("constructors"), ref_region, "constructor_id",
                                              ["constructor_name"]),
        "dim_drivers": M.dim_with_region(silver("drivers"), ref_region, "driver_id",
                                         ["driver_name", "date_of_birth"]),
        "fact_session_results": fact,
    }


GOLD_KEYS = {"dim_races": ["season", "round"], "dim_constructors": ["constructor_id"],
             "dim_drivers": ["driver_id"],
             "fact_session_results": ["season", "round", "constructor_id", "driver_id", "session_type"]}


def build_gold_tables(spark: SparkSession, lake: Lake, batch_id: str | None, ref_region: DataFrame,
                      parallel: int = 4) -> None:
    """D-1..D-4 with unguarded upserts (matched rows always updated); the four are independent."""
    def one(item):
        name, df = item
        keys = GOLD_KEYS[name]
        part = ["season", "round"] if "round" in keys else [BUCKET]
        cols = [c for c in df.columns if c not in keys and c not in part]
        # the fact's key is unique by construction: checked cleaned keys + a literal session type
        kw = {"guard": None, "check_unique": name != "fact_session_results"}
        if part == [BUCKET]:
            upsert_bucketed(df, lake.gold(name), keys, cols, **kw)
        else:
            upsert_table(df, lake.gold(name), keys, cols, part, **kw)
    _run_all(one, list(gold_frames(spark, lake, batch_id, ref_region).items()), parallel)


def _run_all(fn, items, parallel: int) -> list:
    """Submit independent Spark jobs from a few driver threads (the job graph's parallel tasks)."""
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        return list(pool.map(fn, items))


# --- batch control and the whole run ------------------------------------------------------
def control_table(spark: SparkSession, lake: Lake) -> DataFrame:
    return read_table(spark, lake.control) if table_exists(spark, lake.control) else B.empty_control(spark)


def next_batch_id(spark: SparkSession, landing: str, lake: Lake) -> str | None:
    """M1 (one-row result to the driver: the id the job continues with)."""
    row = B.next_batch(list_landing_batches(spark, landing), control_table(spark, lake)).first()
    return row["batch_id"] if row["has_batch"] else None


def start_batch(spark: SparkSession, lake: Lake, batch_id: str) -> None:
    append_table(B.start_row(spark, batch_id), lake.control)


def complete_batch(spark: SparkSession, lake: Lake, batch_id: str) -> None:
    """M3 by K10: the batch's in_progress rows of the control table become completed, nothing else changes."""
    done = (spark.createDataFrame([(batch_id, B.COMPLETED)], "batch_id STRING, status STRING")
            .withColumn("updated_timestamp", F.current_timestamp()))
    update_table(done, lake.control, ["batch_id"], ["status", "updated_timestamp"],
                 extra=lambda t, s: t("status") == B.IN_PROGRESS)


def run_batch(spark: SparkSession, landing: str, lake: Lake, batch_id: str | None, ref_region: DataFrame,
              parallel_loads: int = 3, control: bool = True, retry: bool = False,
              before_step: Callable[[str], object] = lambda name: None) -> list[dict]:
    """M5: six loads (in parallel) → six cleans (parents first) → dims + fact → complete.

    A batch is claimed first; one that another run has claimed is refused. A batch whose run failed
    stays claimed (and in_progress) until it is run with ``retry``, which takes it over and goes
    on with the first step that isn't recorded as finished. ``before_step`` is told each step's name.
    """
    checkpoint_root(spark)
    tracked = control and batch_id is not None
    step: Callable = lambda name, work: work()
    if tracked:
        run = claim(spark, lake.ledger, batch_id, retry)
        done = finished_steps(spark, lake.ledger, batch_id)

        def step(name, work):
            if name in done:
                return []
            before_step(name)
            return run_step(spark, lake.ledger, run, name, work)

        step("start", lambda: start_batch(spark, lake, batch_id))
    _run_all(lambda n: step(f"load {n}", lambda: load_raw(spark, landing, lake, n, batch_id)), DATASETS, parallel_loads)
    dq: list[dict] = []
    for level in CLEAN_LEVELS:
        for res in _run_all(lambda n: step(f"clean {n}", lambda: clean_table(spark, lake, n, batch_id)), level,
                            parallel_loads):
            dq += res
    step("star schema", lambda: build_gold_tables(spark, lake, batch_id, ref_region))
    if tracked:
        step("complete", lambda: complete_batch(spark, lake, batch_id))
    return dq


def backfill(spark: SparkSession, landing: str, lake: Lake, ref_region: DataFrame) -> list[dict]:
    """Every landed batch in one pass (the scale path for an initial load)."""
    return run_batch(spark, landing, lake, None, ref_region, control=False)


def run_pending(spark: SparkSession, landing: str, lake: Lake, ref_region: DataFrame,
                max_batches: int | None = None) -> Sequence[str]:
    """Process pending batches oldest first (one scheduled run = one batch in the reference)."""
    done = []
    while max_batches is None or len(done) < max_batches:
        b = next_batch_id(spark, landing, lake)
        if b is None:
            break
        run_batch(spark, landing, lake, b, ref_region)
        done.append(b)
    return done


def retry_failed(spark: SparkSession, landing: str, lake: Lake, ref_region: DataFrame) -> list[str]:
    """Take over every batch that is still in_progress, oldest first (a list of open runs, not of data)."""
    rows = control_table(spark, lake).filter(F.col("status") == B.IN_PROGRESS).select("batch_id").distinct()
    ids = sorted(r["batch_id"] for r in rows.collect())
    for b in ids:
        run_batch(spark, landing, lake, b, ref_region, retry=True)
    return ids
