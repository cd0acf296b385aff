"""The ledger of batch runs: atomic claims and finished steps (M2, M3, M5).

Rows (batch_id, seq, run_id, step, at) of a versioned table, partitioned by batch. A run owns a batch
from the moment its claim is published, and claims exclude each other: of two runs that see a batch
unclaimed, one publishes its claim and the other one's is refused. A retry claims the batch anew with
the next ``seq``; the run that lost the batch by it finds out before its next step and stops. Each
finished step is a row, so a retry goes on with the first step that isn't there.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .snapshots import CommitConflict, append_table, read_table, table_exists, version

LEDGER_SCHEMA = "batch_id STRING, seq BIGINT, run_id STRING, step STRING"
CLAIM = "claim"


class BatchTaken(Exception):
    """Another run owns the batch."""


@dataclass(frozen=True)
class Run:
    """A claimed batch."""
    batch_id: str
    seq: int
    run_id: str


def ledger_rows(spark: SparkSession, path: str, batch_id: str) -> DataFrame:
    """The ledger of one batch; opens that batch's folder only."""
    if not table_exists(spark, path):
        return spark.createDataFrame([], f"{LEDGER_SCHEMA}, at TIMESTAMP")
    return read_table(spark, path).filter(F.col("batch_id") == batch_id)


def _append(spark: SparkSession, path: str, run: Run, step: str, **kw) -> None:
    row = spark.createDataFrame([(run.batch_id, run.seq, run.run_id, step)], LEDGER_SCHEMA)
    append_table(row.coalesce(1).withColumn("at", F.current_timestamp()), path, ["batch_id"], **kw)


def claim(spark: SparkSession, path: str, batch_id: str, retry: bool = False) -> Run:
    """Own a batch: one that no run has claimed, or with ``retry`` also one that another run has."""
    if not batch_id:
        raise ValueError("batch_id is missing")
    since = version(spark, path)
    last = ledger_rows(spark, path, batch_id).agg(F.max("seq").alias("seq")).first()["seq"]
    if last is not None and not retry:
        raise BatchTaken(f"batch {batch_id} is claimed")
    run = Run(batch_id, (last or 0) + 1, uuid.uuid4().hex)
    try:
        _append(spark, path, run, CLAIM, alone=True, since=since)
    except CommitConflict as e:
        raise BatchTaken(f"batch {batch_id} was claimed by another run") from e
    return run


def finished_steps(spark: SparkSession, path: str, batch_id: str) -> set[str]:
    """The steps of a batch that some run has finished (as many as the job has steps)."""
    rows = ledger_rows(spark, path, batch_id).filter(F.col("step") != CLAIM).select("step").distinct()
    return {r["step"] for r in rows.collect()}


def run_step(spark: SparkSession, path: str, run: Run, step: str, work: Callable[[], object]):
    """Do ``work`` and record it; refused if the batch has been claimed by a later run."""
    newest = ledger_rows(spark, path, run.batch_id).filter(F.col("step") == CLAIM).agg(F.max("seq").alias("seq")).first()["seq"]
    if newest != run.seq:
        raise BatchTaken(f"batch {run.batch_id} was taken over by a later run")
    out = work()
    _append(spark, path, run, step)
    return out
