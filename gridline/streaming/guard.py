"""A stream that drops stale rows itself (K3 as keyed state).

The guarded upsert compares each batch with the stored table. A stream can carry the newest batch id of
each key as state instead: rows of an older batch than the key has seen, whenever their file arrives,
never leave the operator, after a restart too, since state is restored from the checkpoint. What passes
is written as new versions of the table.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_root
from ..sinks.snapshots import upsert_table
from .ingest import landed_stream


def _descending(text: Column) -> Column:
    """A text that orders as ``text`` does backwards: inverted hexadecimal digits, then one above them all."""
    return F.concat(F.translate(F.hex(text), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G"))


def drop_stale(stream: DataFrame, keys: Sequence[str], batch: str = "batch_id") -> DataFrame:
    """Of each key, the newest row of a micro-batch if no newer batch of the key was seen before.

    Rows with a null in their key are dropped: an upsert would match them with nothing and add them each
    time. Rows of one key and batch in one micro-batch are ordered by their other columns' texts and the
    first stays; of later micro-batches the last one's row counts.

    A streaming aggregate keeps each key's leading row as state, with the time of the micro-batch that
    brought it (a replay has the same time, the clock must not go back between runs): a key whose leading
    row is from an earlier micro-batch had stale rows only and is left out.
    """
    columns = stream.columns
    rest = [c for c in columns if c not in keys]
    rows = stream.dropna(subset=[*keys, batch]).withColumn("__at", F.current_timestamp())
    order = F.struct(_descending(F.col(batch)), -F.unix_micros("__at"),
                     *[F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in rest if c != batch])
    first = rows.groupBy(*keys).agg(F.min_by(F.struct("__at", *rest), order).alias("__row"))
    return first.filter(F.col("__row.__at") == F.current_timestamp()).select(
        *[F.col(c) if c in keys else F.col("__row")[c].alias(c) for c in columns])


# Every key ever seen is state: kept in RocksDB on the executors' local disks, not as a map in their heaps, and
# in one cache of a fixed size for all partitions of an executor. An older checkpoint goes on with the store it names.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",   # a read for each write
}


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in ``STATE_STORE``: each takes the session's settings as it starts."""
    before = {k: spark.conf.get(k, None) for k in STATE_STORE}
    for k, v in STATE_STORE.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def upsert_stream(spark: SparkSession, landing: str, dataset: str, target: str, checkpoint: str, keys: Sequence[str],
                  partition_by: Sequence[str], max_files_per_trigger: int | None = None) -> int:
    """Upsert what has landed since the last run into the versioned table at ``target``, newest batch per key.

    A replayed micro-batch finds its rows stored already and writes the same again. Returns the number
    of micro-batches.
    """
    checkpoint_root(spark)
    fresh = drop_stale(landed_stream(spark, landing, dataset, max_files_per_trigger).drop("source_file", "ingestion_timestamp"), keys)

    def write(rows: DataFrame, epoch_id: int) -> None:
        # The newest of a key and batch: a replay may bring a row again that a later version has passed.
        cols = [c for c in rows.columns if c not in keys and c not in partition_by]
        rows = rows.checkpoint()      # read several times below: each would pass the keys' state again
        if not rows.isEmpty():
            upsert_table(rows, target, keys, cols, partition_by, guard=lambda t, s: s("batch_id") >= t("batch_id"))

    with state_store(spark):
        q = (fresh.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    q.awaitTermination()
    return sum(p["numInputRows"] > 0 for p in q.recentProgress)
