"""Landing ingestion as a Structured Streaming query (the raw load of §2.16, re-aimed).

New landed files of a dataset are picked up by a file-source stream with the fixed
raw schema; ``trigger(availableNow=True)`` processes everything present and stops,
which makes the scheduled batch job an incremental, restartable stream: the
checkpoint records which files were already loaded, so a rerun or a lost executor
never loads a file twice. Each micro-batch replaces the raw partitions of the batch
ids it contains by all that these batches have landed (dynamic partition overwrite), so
a batch may come in several parts and a replayed micro-batch is idempotent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.writes import overwrite_partitions
from ..sources.files import RAW_FORMATS, RAW_SCHEMAS, batch_path, with_source_file


def landed_stream(spark: SparkSession, landing: str, dataset: str, max_files_per_trigger: int | None = None
                  ) -> DataFrame:
    """Streaming read of one landed dataset, with ``batch_id`` from the folder and load metadata."""
    r = _reader(spark.readStream, dataset)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return _with_metadata(r, landing, dataset)


def _reader(read, dataset: str):
    return read.schema(f"{RAW_SCHEMAS[dataset]}, batch_id STRING").option("mode", "FAILFAST")


def _scan(r, path, dataset: str) -> DataFrame:
    return r.option("header", True).csv(path) if RAW_FORMATS[dataset] == "csv" else r.json(path)


def _with_metadata(r, landing: str, dataset: str, path=None) -> DataFrame:
    base = batch_path(landing, dataset)
    df = with_source_file(_scan(r.option("basePath", base), path or base, dataset))
    return df.withColumn("ingestion_timestamp", F.current_timestamp())


def _replace_batches(spark: SparkSession, landing: str, dataset: str, target: str):
    """Replace the raw partitions of the batches that a micro-batch has files of.

    A batch's files may arrive in several micro-batches, so its partition is made from all files it
    has landed so far, not from the new ones alone; a replayed micro-batch writes the same again.
    Only the folders of these batches are opened: their ids, at most one per file of the micro-batch,
    name the paths to read.
    """
    def write(batch: DataFrame, epoch_id: int) -> None:
        ids = sorted(r["batch_id"] for r in batch.select("batch_id").distinct().collect())
        if not ids:
            return
        paths = [batch_path(landing, dataset, i) for i in ids]
        landed = _with_metadata(_reader(spark.read, dataset), landing, dataset, paths)
        overwrite_partitions(landed.select(*batch.columns), target, ["batch_id"])
    return write


def ingest_available(spark: SparkSession, landing: str, dataset: str, target: str, checkpoint: str,
                     max_files_per_trigger: int | None = None) -> int:
    """Load every not-yet-loaded landed file of ``dataset`` into the raw table at ``target``, then stop.
    Returns how many micro-batches it took."""
    q = (landed_stream(spark, landing, dataset, max_files_per_trigger).writeStream
         .foreachBatch(_replace_batches(spark, landing, dataset, target))
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    return sum(p["numInputRows"] > 0 for p in q.recentProgress)
