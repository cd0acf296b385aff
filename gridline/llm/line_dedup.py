"""Line dedup over levelled sorted runs of line hashes.

A run is a table of (h1, h2, n_docs, owner): the 128-bit hash of a line key, in how many documents
of its batches the key was found, and the largest doc_id among them. Runs are bucketed by hash and
sorted within each bucket, so joining a batch with a run, or merging runs, needs no shuffle of either.
Batches come in descending order of doc_id. Each one merge-anti-joins the runs' settled keys (those
already found in ``min_docs`` documents, whose owner no later batch can change) and adds what is left
as a run of level 0; when a level has ``fanout`` runs they are merged into one of the next level.
Boilerplate is thus counted until it is settled and never written again.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_root, scratch_path, shuffle_partitions
from .common import SPACES, ascii_lower, spread_join, stored, text_of

HASH = ["h1", "h2"]


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def _hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("line"), key).alias("h2")]


class RunStore:
    """The levelled runs of one session, kept under the shared folder."""

    def __init__(self, spark: SparkSession, min_docs: int, fanout: int = 2, buckets: int | None = None):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.buckets = buckets or shuffle_partitions(spark)
        self.levels: list[list[str]] = []

    def _save(self, df: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        (df.write.bucketBy(self.buckets, *HASH).sortBy(*HASH)
         .option("path", scratch_path(self.spark, name)).saveAsTable(name))
        return name

    def _merged(self, names: list[str]) -> DataFrame:
        """Merge sorted runs, two by two, as full outer merge joins of equally bucketed tables."""
        def merge(a: DataFrame, b: DataFrame) -> DataFrame:
            b = b.select(*HASH, F.col("n_docs").alias("n_more"), F.col("owner").alias("owner_too"))
            zero = F.lit(0)
            return a.join(b, HASH, "full").select(
                *HASH, (F.coalesce("n_docs", zero) + F.coalesce("n_more", zero)).alias("n_docs"),
                F.greatest("owner", "owner_too").alias("owner"))
        return reduce(merge, [self.spark.table(n) for n in names])

    def add(self, keys: DataFrame) -> None:
        """Add a batch of (h1, h2, n_docs, owner); its doc_ids must be below those of earlier batches."""
        for name in [n for level in self.levels for n in level]:
            settled = self.spark.table(name).filter(F.col("n_docs") >= self.min_docs).select(*HASH)
            keys = keys.join(settled, HASH, "left_anti")
        self._push(0, self._save(keys))

    def _push(self, level: int, name: str) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) == self.fanout:
            names, self.levels[level] = self.levels[level], []
            merged = self._save(self._merged(names))
            self._forget(names)
            self._push(level + 1, merged)

    def _forget(self, names: list[str]) -> None:
        for n in names:
            self.spark.sql(f"DROP TABLE {n}")

    def close(self) -> DataFrame:
        """The keys found in ``min_docs`` documents or more, with their owner; ends the store."""
        names = [n for level in self.levels for n in level]
        out = stored(self._merged(names).filter(F.col("n_docs") >= self.min_docs), "repeated-lines")
        self._forget(names)
        return out


def _batches(ids: DataFrame, batches: int) -> list[float]:
    """doc_ids that cut the documents into about equal batches; inexact cuts change sizes, not results."""
    shares = [i / batches for i in range(1, batches)]
    return sorted(set(ids.approxQuantile("doc_id", shares, 0.01)), reverse=True) if shares else []


def repeated_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, batches: int = 4,
                   fanout: int = 2) -> DataFrame:
    """Line keys of at least ``min_chars`` code points found in at least ``min_docs`` documents:
    (h1, h2, n_docs, owner). The runs stop counting a key once it is settled, so ``n_docs``, by which hot
    keys are split, comes from the batches' counts (a row per key and batch)."""
    spark = docs.sparkSession
    checkpoint_root(spark)
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of(docs).alias("text"))
    cuts = _batches(ids.select("doc_id").dropna(), batches)
    batch = sum((F.coalesce(F.col("doc_id") < F.lit(int(c)), F.lit(True)).cast("int") for c in cuts), F.lit(0))
    keys = F.array_distinct(F.filter(F.transform(F.split("text", "\n", -1), line_key),
                                     lambda k: F.length(k) >= min_chars))
    held = ids.select("doc_id", batch.alias("batch"), F.explode(keys).alias("key"))
    staged = scratch_path(spark, "line-keys")
    store = RunStore(spark, min_docs, fanout)
    (held.select("doc_id", "batch", *_hashes(F.col("key")))
     .groupBy("batch", *HASH).agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("owner"))
     .write.partitionBy("batch").parquet(staged))
    schema = "h1 bigint, h2 bigint, n_docs bigint, owner bigint, batch int"
    for b in range(len(cuts) + 1):
        one = spark.read.schema(schema).parquet(staged).filter(F.col("batch") == b).drop("batch")
        store.add(one.repartition(store.buckets, *HASH))
    settled = store.close().drop("n_docs")
    counts = (spark.read.schema(schema).parquet(staged).join(settled.select(*HASH), HASH, "left_semi")
              .groupBy(*HASH).agg(F.sum("n_docs").alias("n_docs")))
    return settled.join(counts, HASH).select(*HASH, "n_docs", "owner")


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, batches: int = 4,
                fanout: int = 2) -> DataFrame:
    """``docs`` with its repeated lines dropped from ``text``, plus n_lines and n_dropped.

    A line is dropped if its key has at least ``min_chars`` code points and is found in at least
    ``min_docs`` documents, unless the document has the largest doc_id of those. Every row counts as
    a document: repeated rows count each, and rows that share the largest doc_id all keep the line.
    Rows without doc_id count, and rank below every id; if no holder has an id all keep the line.
    Null or empty text is one empty line (text of the result: ''); an empty table gives no rows.
    Other columns pass through; input columns named n_lines or n_dropped are replaced.
    """
    d = docs.drop("n_lines", "n_dropped").withColumn("text", text_of(docs))
    repeated = stored(repeated_lines(docs, min_chars, min_docs, batches, fanout), "repeated")
    rows = d.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("fp"), "text")
    lines = rows.select("doc_id", "fp", F.posexplode(F.transform(F.split("text", "\n", -1), line_key))
                        .alias("pos", "key"))
    lines = lines.filter(F.length("key") >= min_chars).select("doc_id", "fp", "pos", *_hashes(F.col("key")))
    total = repeated.agg(F.sum("n_docs")).first()[0] or 0
    drop = (spread_join(lines, repeated, HASH, "n_docs", total, F.struct("doc_id", "fp"))
            .filter(~F.col("doc_id").eqNullSafe(F.col("owner")))
            .groupBy(F.col("doc_id").alias("__id"), F.col("fp").alias("__fp"))
            .agg(F.collect_set("pos").alias("__drop")))
    joined = d.withColumn("__own", F.xxhash64("text")).join(
        drop, d["doc_id"].cast("bigint").eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__fp")), "left")
    n_lines, n_dropped = F.size("__lines"), F.coalesce(F.size("__drop"), F.lit(0))
    # array_except keeps the order of its first argument and looks positions up by hash.
    kept = F.array_except(F.sequence(F.lit(0), n_lines - 1), F.col("__drop"))
    some = F.array_join(F.transform(kept, lambda p: F.get(F.col("__lines"), p)), "\n")
    return (joined.withColumn("__lines", F.split("text", "\n", -1))
            .withColumn("n_lines", n_lines.cast("bigint"))
            .withColumn("n_dropped", F.when(F.col("__drop").isNull(), F.lit(0)).otherwise(n_dropped).cast("bigint"))
            .withColumn("text", F.when(F.col("__drop").isNull(), F.col("text")).otherwise(some))
            .drop("__id", "__fp", "__own", "__drop", "__lines"))
