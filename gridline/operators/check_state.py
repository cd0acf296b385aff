"""Data-quality checks whose state is kept and merged (Q1-Q6, Q13): a batch's suite doesn't scan the table.

State of a table's suite, in versioned tables partitioned by batch:

* ``counts``: per batch the rows, and the failures of each row-level check. A batch that runs again replaces its own;
* ``keys``: per batch and ``unique`` check its distinct key hashes and how many rows hold each, 128 bits a key, as a run
  sorted by hash. Duplicates of the whole table are its rows less its distinct keys;
* ``parents``: per batch and ``referential`` check the values without a parent at the time, with their rows.
  Parents that come later clear them when the results are read, so only values that failed are looked at
  again (parents that go are not noticed; the reference data only grows).

The distinct keys of all batches are counted by an aggregation over the runs, 16 bytes a key, not over the
table. ``min_rows``, ranges and null counts are sums over the batches.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.snapshots import read_table, replace_partitions, table_exists
from .joins import orphans

ROW_CHECKS = ("not_null", "value_range", "not_negative")


def failed(chk: Mapping[str, Any]) -> Column:
    """Whether a row fails a row-level check."""
    c = F.col(chk["column"])
    if chk["type"] == "not_null":
        return c.isNull()
    if chk["type"] == "not_negative":
        return c.isNotNull() & (c < 0)
    out = F.lit(False)
    for bound, beyond in (("min", lambda v: c < v), ("max", lambda v: c > v)):
        if chk.get(bound) is not None:
            out = out | beyond(F.lit(chk[bound]))
    return c.isNotNull() & out


def _columns(chk: Mapping[str, Any]) -> list[str]:
    return list(chk.get("columns") or [chk["column"]])


class CheckState:
    """The kept state of one table's checks, below ``root``."""

    def __init__(self, spark: SparkSession, root: str, checks: Sequence[Mapping[str, Any]],
                 parent: Callable[[str], DataFrame] | None = None):
        self.spark, self.root, self.parent = spark, root, parent
        self.checks = list(checks)

    def _of(self, *types: str) -> list[Mapping[str, Any]]:
        return [c for c in self.checks if c["type"] in types]

    def add_batch(self, rows: DataFrame, batch_id: str) -> None:
        """Take in a batch (again): only its own rows are read, only its own state is replaced."""
        batch = F.lit(batch_id).alias("batch_id")
        gone = self.spark.createDataFrame([(batch_id,)], "batch_id string")
        fails = [F.count_if(failed(c)).alias(c["name"]) for c in self._of(*ROW_CHECKS)]
        counts = rows.agg(F.count(F.lit(1)).alias("rows"), *fails).select(batch, "*")
        replace_partitions(counts, f"{self.root}/counts", ["batch_id"], gone)
        for chk in self._of("unique"):
            key = F.struct(*[F.col(c) for c in _columns(chk)])
            runs = (rows.select(F.xxhash64(key).alias("h1"), F.xxhash64(key, F.lit(1)).alias("h2"))
                    .groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).select(batch, "*").sortWithinPartitions("h1", "h2"))
            replace_partitions(runs, f"{self.root}/keys/{chk['name']}", ["batch_id"], gone)
        for chk in self._of("referential"):
            parents = self.parent(chk["ref_table"])
            lost = orphans(rows.select(F.col(chk["column"]).alias("value")), "value", parents, chk["ref_column"])
            lost = lost.groupBy("value").agg(F.count(F.lit(1)).alias("n")).select(batch, "*")
            replace_partitions(lost, f"{self.root}/parents/{chk['name']}", ["batch_id"], gone)

    def results(self) -> DataFrame:
        """(check_name, check_type, severity, passed, fail_count, total_rows) of the whole table, a row per check."""
        counts = read_table(self.spark, f"{self.root}/counts")
        row_level = self._of(*ROW_CHECKS)
        sums = counts.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
                          *[F.coalesce(F.sum(c["name"]), F.lit(0)).alias(c["name"]) for c in row_level])
        total = counts.agg(F.coalesce(F.sum("rows"), F.lit(0))).scalar()
        parts = []
        for chk in self.checks:
            kind, name = chk["type"], chk["name"]
            if kind in ROW_CHECKS:
                fails = sums.select(F.col(name).alias("fail_count"))
            elif kind == "min_rows":
                fails = sums.select(F.greatest(F.lit(int(chk["threshold"])) - F.col("rows"), F.lit(0)).alias("fail_count"))
            elif kind == "unique":
                runs = read_table(self.spark, f"{self.root}/keys/{name}").groupBy("h1", "h2").agg(F.sum("n").alias("n"))
                fails = runs.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("fail_count"))
            elif kind == "referential":
                path = f"{self.root}/parents/{name}"
                left = orphans(read_table(self.spark, path), "value", self.parent(chk["ref_table"]), chk["ref_column"])
                fails = left.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("fail_count"))
            else:
                fails = sums.select(F.lit(0).alias("fail_count"))
            parts.append(fails.select(F.lit(name).alias("check_name"), F.lit(kind).alias("check_type"),
                                      F.lit(chk.get("severity", "critical")).alias("severity"),
                                      F.col("fail_count").cast("long").alias("fail_count")))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out.select("check_name", "check_type", "severity", (F.col("fail_count") == 0).alias("passed"), "fail_count",
                          total.cast("long").alias("total_rows"))

    def batches(self) -> list[str]:
        """The batches taken in."""
        path = f"{self.root}/counts"
        rows = read_table(self.spark, path).select("batch_id").collect() if table_exists(self.spark, path) else []
        return sorted(r["batch_id"] for r in rows)
