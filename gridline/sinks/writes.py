"""Writes (K1, K5-K9, K11-K14) to path-based parquet tables and landing files.

Tables are folders of parquet files, optionally Hive-partitioned. Replacing one
batch uses dynamic partition overwrite (only the partitions present in the data are
replaced), which is idempotent on rerun.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def path_exists(spark: SparkSession, path: str) -> bool:
    """Driver-side metadata check through the session's Hadoop file system."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    return bool(fs.exists(p)) and len(fs.listStatus(p)) > 0


def balanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rebalance rows by the output partition columns before a partitioned write.

    Without it every task writes one file per partition value it holds (tasks x values
    small files); with the ``rebalance`` hint AQE groups each value's rows, splits a
    value that is too large over several tasks and merges small ones, so files come out
    near the advisory size and a hot value never lands on a single task.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def replace_partition(df: DataFrame, path: str, batch_id: str, partition_col: str = "batch_id") -> None:
    """K1: stamp ``batch_id`` and replace only that partition of the table at ``path``.

    The per-write option makes this overwrite dynamic whatever the session default is
    (``gridline.session`` also sets the session default); a static overwrite would wipe
    every other batch. Dynamic overwrite leaves a partition alone for which there are no
    rows, so a rerun without rows removes the batch's folder itself.
    """
    if df.isEmpty():
        drop_partition(df.sparkSession, path, partition_col, batch_id)
        return
    overwrite_partitions(df.withColumn(partition_col, F.lit(batch_id)), path, [partition_col])


def drop_partition(spark: SparkSession, path: str, partition_col: str, value: str) -> None:
    """Remove one partition folder of a table (a no-op if there is none)."""
    jvm = spark.sparkContext._jvm
    escaped = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)
    p = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{partition_col}={escaped}")
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace exactly the partitions present in ``df`` (dynamic partition overwrite)."""
    (balanced(df, partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """K5/K11."""
    w = balanced(df, partition_by).write.mode("append")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """K6/K7/K8: full replace with the frame's (explicit) schema, old partitions included."""
    w = balanced(df, partition_by).write.mode("overwrite").option("partitionOverwriteMode", "static")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def create_if_not_exists(spark: SparkSession, path: str, schema: str) -> bool:
    """K9: create an empty table with ``schema`` unless one exists; True when created."""
    if path_exists(spark, path):
        return False
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
    return True


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    r = spark.read
    return (r.schema(schema) if schema else r).parquet(path)


def write_ndjson(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite",
                 compression: str = "none") -> None:
    """One JSON object per line (nulls kept as ``null``)."""
    w = balanced(df, partition_by).write.mode(mode).option("ignoreNullFields", False).option("compression", compression)
    (w.partitionBy(*partition_by) if partition_by else w).json(path)


def write_csv(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Header CSV, UTF-8."""
    w = balanced(df, partition_by).write.mode(mode).option("header", True).option("encoding", "UTF-8")
    (w.partitionBy(*partition_by) if partition_by else w).csv(path)


def write_json_array(df: DataFrame, path: str, partition_col: str, expected: DataFrame | None = None,
                     max_records: int = 1000, mode: str = "overwrite", documents: bool = False,
                     compression: str = "none") -> None:
    """Records as JSON arrays, ``[]`` for an expected partition without records.

    Each array holds about ``max_records`` records: rows are spread over
    ``ceil(n / max_records)`` hash chunks per partition value, so no single array --
    and no single aggregation group -- grows with the data. Arrays are written one per
    line, which the JSON reader splits and turns back into rows (``[]`` → none). With
    ``documents`` each array is a file of its own, an indented JSON document that any JSON
    parser loads whole (read back with ``scan_json_array(multi_line=True)``).
    """
    cols = [c for c in df.columns if c != partition_col]
    counts = df.groupBy(partition_col).agg(F.count(F.lit(1)).alias("__n"))
    chunks = F.greatest(F.lit(1), F.ceil(F.col("__n") / F.lit(max_records)))
    small = counts.withColumnRenamed(partition_col, "__value")
    # Equal rows are told apart by their place, so that they don't all meet in one array.
    chunked = (df.withColumn("__place", F.monotonically_increasing_id())
               .join(small, F.col(partition_col).eqNullSafe(F.col("__value")))
               .withColumn("__chunk", F.pmod(F.xxhash64("__place"), chunks.cast("long"))))
    form = {"ignoreNullFields": "false", "pretty": str(documents).lower()}
    arrays = (chunked.groupBy(partition_col, "__chunk")
              .agg(F.to_json(F.collect_list(F.struct(*cols)), form).alias("value"))
              .select(partition_col, "value"))
    if expected is not None:
        missing = (expected.select(partition_col).distinct()
                   .join(counts.select(partition_col), partition_col, "left_anti")
                   .withColumn("value", F.lit("[]")))
        arrays = arrays.unionByName(missing)
    w = balanced(arrays, [partition_col]).write.mode(mode).option("compression", compression).partitionBy(partition_col)
    (w.option("maxRecordsPerFile", 1) if documents else w).text(path)
