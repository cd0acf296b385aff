"""Landed-file scans (S1-S5, S9-S11) with fixed schemas and FAILFAST parsing.

Landing layout is dataset-major and Hive-partitioned: ``<root>/<dataset>/batch_id=<id>/``.
Reading ``<root>/<dataset>`` then yields ``batch_id`` as a partition column, so a
filter on one batch prunes every other folder before any file is opened.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Raw schemas of the six landed datasets (explicit, never inferred).
RAW_SCHEMAS: dict[str, str] = {
    "circuits": "circuitId STRING, url STRING, circuitName STRING, lat DOUBLE, long DOUBLE, locality STRING, "
                "country STRING",
    "races": "season INT, round INT, url STRING, raceName STRING, date DATE, circuitId STRING",
    "constructors": "constructorId STRING, name STRING, nationality STRING, url STRING",
    "drivers": "driverId STRING, name STRUCT<givenName: STRING, familyName: STRING>, dateOfBirth DATE, "
               "nationality STRING, url STRING",
    "results": "date DATE, raceName STRING, round INT, season INT, url STRING, constructorId STRING, "
               "driverId STRING, grid INT, laps INT, number INT, points FLOAT, position INT, "
               "positionText STRING, status STRING",
}
RAW_SCHEMAS["sprints"] = RAW_SCHEMAS["results"]
RAW_FORMATS = {"circuits": "csv", "races": "csv", "constructors": "ndjson", "drivers": "ndjson",
               "results": "ndjson", "sprints": "json_array"}


def batch_path(root: str, dataset: str, batch_id: str | None = None) -> str:
    """Folder of one dataset (optionally one batch) under the landing root."""
    base = f"{root.rstrip('/')}/{dataset}"
    return base if batch_id is None else f"{base}/batch_id={batch_id}"


def _reader(spark: SparkSession, schema: str | StructType, base_path: str | None):
    r = spark.read.schema(schema).option("mode", "FAILFAST")
    return r.option("basePath", base_path) if base_path else r


def scan_csv(spark: SparkSession, path: str, schema: str | StructType, base_path: str | None = None) -> DataFrame:
    """Header CSV with an explicit schema; a malformed row aborts the read."""
    return _reader(spark, schema, base_path).option("header", True).csv(path)


def scan_ndjson(spark: SparkSession, path: str, schema: str | StructType, base_path: str | None = None) -> DataFrame:
    """Line-delimited JSON (flat or nested schema; a file or a directory), splittable."""
    return _reader(spark, schema, base_path).json(path)


def scan_json_array(spark: SparkSession, path: str, schema: str | StructType, multi_line: bool = False,
                    base_path: str | None = None) -> DataFrame:
    """JSON arrays of records; ``[]`` gives zero rows.

    Arrays written one per line (our sink) stay splittable; ``multi_line=True`` reads
    pretty-printed single-document files, one task per file.
    """
    return _reader(spark, schema, base_path).option("multiLine", multi_line).json(path)


def scan_landed(spark: SparkSession, root: str, dataset: str, batch_id: str | None = None) -> DataFrame:
    """Any of the six landed datasets by name, with ``batch_id`` from the folder."""
    base = batch_path(root, dataset)
    path = batch_path(root, dataset, batch_id)
    schema, fmt = RAW_SCHEMAS[dataset], RAW_FORMATS[dataset]
    if fmt == "csv":
        df = scan_csv(spark, path, schema, base)
    elif fmt == "ndjson":
        df = scan_ndjson(spark, path, schema, base)
    else:
        df = scan_json_array(spark, path, schema, base_path=base)
    if batch_id is not None and "batch_id" not in df.columns:
        df = df.withColumn("batch_id", F.lit(batch_id))
    return df


def with_source_file(df: DataFrame, col: str = "source_file") -> DataFrame:
    """The file each row came from (hidden ``_metadata`` column; batch and stream)."""
    return df.withColumn(col, F.col("_metadata.file_path"))


def add_ingestion_metadata(df: DataFrame) -> DataFrame:
    """Raw-table audit columns: load time and source file."""
    return with_source_file(df.withColumn("ingestion_timestamp", F.current_timestamp()))


def list_landing_batches(spark: SparkSession, root: str) -> DataFrame:
    """Distinct batch ids that have at least one landed file (sorted).

    A distributed file listing (binaryFile source, only the ``path`` column, so no
    content is read); an empty folder holds no file and is therefore not seen.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path"))
    ids = files.select(F.regexp_extract("path", r"batch_id=([^/]+)/", 1).alias("batch_id"))
    return ids.filter(F.col("batch_id") != "").distinct().orderBy("batch_id")
