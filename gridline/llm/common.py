"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

# Fixed values of the contracts: ASCII white space as a character class and as characters, ASCII letters.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


PACKAGE_ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. Functions that run in tasks are imported by name there, so worker processes get
    the folder of this package on their path (where it isn't installed)."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if PACKAGE_ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, PACKAGE_ROOT])
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared scratch folder and read it back.

    Cuts the lineage with files every executor can read, so losing an executor costs
    nothing that was computed before.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(df: DataFrame, name: str = "text") -> Column:
    """The text column with null as empty."""
    return F.coalesce(df[name].cast("string"), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; the fast built-in is taken where a string is pure ASCII."""
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def words_of(text: Column) -> Column:
    """All maximal runs of non-space characters, as an array."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def spread_join(big: DataFrame, small: DataFrame, keys: list[str], weight: str, total: int,
                spread: Column, how: str = "inner", parts: int = 1000) -> DataFrame:
    """Join ``big`` with ``small`` (unique on ``keys``), splitting the hot keys.

    ``small[weight]`` states how many rows of ``big`` hold the key, and ``total`` their sum.
    A key of more than ``total / parts`` rows is hot; as the weights add up to ``total`` there
    are at most ``parts`` of them, so the list of hot keys may be broadcast at any input size.
    Rows of a hot key are dealt over as many salts as it has shares of ``total / parts`` (by the
    hash of ``spread``), and its row of ``small`` is repeated once per salt. ``keys`` must not be null.
    """
    share = max(1, -(-total // parts))
    salts = F.ceil(F.col(weight) / F.lit(share)).cast("int")
    hot = small.filter(F.col(weight) > share).select(*keys, salts.alias("__salts"))
    b = (big.join(F.broadcast(hot), keys, "left")
         .withColumn("__salt", F.when(F.col("__salts").isNull(), F.lit(0))
                     .otherwise(F.pmod(F.xxhash64(spread), F.col("__salts")).cast("int")))
         .drop("__salts"))
    s = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.greatest(salts, F.lit(1)) - 1)))
    return b.join(s, [*keys, "__salt"], how).drop("__salt")
