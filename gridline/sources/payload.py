"""Paged API payloads → flat records (S12-S16), read and flattened by Spark.

A page is one JSON document per line: ``{"MRData": {"total", "limit", "offset",
"<Table>": {"<Records>": [...]}}}``. All pages of an endpoint are read in one
distributed scan and their records exploded; the HTTP client that would fetch
them is not part of this library.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from types import MappingProxyType

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import blank_to_null

_RESULT = ("STRUCT<Constructor: STRUCT<constructorId: STRING>, Driver: STRUCT<driverId: STRING>, grid: STRING, "
           "laps: STRING, number: STRING, points: STRING, position: STRING, positionText: STRING, status: STRING>")
RACE_RECORD = (f"STRUCT<season: STRING, round: STRING, url: STRING, raceName: STRING, date: STRING, "
               f"Circuit: STRUCT<circuitId: STRING>, Results: ARRAY<{_RESULT}>, SprintResults: ARRAY<{_RESULT}>>")
DRIVER_RECORD = ("STRUCT<driverId: STRING, givenName: STRING, familyName: STRING, dateOfBirth: STRING, "
                 "nationality: STRING, url: STRING>")
CIRCUIT_RECORD = ("STRUCT<circuitId: STRING, url: STRING, circuitName: STRING, "
                  "Location: STRUCT<lat: STRING, long: STRING, locality: STRING, country: STRING>>")
CONSTRUCTOR_RECORD = "STRUCT<constructorId: STRING, url: STRING, name: STRING, nationality: STRING>"


def page_schema(data_key: str, record_key: str, record: str) -> str:
    return (f"MRData STRUCT<total: STRING, limit: STRING, offset: STRING, "
            f"{data_key}: STRUCT<{record_key}: ARRAY<{record}>>>")


def read_pages(spark: SparkSession, path: str, data_key: str, record_key: str, record: str) -> DataFrame:
    return spark.read.schema(page_schema(data_key, record_key, record)).option("mode", "FAILFAST").json(path)


def combine_pages(pages: DataFrame, data_key: str, record_key: str) -> DataFrame:
    """Records of all pages, each with the page's ``total``, ``limit`` and ``offset``.

    Page count is ``ceil(total / limit)``; ``page_check`` compares records per
    ``total`` with the declared total (the one thing a paged fetch can get wrong).
    """
    return pages.select(F.col("MRData.total").cast("long").alias("total"),
                        F.col("MRData.limit").cast("long").alias("limit"),
                        F.col("MRData.offset").cast("long").alias("offset"),
                        F.posexplode(F.col(f"MRData.{data_key}.{record_key}")).alias("pos", "record"))


def page_check(records: DataFrame, by: Sequence[str] = (), count: Column | None = None) -> DataFrame:
    """Per entity (``by``): declared total, pages seen/expected, records seen, ``complete`` flag.

    ``count`` is the number of records a page element stands for (default 1; for a
    race element of the results endpoint: the size of its results array).
    """
    n = count if count is not None else F.lit(1)
    return (records.groupBy(*by, "total", "limit")
            .agg(F.count_distinct("offset").alias("pages_seen"), F.sum(n).cast("long").alias("records_seen"))
            .withColumn("pages_expected", F.ceil(F.col("total") / F.col("limit")).cast("long"))
            .withColumn("complete", (F.col("records_seen") == F.col("total"))
                        & (F.col("pages_seen") == F.col("pages_expected")))
            .drop("limit"))


class PagesMissing(Exception):
    """Landed pages don't make up what their headers declare."""


def read_complete_pages(spark: SparkSession, path: str, data_key: str, record_key: str, record: str,
                        by: Mapping[str, str] = MappingProxyType({}), records: str | None = None) -> DataFrame:
    """The records of all pages, refused unless every endpoint's pages are all there.

    ``by`` names the record fields that tell endpoints apart (season and round of a results endpoint), ``records``
    the array in a record that ``total`` counts. An endpoint's offsets must be 0, limit, 2 limit, ... below
    its total, each once; which are missing or landed twice is said in the error, for the first few endpoints.
    """
    found = combine_pages(read_pages(spark, path, data_key, record_key, record), data_key, record_key)
    named = found.withColumns({k: F.col(f"record.{v}") for k, v in by.items()})
    count = F.size(f"record.{records}") if records else F.lit(1)
    pages = named.groupBy(*by, "total", "limit", "offset").agg(F.sum(count).alias("n"), F.count_if(F.col("pos") == 0).alias("times"))
    whole = pages.groupBy(*by, "total", "limit").agg(
        F.collect_set("offset").alias("offsets"), F.sum("n").alias("n"), F.max("times").alias("times"))
    # A list entry per page of an endpoint, as many as its fetch had requests.
    missing = F.array_except(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("total") - 1, F.lit(0)), F.col("limit")), "offsets")
    bad = whole.withColumn("missing", missing).filter((F.size("missing") > 0) | (F.col("n") != F.col("total")) | (F.col("times") > 1))
    wrong = bad.limit(5).collect()
    if wrong:
        raise PagesMissing("; ".join(f"{[r[k] for k in by]}: {r['n']} of {r['total']} records, offsets missing {r['missing'][:10]}"
                                     + (", some landed twice" if r["times"] > 1 else "") for r in wrong))
    return found


def _result_rows(races: DataFrame, array_field: str, first_race_only: bool) -> DataFrame:
    if first_race_only:                    # races[0] of the combined pages: the first record of the first page
        races = races.filter((F.col("offset") == 0) & (F.col("pos") == 0))
    r = races.select("race.*").select(
        F.col("date"), F.lower("raceName").alias("raceName"), F.col("round").cast("int").alias("round"),
        F.col("season").cast("int").alias("season"), F.col("url"), F.explode(array_field).alias("x"))
    return r.select(
        F.col("date"), "raceName", "round", "season", "url",
        F.col("x.Constructor.constructorId").alias("constructorId"), F.col("x.Driver.driverId").alias("driverId"),
        F.col("x.grid").cast("int").alias("grid"), F.col("x.laps").cast("int").alias("laps"),
        F.col("x.number").cast("int").alias("number"), F.col("x.points").cast("double").alias("points"),
        F.col("x.position").cast("int").alias("position"), F.col("x.positionText").alias("positionText"),
        F.col("x.status").alias("status"))


def races_of(records: DataFrame) -> DataFrame:
    """Race records with their page's offset and position in it (0 and 0 for the first of an endpoint)."""
    return records.select("offset", "pos", F.col("record").alias("race"))


def flatten_results(races: DataFrame, first_race_only: bool = False) -> DataFrame:
    """One row per result, race header repeated, text cast strictly (ANSI), race name lower-cased.

    No race at all is an error (the round has not been run yet).
    """
    if races.isEmpty():
        raise ValueError("No results found. Verify the round has been completed and the batch_id is correct.")
    return _result_rows(races, "Results", first_race_only)


def flatten_sprints(races: DataFrame, first_race_only: bool = False) -> DataFrame:
    """As ``flatten_results`` over ``SprintResults``; no sprint gives no rows, not an error."""
    return _result_rows(races, "SprintResults", first_race_only)


def flatten_drivers(records: DataFrame) -> DataFrame:
    """Names lower-cased into a struct; blank/missing birth date → null; missing text → ''."""
    d = records.select("record.*")
    return d.select(
        "driverId",
        F.struct(F.lower("givenName").alias("givenName"), F.lower("familyName").alias("familyName")).alias("name"),
        blank_to_null("dateOfBirth").alias("dateOfBirth"),
        F.lower(F.coalesce("nationality", F.lit(""))).alias("nationality"),
        F.coalesce("url", F.lit("")).alias("url"))


def flatten_circuits(records: DataFrame) -> DataFrame:
    """Lift ``Location.*``; lower-case name and locality."""
    c = records.select("record.*")
    return c.select("circuitId", "url", F.lower("circuitName").alias("circuitName"),
                    F.col("Location.lat").alias("lat"), F.col("Location.long").alias("long"),
                    F.lower("Location.locality").alias("locality"), F.col("Location.country").alias("country"))


def flatten_races(races: DataFrame) -> DataFrame:
    """Race schedule rows; circuit id lifted, name lower-cased."""
    r = races.select("race.*")
    return r.select("season", "round", "url", F.lower("raceName").alias("raceName"), "date",
                    F.col("Circuit.circuitId").alias("circuitId"))


def flatten_constructors(records: DataFrame) -> DataFrame:
    """Nationality lower-cased, missing url → ''."""
    c = records.select("record.*")
    return c.select("constructorId", "name", F.lower("nationality").alias("nationality"),
                    F.coalesce("url", F.lit("")).alias("url"))
