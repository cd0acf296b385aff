"""Landed batches derived from the test tables, in the raw formats of the batch job.

For every batch (season-round) of the stand-in star schema:

* ``results`` / ``sprints``: the RACE / SPRINT session rows as NDJSON / JSON arrays;
* ``races`` / ``circuits`` (CSV), ``constructors`` / ``drivers`` (NDJSON, nested name):
  the race of the batch and the entities that took part in it;
* API pages of the results endpoint (``pages/results``), at most 100 results a page.

Everything is written with one partitioned write per dataset
(``<root>/<dataset>/batch_id=<id>/``); nothing goes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import batch_id as batch_id_col
from ..sinks.writes import balanced, write_csv, write_json_array, write_ndjson
from ..sources.tables import load_tables
from ..operators.ranking import rank_within
from .standin import Gold, build_gold

PAGE_LIMIT = 100


def raw_results(g: Gold, session: str) -> DataFrame:
    """Session rows in the landed (camelCase, text id) results schema, with their batch id."""
    f = g.fact.filter(F.col("session_type") == session)
    r = g.dim_races.select("season", "round", "race_date", "race_name")
    return f.join(r, ["season", "round"], "left").select(
        F.date_format("race_date", "yyyy-MM-dd").alias("date"), F.lower("race_name").alias("raceName"),
        "round", "season", F.concat(F.lit("race/"), F.col("season"), F.lit("/"), F.col("round")).alias("url"),
        F.col("constructor_id").cast("string").alias("constructorId"),
        F.col("driver_id").cast("string").alias("driverId"),
        F.col("grid_position").alias("grid"), F.col("completed_laps").alias("laps"),
        F.col("car_number").alias("number"), F.col("points").cast("float").alias("points"),
        F.col("final_position").alias("position"), F.col("final_position_text").alias("positionText"),
        "status", batch_id_col("season", "round").alias("batch_id"))


def raw_races(g: Gold, nation: DataFrame) -> DataFrame:
    r = g.dim_races.join(nation.select(F.col("n_name").alias("country"), "n_nationkey"), "country")
    return r.select("season", "round", F.concat(F.lit("race/"), F.col("season"), F.lit("/"), F.col("round"))
                    .alias("url"), F.lower("race_name").alias("raceName"),
                    F.date_format("race_date", "yyyy-MM-dd").alias("date"),
                    F.lower("country").alias("circuitId"), batch_id_col("season", "round").alias("batch_id"))


def raw_circuits(g: Gold, nation: DataFrame) -> DataFrame:
    """The circuit of each batch's race."""
    r = g.dim_races.join(nation.select(F.col("n_name").alias("country"), "n_nationkey"), "country")
    return r.select(F.lower("country").alias("circuitId"),
                    F.concat(F.lit("circuit/"), F.lower("country")).alias("url"),
                    F.lower("circuit_name").alias("circuitName"),
                    (F.col("n_nationkey") * 3.5 - 40.0).alias("lat"), (F.col("n_nationkey") * 7.0 - 80.0).alias("long"),
                    F.lower("locality").alias("locality"), "country",
                    batch_id_col("season", "round").alias("batch_id"))


def _participants(g: Gold, col: str) -> DataFrame:
    return g.fact.select(col, batch_id_col("season", "round").alias("batch_id")).distinct()


def raw_constructors(g: Gold) -> DataFrame:
    c = _participants(g, "constructor_id").join(g.dim_constructors, "constructor_id")
    return c.select(F.col("constructor_id").cast("string").alias("constructorId"),
                    F.col("constructor_name").alias("name"), F.lower("nationality").alias("nationality"),
                    F.concat(F.lit("constructor/"), F.col("constructor_id")).alias("url"), "batch_id")


def raw_drivers(g: Gold, customer: DataFrame) -> DataFrame:
    d = _participants(g, "driver_id").join(
        customer.select(F.col("c_custkey").alias("driver_id"), "c_mktsegment", "c_name"), "driver_id"
    ).join(g.dim_drivers.select("driver_id", "date_of_birth", "nationality"), "driver_id")
    return d.select(F.col("driver_id").cast("string").alias("driverId"),
                    F.struct(F.lower("c_mktsegment").alias("givenName"), F.lower("c_name").alias("familyName"))
                    .alias("name"),
                    F.date_format("date_of_birth", "yyyy-MM-dd").alias("dateOfBirth"),
                    F.lower("nationality").alias("nationality"),
                    F.concat(F.lit("driver/"), F.col("driver_id")).alias("url"), "batch_id")


def result_pages(g: Gold, session: str = "RACE", limit: int = PAGE_LIMIT) -> DataFrame:
    """API pages (one JSON document per row, ``value``): each race's results, ``limit`` per page.

    A page groups at most ``limit`` results, so the per-page ``collect_list`` is bounded.
    """
    f = g.fact.filter(F.col("session_type") == session)
    r = g.dim_races.select("season", "round", "race_date", "race_name", "country")
    rows = f.join(r, ["season", "round"], "left").withColumn(
        "page", F.floor((F.col("final_position") - 1) / limit).cast("long"))
    totals = f.groupBy("season", "round").agg(F.count(F.lit(1)).alias("total"))
    s = F.col
    result = F.struct(                      # the leading position orders sort_array
        s("final_position").alias("__order"),
        F.struct(s("constructor_id").cast("string").alias("constructorId")).alias("Constructor"),
        F.struct(s("driver_id").cast("string").alias("driverId")).alias("Driver"),
        s("grid_position").cast("string").alias("grid"), s("completed_laps").cast("string").alias("laps"),
        s("car_number").cast("string").alias("number"), s("points").cast("string").alias("points"),
        s("final_position").cast("string").alias("position"), s("final_position_text").alias("positionText"),
        s("status").alias("status"))
    pages = (rows.groupBy("season", "round", "page", "race_date", "race_name", "country")
             .agg(F.sort_array(F.collect_list(result)).alias("results"))
             .join(totals, ["season", "round"]))
    array_key = "Results" if session == "RACE" else "SprintResults"
    race = F.struct(s("season").cast("string").alias("season"), s("round").cast("string").alias("round"),
                    F.concat(F.lit("race/"), s("season"), F.lit("/"), s("round")).alias("url"),
                    s("race_name").alias("raceName"), F.date_format("race_date", "yyyy-MM-dd").alias("date"),
                    F.struct(F.lower("country").alias("circuitId")).alias("Circuit"),
                    F.transform("results", lambda x: x.dropFields("__order")).alias(array_key))
    doc = F.struct(F.struct(s("total").cast("string").alias("total"), F.lit(str(limit)).alias("limit"),
                            (s("page") * limit).cast("string").alias("offset"),
                            F.struct(F.array(race).alias("Races")).alias("RaceTable")).alias("MRData"))
    return pages.select(F.to_json(doc).alias("value"), batch_id_col("season", "round").alias("batch_id"))


def driver_pages(g: Gold, customer: DataFrame, nation: DataFrame, limit: int = PAGE_LIMIT) -> DataFrame:
    """API pages of the drivers endpoint, ``limit`` drivers a page, ordered by id.

    Some records carry a blank birth date (negative balance) or no nationality key
    (every seventh id), as incomplete API entries do.
    """
    c = customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left")
    numbered = rank_within(c.select("c_custkey", "c_mktsegment", "c_name", "c_acctbal", "n_name"), [],
                           [("c_custkey", "asc")], method="row_number", out="n", unique=True)
    dob = F.date_format(F.date_add(F.lit("1960-01-01").cast("date"), (F.col("c_custkey") % 15000).cast("int")),
                        "yyyy-MM-dd")
    rec = F.struct(
        F.col("c_custkey").cast("string").alias("driverId"), F.col("c_mktsegment").alias("givenName"),
        F.col("c_name").alias("familyName"),
        F.when(F.col("c_acctbal") < 0, F.lit("")).otherwise(dob).alias("dateOfBirth"),
        F.when(F.col("c_custkey") % 7 != 0, F.col("n_name")).alias("nationality"),
        F.concat(F.lit("driver/"), F.col("c_custkey")).alias("url"))
    total = numbered.agg(F.count(F.lit(1))).scalar()
    pages = (numbered.withColumn("page", F.floor((F.col("n") - 1) / limit).cast("long"))
             .groupBy("page").agg(F.sort_array(F.collect_list(F.struct(F.col("n"), rec.alias("r")))).alias("rs")))
    doc = F.struct(F.struct(total.cast("string").alias("total"), F.lit(str(limit)).alias("limit"),
                            (F.col("page") * limit).cast("string").alias("offset"),
                            F.struct(F.transform("rs", lambda x: x["r"]).alias("Drivers")).alias("DriverTable"))
                   .alias("MRData"))
    return pages.select(F.to_json(doc).alias("value"))


DATASETS = ("results", "sprints", "races", "circuits", "constructors", "drivers", "pages/results", "pages/drivers")


def land(spark: SparkSession, sf_dir: str, root: str, name: str, g: Gold) -> None:
    """Write one dataset of every batch under ``root``, as gzip files.

    Landed text is several times as large as what was shuffled for it, and packs well. A packed file
    is read by one task; the rebalanced write bounds what goes into a file, so a large batch has several.
    """
    nation, customer = load_tables(spark, sf_dir, ["nation", "customer"]).values()
    path, part = f"{root}/{name}", ["batch_id"]
    if name == "results":
        write_ndjson(raw_results(g, "RACE"), path, part, compression="gzip")
    elif name == "sprints":
        write_json_array(raw_results(g, "SPRINT"), path, "batch_id", compression="gzip",
                         expected=g.dim_races.select(batch_id_col("season", "round").alias("batch_id")))
    elif name == "races":
        write_csv(raw_races(g, nation), path, part)
    elif name == "circuits":
        write_csv(raw_circuits(g, nation), path, part)
    elif name == "constructors":
        write_ndjson(raw_constructors(g), path, part, compression="gzip")
    elif name == "drivers":
        write_ndjson(raw_drivers(g, customer), path, part, compression="gzip")
    elif name == "pages/results":
        write_pages(result_pages(g), path)
    elif name == "pages/drivers":
        driver_pages(g, customer, nation).write.mode("overwrite").option("compression", "gzip").text(path)
    else:
        raise ValueError(f"unknown dataset {name!r}")


def write_pages(pages: DataFrame, path: str) -> None:
    """API pages by batch, a document per line."""
    (balanced(pages, ["batch_id"]).write.mode("overwrite").option("compression", "gzip")
     .partitionBy("batch_id").text(path))


def land_all(spark: SparkSession, sf_dir: str, root: str, g: Gold | None = None) -> Gold:
    """Write every dataset of every batch under ``root``; returns the stand-in gold used."""
    g = g or build_gold(spark, sf_dir)
    for name in DATASETS:
        land(spark, sf_dir, root, name, g)
    return g
