"""Registered queries for sources, sinks, cleaning, quality, batch control and the batch job.

They land the test tables as raw batch files (``landing.land``, each dataset once per session
and scale directory, under the session's shared checkpoint folder), then exercise the
readers, writers and jobs on them. Oracles are DuckDB SQL over the same parquet tables
(the ``GOLD`` CTEs of ``oracle_sql``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import batch as B
from ..operators.check_state import CheckState
from ..operators.clean import CLEAN_SPECS, clean
from ..operators.quality import results_frame, run_checks
from ..operators.ranking import rank_within
from ..session import ensure_conf, scratch_path
from ..sinks.snapshots import append_table, read_table, update_table, upsert_table, write_unpublished
from ..sinks.upsert import newer_batch_guard, upsert, upsert_unguarded
from ..sinks.writes import overwrite, path_exists, replace_partition, write_json_array, write_ndjson
from ..sources import payload as P
from ..sources.files import add_ingestion_metadata, list_landing_batches, scan_json_array, scan_landed
from ..sources.tables import load_table
from ..streaming.guard import upsert_stream
from ..streaming.ingest import ingest_available
from . import medallion as PL
from .landing import DATASETS as LANDED, land, result_pages, write_pages
from .oracle_sql import GOLD, tc
from .standin import materialize_gold, nationality_region

Query = Callable[[SparkSession, str], DataFrame]
IO_QUERIES: dict[str, tuple[Query, str | None]] = {}
_LANDED: dict[tuple[str, str], str] = {}


def q(name: str, sql: str | None):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_conf(spark)
            return fn(spark, sf_dir.rstrip("/"))
        IO_QUERIES[name] = (run, sql)
        return fn
    return deco


def landed(spark: SparkSession, sf_dir: str, *datasets: str) -> str:
    """Landing root for ``sf_dir`` in this application with at least these datasets, all by default.

    A dataset is written once, from the stored star schema, and then reused.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    root = _LANDED.setdefault(key, scratch_path(spark, "landing"))
    for name in datasets or LANDED:
        done = f"{root}-done/{name}"
        if not path_exists(spark, done):
            land(spark, sf_dir, root, name, materialize_gold(spark, sf_dir))
            spark.createDataFrame([("ok",)], "v STRING").coalesce(1).write.mode("overwrite").text(done)
    return root


def _with(body: str) -> str:
    return f"WITH {GOLD}\n{body}"


_BATCH = "CAST(season AS VARCHAR) || '-' || lpad(CAST(round AS VARCHAR), 2, '0')"
def raw_results_sql(session: str) -> str:
    """The landed results rows of one session type, as the landing writer produces them."""
    return f"""
SELECT r.race_date AS date, lower(r.race_name) AS raceName, f.round, f.season,
       'race/' || f.season || '/' || f.round AS url, CAST(f.constructor_id AS VARCHAR) AS constructorId,
       CAST(f.driver_id AS VARCHAR) AS driverId, f.grid_position AS grid, f.completed_laps AS laps,
       f.car_number AS number, CAST(f.points AS FLOAT) AS points, f.final_position AS position,
       f.final_position_text AS positionText, f.status,
       CAST(f.season AS VARCHAR) || '-' || lpad(CAST(f.round AS VARCHAR), 2, '0') AS batch_id
FROM fact f LEFT JOIN dim_races r ON r.season = f.season AND r.round = f.round
WHERE f.session_type = '{session}'"""


# --- sources ---------------------------------------------------------------------------------
@q("scan_csv", _with(f"""
SELECT season, round, 'race/' || season || '/' || round AS url, lower(race_name) AS raceName, race_date AS date,
       lower(country) AS circuitId, {_BATCH} AS batch_id FROM dim_races"""))
def _scan_csv(spark, sf):
    return scan_landed(spark, landed(spark, sf, "races"), "races")


@q("scan_ndjson", _with(f"""
SELECT DISTINCT CAST(f.constructor_id AS VARCHAR) AS constructorId, c.constructor_name AS name,
       lower(c.nationality) AS nationality, 'constructor/' || f.constructor_id AS url,
       CAST(f.season AS VARCHAR) || '-' || lpad(CAST(f.round AS VARCHAR), 2, '0') AS batch_id
FROM fact f JOIN dim_constructors c ON c.constructor_id = f.constructor_id"""))
def _scan_ndjson(spark, sf):
    return scan_landed(spark, landed(spark, sf, "constructors"), "constructors")


@q("scan_nested_json", _with("""
SELECT DISTINCT CAST(f.driver_id AS VARCHAR) AS driverId, lower(c.c_mktsegment) AS givenName,
       lower(c.c_name) AS familyName, d.date_of_birth AS dateOfBirth, lower(d.nationality) AS nationality,
       'driver/' || f.driver_id AS url,
       CAST(f.season AS VARCHAR) || '-' || lpad(CAST(f.round AS VARCHAR), 2, '0') AS batch_id
FROM fact f JOIN customer c ON c.c_custkey = f.driver_id JOIN dim_drivers d ON d.driver_id = f.driver_id"""))
def _scan_nested(spark, sf):
    d = scan_landed(spark, landed(spark, sf, "drivers"), "drivers")
    return d.select("driverId", F.col("name.givenName").alias("givenName"),
                    F.col("name.familyName").alias("familyName"), "dateOfBirth", "nationality", "url", "batch_id")


@q("scan_json_array", _with(raw_results_sql("SPRINT")))
def _scan_array(spark, sf):
    return scan_landed(spark, landed(spark, sf, "sprints"), "sprints")


def _pages(spark, sf) -> DataFrame:
    return P.combine_pages(P.read_pages(spark, f"{landed(spark, sf, 'pages/results')}/pages/results", "RaceTable",
                                        "Races", P.RACE_RECORD), "RaceTable", "Races")


@q("json_documents", """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS o_orderpriority, o_orderstatus
FROM orders""")
def _q_json_documents(spark, sf):
    """Orders as JSON documents, a file each, with an empty one for a status that no order has."""
    path = scratch_path(spark, "documents")
    priority = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority")).alias("o_orderpriority")
    rows = load_table(spark, sf, "orders").select("o_orderkey", "o_custkey", priority, "o_orderstatus")
    expected = rows.select("o_orderstatus").distinct().union(rows.select(F.lit("none")).limit(1))
    write_json_array(rows, path, "o_orderstatus", expected, max_records=5_000, documents=True)
    return scan_json_array(spark, path, rows.schema, multi_line=True)


@q("flatten_payload", _with("""
SELECT strftime(r.race_date, '%Y-%m-%d') AS date, lower(r.race_name) AS raceName, f.round, f.season,
       'race/' || f.season || '/' || f.round AS url, CAST(f.constructor_id AS VARCHAR) AS constructorId,
       CAST(f.driver_id AS VARCHAR) AS driverId, f.grid_position AS grid, f.completed_laps AS laps,
       f.car_number AS number, f.points, f.final_position AS position, f.final_position_text AS positionText,
       f.status
FROM fact f LEFT JOIN dim_races r ON r.season = f.season AND r.round = f.round
WHERE f.session_type = 'RACE'"""))
def _flatten(spark, sf):
    return P.flatten_results(P.races_of(_pages(spark, sf)))


@q("flatten_drivers_payload", """
SELECT CAST(c_custkey AS VARCHAR) AS driverId, lower(c_mktsegment) AS givenName, lower(c_name) AS familyName,
       CASE WHEN c_acctbal < 0 THEN NULL
            ELSE strftime(DATE '1960-01-01' + CAST(c_custkey % 15000 AS INTEGER), '%Y-%m-%d') END AS dateOfBirth,
       CASE WHEN c_custkey % 7 = 0 THEN '' ELSE lower(n_name) END AS nationality, 'driver/' || c_custkey AS url
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def _flatten_drivers(spark, sf):
    recs = P.combine_pages(P.read_pages(spark, f"{landed(spark, sf, 'pages/drivers')}/pages/drivers", "DriverTable",
                                        "Drivers", P.DRIVER_RECORD), "DriverTable", "Drivers")
    d = P.flatten_drivers(recs)
    return d.select("driverId", F.col("name.givenName").alias("givenName"),
                    F.col("name.familyName").alias("familyName"), "dateOfBirth", "nationality", "url")


@q("combine_pages", _with("""
SELECT season, round, count(*) AS total, CAST(ceil(count(*) / 100) AS BIGINT) AS pages_seen,
       count(*) AS records_seen, CAST(ceil(count(*) / 100) AS BIGINT) AS pages_expected, true AS complete
FROM fact WHERE session_type = 'RACE' GROUP BY 1, 2"""))
def _combine(spark, sf):
    recs = _pages(spark, sf).withColumns({"season": F.col("record.season").cast("int"),
                                          "round": F.col("record.round").cast("int")})
    return P.page_check(recs, ["season", "round"], F.size("record.Results"))


def _sprint_pages(spark, sf) -> DataFrame:
    path = scratch_path(spark, "pages-sprints")
    write_pages(result_pages(materialize_gold(spark, sf), "SPRINT"), path)
    return P.read_complete_pages(spark, path, "RaceTable", "Races", P.RACE_RECORD,
                                 by={"season": "season", "round": "round"}, records="SprintResults")


@q("scan_pages", _with("""
SELECT season, round, count(*) AS results, CAST(ceil(count(*) / 100) AS BIGINT) AS pages
FROM fact WHERE session_type = 'SPRINT' GROUP BY 1, 2"""))
def _scan_pages(spark, sf):
    recs = _sprint_pages(spark, sf)
    return recs.groupBy(F.col("record.season").cast("int").alias("season"), F.col("record.round").cast("int").alias("round")).agg(
        F.sum(F.size("record.SprintResults")).cast("long").alias("results"), F.count_distinct("offset").alias("pages"))


@q("flatten_sprints_payload", _with("""
SELECT strftime(r.race_date, '%Y-%m-%d') AS date, lower(r.race_name) AS raceName, f.round, f.season,
       'race/' || f.season || '/' || f.round AS url, CAST(f.constructor_id AS VARCHAR) AS constructorId,
       CAST(f.driver_id AS VARCHAR) AS driverId, f.grid_position AS grid, f.completed_laps AS laps,
       f.car_number AS number, f.points, f.final_position AS position, f.final_position_text AS positionText,
       f.status
FROM fact f LEFT JOIN dim_races r ON r.season = f.season AND r.round = f.round
WHERE f.session_type = 'SPRINT'"""))
def _flatten_sprints(spark, sf):
    return P.flatten_sprints(P.races_of(_sprint_pages(spark, sf)))


@q("flatten_races_payload", _with("""
SELECT CAST(f.season AS VARCHAR) AS season, CAST(f.round AS VARCHAR) AS round, 'race/' || f.season || '/' || f.round AS url,
       lower(r.race_name) AS raceName, strftime(r.race_date, '%Y-%m-%d') AS date, lower(r.country) AS circuitId
FROM (SELECT season, round, CAST(ceil(count(*) / 100) AS BIGINT) AS pages FROM fact WHERE session_type = 'RACE' GROUP BY 1, 2) f
JOIN dim_races r ON r.season = f.season AND r.round = f.round, unnest(range(f.pages)) AS p(page)"""))
def _flatten_races(spark, sf):
    return P.flatten_races(P.races_of(_pages(spark, sf)))


@q("list_landing_batches", _with(f"SELECT DISTINCT {_BATCH} AS batch_id FROM dim_races"))
def _list(spark, sf):
    return list_landing_batches(spark, landed(spark, sf))


# --- sinks ------------------------------------------------------------------------------------
@q("replace_partition", _with(f"""
SELECT * EXCLUDE (date) FROM ({raw_results_sql("RACE")})
WHERE NOT (batch_id = '1997-03' AND position > 10)"""))
def _replace(spark, sf):
    root = landed(spark, sf, "results")
    path = scratch_path(spark, "bronze-results")
    raw = scan_landed(spark, root, "results")
    overwrite(raw, path, ["batch_id"])
    one = scan_landed(spark, root, "results", "1997-03").filter(F.col("position") <= 10).drop("batch_id")
    replace_partition(one, path, "1997-03")
    replace_partition(one, path, "1997-03")            # rerun: same result
    return spark.read.parquet(path).drop("date")


_SILVER_RESULTS = f"""
SELECT f.season, f.round, CAST(f.constructor_id AS VARCHAR) AS constructor_id,
       CAST(f.driver_id AS VARCHAR) AS driver_id, r.race_date, {tc('lower(r.race_name)')} AS race_name,
       f.grid_position, f.completed_laps, f.car_number, CAST(f.points AS FLOAT) AS points,
       f.final_position, f.final_position_text, f.status,
       CAST(f.season AS VARCHAR) || '-' || lpad(CAST(f.round AS VARCHAR), 2, '0') AS batch_id
FROM fact f LEFT JOIN dim_races r ON r.season = f.season AND r.round = f.round WHERE f.session_type = 'RACE'"""


def _clean_results(spark, sf) -> DataFrame:
    raw = add_ingestion_metadata(scan_landed(spark, landed(spark, sf, "results"), "results"))
    return clean(raw, CLEAN_SPECS["results"]).drop("ingestion_timestamp", "source_file")


@q("clean_results", _with(_SILVER_RESULTS))
def _q_clean_results(spark, sf):
    return _clean_results(spark, sf)


@q("clean_drivers", _with("""
SELECT CAST(d.driver_id AS VARCHAR) AS driver_id, d.date_of_birth, d.nationality, d.driver_name, b.batch_id
FROM dim_drivers d JOIN (SELECT driver_id, max(CAST(season AS VARCHAR) || '-' ||
                                             lpad(CAST(round AS VARCHAR), 2, '0')) AS batch_id
                         FROM fact GROUP BY 1) b ON b.driver_id = d.driver_id"""))
def _q_clean_drivers(spark, sf):
    lake = PL.Lake(scratch_path(spark, "lake"))
    PL.load_raw(spark, landed(spark, sf, "drivers"), lake, "drivers", None)
    return PL.cleaned(spark, lake, "drivers", None).drop("ingestion_timestamp", "source_file")


@q("upsert_guarded", _with(f"""
SELECT season, round, constructor_id, driver_id,
       CASE WHEN season = 1998 THEN points + 1000 ELSE points END AS points,
       CASE WHEN season = 1998 THEN '2099-01' ELSE batch_id END AS batch_id
FROM ({_SILVER_RESULTS})"""))
def _q_upsert(spark, sf):
    path = scratch_path(spark, "silver-results")
    src = _clean_results(spark, sf)
    keys = ["season", "round", "constructor_id", "driver_id"]
    cols = [c for c in src.columns if c not in keys]
    upsert(src.filter(F.col("round") <= 6), path, keys, cols, ["season", "round"], newer_batch_guard)
    upsert(src.filter(F.col("round") >= 4), path, keys, cols, ["season", "round"], newer_batch_guard)
    bumped = src.withColumn("points", F.col("points") + 1000)
    stale = bumped.filter(F.col("season") == 1997).withColumn("batch_id", F.lit("1990-01"))
    newer = bumped.filter(F.col("season") == 1998).withColumn("batch_id", F.lit("2099-01"))
    upsert(stale.unionByName(newer), path, keys, cols, ["season", "round"], newer_batch_guard)
    return spark.read.parquet(path).select(*keys, "points", "batch_id")


@q("upsert_unguarded", _with(f"""
SELECT season, round, constructor_id, driver_id,
       CASE WHEN season IN (1997, 1998) THEN points + 1000 ELSE points END AS points
FROM ({_SILVER_RESULTS})"""))
def _q_upsert_all(spark, sf):
    src = _clean_results(spark, sf)
    keys, path = ["season", "round", "constructor_id", "driver_id"], scratch_path(spark, "gold-results")
    bumped = src.filter(F.col("season").isin(1997, 1998)).withColumn("points", F.col("points") + 1000) \
        .withColumn("batch_id", F.lit("1990-01"))
    for rows in (src, bumped):
        upsert_unguarded(rows, path, keys, ["points", "batch_id"], ["season", "round"])
    return spark.read.parquet(path).select(*keys, "points")


@q("upsert_null_partition", """
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_nationkey END AS part,
       CASE WHEN c_custkey % 2 = 0 THEN 'second' ELSE 'first' END AS said
FROM customer""")
def _q_upsert_null(spark, sf):
    path = scratch_path(spark, "null-partition")
    src = load_table(spark, sf, "customer").select(
        F.col("c_custkey").cast("bigint").alias("c_custkey"),
        F.when(F.col("c_custkey") % 3 != 0, F.col("c_nationkey")).alias("part"), F.lit("first").alias("said"))
    upsert(src, path, ["c_custkey"], ["said"], ["part"])
    upsert(src.filter("c_custkey % 2 = 0").withColumn("said", F.lit("second")), path, ["c_custkey"], ["said"], ["part"])
    return spark.read.parquet(path).select("c_custkey", F.col("part").cast(src.schema["part"].dataType).alias("part"), "said")


@q("upsert_text_key", """
SELECT lpad((c_custkey % 40)::varchar, 3, '0') AS code, c_custkey,
       CASE WHEN c_custkey % 40 < 20 THEN 'second' ELSE 'first' END AS said FROM customer""")
def _q_upsert_text(spark, sf):
    path = scratch_path(spark, "text-key")
    src = load_table(spark, sf, "customer").select(
        F.lpad((F.col("c_custkey") % 40).cast("string"), 3, "0").alias("code"), "c_custkey")
    for said, rows in (("first", src), ("second", src.filter("code < '020'"))):
        upsert(rows.withColumn("said", F.lit(said)), path, ["code", "c_custkey"], ["said"], ["code"])
    return spark.read.schema("code STRING, c_custkey BIGINT, said STRING").parquet(path)


@q("replace_partition_empty", "SELECT o_orderkey, 'kept' AS batch_id FROM orders")
def _q_replace_empty(spark, sf):
    path = scratch_path(spark, "replace-empty")
    rows = load_table(spark, sf, "orders").select("o_orderkey")
    for batch in ("gone", "kept"):
        replace_partition(rows, path, batch)
    replace_partition(rows.filter("o_orderkey < 0"), path, "gone")
    return spark.read.parquet(path)


@q("overwrite_partitioned", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'")
def _q_overwrite(spark, sf):
    path = scratch_path(spark, "overwrite")
    rows = load_table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    overwrite(rows, path, ["o_orderstatus"])
    overwrite(rows.filter("o_orderstatus <> 'F'"), path, ["o_orderstatus"])
    return spark.read.schema(rows.schema).parquet(path)


@q("upsert_snapshot", _with(f"""
SELECT season, round, constructor_id, driver_id,
       CASE WHEN season = 1998 THEN points + 1000 ELSE points END AS points,
       CASE WHEN season = 1998 THEN '2099-01' ELSE batch_id END AS batch_id
FROM ({_SILVER_RESULTS})"""))
def _q_upsert_snapshot(spark, sf):
    """Guarded upserts into a versioned table, with a write between them that dies before its pointer."""
    path = scratch_path(spark, "snapshot-results")
    src = _clean_results(spark, sf)
    keys = ["season", "round", "constructor_id", "driver_id"]
    cols = [c for c in src.columns if c not in keys]
    bumped = src.withColumn("points", F.col("points") + 1000)
    stale = bumped.filter(F.col("season") == 1997).withColumn("batch_id", F.lit("1990-01"))
    newer = bumped.filter(F.col("season") == 1998).withColumn("batch_id", F.lit("2099-01"))
    for rows in (src.filter(F.col("round") <= 6), src.filter(F.col("round") >= 4), stale.unionByName(newer)):
        upsert_table(rows, path, keys, cols, ["season", "round"], newer_batch_guard)
        write_unpublished(bumped, path, ["season", "round"])
    return read_table(spark, path).select(*keys, "points", "batch_id")


@q("control_table_updates", _with(f"""
SELECT batch_id, CASE WHEN batch_id < '1999-01' THEN 'completed' ELSE 'in_progress' END AS status
FROM (SELECT DISTINCT {_BATCH} AS batch_id FROM dim_races)"""))
def _q_control_updates(spark, sf):
    """K5, K10 on a stored table: batches start, and the matched in_progress rows among them are completed."""
    path = scratch_path(spark, "control")
    ids = list_landing_batches(spark, landed(spark, sf))
    append_table(ids.withColumn("status", F.lit(B.IN_PROGRESS)), path)
    done = ids.filter("batch_id < '1999-01'").withColumn("status", F.lit(B.COMPLETED))
    missing = ids.withColumn("batch_id", F.concat("batch_id", F.lit("-x"))).withColumn("status", F.lit("none"))
    update_table(done.unionByName(missing), path, ["batch_id"], ["status"], extra=lambda t, s: t("status") == B.IN_PROGRESS)
    return read_table(spark, path)


@q("rank_fractional", """
WITH r AS (SELECT l_suppkey, sum(l_extendedprice * (1 - l_discount)) AS rev FROM lineitem GROUP BY l_suppkey)
SELECT l_suppkey, round(rev, 2) AS rev, rank() OVER (ORDER BY rev DESC)::int AS rnk,
       dense_rank() OVER (ORDER BY rev DESC)::int AS dense FROM r""")
def _q_rank_fractional(spark, sf):
    rev = load_table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("rev"))
    ranked = rank_within(rank_within(rev, [], [("rev", "desc")], out="rnk"), [], [("rev", "desc")],
                         method="dense_rank", out="dense")
    return ranked.select("l_suppkey", F.round("rev", 2).alias("rev"), "rnk", "dense")


@q("stream_ingest_two_triggers", _with(f"SELECT * EXCLUDE (date) FROM ({raw_results_sql('RACE')})"))
def _q_stream_twice(spark, sf):
    """Several files a batch, fewer files a micro-batch: a batch's files arrive apart and its partition stays whole."""
    root, out = scratch_path(spark, "landing-split"), scratch_path(spark, "bronze-stream")
    for part in (0, 1):                     # a file per batch and part
        rows = scan_landed(spark, landed(spark, sf, "results"), "results").filter(F.pmod(F.xxhash64("driverId"), F.lit(2)) == part)
        write_ndjson(rows.withColumn("date", F.date_format("date", "yyyy-MM-dd")), f"{root}/results", ["batch_id"], "append", "gzip")
    took = ingest_available(spark, root, "results", out, scratch_path(spark, "stream-ckpt"), max_files_per_trigger=60)
    if took < 2:
        raise AssertionError(f"{took} micro-batch")
    return spark.read.parquet(out).drop("date", "ingestion_timestamp", "source_file")


@q("stream_stale_guard", _with(f"""
SELECT season, round, constructorId, driverId, CASE WHEN season = 1998 THEN points + 1000 ELSE points END AS points,
       CASE WHEN season = 1998 THEN '2099-01' ELSE batch_id END AS batch_id
FROM ({raw_results_sql('RACE')})"""))
def _q_stream_guard(spark, sf):
    """Files of an older batch land after a restart and change nothing; those of a newer one do."""
    root, out, ckpt = (scratch_path(spark, n) for n in ("landing-guard", "silver-stream", "guard-ckpt"))
    rows = scan_landed(spark, landed(spark, sf, "results"), "results").withColumn("date", F.date_format("date", "yyyy-MM-dd"))
    bumped = rows.withColumn("points", (F.col("points") + 1000).cast("float"))
    stale = bumped.filter("season <> 1998").withColumn("batch_id", F.lit("1990-01"))
    newer = bumped.filter("season = 1998").withColumn("batch_id", F.lit("2099-01"))
    keys = ["season", "round", "constructorId", "driverId"]
    for landing in (rows, newer, stale):
        write_ndjson(landing, f"{root}/results", ["batch_id"], "append", "gzip")
        upsert_stream(spark, root, "results", out, ckpt, keys, ["season", "round"])
    return read_table(spark, out).select(*keys, "points", "batch_id")


_CONTROL = f"""
landed AS (SELECT DISTINCT {_BATCH} AS batch_id FROM dim_races),
control AS (
  SELECT batch_id, CASE WHEN batch_id < '1998-01' THEN 'completed' WHEN batch_id = '1998-01' THEN 'in_progress'
                        ELSE 'failed' END AS status
  FROM landed WHERE batch_id <= '1998-02')"""


def _control(spark, sf) -> tuple[DataFrame, DataFrame]:
    landed_ids = list_landing_batches(spark, landed(spark, sf))
    control = (landed_ids.filter(F.col("batch_id") <= "1998-02")
               .withColumn("status", F.when(F.col("batch_id") < "1998-01", "completed")
                           .when(F.col("batch_id") == "1998-01", "in_progress").otherwise("failed"))
               .withColumns({"created_timestamp": F.current_timestamp(),
                             "updated_timestamp": F.current_timestamp()}))
    return landed_ids, control


@q("next_batch", _with(f""",{_CONTROL}
SELECT min(batch_id) AS batch_id, min(batch_id) IS NOT NULL AS has_batch FROM landed
WHERE batch_id NOT IN (SELECT batch_id FROM control WHERE status IN ('in_progress', 'completed'))""".replace(
    "\n,", ",", 1)))
def _q_next(spark, sf):
    landed_ids, control = _control(spark, sf)
    return B.next_batch(landed_ids, control)


@q("batch_lifecycle", _with(f""",{_CONTROL}
SELECT batch_id, CASE WHEN batch_id = '1998-01' THEN 'completed' ELSE status END AS status FROM control""".replace(
    "\n,", ",", 1)))
def _q_lifecycle(spark, sf):
    _, control = _control(spark, sf)
    return B.complete_rows(control, "1998-01").select("batch_id", "status")


# --- quality ------------------------------------------------------------------------------------
DQ_CHECKS = [
    {"name": "orderkey_not_null", "type": "not_null", "column": "l_orderkey", "severity": "critical"},
    {"name": "line_key_unique", "type": "unique", "columns": ["l_orderkey", "l_linenumber"], "severity": "warning"},
    {"name": "min_rows_big", "type": "min_rows", "threshold": 100000, "severity": "warning"},
    {"name": "discount_range", "type": "value_range", "column": "l_discount", "min": 0, "max": 0.05,
     "severity": "warning"},
    {"name": "quantity_not_negative", "type": "not_negative", "column": "l_quantity", "severity": "critical"},
    {"name": "part_ref_big_parts", "type": "referential", "column": "l_partkey", "ref_table": "big_parts",
     "ref_column": "p_partkey", "severity": "warning"},
    {"name": "missing_parent", "type": "referential", "column": "l_partkey", "ref_table": "nowhere",
     "ref_column": "p_partkey", "severity": "warning"},
    {"name": "bad_column", "type": "not_null", "column": "no_such_column", "severity": "warning"},
    {"name": "mystery", "type": "freshness", "severity": "critical"},
]


def _fmt_sql(x: str) -> str:
    return f"format('{{:,}}', {x})"


@q("dq_results", f"""
WITH s AS (SELECT count(*) AS total,
                  count_if(l_orderkey IS NULL) AS nn,
                  count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS dup,
                  count_if(l_discount IS NOT NULL AND (l_discount < 0 OR l_discount > 0.05)) AS rng,
                  count_if(l_quantity IS NOT NULL AND l_quantity < 0) AS neg,
                  count_if(l_partkey IS NOT NULL AND l_partkey NOT IN
                           (SELECT p_partkey FROM part WHERE p_size > 10 AND p_partkey IS NOT NULL)) AS orph
           FROM lineitem)
SELECT * FROM (
  SELECT 'orderkey_not_null' AS check_name, 'not_null' AS check_type, 'critical' AS severity, nn = 0 AS passed,
         nn AS fail_count, total AS total_rows, {_fmt_sql('nn')} || ' null values found in ''l_orderkey''' AS details FROM s
  UNION ALL SELECT 'line_key_unique', 'unique', 'warning', dup = 0, dup, total,
         {_fmt_sql('dup')} || ' duplicate rows on key [''l_orderkey'', ''l_linenumber'']' FROM s
  UNION ALL SELECT 'min_rows_big', 'min_rows', 'warning', total >= 100000,
         CASE WHEN total >= 100000 THEN 0 ELSE 100000 - total END, total,
         'Row count ' || {_fmt_sql('total')} || ' vs minimum 100,000' FROM s
  UNION ALL SELECT 'discount_range', 'value_range', 'warning', rng = 0, rng, total,
         {_fmt_sql('rng')} || ' values outside [0, 0.05] in ''l_discount''' FROM s
  UNION ALL SELECT 'quantity_not_negative', 'not_negative', 'critical', neg = 0, neg, total,
         {_fmt_sql('neg')} || ' negative values in ''l_quantity''' FROM s
  UNION ALL SELECT 'part_ref_big_parts', 'referential', 'warning', orph = 0, orph, total,
         {_fmt_sql('orph')} || ' values in ''l_partkey'' not found in big_parts.p_partkey' FROM s
  UNION ALL SELECT 'missing_parent', 'referential', 'warning', false, -1, total, 'error' FROM s
  UNION ALL SELECT 'bad_column', 'not_null', 'warning', false, -1, total, 'error' FROM s
  UNION ALL SELECT 'mystery', 'freshness', 'critical', true, 0, total, 'Unknown check type: ''freshness'' — skipped'
  FROM s)""")
def _q_dq(spark, sf):
    li = load_table(spark, sf, "lineitem")
    parts = load_table(spark, sf, "part").filter(F.col("p_size") > 10)
    res = run_checks(li, DQ_CHECKS, "lineitem", "all", ref_tables={"big_parts": parts}, raise_on_critical=False)
    for r in res:                                   # error texts are engine messages: compare the marker only
        if r["fail_count"] == -1:
            r["details"] = "error"
    return results_frame(spark, res).drop("run_id", "table_name", "batch_id", "run_timestamp")


_KEPT_CHECKS = [c for c in DQ_CHECKS if c["type"] in ("not_null", "unique", "min_rows", "value_range", "not_negative",
                                                      "referential") and c["name"] not in ("bad_column", "missing_parent")]


@q("dq_incremental", """
WITH s AS (SELECT count(*) AS total, count_if(l_orderkey IS NULL) AS nn,
                  count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS dup,
                  count_if(l_discount IS NOT NULL AND (l_discount < 0 OR l_discount > 0.05)) AS rng,
                  count_if(l_quantity IS NOT NULL AND l_quantity < 0) AS neg,
                  count_if(l_partkey IS NOT NULL AND l_partkey NOT IN
                           (SELECT p_partkey FROM part WHERE p_size > 10 AND p_partkey IS NOT NULL)) AS orph
           FROM lineitem),
r AS (
  SELECT 'orderkey_not_null' AS check_name, 'not_null' AS check_type, 'critical' AS severity, nn AS fail_count, total FROM s
  UNION ALL SELECT 'line_key_unique', 'unique', 'warning', dup, total FROM s
  UNION ALL SELECT 'min_rows_big', 'min_rows', 'warning', greatest(100000 - total, 0), total FROM s
  UNION ALL SELECT 'discount_range', 'value_range', 'warning', rng, total FROM s
  UNION ALL SELECT 'quantity_not_negative', 'not_negative', 'critical', neg, total FROM s
  UNION ALL SELECT 'part_ref_big_parts', 'referential', 'warning', orph, total FROM s)
SELECT check_name, check_type, severity, fail_count = 0 AS passed, fail_count::bigint AS fail_count, total::bigint AS total_rows
FROM r""")
def _q_dq_incremental(spark, sf):
    """Four batches of lineitem, the third one at first with wrong rows and then again; some parts come late."""
    li = load_table(spark, sf, "lineitem")
    parts, late = load_table(spark, sf, "part").filter(F.col("p_size") > 10), [True]
    state = CheckState(spark, scratch_path(spark, "check-state"), _KEPT_CHECKS,
                       lambda name: parts.filter("p_partkey % 2 = 0") if late[0] else parts)
    for n in range(4):
        rows = li.filter(F.col("l_orderkey") % 4 == n)
        if n == 2:
            state.add_batch(rows.union(rows).withColumn("l_quantity", F.lit(-1.0)), str(n))
        state.add_batch(rows, str(n))
    late[0] = False
    return state.results()


# --- pipeline and streaming -------------------------------------------------------------------
@q("medallion_backfill", _with("""
SELECT season, round, CAST(constructor_id AS VARCHAR) AS constructor_id, CAST(driver_id AS VARCHAR) AS driver_id,
       session_type, grid_position, completed_laps, car_number, CAST(points AS FLOAT) AS points, final_position,
       final_position_text, status, is_win, is_podium, has_points, is_pole
FROM fact"""))
def _q_backfill(spark, sf):
    lake = PL.Lake(scratch_path(spark, "lake"))
    t = {n: load_table(spark, sf, n) for n in ("nation", "region")}
    PL.backfill(spark, landed(spark, sf, *PL.DATASETS), lake, nationality_region(t["nation"], t["region"]))
    return read_table(spark, lake.gold("fact_session_results")).drop("created_timestamp", "updated_timestamp")


_LAKES: dict[tuple[str, str], PL.Lake] = {}


def _backfilled(spark, sf) -> PL.Lake:
    """The lake of a backfill, run once per application and scale directory for the rows on its tables."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _LAKES:
        lake = PL.Lake(scratch_path(spark, "lake"))
        t = {n: load_table(spark, sf, n) for n in ("nation", "region")}
        PL.backfill(spark, landed(spark, sf, *PL.DATASETS), lake, nationality_region(t["nation"], t["region"]))
        _LAKES[key] = lake
    return _LAKES[key]


_STORED = ("created_timestamp", "updated_timestamp", "ingestion_timestamp", "source_file", "key_bucket")


@q("medallion_dim_drivers", _with("""
SELECT CAST(driver_id AS VARCHAR) AS driver_id, driver_name, date_of_birth, nationality, nationality_region
FROM dim_drivers WHERE driver_id IN (SELECT driver_id FROM fact)"""))
def _q_lake_drivers(spark, sf):
    return read_table(spark, _backfilled(spark, sf).gold("dim_drivers")).drop(*_STORED)


@q("medallion_dim_constructors", _with("""
SELECT CAST(constructor_id AS VARCHAR) AS constructor_id, constructor_name, nationality, nationality_region
FROM dim_constructors WHERE constructor_id IN (SELECT constructor_id FROM fact)"""))
def _q_lake_constructors(spark, sf):
    return read_table(spark, _backfilled(spark, sf).gold("dim_constructors")).drop(*_STORED)


@q("medallion_dim_races", _with("SELECT * FROM dim_races"))
def _q_lake_races(spark, sf):
    return read_table(spark, _backfilled(spark, sf).gold("dim_races")).drop(*_STORED)


@q("clean_circuits", _with(f"""
SELECT lower(country) AS circuit_id, circuit_name, CAST(n_nationkey * 3.5 - 40.0 AS DOUBLE) AS latitude,
       CAST(n_nationkey * 7.0 - 80.0 AS DOUBLE) AS longitude,
       locality, country, max({_BATCH}) AS batch_id
FROM dim_races JOIN nation ON n_name = country GROUP BY 1, 2, 3, 4, 5, 6"""))
def _q_lake_circuits(spark, sf):
    return read_table(spark, _backfilled(spark, sf).silver("circuits")).drop(*_STORED)


@q("dq_suites_passed", _with("""
SELECT t AS table_name, true AS passed FROM unnest(['circuits', 'races', 'constructors', 'drivers', 'results', 'sprints']) AS x(t)"""))
def _q_suites(spark, sf):
    """Q10, Q13: the audit rows of the six suites of a backfill; no check failed or couldn't run."""
    rows = read_table(spark, _backfilled(spark, sf).audit)
    name = F.element_at(F.split("table_name", "/"), -1).alias("table_name")
    return rows.groupBy(name).agg(F.bool_and(F.col("passed")).alias("passed"))


@q("batch_retry", _with("""
SELECT season, round, CAST(constructor_id AS VARCHAR) AS constructor_id, CAST(driver_id AS VARCHAR) AS driver_id,
       session_type, CAST(points AS FLOAT) AS points, final_position, is_win
FROM fact WHERE season = (SELECT min(season) FROM fact)
  AND round = (SELECT min(round) FROM fact WHERE season = (SELECT min(season) FROM fact))"""))
def _q_retry(spark, sf):
    """The first batch fails at its last step but one, is refused to another run, and is taken up where it failed."""
    lake = PL.Lake(scratch_path(spark, "lake"))
    root, t = landed(spark, sf, *PL.DATASETS), {n: load_table(spark, sf, n) for n in ("nation", "region")}
    b = PL.next_batch_id(spark, root, lake)

    class Lost(Exception):
        pass

    def lost(step: str) -> None:
        if step == "star schema":
            raise Lost

    region = nationality_region(t["nation"], t["region"])
    try:
        PL.run_batch(spark, root, lake, b, region, before_step=lost)
    except Lost:
        pass
    if PL.next_batch_id(spark, root, lake) == b or PL.retry_failed(spark, root, lake, region) != [b]:
        raise AssertionError("the failed batch is not held for a retry")
    return read_table(spark, lake.gold("fact_session_results")).select(
        "season", "round", "constructor_id", "driver_id", "session_type", "points", "final_position", "is_win")


@q("stream_ingest", _with(f"SELECT * EXCLUDE (date) FROM ({raw_results_sql('RACE')})"))
def _q_stream(spark, sf):
    out = scratch_path(spark, "bronze-stream")
    ingest_available(spark, landed(spark, sf, "results"), "results", out, scratch_path(spark, "stream-ckpt"))
    return spark.read.parquet(out).drop("date", "ingestion_timestamp", "source_file")
