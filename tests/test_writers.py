"""Table writers and SQL exposure: create-if-missing, literal append, constants, registered views."""

import json
from types import SimpleNamespace

from pyspark.sql import functions as F

from gridline.operators.charts import chart_order, metric_long
from gridline.operators.joins import with_constants
from gridline.plans import race_views as V
from gridline.session import scratch_path
from gridline.sinks.writes import append, create_if_not_exists, read_table, write_json_array
from gridline.sources.files import scan_json_array
from gridline.sources.tables import literal_rows


def test_create_if_not_exists_then_append_literals(spark):
    path = scratch_path(spark, "control")
    schema = "batch_id STRING, status STRING"
    assert create_if_not_exists(spark, path, schema) is True
    assert create_if_not_exists(spark, path, schema) is False
    append(literal_rows(spark, [("2025-01", "in_progress")], schema), path)
    append(literal_rows(spark, [("2025-02", "in_progress")], schema), path)
    assert sorted(r.batch_id for r in read_table(spark, path).collect()) == ["2025-01", "2025-02"]


def test_json_documents_are_whole_files(spark):
    path = scratch_path(spark, "docs")
    schema = "id BIGINT, note STRING, part STRING"
    rows = [(i, None if i % 4 == 0 else f"line {i}\nnext", "a" if i < 50 else None) for i in range(60)] + [(0, None, "a")] * 9
    expected = spark.createDataFrame([("a",), ("empty",), (None,)], "part STRING")
    write_json_array(spark.createDataFrame(rows, schema), path, "part", expected, max_records=10, documents=True)
    files = [r.value for r in spark.read.text(path, wholetext=True).collect()]
    assert [] in map(json.loads, files) and len(files) >= 5                    # every file is a document
    assert all("\n" in f.strip() for f in files if json.loads(f))
    back = scan_json_array(spark, path, schema, multi_line=True)
    key = lambda r: (r[0], r[1] or "", r[2] or "")
    assert sorted(map(key, back.collect())) == sorted(map(key, rows))
    write_json_array(spark.createDataFrame([], schema), path, "part", expected, documents=True)
    assert scan_json_array(spark, path, schema, multi_line=True).count() == 0


def test_constants_as_literals(spark):
    df = with_constants(spark.createDataFrame([("a",)], "x STRING"), base_url="http://h", n=3)
    r = df.select(F.concat("base_url", F.lit("/"), "x").alias("u"), "n").collect()[0]
    assert (r.u, r.n) == ("http://h/a", 3)


def test_views_are_queryable_with_sql(spark):
    fact = spark.createDataFrame(
        [(2024, 1, "red", "d1", 1, 25.0, 1, "Finished", "RACE", True, True, True, True)],
        "season INT, round INT, constructor_id STRING, driver_id STRING, grid_position INT, points DOUBLE, "
        "final_position INT, status STRING, session_type STRING, is_win BOOLEAN, is_podium BOOLEAN, "
        "has_points BOOLEAN, is_pole BOOLEAN")
    g = SimpleNamespace(
        fact=fact,
        dim_drivers=spark.createDataFrame([("d1", "Max Driver", "Dutch")],
                                          "driver_id STRING, driver_name STRING, nationality STRING"),
        dim_constructors=spark.createDataFrame([("red", "Red Team", "Austrian")],
                                               "constructor_id STRING, constructor_name STRING, nationality STRING"),
        dim_races=spark.createDataFrame([(2024, 1, "Bahrain Grand Prix", "Sakhir", "Bahrain")],
                                        "season INT, round INT, race_name STRING, circuit_name STRING, country STRING"),
        ref_color=spark.createDataFrame([], "constructor_id STRING, color_code STRING, logo_svg STRING"),
        ref_driver_code=spark.createDataFrame([], "driver_id STRING, fia_driver_code STRING"),
        ref_country_image=spark.createDataFrame([], "country STRING, flag_32_png STRING"))
    V.register_views(g, V.RaceConfig(min_season=2020))
    r = spark.sql("SELECT driver_id, standing, short_name FROM v_driver_standings").collect()
    assert [(x.driver_id, x.standing, x.short_name) for x in r] == [("d1", 1, "M. Driver")]
    assert spark.sql("SELECT short_race_name FROM v_constructor_round_wins").collect()[0][0] == "Bahrain GP"
    long = metric_long(spark.sql("SELECT * FROM v_driver_stats"), ["driver_id"], "color_code")
    assert [x.metric for x in chart_order(long).collect()] == ["Wins", "Podiums", "Pts finishes", "Poles"]


def test_scale_conf_sizes_partitions():
    from gridline.session import scale_conf
    assert scale_conf(10 << 20)["spark.sql.shuffle.partitions"] == "200"
    assert scale_conf(100 * (1 << 40))["spark.sql.shuffle.partitions"] == "204800"
    assert scale_conf(1 << 40)["spark.sql.shuffle.partitions"] == "2048"


def test_empty_rerun_and_full_replace_leave_nothing_behind(spark):
    from gridline.sinks.writes import overwrite, replace_partition
    path = scratch_path(spark, "t-replace")
    df = spark.createDataFrame([(1,), (2,)], "k INT")
    replace_partition(df, path, "b1")
    replace_partition(df, path, "b2")
    replace_partition(df.filter("k > 9"), path, "b1")
    assert [r.batch_id for r in spark.read.parquet(path).select("batch_id").distinct().collect()] == ["b2"]
    overwrite(spark.createDataFrame([(1, "x")], "k INT, p STRING"), path2 := scratch_path(spark, "t-over"), ["p"])
    overwrite(spark.createDataFrame([(1, "y")], "k INT, p STRING"), path2, ["p"])
    assert [r.p for r in spark.read.parquet(path2).collect()] == ["y"]


def test_json_arrays_keep_rows_without_partition_value(spark):
    from gridline.sinks.writes import write_json_array
    path = scratch_path(spark, "t-arrays")
    write_json_array(spark.createDataFrame([(1, "a"), (2, None)], "k INT, p STRING"), path, "p")
    assert sorted(r.k for r in spark.read.schema("k INT").json(path).collect()) == [1, 2]
