"""Landed-file readers: fixed schemas, FAILFAST, JSON arrays, batch listing; sinks round trip."""

import os

import pytest

from gridline.sinks.writes import write_json_array
from gridline.sources.files import list_landing_batches, scan_csv, scan_json_array, scan_ndjson


def test_bad_csv_fails_fast(spark, tmp_dir):
    p = f"{tmp_dir}/c.csv"
    with open(p, "w") as f:
        f.write("season,round\n2024,1\n2024,x\n")
    with pytest.raises(Exception):
        scan_csv(spark, p, "season INT, round INT").collect()


def test_bad_json_date_fails_fast(spark, tmp_dir):
    p = f"{tmp_dir}/d.json"
    with open(p, "w") as f:
        f.write('{"driverId": "a", "dateOfBirth": ""}\n')
    with pytest.raises(Exception):
        scan_ndjson(spark, p, "driverId STRING, dateOfBirth DATE").collect()


def test_json_arrays_round_trip_and_empty(spark, tmp_dir):
    df = spark.createDataFrame([("b1", i, None) for i in range(25)], "batch_id STRING, n INT, s STRING")
    expected = spark.createDataFrame([("b1",), ("b2",)], "batch_id STRING")
    write_json_array(df, f"{tmp_dir}/arr", "batch_id", expected=expected, max_records=10)
    back = scan_json_array(spark, f"{tmp_dir}/arr", "n INT, s STRING, batch_id STRING")
    assert sorted(r.n for r in back.collect()) == list(range(25))
    b2 = [f for f in os.listdir(f"{tmp_dir}/arr/batch_id=b2") if f.endswith(".txt")]
    assert b2 and open(f"{tmp_dir}/arr/batch_id=b2/{b2[0]}").read().strip() == "[]"


def test_pretty_printed_array_multiline(spark, tmp_dir):
    p = f"{tmp_dir}/s.json"
    with open(p, "w") as f:
        f.write('[\n  {"n": 1},\n  {"n": 2}\n]\n')
    assert scan_json_array(spark, p, "n INT", multi_line=True).count() == 2
    with open(f"{tmp_dir}/e.json", "w") as f:
        f.write("[]")
    assert scan_json_array(spark, f"{tmp_dir}/e.json", "n INT", multi_line=True).count() == 0


def test_list_landing_batches_ignores_empty_folders(spark, tmp_dir):
    for b in ("2024-10", "2024-09"):
        os.makedirs(f"{tmp_dir}/results/batch_id={b}")
        with open(f"{tmp_dir}/results/batch_id={b}/part.json", "w") as f:
            f.write("{}\n")
    os.makedirs(f"{tmp_dir}/results/batch_id=2025-01")
    assert [r.batch_id for r in list_landing_batches(spark, tmp_dir).collect()] == ["2024-09", "2024-10"]
