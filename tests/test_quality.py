"""Data-quality checks: every rule, severities, errors, audit-before-raise."""

import pytest

from gridline.operators.quality import (DataQualityError, check_suites, constraint_suites, run_checks, status_of)
from gridline.sinks.upsert import ConstraintViolation, enforce_constraints


@pytest.fixture()
def frame(spark):
    rows = [(1, "a", 5.0, "2000-01-01"), (2, "b", -1.0, "1890-01-01"), (2, None, 95.0, None), (None, "d", None, None)]
    return spark.createDataFrame(rows, "id INT, name STRING, x DOUBLE, dob STRING").selectExpr(
        "id", "name", "x", "CAST(dob AS DATE) AS dob")


CHECKS = [
    {"name": "id_nn", "type": "not_null", "column": "id", "severity": "warning"},
    {"name": "id_unique", "type": "unique", "columns": ["id"], "severity": "warning"},
    {"name": "name_unique", "type": "unique", "column": "name"},
    {"name": "rows", "type": "min_rows", "threshold": 10, "severity": "warning"},
    {"name": "x_range", "type": "value_range", "column": "x", "min": 0, "max": 90, "severity": "warning"},
    {"name": "x_min_only", "type": "value_range", "column": "x", "min": 0, "severity": "warning"},
    {"name": "dob_range", "type": "value_range", "column": "dob", "min": "1900-01-01", "max": "2010-01-01",
     "severity": "warning"},
    {"name": "x_pos", "type": "not_negative", "column": "x", "severity": "warning"},
    {"name": "ref", "type": "referential", "column": "id", "ref_table": "parents", "ref_column": "pid",
     "severity": "warning"},
    {"name": "ref_missing", "type": "referential", "column": "id", "ref_table": "nope", "ref_column": "pid",
     "severity": "warning"},
    {"name": "odd", "type": "row_hash", "severity": "critical"},
]


def test_all_rules(spark, frame):
    parents = spark.createDataFrame([(1,), (1,)], "pid INT")
    audit = []
    res = {r["check_name"]: r for r in run_checks(frame, CHECKS, "t", "b1", ref_tables={"parents": parents},
                                                 audit=audit.append)}
    assert res["id_nn"]["fail_count"] == 1 and not res["id_nn"]["passed"]
    assert res["id_unique"]["fail_count"] == 1            # ids 2, 2 (the null id counts as one key)
    assert res["name_unique"]["fail_count"] == 0 and res["name_unique"]["severity"] == "critical"
    assert (res["rows"]["fail_count"], res["rows"]["details"]) == (6, "Row count 4 vs minimum 10")
    assert res["x_range"]["fail_count"] == 2 and res["x_min_only"]["fail_count"] == 1
    assert res["dob_range"]["fail_count"] == 1 and res["x_pos"]["fail_count"] == 1
    assert res["ref"]["fail_count"] == 2                  # ids 2, 2; the null id is not checked
    assert res["ref_missing"]["fail_count"] == -1 and not res["ref_missing"]["passed"]
    assert res["odd"]["passed"] and "skipped" in res["odd"]["details"]
    assert {r["total_rows"] for r in res.values()} == {4}
    assert status_of(res["id_nn"]) == "WARN" and status_of(res["name_unique"]) == "PASSED"
    assert len(audit) == 1 and audit[0].count() == len(CHECKS)


def test_critical_failure_raises_after_audit(spark, frame):
    audit = []
    with pytest.raises(DataQualityError, match="id_nn"):
        run_checks(frame, [{"name": "id_nn", "type": "not_null", "column": "id"}], "t", "b1", audit=audit.append)
    assert len(audit) == 1 and audit[0].collect()[0].passed is False


def test_bad_column_is_an_error_result(spark, frame):
    r = run_checks(frame, [{"name": "c", "type": "not_null", "column": "zzz", "severity": "warning"}], "t", "b")[0]
    assert r["fail_count"] == -1 and r["details"].startswith("Check execution error")


def test_suites_are_complete():
    sizes = {k: len(v) for k, v in check_suites().items()}
    assert sizes == {"circuits": 7, "races": 10, "constructors": 5, "drivers": 6, "results": 14, "sprints": 12}
    assert {k: len(v) for k, v in constraint_suites().items()} == {
        "circuits": 3, "races": 4, "constructors": 2, "drivers": 2, "results": 5, "sprints": 5}


def test_constraints_refuse_the_write(spark, frame):
    with pytest.raises(ConstraintViolation):
        enforce_constraints(frame, [{"name": "x_ok", "condition": "x IS NULL OR x >= 0"}])
    enforce_constraints(frame.filter("x >= 0"), [{"name": "x_ok", "condition": "x IS NULL OR x >= 0"}])
    with pytest.raises(ValueError, match="duplicate keys"):
        enforce_constraints(frame, [], unique_keys=["id"])


def test_a_check_that_fails_on_the_data_leaves_the_others(spark):
    df = spark.createDataFrame([("1",), ("x",)], "v STRING")
    checks = [{"name": "present", "type": "not_null", "column": "v"},
              {"name": "range", "type": "value_range", "column": "v", "min": 0}]
    got = {r["check_name"]: r["fail_count"] for r in run_checks(df, checks, "t", "b", raise_on_critical=False)}
    assert got == {"present": 0, "range": -1}
