"""Declarative data-quality checks with an audit trail (Q1-Q14).

All row-level checks of a suite run as ONE aggregation job: ``not_null``,
``value_range``, ``not_negative`` become ``count_if`` columns, ``unique`` a
``count(DISTINCT struct(keys))`` (null keys compare equal, like ``dropDuplicates``),
``referential`` a left join to the de-duplicated parent keys counted in the same
pass. A check whose expression cannot be analysed (missing column, missing parent)
is recorded as failed with ``fail_count = -1`` without stopping the others.
"""

from __future__ import annotations

import datetime as _dt
import sys
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AUDIT_SCHEMA = ("run_id STRING, table_name STRING, batch_id STRING, check_name STRING, check_type STRING, "
                "severity STRING, passed BOOLEAN, fail_count LONG, total_rows LONG, details STRING, "
                "run_timestamp TIMESTAMP")


KNOWN_TYPES = ("not_null", "unique", "min_rows", "value_range", "not_negative", "referential")


class DataQualityError(Exception):
    pass


def _fmt(n: int) -> str:
    return f"{n:,}"


def _one_by_one(df: DataFrame, frame: DataFrame, aggs: Sequence[Column], plan: Sequence[tuple]
                ) -> tuple[dict[str, Any], list[tuple]]:
    """The fused aggregation as a job per check; a check that fails on the data becomes an error."""
    row = df.agg(aggs[0]).first().asDict()
    exprs, out = iter(aggs[1:]), []
    for chk, alias, err in plan:
        if alias is not None:
            e = next(exprs)
            try:
                row.update((frame if chk["type"] == "referential" else df).agg(e).first().asDict())
            except Exception as exc:                                # noqa: BLE001  (recorded, not raised)
                print(f"DQ check {chk.get('name')!r} could not run: {str(exc).splitlines()[0]}", file=sys.stderr)
                alias, err = None, f"Check execution error: {exc}"
        out.append((chk, alias, err))
    return row, out


def run_checks(df: DataFrame, checks: Sequence[Mapping[str, Any]], table_name: str, batch_id: str,
               ref_tables: Mapping[str, DataFrame] | Callable[[str], DataFrame] | None = None,
               raise_on_critical: bool = True, audit: Callable[[DataFrame], None] | None = None,
               now: _dt.datetime | None = None) -> list[dict[str, Any]]:
    """Q1-Q11: evaluate ``checks`` on ``df``; append one audit row per check; raise on critical failures."""
    spark: SparkSession = df.sparkSession
    run_ts = now or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    run_id = f"{table_name}__{batch_id}__{run_ts.strftime('%Y%m%dT%H%M%S')}"

    def parent(name: str) -> DataFrame:
        if callable(ref_tables):
            return ref_tables(name)
        if ref_tables is None or name not in ref_tables:
            raise LookupError(f"reference table not found: {name}")
        return ref_tables[name]

    frame = df
    aggs: list[Column] = [F.count(F.lit(1)).alias("__total")]
    plan: list[tuple[Mapping[str, Any], str | None, str | None]] = []   # (check, agg alias, error)
    for i, chk in enumerate(checks):
        ctype, alias = chk["type"], f"__c{i}"
        named = [c for c in (chk.get("columns") or [chk.get("column")]) if c]
        absent = [c for c in named if c.split(".")[0] not in df.columns]
        if ctype in KNOWN_TYPES and absent:              # reported like any failed check, no engine error
            plan.append((chk, None, f"Check execution error: column(s) not found: {absent}"))
            continue
        try:
            if ctype == "not_null":
                e = F.count_if(F.col(chk["column"]).isNull())
            elif ctype == "unique":
                cols = chk.get("columns") or [chk["column"]]
                e = F.count(F.lit(1)) - F.count_distinct(F.struct(*[F.col(c) for c in cols]))
            elif ctype == "value_range":
                c = F.col(chk["column"])
                out = F.lit(False)
                if chk.get("min") is not None:
                    out = out | (c < F.lit(chk["min"]))
                if chk.get("max") is not None:
                    out = out | (c > F.lit(chk["max"]))
                e = F.count_if(c.isNotNull() & out)
            elif ctype == "not_negative":
                c = F.col(chk["column"])
                e = F.count_if(c.isNotNull() & (c < 0))
            elif ctype == "referential":
                flag = f"__ref{i}"
                keys = (parent(chk["ref_table"]).select(F.col(chk["ref_column"]).alias(f"__refkey{i}"))
                        .distinct().withColumn(flag, F.lit(True)))
                trial = frame.join(keys, frame[chk["column"]] == keys[f"__refkey{i}"], "left")
                trial.schema                                        # analysis only: surfaces a bad column
                frame = trial.drop(f"__refkey{i}")
                e = F.count_if(F.col(chk["column"]).isNotNull() & F.col(flag).isNull())
            else:
                plan.append((chk, None, None))                      # unknown / min_rows: no aggregate
                continue
            frame.agg(e.alias(alias)).schema                       # analysis only, no job
            aggs.append(e.alias(alias))
            plan.append((chk, alias, None))
        except Exception as exc:                                    # noqa: BLE001  (recorded, not raised)
            print(f"DQ check {chk.get('name')!r} could not run: {str(exc).splitlines()[0]}", file=sys.stderr)
            plan.append((chk, None, f"Check execution error: {exc}"))

    try:
        row = frame.agg(*aggs).first().asDict()                     # the one job for every check
    except Exception:                                               # noqa: BLE001
        # some check fails on the data: find out which, one job each, so that the others still count
        row, plan = _one_by_one(df, frame, aggs, plan)
    total = int(row["__total"])
    results = []
    for chk, alias, err in plan:
        ctype, sev = chk["type"], chk.get("severity", "critical")
        passed, fail, details = True, 0, ""
        if err is not None:
            passed, fail, details = False, -1, err
        elif ctype == "not_null":
            fail = int(row[alias]); details = f"{_fmt(fail)} null values found in '{chk['column']}'"
        elif ctype == "unique":
            cols = chk.get("columns") or [chk["column"]]
            fail = int(row[alias]); details = f"{_fmt(fail)} duplicate rows on key {cols}"
        elif ctype == "min_rows":
            thr = int(chk["threshold"])
            fail = 0 if total >= thr else thr - total
            details = f"Row count {_fmt(total)} vs minimum {_fmt(thr)}"
        elif ctype == "value_range":
            fail = int(row[alias])
            details = f"{_fmt(fail)} values outside [{chk.get('min')}, {chk.get('max')}] in '{chk['column']}'"
        elif ctype == "not_negative":
            fail = int(row[alias]); details = f"{_fmt(fail)} negative values in '{chk['column']}'"
        elif ctype == "referential":
            fail = int(row[alias])
            details = f"{_fmt(fail)} values in '{chk['column']}' not found in {chk['ref_table']}.{chk['ref_column']}"
        else:
            details = f"Unknown check type: '{ctype}' — skipped"
        if err is None and ctype in KNOWN_TYPES:
            passed = fail == 0
        results.append({"run_id": run_id, "table_name": table_name, "batch_id": batch_id,
                        "check_name": chk["name"], "check_type": ctype, "severity": sev, "passed": passed,
                        "fail_count": int(fail), "total_rows": total, "details": details, "run_timestamp": run_ts})

    if audit is not None:                                           # Q10: audit before any raise
        audit(results_frame(spark, results))
    critical = [r for r in results if not r["passed"] and r["severity"] == "critical"]
    if raise_on_critical and critical:                              # Q11
        raise DataQualityError(
            f"DATA QUALITY CRITICAL FAILURE — table: {table_name}, batch: {batch_id}\n"
            f"Failed checks: {', '.join(r['check_name'] for r in critical)}")
    return results


def status_of(result: Mapping[str, Any]) -> str:
    """Q9: PASSED / FAILED (critical) / WARN (warning)."""
    if result["passed"]:
        return "PASSED"
    return "FAILED" if result["severity"] == "critical" else "WARN"


def results_frame(spark: SparkSession, results: Sequence[Mapping[str, Any]]) -> DataFrame:
    cols = [c.split()[0] for c in AUDIT_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in results], AUDIT_SCHEMA)


def _dob_max(years: int = 15) -> str:
    t = _dt.date.today()
    try:
        return t.replace(year=t.year - years).isoformat()
    except ValueError:                                              # 29 February
        return t.replace(year=t.year - years, day=28).isoformat()


def check_suites(silver: str = "silver") -> dict[str, list[dict[str, Any]]]:
    """Q13: the six check suites of the cleaned tables (names, rules and severities as fixed values)."""
    crit, warn = "critical", "warning"

    def nn(col, sev, name=None):
        return {"name": name or f"{col}_not_null", "type": "not_null", "column": col, "severity": sev}

    def ref(col, table, rcol):
        return {"name": f"{col}_ref_{table}", "type": "referential", "column": col,
                "ref_table": f"{silver}.{table}", "ref_column": rcol, "severity": warn}

    one = {"name": "min_one_row", "type": "min_rows", "threshold": 1, "severity": warn}
    key4 = ["season", "round", "constructor_id", "driver_id"]
    results_common = [nn("season", crit), nn("round", crit), nn("constructor_id", crit), nn("driver_id", crit),
                      nn("points", warn), nn("final_position", warn)]
    return {
        "circuits": [nn("circuit_id", crit), nn("circuit_name", warn), nn("country", warn),
                     {"name": "circuit_id_unique", "type": "unique", "columns": ["circuit_id"], "severity": crit},
                     one,
                     {"name": "latitude_range", "type": "value_range", "column": "latitude", "min": -90,
                      "max": 90, "severity": warn},
                     {"name": "longitude_range", "type": "value_range", "column": "longitude", "min": -180,
                      "max": 180, "severity": warn}],
        "races": [nn("season", crit), nn("round", crit), nn("race_name", warn), nn("circuit_id", warn),
                  nn("race_date", warn),
                  {"name": "season_round_unique", "type": "unique", "columns": ["season", "round"],
                   "severity": crit},
                  one,
                  {"name": "season_range", "type": "value_range", "column": "season", "min": 1950, "max": 2100,
                   "severity": warn},
                  {"name": "round_range", "type": "value_range", "column": "round", "min": 1, "max": 30,
                   "severity": warn},
                  {**ref("circuit_id", "circuits", "circuit_id"), "name": "circuit_id_ref_circuits"}],
        "constructors": [nn("constructor_id", crit), nn("constructor_name", warn), nn("nationality", warn),
                         {"name": "constructor_id_unique", "type": "unique", "columns": ["constructor_id"],
                          "severity": crit}, one],
        "drivers": [nn("driver_id", crit), nn("driver_name", warn), nn("nationality", warn),
                    {"name": "driver_id_unique", "type": "unique", "columns": ["driver_id"], "severity": crit},
                    one,
                    {"name": "dob_range", "type": "value_range", "column": "date_of_birth", "min": "1900-01-01",
                     "max": _dob_max(15), "severity": warn}],
        "results": [*results_common, nn("status", warn),
                    {"name": "composite_key_unique", "type": "unique", "columns": key4, "severity": crit}, one,
                    {"name": "points_not_negative", "type": "not_negative", "column": "points", "severity": warn},
                    {"name": "grid_position_positive", "type": "value_range", "column": "grid_position", "min": 0,
                     "max": 30, "severity": warn},
                    {"name": "completed_laps_not_negative", "type": "not_negative", "column": "completed_laps",
                     "severity": warn},
                    {**ref("driver_id", "drivers", "driver_id"), "name": "driver_id_ref_drivers"},
                    {**ref("constructor_id", "constructors", "constructor_id"),
                     "name": "constructor_id_ref_constructors"}],
        "sprints": [*results_common,
                    {"name": "composite_key_unique", "type": "unique", "columns": key4, "severity": crit}, one,
                    {"name": "points_not_negative", "type": "not_negative", "column": "points", "severity": warn},
                    {"name": "completed_laps_not_negative", "type": "not_negative", "column": "completed_laps",
                     "severity": warn},
                    {**ref("driver_id", "drivers", "driver_id"), "name": "driver_id_ref_drivers"},
                    {**ref("constructor_id", "constructors", "constructor_id"),
                     "name": "constructor_id_ref_constructors"}],
    }


def constraint_suites() -> dict[str, list[dict[str, str]]]:
    """Q14: the predicates each cleaned table must satisfy (enforced by the upsert)."""
    def nn(prefix, col):
        return {"name": f"chk_{prefix}{col}_not_null", "condition": f"{col} IS NOT NULL"}

    def res(p):
        return [nn(p, "season"), nn(p, "round"), nn(p, "constructor_id"), nn(p, "driver_id"),
                {"name": f"chk_{p}points_not_negative", "condition": "points IS NULL OR points >= 0"}]
    return {
        "circuits": [nn("", "circuit_id"),
                     {"name": "chk_latitude_range", "condition": "latitude IS NULL OR latitude BETWEEN -90 AND 90"},
                     {"name": "chk_longitude_range",
                      "condition": "longitude IS NULL OR longitude BETWEEN -180 AND 180"}],
        "races": [nn("", "season"), nn("", "round"),
                  {"name": "chk_season_range", "condition": "season BETWEEN 1950 AND 2100"},
                  {"name": "chk_round_range", "condition": "round BETWEEN 1 AND 30"}],
        "constructors": [nn("", "constructor_id"), nn("", "constructor_name")],
        "drivers": [nn("", "driver_id"), nn("", "driver_name")],
        "results": res("results_"),
        "sprints": res("sprints_"),
    }
