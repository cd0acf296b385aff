"""Kept check state equals a full scan after every batch, reruns and late parents included."""

import random

import pytest

from gridline.operators.check_state import CheckState
from gridline.operators.quality import run_checks
from gridline.session import scratch_path

CHECKS = [{"name": "k_there", "type": "not_null", "column": "k"}, {"name": "one_row", "type": "unique", "columns": ["k", "t"]},
          {"name": "enough", "type": "min_rows", "threshold": 150, "severity": "warning"},
          {"name": "v_range", "type": "value_range", "column": "v", "min": 0, "max": 8},
          {"name": "v_positive", "type": "not_negative", "column": "v"},
          {"name": "known", "type": "referential", "column": "k", "ref_table": "parents", "ref_column": "id"}]
SCHEMA = "k int, t string, v double"


def batch(rng, n):
    return [(rng.choice([None, *range(40)]), rng.choice(["a", "b", None]), rng.choice([None, -1.0, 3.0, 9.0])) for _ in range(n)]


@pytest.mark.parametrize("grow", [False, True])
def test_equals_a_full_scan(spark, grow):
    rng = random.Random(6)
    parents = [spark.range(0, 20)]
    state = CheckState(spark, scratch_path(spark, "checks"), CHECKS, lambda name: parents[0])
    data: dict[str, list] = {}
    for name, n in (("1", 60), ("2", 0), ("3", 50), ("1", 40), ("4", 80)):       # batch 1 runs again
        data[name] = batch(rng, n)
        if grow:
            parents[0] = spark.range(0, 20 + 5 * len(data))
        state.add_batch(spark.createDataFrame(data[name], SCHEMA), name)
        whole = spark.createDataFrame([r for rows in data.values() for r in rows], SCHEMA)
        want = run_checks(whole, CHECKS, "t", "*", ref_tables={"parents": parents[0]}, raise_on_critical=False)
        got = {r.check_name: (r.check_type, r.severity, r.passed, r.fail_count, r.total_rows) for r in state.results().collect()}
        assert got == {w["check_name"]: (w["check_type"], w["severity"], w["passed"], w["fail_count"], w["total_rows"]) for w in want}
    assert state.batches() == ["1", "2", "3", "4"]
