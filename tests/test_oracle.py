"""Every registered query against its DuckDB oracle on the smallest test tables, plus the smoke entry."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from gridline.plans import registry as R
from gridline.sources.tables import TEST_TABLES

SF = "/root/testdata/sf0.001"


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TEST_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(R.queries()) == set(R.oracle_sql())


@pytest.mark.parametrize("name", sorted(R.queries()))
def test_query_matches_oracle(spark, con, name):
    df = R.queries()[name](spark, SF)
    cols = sorted(df.columns)
    rows = sorted(tuple(_norm(v) for v in r) for r in df.select(*cols).collect())
    rel = con.execute(R.oracle_sql()[name])
    ocols = [d[0] for d in rel.description]
    idx = sorted(range(len(ocols)), key=lambda i: ocols[i])
    orows = sorted(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())
    assert cols == [ocols[i] for i in idx]
    assert rows == orows


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert [f.name for f in df.schema.fields] == ["season", "driver_id", "driver_name", "short_name", "nationality",
                                                   "standing", "total_points", "constructor_id", "color_code",
                                                   "cons_logo"]
