"""Registered queries of the training-data operators against their SQL, on the smallest tables."""

import duckdb
import pytest

from gridline.llm import queries as Q

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    rel = con.execute(Q.ORACLES[name])
    cols = [d[0] for d in rel.description]
    df = Q.QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(cols)
    norm = lambda r: tuple(round(v, 6) if isinstance(v, float) else v for v in r)
    assert sorted(map(norm, df.select(*cols).collect())) == sorted(map(norm, rel.fetchall()))
