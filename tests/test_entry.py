import math
import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "NettAmount" in df.columns


def test_every_query_has_oracle():
    from tradeflow.plans import catalog, chains_and_trends
    assert set(catalog.queries() | chains_and_trends.queries()) <= set(E.oracle_sql()) <= set(E.queries())


def _norm(v):
    if v is None:
        return ("n", "")
    if isinstance(v, float):
        return ("f", "nan" if math.isnan(v) else repr(v))
    if isinstance(v, int) and not isinstance(v, bool):
        return ("f", repr(float(v)))
    return ("x", str(v))


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
def test_queries_match_oracle_small(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    sqls = E.oracle_sql()
    from tradeflow.plans import catalog, chains_and_trends
    for name, fn in (catalog.queries() | chains_and_trends.queries()).items():
        df = fn(spark, SF)
        cols = df.columns
        got = sorted(tuple(_norm(r[c]) for c in sorted(cols)) for r in df.collect())
        cur = con.execute(sqls[name])
        ocols = [d[0] for d in cur.description]
        assert sorted(ocols) == sorted(cols), name
        idx = [ocols.index(c) for c in sorted(cols)]
        exp = sorted(tuple(_norm(r[i]) for i in idx) for r in cur.fetchall())
        assert got == exp, name
