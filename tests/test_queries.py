"""Every query that SQL can express, against DuckDB on the smallest tables."""

import math
import os

import pytest

FOLDER = os.environ.get("MILLRACE_TEST_DIR", "/root/testdata/sf0.001")
SLOW = {"neardup_removed", "neardup_pairs"}


def plain(v):
    if hasattr(v, "asDict"):
        v = v.asDict()
    if isinstance(v, dict):
        return tuple(sorted((k, plain(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    if type(v).__name__ == "Decimal":
        return float(v)
    return "nan" if isinstance(v, float) and math.isnan(v) else v


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_queries_against_duckdb(spark):
    import duckdb

    from millrace.plans.catalogue import ORACLE_SQL, QUERIES

    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for f in os.listdir(FOLDER):
        con.execute(f"create view {f.split('.')[0]} as select * from '{FOLDER}/{f}'")
    wrong = []
    for name, sql in ORACLE_SQL.items():
        df = QUERIES[name](spark, FOLDER)
        got = sorted(repr(tuple(plain(r[c]) for c in sorted(df.columns))) for r in df.collect())
        found = con.sql(sql)
        order = sorted(range(len(found.columns)), key=lambda k: found.columns[k])
        want = sorted(repr(tuple(plain(r[k]) for k in order)) for r in found.fetchall())
        if got != want or sorted(df.columns) != sorted(found.columns):
            wrong.append(name)
    assert wrong == []
