"""Driver contract: entry() runs; every registered query runs at sf0.001 and
matches its DuckDB oracle (same comparison as tools/check_oracle.py)."""

import os
from collections import Counter

import pytest

import __spark_entry__ as E
from tools.check_oracle import TABLES, norm, type_mismatches

SF = "/root/testdata/sf0.001"


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "support_health_score" in df.columns


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.LLM_QUERIES)))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF)
    srows = [tuple(norm(x) for x in r) for r in sdf.collect()]
    sql = E.oracle_sql().get(name)
    assert sql is not None, "every query of the library has SQL to be held against"
    rel = duck.sql(sql)
    assert type_mismatches(sdf.schema, rel.columns, rel.types) == []
    cur = duck.execute(sql)
    dcols = [d[0] for d in cur.description]
    assert sorted(sdf.columns) == sorted(dcols)
    so = sorted(range(len(sdf.columns)), key=lambda i: sdf.columns[i])
    do = sorted(range(len(dcols)), key=lambda i: dcols[i])
    drows = [tuple(norm(x) for x in r) for r in cur.fetchall()]
    assert Counter(tuple(r[i] for i in so) for r in srows) == Counter(tuple(r[i] for i in do) for r in drows)
