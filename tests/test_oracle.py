"""Every registered query against its DuckDB SQL on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return str(v)


def rows_by_name(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) - set(E.LLM_ORACLE)))
def test_query_matches_oracle(spark, sf, duck, name):
    df = E.queries()[name](spark, sf)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert rows_by_name(df.columns, srows) == rows_by_name(dcols, drows)


def test_every_query_has_oracle():
    assert set(E.queries()) - set(E.LLM_QUERIES) == set(E.oracle_sql()) - set(E.LLM_ORACLE)
