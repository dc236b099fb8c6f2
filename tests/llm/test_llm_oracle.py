"""Registered training-data queries: SQL parity where SQL can express them."""

import duckdb
import pytest

import __spark_entry__ as E
from tests.test_oracle import TABLES, rows_by_name


def test_all_ten_and_the_pipeline_are_registered():
    names = set(E.queries())
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11)) and "pipeline" in names


@pytest.mark.parametrize("name", sorted(E.LLM_ORACLE))
def test_llm_query_matches_sql(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    res = con.execute(E.oracle_sql()[name])
    cols, want = [d[0] for d in res.description], res.fetchall()
    df = E.queries()[name](spark, sf)
    assert sorted(df.columns) == sorted(cols)
    assert rows_by_name(df.columns, [tuple(r) for r in df.collect()]) == rows_by_name(cols, want)
