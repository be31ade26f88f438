"""The registered queries of the subpackage against their DuckDB answer."""

import duckdb
import pytest

import __spark_entry__ as entry_point
from atende.llm.answers import ANSWERS
from atende.llm.queries import QUERIES

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.mark.parametrize("name", list(ANSWERS))
def test_query_matches_its_answer(spark, sf_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    df, answer = QUERIES[name](spark, sf_dir), con.sql(ANSWERS[name])
    assert sorted(df.columns) == sorted(answer.columns)
    at = [answer.columns.index(c) for c in df.columns]
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(repr(tuple(r[i] for i in at)) for r in answer.fetchall())


def test_entry_registers_them():
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(ANSWERS) <= set(entry_point.oracle_sql())
