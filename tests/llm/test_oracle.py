"""Queries that SQL can express, against DuckDB on the small tables."""

import duckdb
import pytest

from vigia.llm.queries import oracle_sql, queries

from .conftest import SMALL


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    got = queries()[name](spark, SMALL)
    cur = con.execute(oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(repr, map(tuple, got.select(*columns).collect()))) == sorted(map(repr, cur.fetchall()))


def test_every_operator_is_registered_once():
    assert sorted(n.split("_")[0] for n in queries()) == sorted(f"op{i}" for i in range(1, 14))
