"""Queries whose result SQL can say, against DuckDB on whole tables."""

import os

import duckdb
import pytest

from lakeloom.llm.queries import QUERIES, SQL
from tools.check import table

FOLDER = os.environ.get("SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    df = QUERIES[name](spark, FOLDER)
    got, columns = table([tuple(r) for r in df.collect()], df.columns)
    cursor = con.execute(SQL[name])
    want, want_columns = table(cursor.fetchall(), [d[0] for d in cursor.description])
    assert columns == want_columns
    assert got == want


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
