"""Corpus queries against their SQL."""

import math

import duckdb
import pytest

from shelfwise.llm import queries as corpus

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", corpus.oracle_sql())
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    found = corpus.queries()[name](spark, FOLDER)
    cursor = con.execute(corpus.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(found.columns)

    def cell(x):
        return None if x is None or isinstance(x, float) and math.isnan(x) else x

    mine = sorted((tuple(cell(r[c]) for c in sorted(names)) for r in found.collect()), key=repr)
    place = [names.index(c) for c in sorted(names)]
    theirs = sorted((tuple(cell(r[i]) for i in place) for r in cursor.fetchall()), key=repr)
    assert mine == theirs
