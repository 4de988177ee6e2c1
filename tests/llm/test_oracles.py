"""Queries against their DuckDB twins at the smallest scale factor."""

import duckdb
import pytest

from quarrystone.llm import queries


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_against_sql(spark, sf, name):
    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    frame = queries.queries()[name](spark, sf)
    columns = sorted(frame.columns)
    found = c.execute(queries.oracle_sql()[name])
    theirs = [d[0] for d in found.description]
    assert sorted(theirs) == columns
    ours = sorted(repr(tuple(r[x] for x in columns)) for r in frame.collect())
    assert ours == sorted(repr(tuple(r[theirs.index(x)] for x in columns)) for r in found.fetchall())
