"""Queries with a SQL twin against DuckDB over the same files."""

from pathlib import Path

import duckdb
import pytest

from costweave.llm.queries import QUERIES, TWINS

SF = "/root/testdata/sf0.001"


def plain(rows):
    rounded = (tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows)
    return sorted(rounded, key=str)


@pytest.mark.parametrize("name", sorted(TWINS))
def test_query_equals_twin(spark, name):
    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    expected = con.sql(TWINS[name])
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(expected.columns)
    assert plain(got.select(*expected.columns).collect()) == plain(expected.fetchall())
