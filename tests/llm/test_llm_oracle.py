"""Queries of this package that SQL can express, against DuckDB over the same tables."""

from pathlib import Path

import duckdb
import pytest

from ledgerlift.llm import registry

ORACLES = registry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield con
    con.close()


@pytest.mark.parametrize("name", ORACLES)
def test_matches_oracle(spark, sf_dir, duck, name):
    df = registry.queries()[name](spark, sf_dir)
    answer = duck.execute(ORACLES[name])
    names = [c[0] for c in answer.description]
    assert sorted(names) == sorted(df.columns)
    expected = sorted(answer.fetchall(), key=repr)
    assert expected
    assert sorted((tuple(r) for r in df.select(*names).collect()), key=repr) == expected
