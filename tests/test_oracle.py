"""Every registered query against DuckDB over the same tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.01"
# Queries of the package llm have their own tests.
QUERIES, ORACLES = contract._job_queries(), contract._job_oracles()
#: Their oracles have an ORDER BY, and their rows are compared in order.
ORDERED = {
    "category_report_csv",
    "gold_category_spend",
    "gold_category_spend_exact",
    "gold_user_totals",
    "gold_user_totals_exact",
    "lineitem_gold_category_spend",
    "lineitem_gold_user_totals",
    "lineitem_top10_categories",
    "lineitem_top10_users",
    "lineitem_whole_job_category_spend",
    "silver_preview",
    "top10_categories",
    "top10_users",
    "top5_categories",
    "whole_job_user_totals",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    yield con
    con.close()


def by_name(columns, rows, ordered=False):
    """Columns in the order of their names; rows too, unless their order is part of the answer."""
    order = sorted(range(len(columns)), key=columns.__getitem__)
    names = [columns[i] for i in order]
    rows = [tuple(r[i] for i in order) for r in rows]
    return names, rows if ordered else sorted(rows, key=repr)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    answer = duck.execute(ORACLES[name])
    expected = by_name([c[0] for c in answer.description], answer.fetchall(), name in ORDERED)
    assert expected[1], "an oracle without rows proves nothing"
    assert by_name(df.columns, df.collect(), name in ORDERED) == expected


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert {r.tipo_transaccion for r in rows} == {"INGRESO", "EGRESO"}
