"""What must hold of the plans for the queries to work on far more data."""

import re

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

import __spark_entry__ as contract
from ledgerlift.operators import (
    balance,
    category_spend,
    quality_counts,
    share_of_total,
    to_silver,
    top_k,
    user_totals,
)
from ledgerlift.sources import read_bronze, read_silver, write_table

SF_DIR = "/root/testdata/sf0.001"
QUERIES = contract._job_queries()


def plan_of(df, run=False):
    """The physical plan; after a run, the one that adaptive execution ended with."""
    if run:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def bronze(spark):
    return read_bronze(spark, contract._bronze_csv(spark, SF_DIR))


@pytest.fixture(scope="module")
def silver(spark, bronze, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('plans')}/silver"
    write_table(to_silver(bronze), path)
    return read_silver(spark, path)


@pytest.mark.parametrize("name", QUERIES)
def test_no_query_has_python_cross_joins_or_one_task_windows(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert not re.search(r"Python|Pandas|ArrowEval|Cartesian|NestedLoop|Window|Broadcast", plan)


def cleaning_counts(plan):
    """How often the plan has each cleaning expression: money, labels, dates, movements."""
    patterns = (r"replace\(monto_str#", r"regexp_replace\(categoria_raw#", "yyyy/MM/dd", r"upper\(tipo_")
    return [len(re.findall(p, plan)) for p in patterns]


@pytest.fixture(scope="module")
def stored(bronze, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('plans')}/bronze"
    write_table(bronze, path)
    return bronze.sparkSession.read.parquet(path)


@pytest.mark.parametrize("quality", [None, Observation()], ids=["plain", "observed"])
def test_silver_is_one_stage_that_cleans_once(bronze, quality):
    plan = plan_of(to_silver(bronze, quality))
    assert "Exchange" not in plan
    # Two branches of the movement's vocabulary.
    assert cleaning_counts(plan) == [1, 1, 1, 2]


def test_reports_on_bronze_clean_once_and_only_what_they_need(stored):
    spend = plan_of(category_spend(to_silver(stored)))
    assert cleaning_counts(spend) == [1, 1, 1, 2]
    totals = plan_of(balance(to_silver(stored)))
    assert cleaning_counts(totals) == [1, 0, 1, 2]
    assert "categoria_raw" not in totals


def test_made_up_mess_is_made_once(spark):
    plan = plan_of(QUERIES["lineitem_silver"](spark, SF_DIR))
    assert plan.count("date_format(") == 5 and plan.count("gettimestamp(") == 5


def test_filters_on_silver_reach_the_scan(stored):
    plan = plan_of(to_silver(stored).filter(F.col("id_usuario") == "7"))
    assert "EqualTo(id_usuario,7)" in plan
    assert cleaning_counts(plan) == [1, 1, 1, 2]
    assert not re.search("CollectMetrics", plan)


def test_labels_are_cleaned_in_rows_that_stay(stored):
    plan = plan_of(to_silver(stored))
    assert plan.index("regexp_replace(categoria_raw#") < plan.index("Filter") < plan.index("Generate")


def test_equal_silvers_share_an_exchange(bronze):
    both = balance(to_silver(bronze)).join(balance(to_silver(bronze)), "tipo_transaccion")
    assert "ReusedExchange" in plan_of(both, run=True)


def test_counts_read_only_what_they_need(bronze):
    plan = plan_of(quality_counts(bronze))
    columns = "monto_str:string,fecha_operacion:string,tipo_movimiento:string"
    assert f"ReadSchema: struct<{columns}>" in plan
    assert plan.count("FileScan") == 1


@pytest.mark.parametrize(
    "report, columns, exchanges",
    [
        (balance, "id_transaccion:string,monto:double,tipo_transaccion:string", 1),
        (category_spend, "monto:double,categoria:string,tipo_transaccion:string", 2),
        (user_totals, "id_usuario:string,monto:double,tipo_transaccion:string", 2),
    ],
)
def test_reports_aggregate_before_the_shuffle(silver, report, columns, exchanges):
    plan = plan_of(report(silver))
    assert f"ReadSchema: struct<{columns}>" in plan
    assert plan.count("Exchange ") == exchanges
    shuffle = plan.index("Exchange hashpartitioning")
    assert "partial_sum" in plan[shuffle:] and "partial_sum" not in plan[:shuffle]


def test_expenses_are_pushed_into_the_scan(silver):
    assert "EqualTo(tipo_transaccion,EGRESO)" in plan_of(category_spend(silver))


def test_top_k_needs_no_global_sort(silver):
    plan = plan_of(top_k(category_spend(silver), 5, "total_gastado", "categoria"))
    assert "TakeOrderedAndProject(limit=5" in plan
    assert "rangepartitioning" not in plan


def test_share_aggregates_once(silver):
    plan = plan_of(share_of_total(balance(silver), "total_monto", "tipo_transaccion"), run=True)
    assert "ReusedExchange" in plan
