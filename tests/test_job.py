"""The whole job on CSV files."""

import json
import os
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as contract
from ledgerlift.fixtures import bronze_from_orders
from ledgerlift.operators import quality_counts, to_silver
from ledgerlift.plans import job, run
from ledgerlift.schemas import BALANCE, CATEGORY_SPEND
from ledgerlift.sources import read_csv, read_silver

SF_DIR = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[1]


@pytest.fixture(scope="module")
def csv(spark):
    return contract._bronze_csv(spark, SF_DIR)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_job(any_ansi, csv, tmp_path):
    spark = any_ansi
    result = run(spark, csv, str(tmp_path), silver_csv=True)
    bronze = bronze_from_orders(spark, SF_DIR)

    counts = (result.filas_bronze, result.filas_silver, result.filas_descartadas)
    assert counts == tuple(quality_counts(bronze).first())
    assert result.filas_silver + result.filas_descartadas == result.filas_bronze == 1500

    expected = rows(to_silver(bronze))
    assert len(expected) == result.filas_silver
    assert rows(result.silver) == rows(read_silver(spark, f"{tmp_path}/silver")) == expected
    assert rows(read_silver(spark, f"{tmp_path}/silver_csv", "csv")) == expected

    assert len(list((tmp_path / "gold_balance").glob("part-*.csv"))) == 1
    for folder, schema, report in (
        ("gold_balance", BALANCE, result.balance),
        ("gold_categorias", CATEGORY_SPEND, result.category_spend),
    ):
        assert rows(read_csv(spark, f"{tmp_path}/{folder}", schema)) == rows(report)

    written = read_csv(spark, f"{tmp_path}/gold_categorias", CATEGORY_SPEND).collect()
    assert written == result.category_spend.collect()

    operations = {r.tipo_transaccion: r.total_operaciones for r in result.balance.collect()}
    assert sum(operations.values()) == result.filas_silver
    spent = sum(r.total_gastado for r in written)
    totals = {r.tipo_transaccion: r.total_monto for r in result.balance.collect()}
    assert round(spent, 2) == totals["EGRESO"]
    by_user = sum(r.monto_total for r in result.user_totals.collect())
    assert round(by_user, 2) == round(sum(totals.values()), 2)


def test_job_leaves_the_session_alone(spark, csv, tmp_path):
    policy = "spark.sql.legacy.timeParserPolicy"
    before = spark.conf.get(policy)
    spark.conf.set(policy, "EXCEPTION")
    try:
        settings = dict(spark.sparkContext.getConf().getAll())
        result = run(spark, csv, str(tmp_path))
        assert spark.conf.get(policy) == "EXCEPTION"
        assert dict(spark.sparkContext.getConf().getAll()) == settings
        assert rows(result.silver) == rows(to_silver(bronze_from_orders(spark, SF_DIR)))
    finally:
        spark.conf.set(policy, before)


def scans(events, fmt, folder):
    """How many scans of files under a folder the finished queries of an event log have."""
    plans = {}
    for line in events.read_text().splitlines():
        event = json.loads(line)
        if "sparkPlanInfo" in event:
            plans[event["executionId"]] = event["sparkPlanInfo"]  # the last one is what ran

    def count(node):
        own = node["nodeName"].startswith(f"Scan {fmt}") and folder in node["metadata"].get("Location", "")
        return own + sum(map(count, node["children"]))

    return sum(map(count, plans.values()))


def test_command_scans_bronze_once_and_silver_little(csv, tmp_path):
    """Three reports and a preview read silver; nothing is computed twice."""
    env = {**os.environ, "PYTHONPATH": str(ROOT), "PYSPARK_SUBMIT_ARGS": (
        "--master local[2] --conf spark.ui.enabled=false --conf spark.eventLog.enabled=true "
        f"--conf spark.eventLog.dir={tmp_path} --conf spark.eventLog.rolling.enabled=false "
        "--conf spark.eventLog.compress=false pyspark-shell"
    )}
    done = subprocess.run(
        [sys.executable, "-m", "ledgerlift.plans.job", csv, f"{tmp_path}/out"],
        env=env, capture_output=True, text=True, timeout=300,
    )
    assert done.returncode == 0, done.stderr[-2000:]
    (events,) = (p for p in tmp_path.iterdir() if p.is_file())
    assert scans(events, "parquet", "/silver]") == 4
    assert scans(events, "csv", csv) == 1


def test_job_can_run_again(spark, csv, tmp_path):
    first = run(spark, csv, str(tmp_path))
    again = run(spark, csv, str(tmp_path))
    assert again[:3] == first[:3]
    assert rows(again.balance) == rows(read_csv(spark, f"{tmp_path}/gold_balance", BALANCE))


def test_a_job_that_fails_leaves_the_old_answers(spark, csv, tmp_path, monkeypatch):
    first = run(spark, csv, str(tmp_path))
    before = [rows(df) for df in first[3:]]
    files = sorted(p for p in tmp_path.rglob("*") if p.is_file())

    def broken(*args, **kwargs):
        raise OSError("disk full")

    monkeypatch.setattr(job, "write_report", broken)
    with pytest.raises(OSError, match="disk full"):
        run(spark, csv, str(tmp_path))
    assert sorted(p for p in tmp_path.rglob("*") if p.is_file()) == files
    assert [rows(df) for df in first[3:]] == before


def test_exact_sums_of_whole_cents_are_the_same(spark, csv, tmp_path):
    plain, exact = (run(spark, csv, f"{tmp_path}/{e}", exact=e) for e in (False, True))
    assert [rows(df) for df in exact[3:]] == [rows(df) for df in plain[3:]]


def test_command_line(csv, tmp_path):
    """The job as ``spark-submit`` starts it, in its own process."""
    env = {**os.environ, "PYTHONPATH": str(ROOT), "PYSPARK_SUBMIT_ARGS": (
        "--master local[2] --conf spark.ui.enabled=false "
        "--conf spark.ui.showConsoleProgress=false pyspark-shell"
    )}
    done = subprocess.run(
        [sys.executable, "-m", "ledgerlift.plans.job", csv, f"{tmp_path}/out"],
        env=env, capture_output=True, text=True, timeout=300,
    )
    assert done.returncode == 0, done.stderr[-2000:]
    assert "bronze 1500, silver" in done.stdout
    assert "INGRESO" in done.stdout and "USR" not in done.stdout
    assert (tmp_path / "out" / "silver" / "_SUCCESS").exists()
    assert not (tmp_path / "out" / "silver_csv").exists()


FLAKY_JOB = """
import sys
from pyspark import TaskContext
from pyspark.sql import Observation, SparkSession
from ledgerlift.fixtures import bronze_from_orders
from ledgerlift.operators import to_silver
from ledgerlift.sources import read_silver, write_table

def fail_twice(batches):
    yield from batches
    if TaskContext.get().attemptNumber() < 2:
        raise RuntimeError("lost")

spark = SparkSession.builder.getOrCreate()
bronze = bronze_from_orders(spark, sys.argv[1]).repartition(6)
quality = Observation()
silver = to_silver(bronze.mapInPandas(fail_twice, bronze.schema), quality)
write_table(silver, sys.argv[2])
written = read_silver(spark, sys.argv[2]).count()
print(quality.get["filas_bronze"], quality.get["filas_silver"], written)
"""


def test_counts_are_exact_when_tasks_are_lost(spark, tmp_path):
    """Every task writes its rows and fails, twice; only the third attempt counts."""
    env = {**os.environ, "PYTHONPATH": str(ROOT), "PYSPARK_SUBMIT_ARGS": (
        "--master local[4,4] --conf spark.ui.enabled=false "
        "--conf spark.ui.showConsoleProgress=false pyspark-shell"
    )}
    done = subprocess.run(
        [sys.executable, "-c", FLAKY_JOB, SF_DIR, f"{tmp_path}/silver"],
        env=env, capture_output=True, text=True, timeout=300,
    )
    assert done.returncode == 0, done.stderr[-2000:]
    bronze, silver, _ = quality_counts(bronze_from_orders(spark, SF_DIR)).first()
    assert done.stdout.split() == [str(bronze), str(silver), str(silver)]
