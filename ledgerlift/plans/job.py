"""The whole job: bronze CSV in; silver and the gold reports out.

    spark-submit --py-files ledgerlift.zip ledgerlift/plans/job.py IN OUT [--silver-csv] [--exact-sums]
"""

import argparse
from typing import NamedTuple
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql.types import StructType

from ledgerlift.operators import balance, category_spend, preview, to_silver, top_k, user_totals
from ledgerlift.operators.gold import SPEND_ORDER, USER_ORDER, largest_first
from ledgerlift.schemas import BALANCE, CATEGORY_SPEND, USER_TOTALS
from ledgerlift.sources import (
    delete_folder,
    read_bronze,
    read_silver,
    replace_folder,
    write_report,
    write_table,
)


class JobResult(NamedTuple):
    """Counts of rows, and the layers as lazy tables over what was written."""

    filas_bronze: int
    filas_silver: int
    filas_descartadas: int
    silver: DataFrame
    balance: DataFrame
    category_spend: DataFrame
    user_totals: DataFrame


def run(
    spark: SparkSession,
    in_path: str,
    out_path: str,
    silver_csv: bool = False,
    exact: bool = False,
) -> JobResult:
    """Read bronze once, write silver, and build each report once from the written silver.

    The bronze scan, the cleaning and the row counts are one job without a shuffle. Silver goes
    to Parquet, from which each report reads only its own columns, and which is still there when
    an executor is lost. The reports go to Parquet under ``gold/``, from which the CSV reports and
    the result are read. ``exact`` adds amounts that are not whole cents without loss as well. The
    session's settings are left alone.

    All of it is written beside the answers of an earlier run, which it replaces at the end, one
    folder after the other; a run that fails leaves them as they were.
    """
    out_path = out_path.rstrip("/")
    new_path = f"{out_path}/_run-{uuid4().hex[:8]}"
    try:
        counts = _build(spark, in_path, new_path, silver_csv, exact)
        for name in ("silver", "gold", "gold_balance", "gold_categorias", "silver_csv")[: 4 + silver_csv]:
            replace_folder(spark, f"{new_path}/{name}", f"{out_path}/{name}")
    finally:
        delete_folder(spark, new_path)

    def gold(name: str, schema: StructType) -> DataFrame:
        return spark.read.schema(schema).parquet(f"{out_path}/gold/{name}")

    return JobResult(
        filas_bronze=counts["filas_bronze"],
        filas_silver=counts["filas_silver"],
        filas_descartadas=counts["filas_bronze"] - counts["filas_silver"],
        silver=read_silver(spark, f"{out_path}/silver"),
        balance=gold("balance", BALANCE),
        category_spend=gold("categorias", CATEGORY_SPEND).orderBy(*largest_first(*SPEND_ORDER)),
        user_totals=gold("usuarios", USER_TOTALS).orderBy(*largest_first(*USER_ORDER)),
    )


def _build(
    spark: SparkSession, in_path: str, out_path: str, silver_csv: bool, exact: bool
) -> dict[str, int]:
    """Writes all layers to a new folder; returns the counts of rows."""
    quality = Observation("silver_quality")
    bronze = read_bronze(spark, in_path)
    write_table(to_silver(bronze, quality), f"{out_path}/silver", in_place=True)
    silver = read_silver(spark, f"{out_path}/silver")
    if silver_csv:
        write_table(silver, f"{out_path}/silver_csv", "csv", in_place=True)

    def gold(report: DataFrame, name: str) -> DataFrame:
        write_table(report, f"{out_path}/gold/{name}", in_place=True)
        return spark.read.schema(report.schema).parquet(f"{out_path}/gold/{name}")

    by_type = gold(balance(silver, exact), "balance")
    by_category = gold(category_spend(silver, ranked=False, exact=exact), "categorias")
    gold(user_totals(silver, ranked=False, exact=exact), "usuarios")
    write_report(
        by_type, f"{out_path}/gold_balance", "tipo_transaccion", one_file=True, in_place=True
    )
    write_report(
        by_category, f"{out_path}/gold_categorias", *largest_first(*SPEND_ORDER), in_place=True
    )
    return quality.get


def main() -> None:
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("in_path")
    args.add_argument("out_path")
    args.add_argument("--silver-csv", action="store_true", help="also write silver as CSV")
    args.add_argument(
        "--exact-sums", action="store_true", help="add fractions of a cent without loss as well"
    )
    options = args.parse_args()

    spark = SparkSession.builder.appName("ledgerlift").getOrCreate()
    read_bronze(spark, options.in_path).printSchema()
    result = run(
        spark, options.in_path, options.out_path, options.silver_csv, options.exact_sums
    )
    print(
        f"bronze {result.filas_bronze}, silver {result.filas_silver}, "
        f"discarded {result.filas_descartadas}"
    )
    result.silver.printSchema()
    preview(result.silver, 10).show()
    result.balance.show()
    top_k(result.category_spend, 10, *SPEND_ORDER).show()
    top_k(result.user_totals, 10, *USER_ORDER).show()
    spark.stop()


if __name__ == "__main__":
    main()
