"""

``queries()`` cleans messy text made from the test tables; ``oracle_sql()`` computes the same
answers from the clean columns, so the two share no cleaning code.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlift.fixtures import bronze_from_lineitem, bronze_from_orders
from ledgerlift.functions import clean_label, map_synonyms, parse_date_multi, parse_money
from ledgerlift.operators import (
    balance,
    category_spend,
    exact_sums,
    expense_rows,
    preview,
    quality_counts,
    schema_report,
    share_of_total,
    to_silver,
    top_k,
    user_totals,
)
from ledgerlift.operators.gold import SPEND_ORDER, USER_ORDER, largest_first
from ledgerlift.plans import run
from ledgerlift.schemas import BALANCE, CATEGORY_SPEND
from ledgerlift.sources import (
    read_bronze,
    read_csv,
    read_silver,
    scratch_path,
    write_report,
    write_table,
)

try:
    import corpus_pipeline
    from ledgerlift.llm import registry as llm
except ModuleNotFoundError as error:  # the package llm and its pipeline may be left out
    if error.name != "corpus_pipeline" and (error.name or "").split(".")[:2] != ["ledgerlift", "llm"]:
        raise
    corpus_pipeline = llm = None

Query = Callable[[SparkSession, str], DataFrame]
Source = Callable[[SparkSession, str], DataFrame]


def _on_bronze(source: Source, build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(source(spark, sf_dir))


def _on_silver(source: Source, build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(to_silver(source(spark, sf_dir)))


def _cleaned(clean: Callable[[Column], Column], raw: str, name: str) -> Query:
    """One cleaning function over every bronze row."""
    return _on_bronze(
        bronze_from_orders,
        lambda bronze: bronze.select("id_transaccion", clean(F.col(raw)).alias(name)),
    )


def _clean_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label cleaning over whole texts in several languages."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return documents.select("doc_id", clean_label(F.col("text")).alias("categoria"))


def _top_categories(n: int) -> Callable[[DataFrame], DataFrame]:
    return lambda silver: top_k(category_spend(silver), n, *SPEND_ORDER)


def _top_users(silver: DataFrame) -> DataFrame:
    return top_k(user_totals(silver), 10, *USER_ORDER)


def _balance_share(silver: DataFrame) -> DataFrame:
    return share_of_total(balance(silver), "total_monto", "tipo_transaccion")


def _bronze_csv(spark: SparkSession, sf_dir: str, source: Source = bronze_from_orders) -> str:
    path = scratch_path(spark, "bronze")
    # Bronze must arrive as it is, with the blanks around its values.
    source(spark, sf_dir).write.options(
        header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
    return path


def _csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_silver(read_bronze(spark, _bronze_csv(spark, sf_dir)))


def _mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver from a folder whose files have their columns in three orders, one with one more."""
    folder = scratch_path(spark, "mixed")
    bronze = bronze_from_orders(spark, sf_dir)
    names, part = bronze.columns, F.pmod(F.hash("id_transaccion"), F.lit(3))
    headers = [names, names[::-1], [*names[3:], "nota", *names[:3]]]
    for k, header in enumerate(headers):
        rows = bronze.where(part == k).withColumn("nota", F.lit("x")).select(*header)
        rows.write.options(
            header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        ).csv(f"{folder}/k={k}")
    return to_silver(read_bronze(spark, folder))


def _replaced_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze cleaned in the place where it was: the new table is complete before the old one goes."""
    path = scratch_path(spark, "table")
    write_table(bronze_from_orders(spark, sf_dir), path)
    write_table(to_silver(spark.read.parquet(path)), path)
    return read_silver(spark, path)


def _discounted_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts with many binary places, added without loss."""
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    amount = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    totals = exact_sums(
        lineitem.withColumn("amount", amount),
        ["l_returnflag", "l_linestatus"],
        "amount",
        "total",
        {"operations": "l_orderkey"},
    )
    return totals.withColumn("total", F.round("total", 4))


def _silver_export(fmt: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, "silver")
        write_table(to_silver(bronze_from_orders(spark, sf_dir)), path, fmt)
        return read_silver(spark, path, fmt)

    return query


def _balance_report_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "gold_balance")
    report = balance(to_silver(bronze_from_orders(spark, sf_dir)))
    write_report(report, path, "tipo_transaccion", one_file=True)
    if len(files := spark.read.text(path).inputFiles()) != 1:
        raise AssertionError(f"one file expected, found {files}")
    return read_csv(spark, path, BALANCE)


def _category_report_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "gold_categorias")
    report = category_spend(to_silver(bronze_from_orders(spark, sf_dir)), ranked=False)
    write_report(report, path, *largest_first(*SPEND_ORDER))
    return read_csv(spark, path, CATEGORY_SPEND)


def _whole_job(source: Source, report: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        result = run(spark, _bronze_csv(spark, sf_dir, source), scratch_path(spark, "job"))
        return getattr(result, report)

    return query


def _whole_job_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts that the job observed while it wrote silver."""
    result = run(spark, _bronze_csv(spark, sf_dir), scratch_path(spark, "job"))
    counts = result._asdict()
    names = ("filas_bronze", "filas_silver", "filas_descartadas")
    return spark.range(1).select(*(F.lit(counts[n]).cast("bigint").alias(n) for n in names))


def entry(spark: SparkSession) -> DataFrame:
    """The whole job on the smallest tables: how much came in and went out?"""
    return _whole_job(bronze_from_orders, "balance")(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return _job_queries() | _llm_queries()


def _llm_queries() -> dict[str, Query]:
    return llm.queries() | {"pipeline": corpus_pipeline.run} if llm else {}


def _job_queries() -> dict[str, Query]:
    orders, lineitem = bronze_from_orders, bronze_from_lineitem
    return {
        "parse_money": _cleaned(parse_money, "monto_str", "monto"),
        "parse_date_multi": _cleaned(parse_date_multi, "fecha_operacion", "fecha"),
        "clean_label": _cleaned(clean_label, "categoria_raw", "categoria"),
        "clean_label_texts": _clean_texts,
        "map_movement": _cleaned(map_synonyms, "tipo_movimiento", "tipo_transaccion"),
        "silver": _on_bronze(orders, to_silver),
        "silver_preview": _on_silver(orders, lambda s: preview(s, 10, "id_transaccion")),
        "quality_counts": _on_bronze(orders, quality_counts),
        "expense_rows": _on_silver(orders, expense_rows),
        "gold_balance": _on_silver(orders, balance),
        "gold_category_spend": _on_silver(orders, category_spend),
        "top5_categories": _on_silver(orders, _top_categories(5)),
        "top10_categories": _on_silver(orders, _top_categories(10)),
        "gold_user_totals": _on_silver(orders, user_totals),
        "top10_users": _on_silver(orders, _top_users),
        "balance_share": _on_silver(orders, _balance_share),
        "gold_balance_exact": _on_silver(orders, lambda s: balance(s, exact=True)),
        "gold_category_spend_exact": _on_silver(orders, lambda s: category_spend(s, exact=True)),
        "gold_user_totals_exact": _on_silver(orders, lambda s: user_totals(s, exact=True)),
        "lineitem_discounted_totals": _discounted_totals,
        "schema_report": _on_silver(orders, schema_report),
        "csv_roundtrip": _csv_roundtrip,
        "csv_mixed_headers": _mixed_headers,
        "silver_replaced": _replaced_table,
        "silver_export": _silver_export("parquet"),
        "silver_export_csv": _silver_export("csv"),
        "balance_report_csv": _balance_report_csv,
        "category_report_csv": _category_report_csv,
        "whole_job_balance": _whole_job(orders, "balance"),
        "whole_job_counts": _whole_job_counts,
        "whole_job_user_totals": _whole_job(orders, "user_totals"),
        "lineitem_silver": _on_bronze(lineitem, to_silver),
        "lineitem_quality_counts": _on_bronze(lineitem, quality_counts),
        "lineitem_gold_balance": _on_silver(lineitem, balance),
        "lineitem_gold_category_spend": _on_silver(lineitem, category_spend),
        "lineitem_gold_user_totals": _on_silver(lineitem, user_totals),
        "lineitem_top10_categories": _on_silver(lineitem, _top_categories(10)),
        "lineitem_top10_users": _on_silver(lineitem, _top_users),
        "lineitem_whole_job_category_spend": _whole_job(lineitem, "category_spend"),
    }


# Every row as bronze has it, cleaned: null where the fixture made the value unreadable.
_ORDERS_ROWS = """
    SELECT CAST(o_orderkey AS VARCHAR) AS id_transaccion,
           CAST(o_custkey AS VARCHAR) AS id_usuario,
           CASE WHEN o_orderkey % 40 NOT IN (6, 7) AND isfinite(o_totalprice)
                THEN o_totalprice END AS monto,
           CASE WHEN o_orderkey % 50 <> 11 THEN CAST(o_orderdate AS DATE) END AS fecha,
           CASE o_orderkey % 3
                WHEN 2 THEN replace(replace(lower(o_orderpriority), ' ', ''), '-', '')
                ELSE replace(o_orderpriority, '-', '') END AS categoria,
           CASE WHEN o_orderstatus = 'P' AND o_orderkey % 10 = 3 THEN NULL
                WHEN o_orderstatus = 'O' THEN 'INGRESO' ELSE 'EGRESO' END AS tipo_transaccion
    FROM orders"""

_LINEITEM_ROWS = """
    SELECT l_orderkey || '-' || l_linenumber AS id_transaccion,
           CAST(l_suppkey AS VARCHAR) AS id_usuario,
           CASE WHEN k % 40 NOT IN (6, 7) AND isfinite(l_extendedprice)
                THEN l_extendedprice END AS monto,
           CASE WHEN k % 50 <> 11 THEN CAST(l_shipdate AS DATE) END AS fecha,
           CASE k % 3 WHEN 2 THEN 'parttype' ELSE 'Parttype ' END
               || CAST(l_partkey % 500 AS VARCHAR) AS categoria,
           CASE WHEN l_returnflag = 'N' AND k % 10 = 3 THEN NULL
                WHEN l_linestatus = 'O' THEN 'INGRESO' ELSE 'EGRESO' END AS tipo_transaccion
    FROM (SELECT *, l_orderkey * 8 + l_linenumber AS k FROM lineitem)"""

_COMPLETE = "monto IS NOT NULL AND fecha IS NOT NULL AND tipo_transaccion IS NOT NULL"
# Exact in DuckDB whatever the order of its rows: all amounts of the test tables are whole cents.
_TOTAL = "CAST(sum(CAST(monto AS DECIMAL(18, 2))) AS DOUBLE)"

_COUNTS = f"""
    SELECT count(*) AS filas_bronze,
           count(*) FILTER ({_COMPLETE}) AS filas_silver,
           count(*) - count(*) FILTER ({_COMPLETE}) AS filas_descartadas
    FROM bronze_rows"""
_BALANCE = f"""
    SELECT tipo_transaccion, {_TOTAL} AS total_monto,
           count(id_transaccion) AS total_operaciones
    FROM silver GROUP BY tipo_transaccion"""
_CATEGORIES = f"""
    SELECT categoria, {_TOTAL} AS total_gastado
    FROM silver WHERE tipo_transaccion = 'EGRESO' GROUP BY categoria
    ORDER BY total_gastado DESC NULLS LAST, categoria ASC NULLS LAST"""
_USERS = f"""
    SELECT id_usuario, tipo_transaccion, {_TOTAL} AS monto_total
    FROM silver GROUP BY id_usuario, tipo_transaccion
    ORDER BY monto_total DESC NULLS LAST, id_usuario ASC NULLS LAST, tipo_transaccion"""
# Each amount is a whole multiple of 2^-53, so the sum of these is exact in 128 bits.
_DISCOUNTED = """
    SELECT l_returnflag, l_linestatus, round(CAST(sum(CAST(
               l_extendedprice * (1 - l_discount) * (1 + l_tax) * pow(2, 53) AS HUGEINT))
               AS DOUBLE) / pow(2, 53), 4) AS total, count(l_orderkey) AS operations
    FROM lineitem GROUP BY ALL"""
_SCHEMA = " UNION ALL ".join(
    f"SELECT {i} AS position, '{name}' AS name, '{kind}' AS type, "
    f"count(*) AS n_rows, count({name}) AS n_filled FROM silver"
    for i, (name, kind) in enumerate(
        [
            ("id_transaccion", "string"),
            ("id_usuario", "string"),
            ("monto", "double"),
            ("fecha", "date"),
            ("categoria", "string"),
            ("tipo_transaccion", "string"),
        ]
    )
)
_TOP_CATEGORIES = _CATEGORIES + " LIMIT "
_TOP_USERS = _USERS + " LIMIT 10"

# The kept characters one by one, not as the class that the library deletes the others of. Fixed
# values.
_KEPT = (
    "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    "áéíóúÁÉÍÓÚñÑ "
)
_CLEAN_TEXTS = f"""
    SELECT doc_id, CASE WHEN text IS NULL THEN NULL ELSE trim(array_to_string(list_filter(
        list_transform(range(1, length(text) + 1), lambda i: substr(text, i, 1)),
        lambda c: contains('{_KEPT}', c)), ''), ' ') END AS categoria
    FROM documents"""


def oracle_sql() -> dict[str, str]:
    return _job_oracles() | (llm.oracle_sql() if llm else {})


def _job_oracles() -> dict[str, str]:
    def over(rows: str, select: str) -> str:
        return (
            f"WITH bronze_rows AS ({rows}),\n"
            f"silver AS (SELECT * FROM bronze_rows WHERE {_COMPLETE})\n{select}"
        )

    def orders(select: str) -> str:
        return over(_ORDERS_ROWS, select)

    def lineitem(select: str) -> str:
        return over(_LINEITEM_ROWS, select)

    def one_column(name: str) -> str:
        return orders(f"SELECT id_transaccion, {name} FROM bronze_rows")

    silver = "SELECT * FROM silver"
    return {
        "parse_money": one_column("monto"),
        "parse_date_multi": one_column("fecha"),
        "clean_label": one_column("categoria"),
        "clean_label_texts": _CLEAN_TEXTS,
        "map_movement": one_column("tipo_transaccion"),
        "silver": orders(silver),
        "silver_preview": orders(silver + " ORDER BY ALL LIMIT 10"),
        "quality_counts": orders(_COUNTS),
        "expense_rows": orders(silver + " WHERE tipo_transaccion = 'EGRESO'"),
        "gold_balance": orders(_BALANCE),
        "gold_category_spend": orders(_CATEGORIES),
        "top5_categories": orders(_TOP_CATEGORIES + "5"),
        "top10_categories": orders(_TOP_CATEGORIES + "10"),
        "gold_user_totals": orders(_USERS),
        "top10_users": orders(_TOP_USERS),
        "balance_share": orders(
            "SELECT tipo_transaccion, round(100 * total_monto / sum(total_monto) OVER (), 1) "
            f"AS porcentaje FROM ({_BALANCE})"
        ),
        "gold_balance_exact": orders(_BALANCE),
        "gold_category_spend_exact": orders(_CATEGORIES),
        "gold_user_totals_exact": orders(_USERS),
        "lineitem_discounted_totals": _DISCOUNTED,
        "schema_report": orders(_SCHEMA),
        "csv_roundtrip": orders(silver),
        "csv_mixed_headers": orders(silver),
        "silver_replaced": orders(silver),
        "silver_export": orders(silver),
        "silver_export_csv": orders(silver),
        "balance_report_csv": orders(_BALANCE),
        "category_report_csv": orders(_CATEGORIES),
        "whole_job_balance": orders(_BALANCE),
        "whole_job_counts": orders(_COUNTS),
        "whole_job_user_totals": orders(_USERS),
        "lineitem_silver": lineitem(silver),
        "lineitem_quality_counts": lineitem(_COUNTS),
        "lineitem_gold_balance": lineitem(_BALANCE),
        "lineitem_gold_category_spend": lineitem(_CATEGORIES),
        "lineitem_gold_user_totals": lineitem(_USERS),
        "lineitem_top10_categories": lineitem(_TOP_CATEGORIES + "10"),
        "lineitem_top10_users": lineitem(_TOP_USERS),
        "lineitem_whole_job_category_spend": lineitem(_CATEGORIES),
    }
