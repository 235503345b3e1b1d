"""Messy bronze rows made from clean test tables, for the tests and the registered queries."""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlift.defaults import DATE_FORMATS


def _pick(k: Column, *choices: Column | str) -> Column:
    """The choice at position ``k`` modulo their number; only that one is computed."""
    turns = enumerate(choices)
    return reduce(lambda case, turn: case.when(k % len(choices) == turn[0], turn[1]), turns, F)


def _bronze(
    df: DataFrame, k: Column, key: Column, user: Column, price: Column, day: Column,
    label: Column, void: Column, income: Column,
) -> DataFrame:
    """Write clean columns the way bronze has them, with the kind of mess chosen by ``k``."""
    grouped = F.format_number(price, 2)
    money = _pick(
        k,
        F.concat(F.lit("$"), grouped),
        F.concat(grouped, F.lit(" MXN")),
        F.concat(F.lit("$ "), grouped, F.lit(" MXN")),
        F.concat(F.lit("MXN "), grouped),
        F.replace(grouped, F.lit(","), F.lit("")),
        F.concat(F.lit(" "), grouped, F.lit(" ")),
    )
    return df.select(
        key.alias("id_transaccion"),
        user.cast("string").alias("id_usuario"),
        F.when(k % 40 == 6, "N/A").when(k % 40 != 7, money).alias("monto_str"),
        F.when(k % 50 == 11, "sin fecha")
        .otherwise(_pick(k, *(F.date_format(day, f) for f in DATE_FORMATS)))
        .alias("fecha_operacion"),
        _pick(
            k,
            label,
            F.concat(F.lit(" "), label, F.lit("! ")),
            F.replace(F.lower(label), F.lit(" "), F.lit("_")),
        ).alias("categoria_raw"),
        F.when(void, "AJUSTE")
        .when(income, _pick(k, "abono", "INGRESO", "Credito", "cr"))
        .otherwise(_pick(k, "cargo", "Egreso", "DEBITO", "db"))
        .alias("tipo_movimiento"),
    )


def bronze_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, status = F.col("o_orderkey"), F.col("o_orderstatus")
    return _bronze(
        spark.read.parquet(f"{sf_dir}/orders.parquet"),
        k=k,
        key=k.cast("string"),
        user=F.col("o_custkey"),
        price=F.col("o_totalprice"),
        day=F.col("o_orderdate"),
        label=F.col("o_orderpriority"),
        void=(status == "P") & (k % 10 == 3),
        income=status == "O",
    )


def bronze_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    k = order * 8 + line
    return _bronze(
        spark.read.parquet(f"{sf_dir}/lineitem.parquet"),
        k=k,
        key=F.concat_ws("-", order.cast("string"), line.cast("string")),
        user=F.col("l_suppkey"),
        price=F.col("l_extendedprice"),
        day=F.col("l_shipdate"),
        label=F.concat(F.lit("Part-type "), (F.col("l_partkey") % 500).cast("string")),
        void=(F.col("l_returnflag") == "N") & (k % 10 == 3),
        income=F.col("l_linestatus") == "O",
    )
