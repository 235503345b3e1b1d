"""Bronze to silver: typed and cleaned rows, and what was lost on the way."""

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerlift.functions import clean_label, map_synonyms, parse_date_multi, parse_money


def clean_rows(bronze: DataFrame) -> DataFrame:
    """Every bronze row with silver's columns; what cannot be read is null.

    The three columns that decide whether a row is complete are bound once per row, as the fields of
    a generated row. A plain projection would not do: Spark moves filters below it and then computes
    each expression twice, for the filter and for the output. Filters on the ids still reach the scan.
    """
    needed = F.struct(
        parse_money(F.col("monto_str")).alias("monto"),
        parse_date_multi(F.col("fecha_operacion")).alias("fecha"),
        map_synonyms(F.col("tipo_movimiento")).alias("tipo_transaccion"),
    )
    bound = bronze.select(
        "id_transaccion", "id_usuario", "categoria_raw", F.inline(F.array(needed))
    )
    return bound.select(
        "id_transaccion",
        "id_usuario",
        "monto",
        "fecha",
        clean_label(F.col("categoria_raw")).alias("categoria"),
        "tipo_transaccion",
    )


def is_complete() -> Column:
    """Whether a cleaned row belongs to silver. Neither the ids nor the category are needed."""
    return (
        F.col("tipo_transaccion").isNotNull()
        & F.col("fecha").isNotNull()
        & F.col("monto").isNotNull()
        & ~F.isnan("monto")
    )


def _counts() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("filas_bronze"),
        F.count_if(is_complete()).alias("filas_silver"),
    ]


def to_silver(bronze: DataFrame, quality: Observation | None = None) -> DataFrame:
    """The complete rows, cleaned, each value once; labels only in rows that stay.

    Filters on the ids reach the scan, and columns that are not used are not read. Give an
    ``Observation`` to get the counts of bronze and silver rows from the action that runs silver,
    without another scan; Spark moves no filter below an observation.
    """
    rows = clean_rows(bronze)
    return (rows.observe(quality, *_counts()) if quality else rows).filter(is_complete())


def quality_counts(bronze: DataFrame) -> DataFrame:
    """One row: bronze rows, silver rows and the difference, in one pass."""
    return clean_rows(bronze).agg(*_counts()).withColumn(
        "filas_descartadas", F.col("filas_bronze") - F.col("filas_silver")
    )
