"""Silver to gold: the business reports."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift.defaults import EXPENSE
from ledgerlift.functions import sum_money
from ledgerlift.operators.exact import exact_sums

# The measure that ranks a report, then the keys that settle ties.
SPEND_ORDER = ("total_gastado", "categoria")
USER_ORDER = ("monto_total", "id_usuario", "tipo_transaccion")


def _totals(
    silver: DataFrame, keys: list[str], name: str, exact: bool, counted: dict[str, str] | None = None
) -> DataFrame:
    """Money per group, to the cent. ``exact`` adds amounts of any kind without loss."""
    if exact:
        totals = exact_sums(silver, keys, "monto", name, counted)
        return totals.withColumn(name, F.round(name, 2))
    counts = [F.count(c).alias(out) for out, c in (counted or {}).items()]
    return silver.groupBy(*keys).agg(F.round(sum_money(F.col("monto")), 2).alias(name), *counts)


def balance(silver: DataFrame, exact: bool = False) -> DataFrame:
    """Total and number of operations per movement type. Operations without an id do not count."""
    counted = {"total_operaciones": "id_transaccion"}
    return _totals(silver, ["tipo_transaccion"], "total_monto", exact, counted)


def expense_rows(silver: DataFrame) -> DataFrame:
    return silver.filter(F.col("tipo_transaccion") == EXPENSE)


def category_spend(silver: DataFrame, ranked: bool = True, exact: bool = False) -> DataFrame:
    """Expenses per category, the largest first. Null and empty categories are groups too."""
    spend = _totals(expense_rows(silver), ["categoria"], "total_gastado", exact)
    return spend.orderBy(*largest_first(*SPEND_ORDER)) if ranked else spend


def user_totals(silver: DataFrame, ranked: bool = True, exact: bool = False) -> DataFrame:
    """Total per user and movement type, the largest first."""
    totals = _totals(silver, ["id_usuario", "tipo_transaccion"], "monto_total", exact)
    return totals.orderBy(*largest_first(*USER_ORDER)) if ranked else totals


def largest_first(by: str, *keys: str) -> list:
    """Sort order by a measure, with the group's keys to settle ties."""
    return [F.desc(by), *(F.asc_nulls_last(k) for k in keys)]


def top_k(report: DataFrame, n: int, by: str, *keys: str) -> DataFrame:
    """The n rows with the largest measure."""
    return report.orderBy(*largest_first(by, *keys)).limit(n)


def preview(df: DataFrame, n: int, key: str | None = None) -> DataFrame:
    """The first n rows by a key; the other columns settle ties.

    Without a key any n rows, which reads no more of the table than it takes to find them.
    """
    if key is None:
        return df.limit(n)
    others = (c for c in df.columns if c != key)
    return df.orderBy(*(F.asc_nulls_last(c) for c in (key, *others))).limit(n)


def schema_report(df: DataFrame) -> DataFrame:
    """A row per column: its ``position``, ``name`` and ``type``, all rows and those with a value.

    The counts are one pass, whose one row is then turned into one for each column.
    """
    counted = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.array(*(F.count(F.col(f"`{f.name}`")) for f in df.schema)).alias("n_filled"),
    )
    columns = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("name"),
            F.lit(f.dataType.simpleString()).alias("type"),
            "n_rows",
            F.col("n_filled")[i].alias("n_filled"),
        )
        for i, f in enumerate(df.schema)
    ]
    return counted.select(F.inline(F.array(*columns)))


def share_of_total(
    report: DataFrame, measure: str, *keys: str, name: str = "porcentaje"
) -> DataFrame:
    """Each group's percentage of the column's sum, with one decimal.

    The sum is a scalar subquery, so no task ever holds the whole report. Groups and sum need the
    same columns, which lets Spark use one aggregation for both.
    """
    groups = report.select(*keys, measure)
    total = groups.agg(sum_money(F.col(measure))).scalar()
    share = F.round(F.try_divide(100 * F.col(measure), total), 1)
    return groups.select(*keys, share.alias(name))
