"""Silver and gold on small hand-made rows."""

from datetime import date

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from ledgerlift.operators import (
    balance,
    category_spend,
    clean_rows,
    expense_rows,
    preview,
    quality_counts,
    share_of_total,
    to_silver,
    top_k,
    user_totals,
)
from ledgerlift.schemas import (
    BALANCE,
    BRONZE,
    CATEGORY_SPEND,
    SILVER,
    USER_TOTALS,
    check_schema,
)

INF = float("inf")
GOOD = ("T", "U", "$1.00", "2025-04-25", "Renta", "cargo")


def bronze_row(**changes):
    return tuple(changes.get(f.name, v) for f, v in zip(BRONZE, GOOD))


KEPT = [
    GOOD,
    bronze_row(id_transaccion=None),
    bronze_row(id_usuario=None),
    bronze_row(categoria_raw=None),
    bronze_row(categoria_raw="@#$"),
    bronze_row(monto_str="Infinity"),
    bronze_row(monto_str="1.234,56"),
    bronze_row(fecha_operacion="04-05-2025"),
]
DROPPED = [
    bronze_row(monto_str="N/A"),
    bronze_row(monto_str=None),
    bronze_row(monto_str="NaN"),
    bronze_row(fecha_operacion="sin fecha"),
    bronze_row(fecha_operacion=None),
    bronze_row(tipo_movimiento="AJUSTE"),
    bronze_row(tipo_movimiento=" cargo"),
    bronze_row(tipo_movimiento=None),
]


@pytest.fixture
def bronze(spark):
    return spark.createDataFrame(KEPT + DROPPED, BRONZE)


@pytest.fixture
def silver(spark):
    """Ten rows with some users and categories in common, and two spellings of one category."""
    rows = [
        ("A-1", "ana", 120.5, date(2024, 2, 1), "Luz", "EGRESO"),
        ("A-2", "ben", 80.25, date(2024, 2, 1), "Agua", "EGRESO"),
        ("A-3", "ben", 1999.99, date(2024, 2, 3), "Viajes", "EGRESO"),
        ("A-4", "cruz", 310.0, date(2024, 2, 4), "gasolina", "EGRESO"),
        ("A-5", "dana", 9000.01, date(2024, 2, 5), "Sueldo", "INGRESO"),
        ("A-6", "elia", 4100.4, date(2024, 2, 6), "gasolina", "EGRESO"),
        ("A-7", "fede", 2750.35, date(2024, 2, 7), "LUZ", "EGRESO"),
        ("A-8", "fede", 640.1, date(2024, 2, 8), "Escuela", "EGRESO"),
        ("A-9", "gala", 515.15, date(2024, 2, 9), "Cine", "EGRESO"),
        ("A-10", "hugo", 12000.0, date(2024, 2, 10), "Ventas", "INGRESO"),
    ]
    return spark.createDataFrame(rows, SILVER)


def tuples(df):
    return [tuple(r) for r in df.collect()]


def test_silver_keeps_and_drops(any_ansi, bronze):
    silver = check_schema(to_silver(bronze), SILVER)
    rows = tuples(silver)
    day = date(2025, 4, 25)
    assert sorted(rows, key=repr) == sorted(
        [
            ("T", "U", 1.0, day, "Renta", "EGRESO"),
            (None, "U", 1.0, day, "Renta", "EGRESO"),
            ("T", None, 1.0, day, "Renta", "EGRESO"),
            ("T", "U", 1.0, day, None, "EGRESO"),
            ("T", "U", 1.0, day, "", "EGRESO"),
            ("T", "U", INF, day, "Renta", "EGRESO"),
            ("T", "U", 1.23456, day, "Renta", "EGRESO"),
            ("T", "U", 1.0, date(2025, 4, 5), "Renta", "EGRESO"),
        ],
        key=repr,
    )


def test_silver_is_na_drop(bronze):
    dropped = clean_rows(bronze).na.drop(subset=["monto", "fecha", "tipo_transaccion"])
    assert sorted(tuples(dropped), key=repr) == sorted(tuples(to_silver(bronze)), key=repr)


def test_counts_agree(any_ansi, bronze):
    counted = quality_counts(bronze).first()
    assert tuple(counted) == (len(KEPT) + len(DROPPED), len(KEPT), len(DROPPED))
    quality = Observation()
    assert to_silver(bronze, quality).count() == len(KEPT)
    assert quality.get == {"filas_bronze": counted[0], "filas_silver": counted[1]}


def test_counts_of_no_rows(bronze):
    assert tuple(quality_counts(bronze.limit(0)).first()) == (0, 0, 0)


def test_silver_can_be_used_many_times_in_a_query(bronze):
    silver = to_silver(bronze)
    assert silver.unionAll(to_silver(bronze)).count() == 2 * len(KEPT)
    ids = silver.filter(F.col("id_transaccion").isNotNull())
    assert ids.join(silver, "id_transaccion").count() == (len(KEPT) - 1) ** 2
    largest = silver.agg(F.max("monto")).scalar()
    assert silver.filter(F.col("monto") == largest).count() == 1


def test_balance(any_ansi, silver):
    report = check_schema(balance(silver), BALANCE)
    assert sorted(tuples(report)) == [("EGRESO", 10516.74, 8), ("INGRESO", 21000.01, 2)]


def test_a_missing_id_adds_to_the_sum_but_not_to_the_count(bronze):
    finite = to_silver(bronze).filter(F.col("monto") == 1)
    assert tuples(balance(finite)) == [("EGRESO", 6.0, 5)]


def test_category_spend(silver):
    report = check_schema(category_spend(silver), CATEGORY_SPEND)
    assert tuples(report) == [
        ("gasolina", 4410.4),
        ("LUZ", 2750.35),
        ("Viajes", 1999.99),
        ("Escuela", 640.1),
        ("Cine", 515.15),
        ("Luz", 120.5),
        ("Agua", 80.25),
    ]
    expenses = expense_rows(silver).agg(F.round(F.sum("monto"), 2)).first()[0]
    assert round(sum(r.total_gastado for r in report.collect()), 2) == expenses == 10516.74


def test_missing_categories_are_groups(bronze):
    spend = {r.categoria: r.total_gastado for r in category_spend(to_silver(bronze)).collect()}
    assert spend == {"Renta": INF, None: 1.0, "": 1.0}


def test_user_totals(silver):
    report = check_schema(user_totals(silver), USER_TOTALS)
    rows = tuples(report)
    assert rows[:3] == [
        ("hugo", "INGRESO", 12000.0),
        ("dana", "INGRESO", 9000.01),
        ("elia", "EGRESO", 4100.4),
    ]
    assert ("ben", "EGRESO", 2080.24) in rows and len(rows) == 8


def test_one_user_with_most_of_the_rows(spark):
    rows = spark.range(90_000, numPartitions=6).selectExpr(
        "cast(id as string) id_transaccion",
        "if(id % 3 < 2, 'hot', cast(id % 100 as string)) id_usuario",
        "1.25D monto",
        "date'2025-04-25' fecha",
        "'Renta' categoria",
        "'EGRESO' tipo_transaccion",
    )
    report = user_totals(rows).collect()
    assert report[0].id_usuario == "hot" and report[0].monto_total == 75_000.0
    assert len(report) == 101 and sum(r.monto_total for r in report) == 112_500.0


def test_a_missing_user_is_a_group(bronze):
    finite = to_silver(bronze).filter(F.col("monto") == 1)
    assert tuples(user_totals(finite)) == [("U", "EGRESO", 5.0), (None, "EGRESO", 1.0)]


def test_top_k_settles_ties_by_key(spark):
    report = spark.createDataFrame(
        [("d", 1.0), ("b", 2.0), (None, 2.0), ("a", 2.0), ("c", None)], "k string, v double"
    )
    assert tuples(top_k(report, 3, "v", "k")) == [("a", 2.0), ("b", 2.0), (None, 2.0)]
    assert tuples(top_k(report, 9, "v", "k"))[-1] == ("c", None)


def test_preview(silver):
    first = preview(silver, 3, "id_transaccion").collect()
    assert [r.id_transaccion for r in first] == ["A-1", "A-10", "A-2"]
    assert preview(silver, 3).count() == 3


def test_share_of_total(any_ansi):
    recorded = any_ansi.createDataFrame(
        [("EGRESO", 2579932.33, 640), ("INGRESO", 1890867.03, 120)], BALANCE
    )
    shares = share_of_total(recorded, "total_monto", "tipo_transaccion")
    assert sorted(tuples(shares)) == [("EGRESO", 57.7), ("INGRESO", 42.3)]


def test_share_of_nothing_is_null(any_ansi):
    zero = any_ansi.createDataFrame([("EGRESO", 0.0, 1)], BALANCE)
    assert tuples(share_of_total(zero, "total_monto", "tipo_transaccion")) == [("EGRESO", None)]


def test_check_schema_names_the_difference(silver):
    with pytest.raises(ValueError, match="schema mismatch"):
        check_schema(silver, BRONZE)
