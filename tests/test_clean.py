"""The cleaning functions on the strings that are easy to get wrong."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerlift.defaults import DATE_FORMATS
from ledgerlift.functions import clean_label, map_synonyms, parse_date_multi, parse_money
from ledgerlift.functions.clean import _date_shape

NBSP, ACUTE = " ", "́"

MONEY = {
    "$1,234.50": 1234.5,
    "1234.50 MXN": 1234.5,
    "MXN 12.5": 12.5,
    "$ 9.5": 9.5,
    "  7.25 ": 7.25,
    "\t7.25\n": 7.25,
    "-3.5": -3.5,
    "1.234,56": 1.23456,
    "1e3": 1000.0,
    "12d": 12.0,
    "12f": 12.0,
    "Infinity": float("inf"),
    "5 $ MXN": 5.0,
    "M$XN 5": 5.0,
    "1 MXN 2": 12.0,
    "mxn 5": None,
    "USD 5": None,
    "(12.0)": None,
    "N/A": None,
    "$": None,
    "": None,
    "1 234.5": None,
    NBSP + "5": None,
    None: None,
}

APRIL_25 = date(2025, 4, 25)
DATES = {
    "2025-04-25": APRIL_25,
    "25/04/2025": APRIL_25,
    "04-25-2025": APRIL_25,
    "25-Apr-2025": APRIL_25,
    "25-APR-2025": APRIL_25,
    "2025/04/25": APRIL_25,
    "04-05-2025": date(2025, 4, 5),
    "02-29-2024": date(2024, 2, 29),
    **{
        f"05-{name}-2025": date(2025, month, 5)
        for name, month in {
            "feb": 2, "mar": 3, "may": 5, "jun": 6, "jul": 7, "sep": 9, "oct": 10, "nov": 11
        }.items()
    },
    **dict.fromkeys(
        [
            "25-04-2025", "29-02-2024", "2025-02-30", "0000-00-00", "13/13/2025", "32/01/2025",
            "2025-4-5", "5/4/2025", "25/04/25", " 2025-04-25", "2025-04-25 ", "2025-04-25\n",
            "2025-04-25 10:00:00", "2025-04-25T00:00:00", "05-ene-2025", "05-abr-2025",
            "05-ago-2025", "05-dic-2025", "05-Sept-2025", "", None,
        ]
    ),
}

LABELS = {
    "Sérvicios": "Sérvicios",
    "SERVICIOS": "SERVICIOS",
    "renta_mensual": "rentamensual",
    "Súper-mercado!": "Súpermercado",
    "  Ocio  ": "Ocio",
    "! Ocio !": "Ocio",
    "Café\tBar": "CaféBar",
    "pingüino": "pingino",
    "Cafe" + ACUTE: "Cafe",
    "A  B": "A  B",
    "ÁÉÍÓÚÑ áéíóúñ 09": "ÁÉÍÓÚÑ áéíóúñ 09",
    "日本 ４": "",
    "@#$": "",
    "": "",
    None: None,
}

MOVEMENTS = {
    **dict.fromkeys(["abono", "Abono", "INGRESO", "Credito", "CR", "cr"], "INGRESO"),
    **dict.fromkeys(["cargo", "Egreso", "DEBITO", "db"], "EGRESO"),
    **dict.fromkeys(["Débito", "CRÉDITO", " cargo", "cargo ", "XX", "", None]),
}


def apply(spark, function, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "s string")
    return {r.s: r.v for r in rows.select("s", function(F.col("s")).alias("v")).collect()}


@pytest.mark.parametrize(
    "function, expected",
    [
        (parse_money, MONEY),
        (parse_date_multi, DATES),
        (clean_label, LABELS),
        (map_synonyms, MOVEMENTS),
    ],
    ids=["money", "date", "label", "movement"],
)
def test_probe_strings(any_ansi, function, expected):
    assert apply(any_ansi, function, expected) == expected


def test_money_reads_nan(spark):
    assert str(apply(spark, parse_money, ["$NaN"])["$NaN"]) == "nan"


def test_other_vocabulary(spark):
    euros = apply(spark, lambda c: parse_money(c, symbols="€.", word="EUR"), ["€1.234 EUR"])
    assert euros == {"€1.234 EUR": 1234.0}
    upper_only = apply(spark, lambda c: clean_label(c, keep="A-Z"), ["aB C"])
    assert upper_only == {"aB C": "BC"}
    colours = {"warm": ["RED"], "cold": ["BLUE", "GREEN"]}
    found = apply(spark, lambda c: map_synonyms(c, colours), ["red", "Green", "grey"])
    assert found == {"red": "warm", "Green": "cold", "grey": None}


def test_unknown_date_piece_is_tried_on_every_text(spark):
    assert _date_shape("yyyyMMdd") is None
    assert _date_shape("d/M/yyyy") is None
    assert _date_shape("'on' dd/MM/yyyy") is None
    assert _date_shape("dd/MM[/yyyy]") is None
    formats = ["yyyyMMdd", "d/M/yyyy", "[dd/]MM/yyyy", "dd.MM.yyyy"]
    texts = ["20250425", "5/4/2025", "25.04.2025"]
    read = apply(spark, lambda c: parse_date_multi(c, formats), texts)
    assert read == {"20250425": APRIL_25, "5/4/2025": date(2025, 4, 5), "25.04.2025": APRIL_25}


def date_like_texts(n=20_000):
    """Dates in every format, some with a broken, signed or long piece."""
    pick = random.Random(7)
    years = ["2025", "1999", "0001", "0000", "9999", "12025", "+12025", "-2025", "+2025", "25"]
    numbers = ["01", "02", "04", "12", "13", "25", "29", "30", "31", "32", "00", "5", "+5", "-1"]
    months = ["Jan", "FEB", "sep", "Sept", "September", "ene", "May", "04", "", "Mayo"]
    noise = [""] * 20 + [" ", "\n", "x", "T00:00:00", NBSP]
    for _ in range(n):
        text = pick.choice(DATE_FORMATS)
        text = text.replace("yyyy", pick.choice(years)).replace("dd", pick.choice(numbers))
        text = text.replace("MMM", pick.choice(months)).replace("MM", pick.choice(numbers))
        yield pick.choice(noise) + text + pick.choice(noise)


def test_shapes_reject_nothing_that_a_format_reads(spark):
    texts = list(date_like_texts())
    rows = spark.createDataFrame([(t,) for t in texts], "s string")
    plain = F.coalesce(*(F.try_to_date("s", fmt) for fmt in DATE_FORMATS))
    checked = rows.select(
        F.count(plain).alias("read"),
        F.count_if(~plain.eqNullSafe(parse_date_multi(F.col("s")))).alias("different"),
        F.count_if(plain > "9999-12-31").alias("long_years"),
        F.count_if(plain < "0000-01-01").alias("negative_years"),
    ).first()
    assert checked.different == 0
    assert checked.read > 500 and checked.long_years and checked.negative_years


@pytest.mark.parametrize("policy", ["EXCEPTION", "LEGACY"])
def test_dates_do_not_depend_on_the_parser_policy(spark, policy):
    probes = [*DATES, "05-September-2025", "05-sept-2025"]
    spark.conf.set("spark.sql.legacy.timeParserPolicy", policy)
    try:
        read = apply(spark, parse_date_multi, probes)
    finally:
        spark.conf.set("spark.sql.legacy.timeParserPolicy", "CORRECTED")
    assert read == {probe: DATES.get(probe) for probe in probes}


@pytest.mark.parametrize("zone", ["America/Sao_Paulo", "Asia/Kolkata", "America/Mexico_City"])
def test_dates_do_not_depend_on_the_time_zone(spark, zone):
    """October 15, 2017 had no midnight in Sao Paulo."""
    probes = {**DATES, "15/10/2017": date(2017, 10, 15), "0001-01-01": date(1, 1, 1)}
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        read = apply(spark, parse_date_multi, probes)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert read == probes


def test_words_are_found_in_any_case(spark):
    found = apply(spark, lambda c: map_synonyms(c, {"warm": ["Red", "amber"]}), ["RED", "Amber"])
    assert set(found.values() if isinstance(found, dict) else found) == {"warm"}


def test_nothing_to_map_or_parse_is_an_error():
    with pytest.raises(ValueError, match="no words"):
        map_synonyms(F.col("s"), {})
    with pytest.raises(ValueError, match="no date format"):
        parse_date_multi(F.col("s"), [])
