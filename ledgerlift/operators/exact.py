"""Sums of any doubles, rounded once: the same bits whatever the order of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A double is a whole multiple of 2^-1074. In that unit it is written in digits of so many bits, each
# of which is summed on its own; a sum of digits cannot overflow below 2^45 rows a group.
_BITS = 18
_MASK = (1 << _BITS) - 1
_UNIT = -1074
#: Digits that the 53 bits of one double can touch.
_DIGITS = 4
#: Digits that the sum of 2^45 digits can carry on to.
_CARRY = 4


def exact_sums(
    df: DataFrame, keys: list[str], measure: str, name: str, counted: dict[str, str] | None = None
) -> DataFrame:
    """A row per group of ``keys`` with the exact sum of a double column, rounded to a double once.

    Adding doubles gives another answer for each order of the rows, and loses small amounts beside
    large ones. Here each double is taken apart into integer digits, the digits of each place are
    summed per task and then per group, and a group's at most 117 places are carried and rounded at
    the end. Null if a group has no amount; NaN if it has one, or both infinities. ``counted`` names
    counts of columns, which skip nulls. Null keys are keys, and no keys give one row.
    """
    counted = counted or {}
    x, group, first = F.col("_x"), [F.col(k) for k in keys], F.col("_first")
    finite = F.abs(x) < float("inf")  # not so for null; NaN is the largest double
    columns = {*keys, *counted.values()}
    rows = df.select(*columns, F.col(measure).cast("double").alias("_x"))
    by_place = (
        _digits(rows, finite)
        .groupBy(*group, "_place")
        .agg(
            F.sum("_digit").alias("_sum"),
            F.sum(F.when(~finite, x)).alias("_other"),
            F.count(F.when(first, x)).alias("_n"),
            *(F.count(F.when(first, F.col(c))).alias(out) for out, c in counted.items()),
        )
    )
    places = F.collect_list(F.when(F.col("_sum") != 0, F.struct("_place", "_sum")))
    grouped = by_place.groupBy(*group).agg(
        F.map_from_entries(places).alias("_sums"),
        F.sum("_other").alias("_other"),
        F.sum("_n").alias("_n"),
        *(F.coalesce(F.sum(out), F.lit(0)).alias(out) for out in counted),
    )
    total = F.coalesce(F.col("_other"), F.when(F.col("_n") > 0, F.col("_total")))
    return _rounded(grouped, "_sums", "_total").select(*group, total.alias(name), *counted)


def _digits(df: DataFrame, finite: Column) -> DataFrame:
    """Each row's digits with their places; a row without any has one digit of zero."""
    x = F.col("_x")
    exponent = F.floor(F.log2(F.abs(x))).cast("int")
    # The logarithm may be too small by one, never by more.
    top = F.floor((exponent + 1 - _UNIT) / _BITS).cast("int")
    rows = df.withColumn("_top", F.when(finite & (x != 0), top))
    # Zero below the first place, where nothing can be left either.
    rows = rows.withColumn("_unit0", F.pow(F.lit(2.0), F.col("_top") * _BITS + _UNIT))
    rows = rows.withColumn("_rest0", x)
    for k in range(_DIGITS):
        unit, rest = F.col(f"_unit{k}"), F.col(f"_rest{k}")
        digit = F.when(unit > 0, F.try_divide(rest, unit)).otherwise(0.0).cast("bigint")
        rows = rows.withColumn(f"_digit{k}", F.when(F.col("_top").isNotNull(), digit))
        rows = rows.withColumn(f"_rest{k + 1}", rest - F.col(f"_digit{k}") * unit)
        rows = rows.withColumn(f"_unit{k + 1}", unit * 2.0**-_BITS)

    def entry(place: Column, digit: Column, first: bool) -> Column:
        return F.struct(place.alias("_place"), digit.alias("_digit"), F.lit(first).alias("_first"))

    some = [entry(F.col("_top") - k, F.col(f"_digit{k}"), k == 0) for k in range(_DIGITS)]
    none = entry(F.lit(None).cast("int"), F.lit(0).cast("bigint"), True)
    entries = F.when(F.col("_top").isNotNull(), F.array(*some)).otherwise(F.array(none))
    return rows.select(*df.columns, F.inline(entries))


def _carried(sums: Column) -> Column:
    """``carry`` and ``digits`` of sums of digits, the lowest first, after carrying."""
    start = F.struct(
        F.lit(0).cast("bigint").alias("carry"), F.array().cast("array<bigint>").alias("digits")
    )

    def step(state: Column, value: Column) -> Column:
        total = state["carry"] + value
        digit = F.array(total.bitwiseAND(F.lit(_MASK).cast("bigint")))
        return F.struct(
            F.shiftright(total, _BITS).alias("carry"),
            F.concat(state["digits"], digit).alias("digits"),
        )

    return F.aggregate(sums, start, step)


def _left(value: Column, bits: Column) -> Column:
    return F.call_function("shiftleft", value, bits)


def _rounded(df: DataFrame, sums: str, name: str) -> DataFrame:
    """Adds the double nearest to the number whose digits a map from places has."""
    places = F.map_keys(sums)
    low = F.array_min(places)
    in_order = F.transform(
        F.sequence(low, F.array_max(places) + _CARRY),
        lambda place: F.coalesce(F.try_element_at(F.col(sums), place), F.lit(0).cast("bigint")),
    )
    none = F.array(F.lit(0).cast("bigint"))
    df = df.withColumn("_in_order", F.when(F.size(places) > 0, in_order).otherwise(none))
    df = df.withColumn("_negative", _carried(F.col("_in_order"))["carry"] < 0)
    signed = F.when(
        F.col("_negative"), F.transform("_in_order", lambda value: -value)
    ).otherwise(F.col("_in_order"))
    lowest = F.array(*[F.lit(0).cast("bigint")] * (_DIGITS - 1))
    df = df.withColumn("_number", F.concat(lowest, _carried(signed)["digits"]))

    # The place of the first digit that is not zero, from the top; then it and the three below it.
    not_zero = F.transform("_number", lambda digit: digit != 0)
    df = df.withColumn("_from_top", F.array_position(F.reverse(not_zero), True).cast("int"))
    first = F.greatest(F.col("_from_top"), F.lit(1))
    d = [F.element_at("_number", -(first + k)) for k in range(_DIGITS)]
    df = df.select("*", *(x.alias(f"_d{k}") for k, x in enumerate(d)))
    # Its bits and those of the next three are 55 to 72. The last of them go, so that 62 fit an
    # integer; whether anything was cut off is kept in the lowest bit, far below the rounding.
    cut = F.greatest(F.length(F.bin("_d0")) - 8, F.lit(0)).cast("int")
    df = df.withColumn("_cut", cut)
    whole = F.lit(0).cast("bigint")
    for k in range(_DIGITS - 1):
        whole = whole.bitwiseOR(_left(F.col(f"_d{k}"), _BITS * (_DIGITS - 1 - k) - F.col("_cut")))
    last = F.col(f"_d{_DIGITS - 1}")
    whole = whole.bitwiseOR(F.call_function("shiftright", last, F.col("_cut")))
    cut_off = last.bitwiseAND(_left(F.lit(1).cast("bigint"), F.col("_cut")) - 1) != 0
    below = F.slice("_number", 1, F.size("_number") - first - (_DIGITS - 1))
    sticky = (cut_off | F.exists(below, lambda digit: digit != 0)).cast("bigint")
    leading = whole.bitwiseOR(sticky).cast("double")
    # The array starts with extra digits, at places below the lowest one.
    place = F.coalesce(low, F.lit(0)) - (_DIGITS - 1) + F.size("_number") - first - (_DIGITS - 1)
    power = place * _BITS + _UNIT + F.col("_cut")
    # In two steps where the power alone would be too small for a double.
    tiny = leading * F.pow(F.lit(2.0), power + 100) * 2.0**-100
    size = F.when(power < -1000, tiny).otherwise(leading * F.pow(F.lit(2.0), power))
    result = F.when(F.col("_from_top") == 0, 0.0).when(F.col("_negative"), -size).otherwise(size)
    return df.withColumn(name, result)
