"""sum_money: exact, in any order, and right when whole cents are not enough."""

import math
import random
from fractions import Fraction

from pyspark.sql import functions as F

from ledgerlift.functions import sum_money


def total(spark, amounts, partitions=4):
    rows = spark.createDataFrame([(a,) for a in amounts], "m double").repartition(partitions)
    return rows.agg(sum_money(F.col("m")).alias("t")).first().t


def test_is_exact_where_doubles_are_not(any_ansi):
    pick = random.Random(3)
    cents = [pick.randrange(-10**12, 10**13) for _ in range(5000)] + [1] * 5000
    pick.shuffle(cents)
    assert total(any_ansi, [c / 100 for c in cents]) == float(Fraction(sum(cents), 100))


def test_does_not_depend_on_the_order(spark):
    amounts = [0.1] * 1001 + [123456789012.34, -123456789012.34] * 50
    assert {total(spark, amounts[::step], n) for step in (1, -1) for n in (1, 3, 7)} == {100.1}


def test_other_amounts_add_as_doubles(any_ansi):
    assert math.isclose(total(any_ansi, [1.23456, 2.5, 1e-9]), 3.734560001)
    assert total(any_ansi, [1.005]) == 1.005
    assert total(any_ansi, [1e300, 1.0]) == 1e300
    assert total(any_ansi, [float("inf"), 1.0]) == float("inf")
    assert math.isnan(total(any_ansi, [float("nan"), 1.0]))


def test_nulls(any_ansi):
    assert total(any_ansi, [None, 2.5, None]) == 2.5
    assert total(any_ansi, [None, None]) is None
    assert total(any_ansi, []) is None


def test_totals_beyond_64_bits_are_exact_in_any_order(any_ansi):
    assert total(any_ansi, [9e13] * 1100) == 9e13 * 1100
    amounts = [9e13] * 1100 + [0.1] * 1001 + [-9e13] * 1100
    assert {total(any_ansi, amounts[::step], n) for step in (1, -1) for n in (1, 3, 7)} == {100.1}


def test_negative_amounts(any_ansi):
    assert total(any_ansi, [-0.01, -5.0, 2.5]) == -2.51
    assert total(any_ansi, [-0.01] * 300) == -3.0
