"""exact_sums: the bits of math.fsum for any doubles, in any order and number of partitions."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from ledgerlift.operators import balance, category_spend, exact_sums, user_totals

RANGES = [(-1074, -1000), (-1023, -1020), (-60, 60), (-1074, 1000), (0, 5), (50, 54), (900, 1000)]


def amount(pick, low, high):
    return math.ldexp(pick.choice([-1, 1]) * (1 + pick.random()), pick.randint(low, high))


def random_groups(seed):
    pick, groups = random.Random(seed), {}
    for key in range(100):
        low, high = pick.choice(RANGES)
        values = [amount(pick, low, high) for _ in range(pick.randint(1, 60))]
        if pick.random() < 0.4:  # most of it cancels
            values += [-v for v in values[: pick.randint(0, len(values))]]
        if pick.random() < 0.3:
            values += [amount(pick, low, low + 3), 0.0, -0.0, None]
        groups[key] = values
    return groups


def fsum(values):
    values = [v for v in values if v is not None]
    if not values:
        return None
    if any(math.isnan(v) for v in values) or {math.inf, -math.inf} <= set(values):
        return "nan"
    if math.inf in values or -math.inf in values:
        return sum(values)
    return float(sum(map(Fraction, values)))  # as math.fsum, which overflows on the way


def found(spark, groups, partitions):
    rows = [(key, v) for key, values in groups.items() for v in values]
    random.Random(partitions).shuffle(rows)
    df = spark.createDataFrame(rows, "g int, v double").repartition(partitions)
    sums = {r.g: r.s for r in exact_sums(df, ["g"], "v", "s").collect()}
    return {g: "nan" if s is not None and math.isnan(s) else s for g, s in sums.items()}


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_random_doubles(spark, partitions):
    groups = random_groups(partitions)
    assert found(spark, groups, partitions) == {k: fsum(v) for k, v in groups.items()}


def test_edges(any_ansi):
    largest, least, half = 1.7976931348623157e308, 5e-324, 2.0**-53
    groups = {
        1: [1e17] + [0.125] * 1000 + [-1e17],
        2: [None],
        3: [math.inf, 1.0],
        4: [math.inf, -math.inf],
        5: [math.nan, 1.0],
        6: [least, least],
        7: [largest, -largest, 1.0],
        8: [1.0, half],  # a tie, to even
        9: [1.0, half, least],  # just above it
        10: [1.0 + 2 * half, half],
        11: [-1.0, -half, -least],
        12: [0.0, -0.0],
        13: [largest] * 3 + [-largest] * 2,
        None: [0.1, 0.2, None],
    }
    assert found(any_ansi, groups, 3) == {k: fsum(v) for k, v in groups.items()}


def test_no_keys_and_no_rows(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (0.3,)], "v double")
    assert [r.s for r in exact_sums(df, [], "v", "s").collect()] == [math.fsum([0.1, 0.2, 0.3])]
    assert exact_sums(df.limit(0).withColumn("g", F.lit(1)), ["g"], "v", "s").count() == 0


def test_powers_of_two_at_every_exponent(spark):
    """The logarithm that finds a double's first digit may be off by one near powers of two."""
    values = [x for e in range(-1074, 1024, 3) for x in (math.ldexp(1, e), math.ldexp(1 - 2**-53, e))]
    df = spark.createDataFrame(list(enumerate(values)), "g int, v double")
    assert {r.g: r.s for r in exact_sums(df, ["g"], "v", "s").collect()} == dict(enumerate(values))


def test_counts_skip_nulls(spark):
    rows = [("a", 1.5, 1), ("a", 2.5, None), ("a", None, 3), ("a", 0.0, 4), ("b", None, None)]
    df = spark.createDataFrame(rows, "g string, v double, id int")
    got = exact_sums(df, ["g"], "v", "s", {"n": "id", "amounts": "v"}).collect()
    assert {r.g: (r.s, r.n, r.amounts) for r in got} == {"a": (4.0, 3, 3), "b": (None, 0, 0)}


@pytest.mark.parametrize("report", [balance, category_spend, user_totals])
def test_reports_agree_on_whole_cents(spark, report):
    pick = random.Random(4)
    rows = [
        (str(i), str(i % 7), pick.randrange(-10**9, 10**9) / 100, "c%d" % (i % 3), pick.choice(["INGRESO", "EGRESO"]))
        for i in range(500)
    ]
    silver = spark.createDataFrame(
        rows, "id_transaccion string, id_usuario string, monto double, categoria string, tipo_transaccion string"
    )
    assert report(silver, exact=True).collect() == report(silver).collect()
    assert report(silver, exact=True).columns == report(silver).columns


def test_aggregates_before_each_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 3).alias("g"), F.rand(1).alias("v"))
    plan = exact_sums(df, ["g"], "v", "s")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    assert "Window" not in plan and "Python" not in plan
