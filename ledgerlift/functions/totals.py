"""Sums of money that do not depend on the order of the rows."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whole cents are added as three integers of so many bits, the uppermost with the sign.
_BITS = 18
_PART = (1 << _BITS) - 1


def sum_money(c: Column) -> Column:
    """Sum of a double column, exact for amounts of whole cents.

    Adding doubles loses cents in big groups and gives another answer after each shuffle or
    retry. Amounts of whole cents, up to 90 trillion each, are therefore added as integers: in
    three narrow parts, of which none can overflow below 2^45 rows a group, put together as one
    decimal. Other amounts (fractions of a cent, larger ones, NaN and infinity) are added as
    doubles. Null if there is no amount.
    """
    rounded = F.rint(c * 100)
    whole = (F.abs(rounded) < 2.0**53) & (rounded / 100 == c)
    cents = F.when(whole, rounded.cast("bigint"))
    parts = (
        F.shiftright(cents, 2 * _BITS),
        F.shiftright(cents, _BITS).bitwiseAND(F.lit(_PART)),
        cents.bitwiseAND(F.lit(_PART)),
    )
    high, middle, low = (F.sum(p).cast("decimal(19,0)") for p in parts)
    step = F.lit(1 << _BITS).cast("decimal(6,0)")
    total = ((high * step + middle) * step + low).cast("decimal(36,0)")
    exact = (total / F.lit(100).cast("decimal(3,0)")).cast("double")
    other = F.sum(F.when(~whole, c))
    return F.coalesce(exact + other, exact, other)
