"""Sums, averages and ratios, in floating point or in exact cents.

Floating-point sums depend on the order in which tasks deliver their rows, so a
retry can change the last digit and, near a tie, the rounded result. With
``exact=True``, as the operators pass by default, amounts are added as whole cents and rounded half up on integers,
and the result does not depend on the partitioning. It needs amounts that are
``usable``; infinity raises an error.

Aggregates over more than one level add up ``addend``s and turn the last sum
back with ``from_addend``.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


#: A larger amount is not a price: 10**14 cents are exact in a double, and a sum of
#: 90,000 of them still fits in a long.
LARGEST_AMOUNT = 1e12


def usable(value: Column) -> Column:
    """Whether an amount can be added up: zero or more, finite, not absurdly large.

    NaN is larger than any number to Spark, so the upper limit also rejects NaN and
    infinity. NULL is neither usable nor not.
    """
    return (value >= 0) & (value <= LARGEST_AMOUNT)


def usable_sum(value: Column) -> Column:
    """Whether a sum of amounts is one: zero or more and finite, however large."""
    return (value >= 0) & (value < F.lit(float("inf")))


def _in_cents(value: Column) -> Column:
    return F.round(value * 100).cast("long")


def _half_up(numerator: Column, denominator: Column) -> Column:
    return F.call_function("div", numerator * 2 + denominator, denominator * 2)


def addend(value: Column, exact: bool = False) -> Column:
    """What to add up for one amount. Exact addends need amounts without NaN."""
    return _in_cents(value) if exact else value


def addend_of_sum(value: Column, exact: bool = False) -> Column:
    """What to add up for an amount that is a sum itself: cents beyond a long's range."""
    return F.round(value * 100).cast("decimal(28,0)") if exact else value


def from_addend(summed: Column, exact: bool = False) -> Column:
    return summed / F.lit(100.0) if exact else summed


def total(value: Column, exact: bool = False) -> Column:
    """Aggregate: the sum. One NaN makes it NaN, exact or not."""
    if not exact:
        return F.sum(value)
    clean = F.sum(F.when(~F.isnan(value), _in_cents(value))) / F.lit(100.0)
    return F.when(F.bool_or(F.isnan(value)), F.lit(float("nan"))).otherwise(clean)


def per_head(summed: Column, count: Column, exact: bool = False) -> Column:
    """Summed addends per row to 2 digits, 0.0 where nothing was counted."""
    if exact:
        value = _half_up(summed, count) / F.lit(100.0)
    else:
        value = F.round(summed / count, 2)
    return F.when(count > 0, value).otherwise(0.0)


def share(part: Column, whole: Column, exact: bool = False) -> Column:
    """``part / whole`` to 4 digits, 0.0 where ``whole`` is not positive."""
    if exact:
        ratio = _half_up(part * 10_000, whole) / F.lit(10_000.0)
    else:
        ratio = F.round(part / whole, 4)
    return F.when(whole > 0, ratio).otherwise(0.0)
