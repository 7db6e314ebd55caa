"""Exact, order-independent sums of money held as DOUBLE.

A sum of doubles depends on the order in which partitions arrive. Amounts that are whole
cents, which is what money is, are therefore summed as integers. One BIGINT sum of cents can
overflow on a table of 10^12 rows and a DECIMAL sum costs an object per row, so the cents are
summed as three BIGINT parts (24 bits, 24 bits and what is above), which stays inside code
generation; only one value per group becomes a DECIMAL. The price of a line is divided before
it is multiplied, so every price up to 2^53 cents times any INT quantity is exact. A group
has room for 2^39 rows and a total of 2^111 cents; beyond that ANSI mode raises an error.

An amount or price that is not whole cents (a fraction of a cent, NaN, an infinity, a value
from 2^53 cents on) is not rounded: such amounts are summed as doubles beside the others, in
the order they arrive, and added at the end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 24
LARGEST_CENTS = 1 << 53  # up to here every whole number is a double

Parts = tuple[Column, Column, Column, Column]


def _cents(amount: Column) -> tuple[Column, Column]:
    """Whole cents as BIGINT, or else the amount itself; exactly one of the two is not NULL."""
    cents = F.rint(amount * 100)
    whole = (F.abs(cents) < LARGEST_CENTS) & (cents / 100 == amount)
    return F.when(whole, cents.cast("bigint")), F.when(~whole, amount)


def _low(cents: Column) -> Column:
    return cents.bitwiseAND(F.lit((1 << BITS) - 1))


def split(amount: Column) -> Parts:
    """An amount as high, middle and low part, and the rest that is not whole cents."""
    cents, rest = _cents(amount)
    upper = F.shiftright(cents, BITS)
    return F.shiftright(upper, BITS), _low(upper), _low(cents), rest


def split_line(quantity: Column, unit_price: Column) -> Parts:
    """The same for INT quantity x unit price."""
    cents, rest = _cents(unit_price)
    count = quantity.cast("bigint")
    lower = count * _low(cents)
    upper = count * F.shiftright(cents, BITS) + F.shiftright(lower, BITS)
    return F.shiftright(upper, BITS), _low(upper), _low(lower), quantity * rest


def partial_sums(*parts: Column) -> Parts:
    """Aggregates that may be summed again over larger groups before `total`."""
    high, middle, low, rest = map(F.sum, parts)
    return high, middle, low, rest


def total(high: Column, middle: Column, low: Column, rest: Column) -> Column:
    """Summed parts -> DOUBLE amount; NULL if there was no amount at all."""
    wide = [part.cast("decimal(38,0)") for part in (high, middle)]
    exact = (wide[0] * (1 << 2 * BITS) + wide[1] * (1 << BITS) + low).cast("double") / 100
    return F.coalesce(exact + rest, exact, rest)


def sum_money(amount: Column) -> Column:
    """Sum of a DOUBLE money column."""
    return total(*partial_sums(*split(amount)))


def sum_lines(quantity: Column, unit_price: Column) -> Column:
    """Sum of quantity x unit price."""
    return total(*partial_sums(*split_line(quantity, unit_price)))
