"""Exact money arithmetic (X-12, X-20, P-08).

Prices have two decimals and quantities are whole numbers, so every amount is
a whole number of cents.  Prices are turned into BIGINT cents once, on the
(small) product side; line amounts and their sums are then long arithmetic:
exact, independent of summation order and of how work is split across tasks,
and far cheaper than wide decimals (whose sums fall back to big-number
objects).  ANSI mode turns a long overflow into an error, never a wrong sum;
a BIGINT of cents reaches about 9.2e16 currency units.

Presentation: ``double(cents) / 100`` is the nearest DOUBLE to the exact
amount (while the cents fit a double exactly, below 2**53), i.e. the amount
rounded to two places and then converted, as ``ROUND(x::NUMERIC, 2)``
followed by a float conversion.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def price_cents(price: str | Column) -> Column:
    """A price as exact BIGINT cents (the price is taken as DECIMAL(12,2))."""
    return (_c(price).cast(MONEY) * F.lit(100)).cast("long")


def line_cents(quantity: str | Column, cents: str | Column) -> Column:
    """``quantity * price`` for one fact line, in cents."""
    return _c(quantity).cast("long") * _c(cents)


def money_from_cents(cents: str | Column) -> Column:
    """Cents -> currency units as DOUBLE (exact cents, one correctly rounded division)."""
    return _c(cents).cast("double") / F.lit(100.0)


def share_pct(part_cents: str | Column, whole_cents: str | Column) -> Column:
    """``round(part * 100 / whole, 2)`` on the DOUBLE amounts; a zero whole raises under ANSI."""
    return F.round(money_from_cents(part_cents) * 100 / money_from_cents(whole_cents), 2)
