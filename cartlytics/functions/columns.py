"""Scalar column expressions shared by the operators.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def line_revenue(qty: str | Column = "qty", price: str | Column = "unit_price_usd") -> Column:
    """qty × unit price; int × decimal(10,2) stays an exact decimal."""
    return col(qty) * col(price)


def day_of(ts: str | Column) -> Column:
    """Calendar day of a timestamp (``CAST(ts AS DATE)``), time-zone free for NTZ."""
    return F.to_date(col(ts))


def period_start(ts: str | Column, grain: str = "month") -> Column:
    """``date_trunc(grain, ts)`` as a DATE (day, week, month, quarter, year)."""
    grain = grain.lower()
    d = F.to_date(col(ts))
    if grain == "day":
        return d
    if grain == "week":
        return F.to_date(F.date_trunc("week", d))
    return F.trunc(d, grain)


def month_of(ts: str | Column) -> Column:
    return period_start(ts, "month")


def months_apart(start: str | Column, end: str | Column) -> Column:
    """Whole calendar months from ``start`` to ``end`` (both dates)."""
    s, e = col(start), col(end)
    return ((F.year(e) - F.year(s)) * 12 + (F.month(e) - F.month(s))).cast("int")


def ratio(num: str | Column, den: str | Column) -> Column:
    """True division as DOUBLE; NULL where the denominator is 0 or NULL."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))
