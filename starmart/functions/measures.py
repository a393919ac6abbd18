"""Numeric and display expressions shared by the reports."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pct(part: Column | str, whole: Column | str, digits: int) -> Column:
    """``ROUND(100.0 * part / whole, digits)`` with half-up rounding, as a double.

    The quotient is fixed to 12 decimals first, so the rounding step sees the
    same decimal in every engine; a zero denominator gives null, not an error.
    """
    ratio = F.lit(Decimal("100.0")) * _c(part) / F.nullif(_c(whole), F.lit(0))
    return F.round(ratio.cast("decimal(18,12)"), digits).cast("double")


def thousands_dot(c: Column | str) -> Column:
    """Integer with '.' as thousands separator, e.g. 16799 -> '16.799'."""
    return F.replace(F.format_number(_c(c), 0), F.lit(","), F.lit("."))


def printf(fmt: str, c: Column | str) -> Column:
    return F.format_string(fmt, _c(c))
