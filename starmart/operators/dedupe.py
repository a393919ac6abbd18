"""Keep one row per key ("first raw row", "latest year") as a partial aggregate.

A window ``row_number() ... == 1`` would sort every row of a hot key in one
task. A minimum instead combines map-side: each task ships at most one row per
key to the shuffle, whatever the key skew.

Where rows have a number, the minimum is one of a fixed width, which Spark keeps
in a hash table: the least rank per key first, then the values of just the rows
that hold it (``chosen_rows``). Other orders are compared as a struct with the
values in it, which Spark can only aggregate by sorting.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Ranks within a year; more than any row number.
_YEAR = Decimal(10**19)


def keep_first(df: DataFrame, keys: list[str], order: list[Column], values: list[str]) -> DataFrame:
    """One row per ``keys`` (null is a key of its own): the row with the smallest
    ``order`` tuple, compared field by field. ``order`` must be non-null and, to
    be deterministic, unique within a key (end it with the row key)."""
    pick = F.min(
        F.struct(
            *[o.alias(f"__o{i}") for i, o in enumerate(order)],
            *[F.col(v).alias(v) for v in values],
        )
    ).alias("__pick")
    return df.groupBy(*keys).agg(pick).select(*keys, *[F.col(f"__pick.{v}").alias(v) for v in values])


def keep_latest(df: DataFrame, keys: list[str], year: str, row_key: str, values: list[str]) -> DataFrame:
    """One row per key from its most recent year; a missing year is older than any,
    and ties go to the first raw row."""
    missing = F.col(year).isNull()
    return keep_first(df, keys, [missing, F.coalesce(-F.col(year), F.lit(0)), F.col(row_key)], values)


def rank_by_year(year: str, row: str) -> Column:
    """A rank that puts the most recent year first, missing years last, and then the row number."""
    order = F.coalesce(-F.col(year).cast("long"), F.lit(1 << 32)).cast("decimal(11,0)")
    return order * F.lit(_YEAR) + F.col(row).cast("decimal(20,0)")


def chosen_rows(df: DataFrame, keys: list[str], row: str, year: str | None = None) -> DataFrame:
    """The number of the row to keep per ``keys`` (null is a key of its own): the first
    row, or with ``year`` the first of the most recent year. A hash aggregate."""
    rank = rank_by_year(year, row) if year else F.col(row)
    least = df.groupBy(*keys).agg(F.min(rank).alias("__rank"))
    return least.select((F.pmod("__rank", F.lit(_YEAR)).cast("long") if year else F.col("__rank")).alias("__row"))


def take_rows(df: DataFrame, row: str, chosen: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of the rows whose number is in ``chosen``."""
    return df.select(row, *columns).join(chosen, F.col(row) == F.col("__row"), "left_semi").select(*columns)
