"""Deterministic ordering and top-k: every sort ends with the group keys as
tie-breakers (ascending, nulls last), so a LIMIT always keeps the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def asc(name: str) -> Column:
    return F.col(name).asc_nulls_last()


def desc(name: str) -> Column:
    return F.col(name).desc_nulls_last()


def ordered(df: DataFrame, sort: list[Column], ties: list[str]) -> DataFrame:
    return df.orderBy(*sort, *[asc(t) for t in ties])


def top_k(df: DataFrame, k: int, sort: list[Column], ties: list[str]) -> DataFrame:
    """ORDER BY ... LIMIT k; plans as TakeOrderedAndProject (per-task top-k, then merge)."""
    return ordered(df, sort, ties).limit(k)
