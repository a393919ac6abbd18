"""Reshaping: wide-to-long over measure columns, display renames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def measures_long(df: DataFrame, ids: list[str], stages: tuple[tuple[str, str], ...], stage_col: str, value_col: str) -> DataFrame:
    """One row per (ids, stage): ``stages`` maps measure column -> stage label."""
    relabeled = df.select(*ids, *[F.col(c).alias(label) for c, label in stages])
    return relabeled.unpivot(ids, [label for _, label in stages], stage_col, value_col)


def renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)
