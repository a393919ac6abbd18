"""Derived category columns (selection level, publication type, time buckets, age order)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starmart.functions.text import unicode_strip
from starmart.params import (
    AGE_BANDS,
    LEVEL_ENTRANT,
    LEVEL_FINALIST,
    LEVEL_SEMIFINALIST,
    LEVEL_WINNER,
    SELF_PUBLISHED,
    TRADITIONAL_PUBLISHER,
    TimeBuckets,
)


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def selection_level(winner: Column | str, finalist: Column | str, semifinalist: Column | str) -> Column:
    """Highest funnel level reached; winner beats finalist beats semifinalist."""
    return (
        F.when(_c(winner) == 1, F.lit(LEVEL_WINNER))
        .when(_c(finalist) == 1, F.lit(LEVEL_FINALIST))
        .when(_c(semifinalist) == 1, F.lit(LEVEL_SEMIFINALIST))
        .otherwise(F.lit(LEVEL_ENTRANT))
    )


def publication_type(publisher_name: Column | str) -> Column:
    """Self-published when the stripped, lower-cased name is the marker; a null
    name is a traditional publisher (the comparison is simply not true)."""
    marker = SELF_PUBLISHED.lower()
    return F.when(
        F.lower(unicode_strip(_c(publisher_name))) == F.lit(marker), F.lit(SELF_PUBLISHED)
    ).otherwise(F.lit(TRADITIONAL_PUBLISHER))


def decade(year: Column | str, buckets: TimeBuckets) -> Column:
    return F.when(_c(year) < buckets.decade_split, F.lit(buckets.decade_labels[0])).otherwise(
        F.lit(buckets.decade_labels[1])
    )


def period(year: Column | str, buckets: TimeBuckets) -> Column:
    expr = None
    for upper, label in zip(buckets.period_upper, buckets.period_labels):
        cond = _c(year) <= upper
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(buckets.period_labels[-1]))


def age_band_rank(band: Column | str) -> Column:
    """1-based position of the band in natural order; unknown labels give null."""
    expr = None
    for i, label in enumerate(AGE_BANDS, start=1):
        cond = _c(band) == F.lit(label)
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr
