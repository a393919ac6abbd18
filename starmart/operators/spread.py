"""Spread a narrow input over the cluster before per-row work."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spread(df: DataFrame, splits: int, partitions: int | None = None) -> DataFrame:
    """Round-robin ``df`` over ``partitions`` tasks (default: the session's default
    parallelism) when its input has less than half as many ``splits``.

    A single large row group or an unsplittable multi-line CSV file is read by
    one task; without this every later narrow step (joins to broadcast sides,
    cleaning, the first write) would run on one core. The shuffle is only worth
    it for a multiple of tasks, so at scale there is none.
    """
    from starmart.session import default_parallelism

    target = partitions or default_parallelism(df.sparkSession)
    return df.repartition(target) if 2 * splits <= target else df


def scan_splits(df: DataFrame) -> int:
    """Splits of a Parquet scan that hold rows (reads footers only)."""
    return df.select(F.spark_partition_id().alias("split")).distinct().count()
