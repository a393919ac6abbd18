"""Dense surrogate ids 1..n in the order of some columns, without a global sort task.

``row_number().over(Window.orderBy(...))`` moves every row into one partition;
it is used only while one range would do: up to ``MIN_ROWS_PER_RANGE`` rows, or
one core. Above that the ids are built like ``zipWithIndex``, in DataFrame form:

1. ``repartitionByRange`` cuts the rows into ordered ranges (Spark samples the
   keys in the cluster), ``sortWithinPartitions`` orders each range, and
   ``monotonically_increasing_id()`` stamps each row with (range index, position
   in range) - the documented layout puts the partition index in the upper 31
   bits and the position in the lower 33. The result is written once, so every
   later step (and any retried task) sees the same ranges.
2. Rows per range are counted (one small aggregate, one row per range) and a
   window over those few rows gives each range its running offset.
3. The offsets are broadcast (their size is the number of ranges, chosen here)
   and each id is offset + position + 1, a narrow step.

The ids equal the global row number exactly when ``order`` is unique per row.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmart.session import default_parallelism

DEFAULT_ROWS_PER_RANGE = 2_000_000
# Below this many rows per range, spreading over more tasks costs more than it saves.
MIN_ROWS_PER_RANGE = 50_000
# Beyond this many ranges they grow instead (each is an external sort), so that the
# boundaries and offsets stay few however large the table is.
MAX_RANGES = 10_000
_POSITION_BITS = 33


def _sort_columns(order: list[str], nulls_last: bool):
    return [F.col(c).asc_nulls_last() if nulls_last else F.col(c).asc_nulls_first() for c in order]


def with_dense_id(
    df: DataFrame,
    order: list[str],
    id_col: str,
    *,
    workdir: str,
    nulls_last: bool = True,
    rows_per_range: int = DEFAULT_ROWS_PER_RANGE,
    rows: int | None = None,
    at_most: int | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Add ``id_col`` = 1..n (long) following ``order`` ascending.

    ``workdir`` is a folder in shared storage for the ranked copy; ``rows`` is
    the row count when the caller knows it (saves a count job); ``at_most`` is
    a known upper bound of it - where one range would do, no count is needed.
    ``keep`` names the columns to return (default: all); others are used for the
    order and not stored.
    """
    sort_cols = _sort_columns(order, nulls_last)
    keep = df.columns if keep is None else keep
    if at_most is not None and at_most <= min(rows_per_range, MIN_ROWS_PER_RANGE):
        return df.select(*keep, F.row_number().over(Window.orderBy(*sort_cols)).cast("long").alias(id_col))
    n = df.count() if rows is None else rows
    spark: SparkSession = df.sparkSession
    # Enough ranges to bound each task, and to keep every core busy when large.
    parallel = min(default_parallelism(spark), n // MIN_ROWS_PER_RANGE)
    ranges = max(1, min(math.ceil(n / rows_per_range), MAX_RANGES), parallel)
    if ranges == 1:
        # One range: few rows, or a single core.
        return df.select(*keep, F.row_number().over(Window.orderBy(*sort_cols)).cast("long").alias(id_col))

    path = f"{workdir}/ranked-{uuid.uuid4().hex[:12]}"
    (
        df.repartitionByRange(ranges, *sort_cols)
        .sortWithinPartitions(*sort_cols)
        .select(*keep, F.monotonically_increasing_id().alias("__stamp"))
        .write.mode("overwrite")
        .option("compression", "zstd")
        .parquet(path)
    )
    ranked = spark.read.parquet(path).withColumn("__range", F.shiftright("__stamp", _POSITION_BITS))
    counts = ranked.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    position = F.col("__stamp").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return (
        ranked.join(F.broadcast(offsets), "__range")
        .withColumn(id_col, (F.col("__offset") + position + 1).cast("long"))
        .drop("__range", "__offset", "__stamp")
    )
