"""Dimension key lookups: size-checked broadcast and null-safe left equi-joins."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side is broadcast only when both its row count and its estimated size are
# within these bounds.
DEFAULT_BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20
_WIDTH_SAMPLE_ROWS = 2_000

_STORED: dict[tuple, int] = {}


def _memoised(spark: SparkSession, path: str, what: str, compute) -> int:
    """``compute()``, kept as long as the table at ``path`` stays as it is."""
    key = (path, stored_version(spark, path), what)
    if key not in _STORED:
        _STORED[key] = compute()
    return _STORED[key]


def stored_version(spark: SparkSession, path: str) -> tuple:
    """Length, file count and modification time of a stored table."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    summary = fs.getContentSummary(where)
    return summary.getLength(), summary.getFileCount(), fs.getFileStatus(where).getModificationTime()


def input_bytes(df: DataFrame) -> int:
    """Length of the files that ``df`` is read from."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    files = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)) for f in df.inputFiles()]  # names come encoded
    return sum(f.getFileSystem(conf).getFileStatus(f).getLen() for f in files)


def stored_rows(spark: SparkSession, path: str) -> int:
    """Row count of a stored Parquet table (footer metadata), memoised."""
    return _memoised(spark, path, "rows", lambda: spark.read.parquet(path).count())


def measured_bytes(df: DataFrame) -> int:
    """Summed width of all rows."""
    width = sum(F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in df.columns)
    return df.agg(F.sum(width)).first()[0] or 0


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size in memory of a stored Parquet table: summed over all rows where these are few
    enough to be broadcast, else estimated from the mean width of some rows."""

    def estimate() -> int:
        df, rows = spark.read.parquet(path), stored_rows(spark, path)
        if rows <= DEFAULT_BROADCAST_ROWS:
            return measured_bytes(df)
        return math.ceil(measured_bytes(df.limit(_WIDTH_SAMPLE_ROWS)) * rows / _WIDTH_SAMPLE_ROWS)

    return _memoised(spark, path, "bytes", estimate)


def broadcast_if_within(
    side: DataFrame, rows: int, size: int, max_rows: int = DEFAULT_BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Broadcast ``side`` when ``rows`` and ``size`` - checked bounds of it, such as
    those of the table it is derived from - are within both limits."""
    return F.broadcast(side) if rows <= max_rows and size <= max_bytes else side


# Hot keys: a key with at least this share of the sampled fact rows is resolved
# through a broadcast of its dimension row instead of the shuffle join. At most
# 1 / HOT_SHARE keys can qualify, which bounds what is collected and broadcast.
HOT_SHARE = 0.002
_HOT_SAMPLE_ROWS = 200_000
_HOT_SEED = 29


def hot_keys(facts: DataFrame, cols: list[str], rows: int, share: float = HOT_SHARE) -> list[tuple]:
    """Key values holding at least ``share`` of a bounded sample of ``facts``."""
    fraction = min(1.0, _HOT_SAMPLE_ROWS / max(rows, 1))
    sample = facts.select(*cols).sample(False, fraction, _HOT_SEED)
    threshold = max(2.0, share * rows * fraction)
    counts = sample.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"))
    return [tuple(r[c] for c in cols) for r in counts.filter(F.col("__n") >= threshold).collect()]


def _matches(left: DataFrame, lcols: list[str], right: DataFrame, rcols: list[str]):
    return reduce(lambda a, b: a & b, [left[l].eqNullSafe(right[r]) for l, r in zip(lcols, rcols)])


def null_safe_lookup(
    facts: DataFrame,
    dim: DataFrame,
    on: list[tuple[str, str]],
    take: list[str],
    *,
    dim_rows: int | None = None,
    dim_bytes: int | None = None,
    fact_rows: int | None = None,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    hot_share: float = HOT_SHARE,
    hot: list[tuple] | None = None,
) -> DataFrame:
    """Left join ``facts`` to ``dim`` where each (fact column, dim column) pair
    matches null-safely (a null key finds the dimension's null row), adding the
    ``take`` columns of ``dim``. The dim key must be unique, so no fact row is
    added or dropped. ``dim_rows`` / ``fact_rows`` are known row counts (else
    they are counted), ``dim_bytes`` is the dimension's size (else it is measured
    where the rows would do for a broadcast), and ``hot`` the hot keys where they were sampled before (from a stored table, so
    that sampling runs no join again).

    * A dimension within ``max_broadcast_rows`` and BROADCAST_BYTES is broadcast:
      one map-side join.
    * A larger one is a shuffle join, with hot keys split off first: keys that
      hold at least ``hot_share`` of a sample are looked up through a broadcast
      of just their dimension rows, and their fact rows enter the shuffle with a
      spreading key that matches nothing, so no reducer receives a hot key.
    """
    fact_keys = [f for f, _ in on]
    side = dim.select(*[F.col(d).alias(f"__k{i}") for i, (_, d) in enumerate(on)], *take)
    side_keys = [f"__k{i}" for i in range(len(on))]
    n_dim = side.count() if dim_rows is None else dim_rows
    if n_dim <= max_broadcast_rows and (measured_bytes(side) if dim_bytes is None else dim_bytes) <= BROADCAST_BYTES:
        side = F.broadcast(side)
        return facts.join(side, _matches(facts, fact_keys, side, side_keys), "left").drop(*side_keys)

    if hot is None:
        hot = hot_keys(facts, fact_keys, facts.count() if fact_rows is None else fact_rows, hot_share)
    if not hot:
        return facts.join(side, _matches(facts, fact_keys, side, side_keys), "left").drop(*side_keys)

    spark = facts.sparkSession
    key_schema = T.StructType([T.StructField(f"__h{i}", facts.schema[f].dataType) for i, f in enumerate(fact_keys)])
    hot_df = spark.createDataFrame(hot, key_schema)
    hot_side = side.join(
        F.broadcast(hot_df), _matches(side, side_keys, hot_df, list(key_schema.fieldNames())), "left_semi"
    ).select(
        *[F.col(k).alias(f"__hk{i}") for i, k in enumerate(side_keys)],
        *[F.col(c).alias(f"__hot_{c}") for c in take],
        F.lit(True).alias("__is_hot"),
    )
    hot_keys_cols = [f"__hk{i}" for i in range(len(on))]
    marked = facts.join(F.broadcast(hot_side), _matches(facts, fact_keys, hot_side, hot_keys_cols), "left")
    is_hot = F.col("__is_hot").isNotNull()
    # The shuffle join key is (hash of the key, key). Hot rows carry a hash of
    # the whole row instead and a null key: they spread over all reducers, and
    # (unless a 64-bit hash collides with the null key's) match nothing there;
    # their id comes from the broadcast side either way.
    routed = marked.select(
        "*",
        *[F.when(is_hot, F.lit(None)).otherwise(F.col(f)).alias(f"__s{i}") for i, f in enumerate(fact_keys)],
        F.when(is_hot, F.xxhash64(*[F.col(c) for c in facts.columns]))
        .otherwise(F.xxhash64(*[F.col(f).cast(side.schema[k].dataType) for f, k in zip(fact_keys, side_keys)]))
        .alias("__route"),
    )
    cold_keys = [f"__ck{i}" for i in range(len(on))]
    cold_side = side.select(
        *[F.col(k).alias(c) for k, c in zip(side_keys, cold_keys)],
        *[F.col(c).alias(f"__cold_{c}") for c in take],
        F.xxhash64(*[F.col(k) for k in side_keys]).alias("__route0"),
    )
    cond = (routed["__route"] == cold_side["__route0"]) & _matches(
        routed, [f"__s{i}" for i in range(len(on))], cold_side, cold_keys
    )
    joined = routed.join(cold_side, cond, "left")
    out = [F.col(c) for c in facts.columns] + [
        F.coalesce(F.col(f"__hot_{c}"), F.col(f"__cold_{c}")).alias(c) for c in take
    ]
    return joined.select(*out)
