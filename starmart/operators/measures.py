"""Funnel measures and shares of totals.

Reports group the fact by dimension attributes. Small dimensions (checked row
count) are broadcast into the fact stream. A dimension that grows with the fact
is joined only after the fact has been reduced by the dimension *id* (partial +
final hash aggregate, so hot ids cost nothing); joining the raw fact to it
would shuffle every fact row instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.functions.measures import pct
from starmart.operators.lookup import DEFAULT_BROADCAST_ROWS

# Fact flag column per measure name; "n" is the row count.
FLAG_OF = {"semi": "is_semifinalist", "fin": "is_finalist", "win": "is_winner"}
ALL_MEASURES = ("n", "semi", "fin", "win")


def fact_measures(fact: DataFrame, keys: list, measures=ALL_MEASURES) -> DataFrame:
    """Per ``keys``: n = row count, semi/fin/win = sums of the 0/1 flags (long).

    Input that is itself such an aggregate (it carries an ``n`` column) is
    re-aggregated: its measures are summed.
    """
    preaggregated = "n" in fact.columns
    aggs = []
    for m in measures:
        if preaggregated:
            aggs.append(F.sum(m).cast("long").alias(m))
        elif m == "n":
            aggs.append(F.count(F.lit(1)).alias("n"))
        else:
            aggs.append(F.sum(FLAG_OF[m]).cast("long").alias(m))
    return fact.groupBy(*keys).agg(*aggs)


def measures_by(
    fact: DataFrame,
    dims: list[tuple[DataFrame, str, int | None]],
    group: list[Column | str],
    measures=ALL_MEASURES,
    *,
    fact_keys: tuple[str, ...] = (),
    broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """Funnel measures grouped by dimension attributes (and ``fact_keys``, columns of
    the fact that ``group`` names as well).

    ``dims`` lists (dimension frame, id column, row count of the dimension table
    or None if unknown or too wide to broadcast); each frame carries the id and the attributes used in
    ``group`` (filters on it are pushed to its scan).

    * A dimension of at most ``broadcast_rows`` rows is broadcast and joined to
      the fact stream map-side: no shuffle beyond the final aggregate.
    * A larger one (or one of unknown size) is joined only after the fact has
      been reduced by its id (partial + final aggregate), so the join shuffles
      one row per id instead of one per fact row, and hot ids cost nothing.
    """
    small = [(d, i) for d, i, n in dims if n is not None and n <= broadcast_rows]
    large = [(d, i) for d, i, n in dims if n is None or n > broadcast_rows]
    stream = fact
    for dim, id_col in small:
        stream = stream.join(F.broadcast(dim), id_col, "inner")
    if not large:
        return fact_measures(stream, group, measures)
    carried = [c for dim, id_col in small for c in dim.columns if c != id_col]
    partial = fact_measures(stream, [i for _, i in large] + carried + list(fact_keys), measures)
    for dim, id_col in large:
        partial = partial.join(dim, id_col, "inner")
    return partial.groupBy(*group).agg(*[F.sum(m).cast("long").alias(m) for m in measures])


def share_of(value: str, partition: list[str], digits: int) -> Column:
    """``ROUND(100.0 * value / SUM(value) OVER (PARTITION BY partition), digits)``.

    Used on aggregated rows only; with no partition columns the window spans
    the whole (small) aggregate.
    """
    w = Window.partitionBy(*partition) if partition else Window.partitionBy()
    return pct(F.col(value), F.sum(value).over(w), digits)
