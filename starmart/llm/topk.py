"""Exact top-k by inner product over norm-sorted vectors.

Vectors become integers, floor(64 * x). Candidates are sorted by descending length
and cut into blocks. A first pass scores the queries against the block of the
longest vectors, which gives each query a score its k-th best must reach. Then
each block of queries goes through stretches of the sequence: a stretch's blocks
are left as soon as the longest vector in them, by Cauchy-Schwarz, cannot reach
that score; in the others, coordinates rotated onto singular axes are summed for
the leading axes, and the product of what remains of both lengths bounds the
rest. Survivors are scored exactly in integers.

Queries and candidates meet in blocks of bounded size; a query leaves each stretch
with at most k rows.

Defined results: vectors that are null, empty or hold null or non-finite
components, and rows with a null id, take no part; vectors of different lengths
do not meet; rows that repeat an id are candidates of their own, but never of a
query with that id, and a repeated query id is one query, with the vector of the
least of its rows; ties go to the smaller id; other columns are not read; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import Stages, with_rank

K, SCALE, EVERY = 20, 64, 20
#: Vectors in a block of candidates, blocks in a stretch, queries in a block.
BLOCK, STRETCH, QUERIES = 4096, 4, 2048
#: Vectors the axes are fit on, and axes summed first.
SAMPLE, LEADING = 10_000, 24


def _integers(vector: str) -> Column:
    x = F.col(vector)
    fine = x.isNotNull() & (F.size(x) > 0) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.when(F.coalesce(fine, F.lit(False)), F.transform(x, lambda v: F.floor(v.cast("double") * SCALE).cast("double")))


def _axes(candidates: DataFrame, dim: int) -> np.ndarray:
    """Right singular vectors of a bounded sample, the largest singular value first
    (the eigenvectors of its Gram matrix)."""
    rows = candidates.orderBy(F.xxhash64("vector"), "id").limit(SAMPLE).select("vector").toArrow()
    x = rows["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    return np.linalg.eigh(x.T @ x)[1][:, ::-1].T


class _Part:
    """Vectors of a block: exact, rotated on the leading axes, and the length of the rest."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, axes: np.ndarray):
        self.ids, self.x = ids, x
        square = (x * x).sum(axis=1)
        self.lead = x @ axes[:LEADING].T
        self.rest = np.sqrt(np.maximum(square - (self.lead * self.lead).sum(axis=1), 0))
        self.length = np.sqrt(square)


class _Best:
    """The k best (score, id) of each query so far, better ones by score, then by smaller id."""

    def __init__(self, queries: _Part, k: int, floor: np.ndarray):
        self.q, self.k, self.floor = queries, k, floor
        n = len(queries.ids)
        self.row, self.id, self.score = (np.zeros(0, dtype=np.int64) for _ in range(3))
        self.least = floor.copy()  # a score below this cannot be among the k best
        self.n = n

    def add(self, c: _Part) -> None:
        # Slack for rounding: bounds only ever let more through.
        slack = 1e-6 * (1 + self.q.length.max(initial=0) * c.length.max(initial=0))
        able = self.q.length * c.length.max(initial=0) + slack >= self.least
        some = np.flatnonzero(able)
        if not len(some):
            return
        bound = self.q.lead[some] @ c.lead.T
        bound += np.multiply.outer(self.q.rest[some], c.rest)
        r, j = np.nonzero(bound + slack >= self.least[some][:, None])
        if len(r) * 4 > bound.size:  # most pass: one product is cheaper than as many single ones
            scores = (self.q.x[some] @ c.x.T)[r, j]
        else:
            scores = np.concatenate(
                [(self.q.x[some[r[s : s + 65536]]] * c.x[j[s : s + 65536]]).sum(axis=1) for s in range(0, len(r), 65536)]
                or [np.zeros(0)]
            )
        scores = np.rint(scores).astype(np.int64)
        r = some[r]
        good = (scores >= self.least[r]) & (c.ids[j] != self.q.ids[r])
        row = np.concatenate([self.row, r[good]])
        ids = np.concatenate([self.id, c.ids[j[good]]])
        score = np.concatenate([self.score, scores[good]])
        order = np.lexsort((ids, -score, row))
        row, ids, score = row[order], ids[order], score[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        keep = place < self.k
        self.row, self.id, self.score = row[keep], ids[keep], score[keep]
        full = place[keep] == self.k - 1
        self.least[self.row[full]] = np.maximum(self.least[self.row[full]], self.score[full])


def _search(axes: np.ndarray, k: int):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i] for n in batch.schema.names}

                def matrix(name: str) -> np.ndarray:
                    return row[name].values.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, len(axes))  # noqa: B023

                queries = _Part(np.array(row["q_ids"].as_py(), dtype=np.int64), matrix("q_vectors"), axes)
                floor = np.array([-np.inf if f is None else f for f in row["q_floor"].as_py()], dtype=np.float64)
                ids, vectors = np.array(row["ids"].as_py(), dtype=np.int64), matrix("vectors")
                best = _Best(queries, k, floor)
                for at in range(0, len(ids), BLOCK):
                    best.add(_Part(ids[at : at + BLOCK], vectors[at : at + BLOCK], axes))
                yield pa.record_batch(
                    [pa.array(queries.ids[best.row]), pa.array(best.id), pa.array(best.score)], ["query_id", "vec_id", "score"]
                )

    return found


def _gathered(rows: DataFrame, group: Column, name: str, **lists: str) -> DataFrame:
    """Rows of each group (of bounded size) as one row of lists, in order of place."""
    order = F.sort_array(F.collect_list(F.struct("place", *lists.values())))
    out = rows.groupBy(group.alias(name)).agg(order.alias("rows"))
    return out.select(
        name, *[(F.flatten(f"rows.{c}") if c == "vector" else F.col(f"rows.{c}")).alias(a) for a, c in lists.items()]
    )


def _of_length(stages: Stages, rows: DataFrame, dim: int, every: int, k: int) -> DataFrame:
    axes = _axes(rows, dim)
    square = F.aggregate("vector", F.lit(0.0), lambda s, v: s + v * v)
    ranked = with_rank(stages, rows.withColumn("square", square), [F.col("square").desc(), F.col("id")], "place")
    first = F.floor(F.col("place") / (BLOCK * STRETCH))
    stretches = stages.write(_gathered(ranked, first, "stretch", ids="id", vectors="vector"), "stretches")
    longest = stages.write(_gathered(ranked.where(F.col("place") < BLOCK), F.lit(0).cast("long"), "stretch", ids="id", vectors="vector"), "longest")

    queries = rows.where(F.col("id") % every == 0).groupBy("id").agg(F.min("vector").alias("vector"))
    queries = with_rank(stages, queries, [F.col("id")], "place")
    slots = stages.spark.sparkContext.defaultParallelism * 4

    def search(asked: DataFrame, against: DataFrame, count: int) -> DataFrame:
        blocks = _gathered(asked, F.floor(F.col("place") / QUERIES), "asked", q_ids="id", q_vectors="vector", q_floor="floor")
        blocks = stages.write(blocks, "asked")
        # Every block of queries goes against every stretch: the numbers meet first, then the blocks.
        numbers = blocks.select("asked", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long"))).alias("stretch"))
        meet = numbers.join(blocks, "asked").join(against, "stretch").repartition(slots, "asked", "stretch")
        columns = ["q_ids", "q_vectors", "q_floor", "ids", "vectors"]
        return meet.select(*columns).mapInArrow(_search(axes, k), "query_id long, vec_id long, score long")

    seen = search(queries.withColumn("floor", F.lit(None).cast("double")), longest, 1)
    floors = seen.groupBy("query_id").agg(F.min("score").alias("floor"), F.count(F.lit(1)).alias("n")).where(F.col("n") == k)
    floors = stages.write(floors.select(F.col("query_id").alias("id"), F.col("floor").cast("double").alias("floor")), "floors")
    return search(queries.join(floors, "id", "left"), stretches, stretches.count())


def top_inner_products(
    vectors: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", k: int = K, every: int = EVERY
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: the ``k`` best other rows for each
    row whose id is divisible by ``every``."""
    stages = Stages(vectors.sparkSession, "topk")
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), _integers(vector).alias("vector"))
    rows = stages.write(rows.where("id IS NOT NULL AND vector IS NOT NULL"), "integers")
    found = vectors.sparkSession.createDataFrame([], "query_id long, vec_id long, score long")
    for row in rows.select(F.size("vector").alias("dim")).distinct().orderBy("dim").collect():
        found = found.unionByName(_of_length(stages, rows.where(F.size("vector") == row["dim"]), row["dim"], every, k))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


#: The same rows for DuckDB, scoring all pairs (for small tables).
TOP_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.x, c.x)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.x) = len(c.x)
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
