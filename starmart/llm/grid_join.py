"""Epsilon grid order join: exact groups of vectors with a cosine of 0.95 or more.

On unit vectors a cosine bound is a distance bound, epsilon. Vectors are rotated
onto their principal axes (fit on a bounded sample; any rotation keeps distances)
and sorted by their grid cells of width epsilon on the leading axes. The sorted
sequence is cut into intervals; pairs of intervals whose bounding boxes are
farther apart than epsilon are skipped, the others are joined recursively: both
are halved until they are small, and blocks provably apart are skipped at every
step. In small blocks the distance on the leading axes alone rules out nearly all
pairs; the rest are compared exactly, in double precision on the given components.

Equal vectors are one class; links are counted with the sizes of the classes, and
only a spanning forest of links leaves a block, so copies and dense groups cost no
pairs outside it.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components link with nothing; vectors of different lengths never link; a null id
is returned with a null component and takes no part; rows that repeat an id
are vectors of their own that share its component; other columns are not read;
an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import Stages, components, with_rank
from starmart.llm.trie import Groups

COSINE = 0.95
#: Vectors the axes are fit on, axes that make the grid, axes whose distance is looked at first.
SAMPLE, GRID_AXES, LEADING = 10_000, 8, 20
#: Vectors of an interval of the sequence, and of the blocks that recursion ends with.
INTERVAL, SMALL = 4096, 1024


def usable(vector: str):
    """Whether a vector can link: not null, zero or with null or non-finite components."""
    x = F.col(vector)
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(x.isNotNull() & fine & F.exists(x, lambda v: v != 0), F.lit(False))


def _matrix(values: pa.Array, dim: int) -> np.ndarray:
    return values.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def principal_axes(vectors: DataFrame, dim: int, most: int = SAMPLE) -> np.ndarray:
    """The axes of the largest variance first, from at most ``most`` vectors."""
    rows = vectors.orderBy(F.xxhash64("vector"), "node").limit(most).select("vector").toArrow()
    unit = _unit(_matrix(rows["vector"].combine_chunks().flatten(), dim))
    unit = unit - unit.mean(axis=0)
    return np.linalg.eigh(unit.T @ unit)[1][:, ::-1].T


def _order_cells(axes: np.ndarray, epsilon: float):
    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.floor(_unit(_matrix(batch.column("vector").flatten(), len(axes))) @ axes[:GRID_AXES].T / epsilon)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(at.astype(np.int32).ravel()), at.shape[1]).cast(pa.list_(pa.int32()))
            yield pa.record_batch([batch.column("node"), batch.column("copies"), batch.column("vector"), lists], ["node", "copies", "vector", "cell"])

    return cells


class _Side:
    """An interval's vectors: given components, unit vectors, coordinates on the axes."""

    def __init__(self, node: np.ndarray, copies: np.ndarray, vectors: np.ndarray, axes: np.ndarray):
        self.node, self.copies = node, copies
        self.given = vectors
        self.norm = np.sqrt((vectors * vectors).sum(axis=1))
        self.at = _unit(vectors) @ axes.T
        self.lead = self.at[:, :LEADING].astype(np.float32)
        self.square = (self.lead * self.lead).sum(axis=1)
        self.links = np.zeros(len(node), dtype=np.int64)


class _Forest:
    """Which vectors of a block are tied already: union-find, with each vector's group at hand."""

    def __init__(self, n: int):
        self.groups = Groups(list(range(n)))
        self.of = np.arange(n)

    def settle(self) -> None:
        ids, inverse = np.unique(self.of, return_inverse=True)
        self.of = np.array([self.groups.find(int(g)) for g in ids], dtype=np.int64)[inverse]


def _apart(a: _Side, i: slice, b: _Side, j: slice, epsilon: float) -> bool:
    x, y = a.at[i], b.at[j]
    gap = np.maximum(0, np.maximum(x.min(0) - y.max(0), y.min(0) - x.max(0)))
    return float((gap * gap).sum()) > epsilon * epsilon * (1 + 1e-9)


def _join(a: _Side, i: slice, b: _Side, j: slice, cosine: float, forest: _Forest, edges: list, base: int) -> None:
    """Count the links between two stretches and keep a spanning forest of them."""
    epsilon = math.sqrt(2 - 2 * cosine)
    same = a is b
    if i.stop <= i.start or j.stop <= j.start or _apart(a, i, b, j, epsilon):
        return
    if max(i.stop - i.start, j.stop - j.start) > SMALL:
        m, n = (i.start + i.stop) // 2, (j.start + j.stop) // 2
        halves = [(slice(i.start, m), slice(j.start, n)), (slice(i.start, m), slice(n, j.stop))]
        halves += [(slice(m, i.stop), slice(n, j.stop))]
        if not (same and i == j):
            halves.append((slice(m, i.stop), slice(j.start, n)))
        for x, y in halves:
            _join(a, x, b, y, cosine, forest, edges, base)
        return
    near = a.square[i][:, None] + b.square[j][None, :] - 2 * (a.lead[i] @ b.lead[j].T) <= epsilon * epsilon + 1e-4
    if same and i == j:
        near &= np.tri(*near.shape, k=-1, dtype=bool)
    left, right = np.nonzero(near)
    for s in range(0, len(left), 1 << 16):
        p, q = left[s : s + (1 << 16)] + i.start, right[s : s + (1 << 16)] + j.start
        linked = (a.given[p] * b.given[q]).sum(axis=1) / (a.norm[p] * b.norm[q]) >= cosine
        p, q = p[linked], q[linked]
        np.add.at(a.links, p, b.copies[q])
        np.add.at(b.links, q, a.copies[p])
        # Groups that these links tie, each pair of groups once: dense blocks add few edges.
        x, y = forest.of[p], forest.of[q + base]
        apart = np.flatnonzero(x != y)
        if len(apart):
            pairs, first = np.unique(np.stack([x[apart], y[apart]], axis=1), axis=0, return_index=True)
            for (g, h), k in zip(pairs.tolist(), apart[first].tolist(), strict=True):
                if forest.groups.find(g) != forest.groups.find(h):
                    forest.groups.join(g, h)
                    edges.append((int(a.node[p[k]]), int(b.node[q[k]])))
            forest.settle()


def _interval_join(axes: np.ndarray, cosine: float):
    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row = {n: batch.column(n)[r] for n in batch.schema.names}
                side = [
                    _Side(
                        np.array(row[f"{s}_nodes"].as_py(), dtype=np.int64),
                        np.array(row[f"{s}_copies"].as_py(), dtype=np.int64),
                        _matrix(row[f"{s}_vectors"].values, len(axes)),
                        axes,
                    )
                    for s in ("left", "right")
                ]
                if row["left"].as_py() == row["right"].as_py():
                    side[1] = side[0]
                a, b = side
                base = 0 if a is b else len(a.node)
                forest, edges = _Forest(len(a.node) + (base and len(b.node))), []
                _join(a, slice(0, len(a.node)), b, slice(0, len(b.node)), cosine, forest, edges, base)
                counts = [(int(n), int(c)) for s in ([a] if a is b else side) for n, c in zip(s.node, s.links, strict=True) if c]
                yield pa.record_batch(
                    [
                        pa.array([n for n, _ in counts] + [x for x, _ in edges], pa.int64()),
                        pa.array([None] * len(counts) + [y for _, y in edges], pa.int64()),
                        pa.array([c for _, c in counts] + [0] * len(edges), pa.int64()),
                    ],
                    ["a", "b", "links"],
                )

    return joined


def _links_of(stages: Stages, classes: DataFrame, dim: int, cosine: float, interval: int) -> DataFrame:
    """(a, null, links): links of a class to others; (a, b, 0): edges of a spanning forest."""
    epsilon = math.sqrt(2 - 2 * cosine)
    axes = principal_axes(classes, dim)
    kind = dict(classes.dtypes)["vector"]
    celled = classes.mapInArrow(_order_cells(axes, epsilon), f"node long, copies long, vector {kind}, cell array<int>")
    ranked = with_rank(stages, celled, [F.col("cell"), F.col("node")], "place")
    rows = ranked.groupBy(F.floor(F.col("place") / interval).alias("interval")).agg(
        F.sort_array(F.collect_list(F.struct("place", "node", "copies", "vector"))).alias("rows"),  # at most ``interval``
        *[F.min(F.col("cell")[d]).alias(f"low{d}") for d in range(min(GRID_AXES, dim))],
        *[F.max(F.col("cell")[d]).alias(f"high{d}") for d in range(min(GRID_AXES, dim))],
    )
    intervals = stages.write(
        rows.select(
            "interval",
            F.col("rows.node").alias("nodes"),
            F.col("rows.copies").alias("copies"),
            F.flatten("rows.vector").alias("vectors"),
            *[c for d in range(min(GRID_AXES, dim)) for c in (f"low{d}", f"high{d}")],
        ),
        "intervals",
    )
    boxes = intervals.drop("nodes", "copies", "vectors")
    left = boxes.select([F.col(c).alias(f"left_{c}") for c in boxes.columns])
    right = boxes.select([F.col(c).alias(f"right_{c}") for c in boxes.columns])
    # Intervals whose first cells are neighbours meet by those cells; the other axes rule more of them out.
    left = left.withColumn("meet", F.explode(F.sequence("left_low0", "left_high0")))
    right = right.withColumn("meet", F.explode(F.sequence(F.col("right_low0") - 1, F.col("right_high0") + 1)))
    close = [
        (F.col(f"left_low{d}") <= F.col(f"right_high{d}") + 1) & (F.col(f"right_low{d}") <= F.col(f"left_high{d}") + 1)
        for d in range(min(GRID_AXES, dim))
    ]
    pairs = left.join(right, "meet").where(F.col("left_interval") <= F.col("right_interval"))
    for c in close:
        pairs = pairs.where(c)
    pairs = pairs.select(F.col("left_interval").alias("left"), F.col("right_interval").alias("right")).distinct()
    data = [
        intervals.select(
            F.col("interval").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in ("nodes", "copies", "vectors")]
        )
        for s in ("left", "right")
    ]
    work = pairs.join(data[0], "left").join(data[1], "right")
    work = work.repartition(stages.spark.sparkContext.defaultParallelism * 4, "left", "right")
    columns = ["left", "right", *(f"{s}_{c}" for s in ("left", "right") for c in ("nodes", "copies", "vectors"))]
    return work.select(*columns).mapInArrow(_interval_join(axes, cosine), "a long, b long, links long")


def near_vectors(
    vectors: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", cosine: float = COSINE, interval: int = INTERVAL
) -> DataFrame:
    """vec_id, n_links, component_id (the least id reachable by links) and kept."""
    stages = Stages(vectors.sparkSession, "grid")
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector"))
    # Negative zero equals zero, so that equal vectors are equal arrays.
    tidy = F.when(usable("vector") & F.col("vec_id").isNotNull(), F.transform("vector", lambda v: v + F.lit(0).cast("float")))
    rows = stages.write(rows.select(F.col("vec_id"), tidy.alias("vector")), "vectors")
    classes = rows.where("vector IS NOT NULL").groupBy("vector").agg(
        F.min("vec_id").cast("long").alias("node"), F.count(F.lit(1)).alias("copies")
    )
    classes = stages.write(classes.select("node", "copies", "vector"), "classes")
    found = None
    for row in classes.select(F.size("vector").alias("dim")).distinct().orderBy("dim").collect():
        part = _links_of(stages, classes.where(F.size("vector") == row["dim"]), row["dim"], cosine, interval)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = vectors.sparkSession.createDataFrame([], "a long, b long, links long")
    found = stages.write(found, "found")
    joined = components(stages, found.where("b IS NOT NULL").select("a", "b"))
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    summed = (
        classes.join(counts, "node", "left")
        .join(joined, "node", "left")
        .select(
            F.col("vector").alias("of"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
            F.coalesce("component", "node").alias("component"),
        )
    )
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", F.col("vec_id").cast("long")))
    return rows.join(summed, F.col("vector") == F.col("of"), "left").select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"),
    )


#: The same rows for DuckDB, comparing all pairs (for small tables).
NEAR_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0
), e AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
    ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.95
), r AS (
  SELECT vec_id, vec_id AS m FROM embeddings
  UNION
  SELECT e.b, r.m FROM r JOIN e ON e.a = r.vec_id
), c AS (
  SELECT vec_id, min(m) AS component_id FROM r GROUP BY vec_id
)
SELECT t.vec_id, (SELECT count(*) FROM e WHERE e.a = t.vec_id) AS n_links, c.component_id,
       coalesce(c.component_id = t.vec_id, false) AS kept
FROM embeddings t LEFT JOIN c ON c.vec_id IS NOT DISTINCT FROM t.vec_id
"""
