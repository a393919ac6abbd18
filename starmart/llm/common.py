"""Helpers shared by the operators: the shared folder, written stages, global
ranks and connected components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word: a run of characters other than space and the ASCII controls 9 to 13.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
#: Most bytes of the rows that a task hands to Python at a time (one row at least).
BATCH_BYTES = 2 << 20
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as ``spark.checkpoint.dir`` names it.

    Only a single-machine session (``local`` or ``local[n]``) may leave it unset;
    a private folder is then made once and set for the application."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor reaches")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="starmart-llm-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def small_batches(spark: SparkSession) -> None:
    """Hand rows to Python in batches of at most ``BATCH_BYTES``.

    Spark's own bound is 64 MB or 10,000 rows. The JVM holds a batch outside its heap on
    the way there and back, and Python the batch and what is made of it, so every
    task that reads whole texts would take many times that. A session's lower bound stays."""
    now = spark.conf.get(_BATCH_BYTES, None)
    if now is None or not 0 < spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(now) <= BATCH_BYTES:
        spark.conf.set(_BATCH_BYTES, f"{BATCH_BYTES}b")


class Stages:
    """Tables an operator writes to the shared folder on its way.

    Writing cuts the lineage: a lost executor costs the tasks since the last
    table, never the whole job. ``drop`` removes a table that no result reads."""

    def __init__(self, spark: SparkSession, operator: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/llm/{operator}-{uuid.uuid4().hex[:12]}"
        self._count = 0

    def write(self, df: DataFrame, name: str) -> DataFrame:
        self._count += 1
        path = f"{self.root}/{self._count:02d}-{name}"
        schema = df.schema
        df.write.parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    def drop(self, df: DataFrame) -> None:
        """Remove the folder of a table returned by ``write``."""
        files = df.inputFiles()
        folder = files[0].rpartition("/")[0] if files else ""
        if self.root.rpartition("/")[2] not in folder:
            return
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def word_count(text: Column | str) -> Column:
    """Words of a text (null: 0) as long."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def held_out(doc_id: Column | str) -> Column:
    """Documents no model may learn from: crc32 of the id's text, modulo 3, is 1."""
    remainder = F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % 3
    return F.coalesce(remainder == 1, F.lit(False))


def with_rank(stages: Stages, df: DataFrame, order: list[Column], rank: str) -> DataFrame:
    """Write ``df`` sorted by ``order`` with its global row number from 0.

    Ranges of the order are sorted side by side; the number is the position in
    the range plus the rows of the ranges before. No task sees all rows, and
    what is broadcast has one row per range, at most the number of shuffle
    partitions. Equal rows are numbered in any order."""
    stamp, part = f"{rank}__stamp", f"{rank}__part"
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    written = stages.write(ranged.withColumn(stamp, F.monotonically_increasing_id()), f"ranked-{rank}")
    written = written.withColumn(part, F.shiftright(stamp, 33))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = written.groupBy(part).agg(F.count(F.lit(1)).alias("n")).select(
        part, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(f"{rank}__before")
    )
    position = F.col(stamp).bitwiseAND(F.lit((1 << 33) - 1))
    return (
        written.join(F.broadcast(offsets), part)
        .withColumn(rank, F.col(f"{rank}__before") + position)
        .drop(stamp, part, f"{rank}__before")
    )


def components(stages: Stages, edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (a long, b long): (node, component), with
    the smallest node of each component, for every node that has an edge.

    Alternates large-star and small-star steps (Kiveris et al., 2014): each
    points the neighbours of a node at the smallest of them, as grouped minima
    and a join, until the edges are stars. Edges stay in the cluster; the driver
    sees two flags per round."""

    def step(e: DataFrame, large: bool) -> DataFrame:
        low = e.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        out = e.join(low, "u").select("v", "m")
        if large:
            out = out.where("v > m")
        else:
            out = out.unionByName(low.select(F.col("u").alias("v"), "m")).where("v <> m")
        return out.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()

    def are_stars(e: DataFrame) -> bool:
        # Every node hangs on one other, and none that others hang on.
        ends = e.select(F.col("u").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).unionByName(
            e.select(F.col("v").alias("node"), F.lit(0).alias("hangs"), F.lit(1).alias("holds"))
        )
        each = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
        return not each.where("hangs > 1 OR (hangs = 1 AND holds = 1)").agg(F.count(F.lit(1))).first()[0]

    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    e = stages.write(e, "edges")
    for _ in range(max_rounds):
        if are_stars(e):
            stars = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        done, e = e, stages.write(step(step(both, True), False), "stars")
        stages.drop(done)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
