"""Mixing sources to target weights by systematic sampling (DataFrame functions only).

Within a source every document has the same expected number of copies, target
size over source size. The running sum of these in a fixed order, plus one
random offset per source, crosses an integer once for every copy to emit. The
order is by size, so each source's taken words come within about one document
of its target.

Defined results: a null or empty text has size 0 and counts for nothing; a null
source is a source of its own, last; repeated rows are separate documents; extra
columns, also clashing ones, come back unchanged; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import Stages, with_rank, word_count

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (3, 1, 2)
#: Words of the mix per word of the input.
SHARE = 1.5
#: Most copies of a document, and so the most a source's target may exceed its size.
MOST = 2
SEED = 20


def _offset(source: Column, seed: int) -> Column:
    """The source's offset in [0, 1), from a digest of its name."""
    name = F.concat(F.lit(f"{seed}:"), F.when(source.isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), source)))
    return F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def _level(sources: DataFrame, words: float, most: int) -> float | None:
    """Words per unit of weight for the sources below their limit.

    What sources at their limit leave is shared again by weight until none is
    above: a fixed point of one global sum, so any number of sources will do.
    None: all are at the limit."""
    cap = F.col("source_size") * most
    level = None
    while True:
        above = F.lit(False) if level is None else F.lit(level) * F.col("weight") > cap
        capped, weight = sources.agg(
            F.sum(F.when(above, cap).otherwise(0)), F.sum(F.when(above, 0).otherwise(F.col("weight")))
        ).first()
        if not weight:
            return None
        nxt = (words - float(capped)) / float(weight)
        if nxt == level:
            return level
        level = nxt


def mix_plan(
    docs: DataFrame,
    *,
    source: str = "source",
    text: str = "text",
    order: str = "doc_id",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    seed: int = SEED,
    columns: list[str] | None = None,
) -> DataFrame:
    """Each document with its copies in the mix.

    Returns a struct ``row`` of the chosen input ``columns`` (default all), and
    ``size``, ``source_size``, ``target``, ``copies``. Sources need no bound: the
    table of sources is an aggregate, ranked like the documents by ranges."""
    stages = Stages(docs.sparkSession, "mix")
    keep = docs.columns if columns is None else columns
    rows = docs.select(
        F.col(source).alias("source"),
        word_count(text).alias("size"),
        F.col(order).alias("key"),
        F.struct(*keep).alias("row"),
    )
    ranked = with_rank(stages, rows, [F.col("source").asc_nulls_last(), F.col("size"), F.col("key")], "rank")
    sources = ranked.groupBy("source").agg(F.sum("size").alias("source_size"), F.min("rank").alias("first"))
    sources = with_rank(stages, sources, [F.col("source").asc_nulls_last()], "place")
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    sources = stages.write(sources.withColumn("weight", turn), "sources")

    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level = _level(sources, share * total, most) if total else 0.0
    cap = (F.col("source_size") * most).cast("double")
    wanted = cap if level is None else F.lit(level) * F.col("weight")
    sources = sources.select(
        F.col("source").alias("of"),
        "source_size",
        "first",
        F.when(wanted > cap, cap).otherwise(wanted).alias("target"),
        _offset(F.col("source"), seed).alias("offset"),
    )
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    place = F.col("rank") - F.col("first")
    crossed = F.floor(each * (place + 1) + F.col("offset")) - F.floor(each * place + F.col("offset"))
    return ranked.join(sources, F.col("source").eqNullSafe(F.col("of"))).select(
        "row", "size", "source_size", "target", F.least(crossed, F.lit(most)).cast("long").alias("copies")
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the columns of ``docs``, one row per copy of a document."""
    plan = mix_plan(docs, **options).where("copies > 0")
    return plan.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target and the words taken, for every document."""
    return mix_plan(docs, columns=["doc_id"], **options).select(
        F.col("row.doc_id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


#: The same rows for DuckDB; the level comes in closed form from sources sorted by limit per weight.
MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INTEGER] AS weight
  FROM d GROUP BY source
), o AS (
  SELECT *, 2 * source_size AS cap,
         coalesce(sum(2 * source_size) OVER before, 0) AS capped, coalesce(sum(weight) OVER before, 0) AS used,
         row_number() OVER (ORDER BY 2.0 * source_size / weight, source NULLS LAST) AS k
  FROM s
  WINDOW before AS (ORDER BY 2.0 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), l AS (
  SELECT (1.5::DOUBLE * (SELECT sum(source_size) FROM s)::DOUBLE - capped::DOUBLE)
         / ((SELECT sum(weight) FROM s) - used)::DOUBLE AS level, weight, cap, k
  FROM o
), f AS (
  SELECT arg_min(level, k) AS level FROM l WHERE level * weight <= cap
), t AS (
  SELECT source, source_size, least(f.level * weight, (2 * source_size)::DOUBLE) AS target,
         ('0x' || substr(md5('20:' || coalesce('=' || source, 'null')), 1, 8))::BIGINT::DOUBLE / 4294967296.0::DOUBLE AS u
  FROM s, f
), r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.u,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size::DOUBLE ELSE 0 END AS e,
         row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id) - 1 AS place
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (size * least(2, floor(e * (place + 1) + u) - floor(e * place + u)))::BIGINT AS taken
FROM r
"""
