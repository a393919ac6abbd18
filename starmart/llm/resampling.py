"""Importance resampling towards a target text set, drawn at a cutoff that a sketch brackets.

Features are runs of 1 to ``runs`` words, hashed to ``buckets`` counters. Two passes
over the texts: the first counts the buckets of the documents (and of the target texts),
one array per task, added up by bucket; the second scores every document with an array of
``buckets`` gains, the floored log ratios of the smoothed shares. A document's weight is
the floored mean of its gains, its score the weight plus Gumbel noise from a digest of
its id, so the highest scores are a draw without replacement in proportion to the
exponentials of the weights.

The documents with the k highest scores are drawn, and no sort sees all rows to find them:

1. a mergeable quantile sketch of the scores gives a bracket around the k-th highest;
2. the rows above the bracket and those in it are counted exactly. If the k-th is not in
   the bracket, the side at fault is widened fourfold, down to the least or up to the
   greatest score, which no count can refute;
3. only the rows of the bracket are sorted, in ranges, and the row at the k-th place less
   those above is the cutoff.

Rows up to the cutoff are then numbered by ranges as well. The order ends with the number
a row had when the scores were written, so that equal scores and repeated ids split
between ranges like others.

Defined results: a null text, or one without words, has no features, weight 0 and only
its noise, and is not drawn below ``least`` words; ties go to the smaller id, null ids
come last, then fewer features; rows that repeat an id share its noise; without target
texts, or without documents, the counts are 0 and gains follow from the smoothing alone;
other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import Stages, with_rank
from starmart.llm.hashing import blocks

BUCKETS = 10_000
#: Words of the longest feature.
RUNS = 1
SEED = 2024
#: Of the documents with at least ``LEAST_WORDS`` words so many in a hundred are drawn.
PERCENT, LEAST_WORDS = 10, 20
#: The sketch's error is one row in so many, and the first bracket reaches twice as far to each side.
ACCURACY = 1000

# A-Z as a-z; every other ASCII byte but digits and a-z parts words; bytes from 128 belong to them.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def features(text: bytes | None, runs: int = RUNS, buckets: int = BUCKETS) -> tuple[np.ndarray, int]:
    """The bucket of every feature of a text, and its number of words.

    Long texts go block by block; ``tail`` carries the last words over the border."""
    found, n, tail = [], 0, []
    for block in blocks(text or b""):
        fresh = block.translate(_FOLD).split()
        n += len(fresh)
        words = tail + fresh
        sums = list(map(crc32, words))
        found.append(np.fromiter(sums[len(tail) :], np.uint32, len(fresh)))
        for k in range(2, runs + 1):
            # A crc of joined bytes goes on from that of the first of them.
            sums = [crc32(b" " + w, c) for c, w in zip(sums, words[k - 1 :], strict=False)]
            new = sums[max(0, len(tail) - k + 1) :]
            found.append(np.fromiter(new, np.uint32, len(new)))
        tail = words[len(words) - min(len(words), runs - 1) :]
    return (np.concatenate(found) % buckets).astype(np.int64), n


def bucket_counts(texts: DataFrame, runs: int = RUNS, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over every ``text``; a task sends at most ``buckets`` rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for value in batch.column("text").cast(pa.binary()):
                total += np.bincount(features(value.as_py(), runs, buckets)[0], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    counted = texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, dtype=np.int64)
    for row in counted.collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(ours: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares in the target and in ours, floored."""
    here, there = float(ours.sum() + len(ours)), float(target.sum() + len(target))
    return np.array([math.floor(1000 * math.log((t + 1.0) * here / ((s + 1.0) * there))) for s, t in zip(ours.tolist(), target.tolist(), strict=True)], dtype=np.int64)


def noise(key: Column, seed: int = SEED) -> Column:
    """Thousandths of Gumbel noise from the first 32 bits of a digest of the key, floored."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def scored(docs: DataFrame, gain: np.ndarray, runs: int = RUNS, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # 8 bytes a bucket

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            rows = []
            for value in batch.column("text").cast(pa.binary()):
                of, words = features(value.as_py(), runs, len(gain))
                rows.append((words, len(of), int(gain[of].sum()) // len(of) if len(of) else 0))
            columns = np.array(rows, dtype=np.int64).reshape(-1, 3)
            yield pa.record_batch([batch.column("doc_id"), *(pa.array(columns[:, i]) for i in range(3))], ["doc_id", "n_words", "n_features", "weight"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text").mapInArrow(weigh, f"doc_id {kind}, n_words long, n_features long, weight long")
    return rows.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))


def bracket(rows: DataFrame, score: str, k: int, n: int, accuracy: int = ACCURACY) -> tuple[int, int, int]:
    """Scores (low, high) between which the k-th highest of the ``n`` rows lies, and the
    exact number of rows above ``high``."""
    reach_low = reach_high = 2.0 / accuracy
    place = 1.0 - k / n
    while True:
        ends = [max(0.0, place - reach_low), min(1.0, place + reach_high)]
        (low, high), least, most = rows.agg(F.percentile_approx(score, ends, accuracy), F.min(score), F.max(score)).first()
        low, high = least if ends[0] == 0 else low, most if ends[1] == 1 else high
        above, upto = rows.agg(F.count_if(F.col(score) > high), F.count_if(F.col(score) >= low)).first()
        if above < k <= upto:
            return low, high, above
        if above >= k:
            reach_high *= 4
        if upto < k:
            reach_low *= 4


def _place(columns: dict[str, Column]) -> list[Column]:
    """What the order compares: highest score, smallest id, null ids last, then the rest."""
    return [-columns["score"], columns["doc_id"].isNull(), columns["doc_id"], columns["n_features"], columns["weight"], columns["number"]]


def draw(rows: DataFrame, stages: Stages, *, percent: int = PERCENT, least: int = LEAST_WORDS, accuracy: int = ACCURACY) -> DataFrame:
    """``rows`` (of ``scored``) with the ``rank`` from 1 of those drawn, null for others."""
    rows = stages.write(rows.withColumn("number", F.monotonically_increasing_id()), "scored")
    able = rows.where(F.col("n_words") >= least)
    n = able.count()
    k = n * percent // 100
    if not k:
        return rows.withColumn("rank", F.lit(None).cast("long"))
    low, high, above = bracket(able, "score", k, n, accuracy)
    order = _place({c: F.col(c) for c in rows.columns})
    inside = with_rank(stages, able.where(F.col("score").between(low, high)), order, "place")
    last = inside.where(F.col("place") == k - above - 1).first()
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    limit = F.struct(*_place({c: F.lit(last[c]).cast(kinds[c]) for c in rows.columns}))
    taken = (F.col("n_words") >= least) & (F.struct(*order) <= limit)
    drawn = with_rank(stages, rows.where(taken), order, "rank").withColumn("rank", F.col("rank") + 1)
    return drawn.unionByName(rows.where(~taken).withColumn("rank", F.lit(None).cast("long")))


def resample(
    docs: DataFrame, target: DataFrame, *, runs: int = RUNS, buckets: int = BUCKETS, seed: int = SEED, percent: int = PERCENT, least: int = LEAST_WORDS, accuracy: int = ACCURACY
) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document of ``docs``, drawn
    towards the texts of ``target``."""
    stages = Stages(docs.sparkSession, "resample")
    gain = gains(bucket_counts(docs, runs, buckets), bucket_counts(target, runs, buckets))
    return draw(scored(docs, gain, runs, seed), stages, percent=percent, least=least, accuracy=accuracy).select("doc_id", "n_features", "weight", "score", "rank")


#: The same rows for DuckDB; crc32 of the distinct words from a table of its 256 steps.
RESAMPLE_SQL = r"""
WITH steps AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) AS r(i)
), w AS (
  SELECT 0 AS side, r, unnest(w) AS word FROM (SELECT row_number() OVER () AS r,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents)
  UNION ALL
  SELECT 1, r, unnest(w) FROM (SELECT row_number() OVER () AS r,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark)
), v AS (
  SELECT word, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(hex(word)), 2), lambda k: ('0x' || substr(hex(word), k, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT word FROM w), steps
), f AS (
  SELECT side, r, bucket FROM w JOIN v ON v.word = w.word
), n AS (
  SELECT bucket, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t FROM f GROUP BY bucket
), g AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM n) + 10000)::DOUBLE
                                 / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM n) + 10000)::DOUBLE)))::BIGINT AS gain FROM n
), m AS (
  SELECT r, count(*)::BIGINT AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM f JOIN g ON g.bucket = f.bucket WHERE side = 0 GROUP BY r
), d AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM (SELECT row_number() OVER () AS r, doc_id FROM documents) x LEFT JOIN m ON m.r = x.r
), o AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS place,
         count(*) FILTER (n_features >= 20) OVER () * 10 // 100 AS k
  FROM d
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= k THEN place END AS rank FROM o
"""
