"""Substring dedup over sliding sentence spans.

A text's words fall into sentences: one ends after a word that ends in ``.``,
``!`` or ``?``, and at a line feed. A run is any ``SENTENCES`` or more consecutive
sentences with ``WORDS`` words, or one sentence of ``LONG`` words (A-Z as a-z, white
space as one space). The first occurrence of a run, in the least document, stays;
every sentence that a later occurrence covers goes.

Hashed are, for every sentence, the shortest run that starts there and the shortest
that ends there. They lie within every longer run and cover it to both ends: a
sentence from which the rest of it is too short ends a run that is not, or is in the
one from its first sentence. So their later occurrences cover the same sentences as
those of all runs, at linear size. Runs meet by hash over the whole corpus; a passage
whose line feeds fall elsewhere meets only in shortest runs with the same words.

Occurrences are counted and the least document found by partial sums before the
shuffle, so a run that a third of all documents share costs one row per task there. The
runs that hold more than ``HOT`` of all occurrences, at most ``1 / HOT`` of them, meet
their occurrences by a broadcast; only the others are shuffled for it.

Defined results: a null or empty text has no sentences; documents with a null id
take no part and stay as they are; rows that repeat an id are documents of their own, in
the order they were numbered, which is written before anything hangs on it; repeats
within a document count like those across; other columns are not read; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import Stages
from starmart.llm.hashing import blocks, multiply_up, words_of_block

#: A run has at least this many sentences and words, or is one sentence of ``LONG`` words.
SENTENCES, WORDS, LONG = 2, 20, 40
#: A run with a larger share of all occurrences is not shuffled to meet them.
HOT = 0.001

_ENDS = np.zeros(256, dtype=bool)
_ENDS[list(b".!?")] = True


def sentences(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, bytes where words start and end, and the words that sentences start with."""
    hashes, starts, ends, breaks = [], [], [], []
    at, ended = 0, True
    for block in blocks(text):
        data = np.frombuffer(block, dtype=np.uint8)
        s, e, h = words_of_block(data)
        if len(s):
            lines = np.concatenate([[0], np.cumsum(data == 10)])
            new = np.empty(len(s), dtype=bool)
            new[0] = ended or lines[s[0]] > 0
            new[1:] = _ENDS[data[e[:-1] - 1]] | (lines[s[1:]] > lines[e[:-1]])
            ended = bool(_ENDS[data[e[-1] - 1]] or lines[-1] > lines[e[-1]])
            hashes.append(h)
            starts.append(s + at)
            ends.append(e + at)
            breaks.append(new)
        else:
            ended = ended or bool((data == 10).any())
        at += len(block)
    if not hashes:
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), none, none, none
    first = np.flatnonzero(np.concatenate(breaks))
    return np.concatenate(hashes), np.concatenate(starts), np.concatenate(ends), first


def runs(hashes: np.ndarray, first: np.ndarray, least: int, words: int, long: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First sentence, sentence after the last, and hash of the shortest runs of a text
    that start or end at each sentence, by first sentence."""
    n = len(first)
    cut = np.append(first, len(hashes))  # words before each sentence
    i = np.arange(n)
    to = np.maximum(i + least, np.searchsorted(cut, cut[:-1] + words))
    to = np.where(np.diff(cut) >= long, i + 1, to)
    # The last sentence from which the words up to the end of each suffice.
    by = np.minimum(i + 1 - least, np.searchsorted(cut, cut[1:] - words, side="right") - 1)
    ends = np.flatnonzero(by >= 0)
    ends = ends[to[by[ends]] != ends + 1]
    starts = np.flatnonzero(to <= n)
    i, to = np.concatenate([starts, by[ends]]), np.concatenate([to[starts], ends + 1])
    order = np.lexsort((to, i))
    i, to = i[order], to[order]
    up, down = multiply_up(len(hashes) + 1)
    total = np.concatenate([[np.uint64(0)], np.cumsum(hashes * up[: len(hashes)], dtype=np.uint64)])
    value = (total[cut[to]] - total[cut[i]]) * down[cut[i]]
    value = (value ^ (value >> np.uint64(31))) * np.uint64(0x9E6C63D0676A9A99) ^ (cut[to] - cut[i]).astype(np.uint64)
    return i, to, (value ^ (value >> np.uint64(29))).view(np.int64)


def _run_rows(least: int, words: int, long: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows, texts = batch.column("doc_id"), batch.column("row"), batch.column("text").cast(pa.binary())
            out: list[tuple] = []
            size = 0

            def done() -> pa.RecordBatch:
                which = np.concatenate([np.full(len(h), r) for r, _, _, _, h, _ in out])
                return pa.record_batch(
                    [
                        rows.take(pa.array(which)),  # noqa: B023
                        ids.take(pa.array(which)),  # noqa: B023
                        pa.array(np.concatenate([np.full(len(h), n, dtype=np.int32) for _, n, _, _, h, _ in out])),  # noqa: B023
                        *(pa.array(np.concatenate([x[k] for x in out])) for k in (2, 3, 4, 5)),  # noqa: B023
                    ],
                    ["row", "doc_id", "n_sentences", "begin", "end", "run", "again"],
                )

            for r in range(batch.num_rows):
                text = texts[r].as_py()
                if not text or not ids[r].is_valid:
                    continue
                hashes, _, _, first = sentences(text)
                i, to, run = runs(hashes, first, least, words, long)
                if len(i):
                    again = np.ones(len(run), dtype=bool)
                    again[np.unique(run, return_index=True)[1]] = False
                    out.append((r, len(first), i.astype(np.int32), to.astype(np.int32), run, again))
                    size += len(run)
                if size > 100_000:
                    yield done()
                    out, size = [], 0
            if out:
                yield done()

    return rows


def repeated_spans(
    docs: DataFrame, *, row: str | None = None, least: int = SENTENCES, words: int = WORDS, long: int = LONG
) -> DataFrame:
    """The rows that hold a later occurrence of a run: row, doc_id, first_doc_id (the
    least document that holds one of these runs first), n_sentences, n_removed, and
    the removed sentences as sorted (begin, end) pairs in ``spans``, ends exclusive.

    ``row`` names a written column of different longs; without it rows are numbered here."""
    stages = Stages(docs.sparkSession, "spans")
    kind = dict(docs.dtypes)["doc_id"]
    number = F.col(row) if row else F.monotonically_increasing_id()
    schema = f"row long, doc_id {kind}, n_sentences int, begin int, end int, run long, again boolean"
    found = docs.select(number.alias("row"), "doc_id", "text").mapInArrow(_run_rows(least, words, long), schema)
    found = stages.write(found, "runs")
    shared = found.groupBy("run").agg(F.min(F.struct("doc_id", "row")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = stages.write(shared, "shared")
    most = found.count() * HOT
    hot = F.broadcast(shared.where(F.col("n") > most))  # fewer than 1 / HOT rows
    met = found.join(hot, "run").unionByName(
        found.join(hot.select("run"), "run", "left_anti").join(shared.where(F.col("n") <= most), "run")
    )
    later = met.where(F.col("again") | (F.struct("doc_id", "row") > F.col("first"))).withColumn("first_doc_id", F.col("first.doc_id"))
    # Overlapping and touching runs of a row merge; a window holds one row's runs only.
    before = Window.partitionBy("row").orderBy("begin", "end").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.coalesce(F.max("end").over(before), F.lit(-1)) < F.col("begin")
    upto = before.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    island = later.withColumn("fresh", fresh.cast("int")).withColumn("island", F.sum("fresh").over(upto))
    merged = island.groupBy("row", "island").agg(
        F.min("doc_id").alias("doc_id"),
        F.min("first_doc_id").alias("first_doc_id"),
        F.max("n_sentences").alias("n_sentences"),
        F.min("begin").alias("begin"),
        F.max("end").alias("end"),
    )
    return merged.groupBy("row").agg(
        F.min("doc_id").alias("doc_id"),
        F.min("first_doc_id").alias("first_doc_id"),
        F.max("n_sentences").alias("n_sentences"),
        F.sum(F.col("end") - F.col("begin")).alias("n_removed"),
        F.sort_array(F.collect_list(F.struct("begin", "end"))).alias("spans"),
    )


def repeated_report(docs: DataFrame) -> DataFrame:
    """The affected documents, the removed sentences written as ``begin-end,...``."""
    listed = F.array_join(F.transform("spans", lambda x: F.concat_ws("-", x["begin"], x["end"])), ",")
    found = repeated_spans(docs)
    return found.select(
        "doc_id",
        "first_doc_id",
        F.col("n_sentences").cast("long").alias("n_sentences"),
        F.col("n_removed").cast("long").alias("n_removed"),
        listed.alias("removed"),
    )


def cut_sentences(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the sentences of ``spans``, from the first word of each span
    up to the first word after it."""
    data = text.encode()
    _, starts, _, first = sentences(data)
    out, at = [], 0
    for begin, end in spans:
        out.append(data[at : starts[first[begin]]])
        at = starts[first[end]] if end < len(first) else len(data)
    return b"".join([*out, data[at:]]).decode()


def drop_repeats(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without the repeated sentences (``n_chars``, if there, counted anew)."""
    numbered = docs.select(F.monotonically_increasing_id().alias("number"), F.struct(*docs.columns).alias("row"))
    numbered = Stages(docs.sparkSession, "cut").write(numbered, "numbered")
    texts = numbered.select("number", F.col("row.doc_id").alias("doc_id"), F.col("row.text").alias("text"))
    spans = repeated_spans(texts, row="number", **options).select(F.col("row").alias("of"), "spans")
    joined = numbered.select("number", "row", F.col("row.text").alias("text")).join(spans, F.col("number") == F.col("of"), "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                t if t is None or s is None else cut_sentences(t, [(x["begin"], x["end"]) for x in s])
                for t, s in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True)
            ]
            yield pa.record_batch([batch.column("row"), pa.array(texts, pa.string())], ["row", "new"])

    kind = joined.schema["row"].dataType.simpleString()
    done = joined.select("row", "text", "spans").mapInArrow(cut, f"row {kind}, new string")
    kinds = dict(docs.dtypes)
    fresh = {"text": F.col("new"), "n_chars": F.coalesce(F.length("new").cast(kinds.get("n_chars", "long")), F.col("row.n_chars")) if "n_chars" in kinds else None}
    return done.select(*[fresh[c].alias(c) if fresh.get(c) is not None else F.col("row")[c].alias(c) for c in docs.columns])


#: The same rows for DuckDB, from every run of every length. (A run that repeats starts at
#: sentences with the same next 20 words and ends at ones with the same last 20; others are not listed.)
SPANS_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(regexp_replace(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '([.!?])[\x20\x09-\x0D]+', E'\\1\n', 'g'), E'\n')) AS line,
         unnest(range(len(string_split(regexp_replace(text, '([.!?])[\x20\x09-\x0D]+', E'\\1\n', 'g'), E'\n')))) AS k
  FROM documents WHERE doc_id IS NOT NULL
), s AS (
  SELECT doc_id, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w,
         (row_number() OVER (PARTITION BY doc_id ORDER BY k) - 1)::INTEGER AS i
  FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), d AS (
  SELECT doc_id, flatten(list(w ORDER BY i)) AS words, count(*) AS n_sentences FROM s GROUP BY doc_id
), c AS (
  SELECT s.doc_id, i, sum(len(w)) OVER (PARTITION BY s.doc_id ORDER BY i) - len(w) AS a, sum(len(w)) OVER (PARTITION BY s.doc_id ORDER BY i) AS z
  FROM s
), e AS (
  SELECT c.*, count(*) OVER (PARTITION BY array_to_string(words[a + 1:a + 20], ' ')) AS heads,
         count(*) OVER (PARTITION BY array_to_string(words[greatest(z - 19, 1):z], ' ')) AS tails
  FROM c JOIN d ON d.doc_id = c.doc_id
), r AS (
  SELECT b.doc_id, b.i AS b, e.i + 1 AS e, md5(array_to_string(words[b.a + 1:e.z], ' ')) AS run
  FROM e b JOIN e ON e.doc_id = b.doc_id AND ((e.i > b.i AND e.z - b.a >= 20) OR (e.i = b.i AND e.z - b.a >= 40)) JOIN d ON d.doc_id = b.doc_id
  WHERE b.heads > 1 AND e.tails > 1
), f AS (
  SELECT *, min(doc_id) OVER (PARTITION BY run) AS first_doc_id, row_number() OVER (PARTITION BY run ORDER BY doc_id, b) AS k FROM r
), g AS (
  SELECT DISTINCT f.doc_id, c.i FROM f JOIN c ON c.doc_id = f.doc_id AND c.i >= f.b AND c.i < f.e WHERE k > 1
), h AS (
  SELECT doc_id, i, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS island FROM g
), o AS (
  SELECT doc_id, min(i) AS b, max(i) + 1 AS e FROM h GROUP BY doc_id, island
), m AS (
  SELECT doc_id, min(first_doc_id) AS first_doc_id FROM f WHERE k > 1 GROUP BY doc_id
)
SELECT o.doc_id, any_value(m.first_doc_id) AS first_doc_id, any_value(d.n_sentences)::BIGINT AS n_sentences,
       sum(o.e - o.b)::BIGINT AS n_removed, string_agg(o.b || '-' || o.e, ',' ORDER BY o.b) AS removed
FROM o JOIN m ON m.doc_id = o.doc_id JOIN d ON d.doc_id = o.doc_id
GROUP BY o.doc_id
"""
