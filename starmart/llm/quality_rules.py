"""Quality rules as a short-circuit cascade, ordered by what a sample shows.

A rule rejects a text by a few of its measures (words, symbols, repeated lines, ...).
On a sample the measures are timed and every rule's verdict is taken; the rules are then
put in order greedily: next comes the rule that rejects the most of what the rules before
it let pass, per nanosecond of the measures that were not taken yet. In the cascade a
measure is taken when a rule first asks for it, and the first rejection ends the text.

The order decides the cost alone: a text is kept if no rule rejects it, so the verdict
does not depend on the timings, which differ from run to run. Measures that a report
asks for of every text are taken first and cost the rules nothing more.

Words are what ``bytes.split()`` gives, the runs of characters other than space and 9 to
13. Windows of three words are compared by 64-bit hashes.

Each text is looked at by itself, so no shuffle and no skew; the sample has about
``SAMPLE`` rows and comes back as counts per combination of verdicts, at most
``2 ** len(rules)`` rows.

Defined results: a null or empty text has no words and fails the base; repeated rows are
judged each for itself; other columns are not read, and come back unchanged from
``keep_good``, also where names clash; an empty table gives no rows (and no sample, so
the rules keep their order).
"""

from __future__ import annotations

import time
from collections import defaultdict
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.hashing import blocks, shingles, word_hashes

#: Rows of the sample, about.
SAMPLE = 2000
SAMPLE_SEED = 13
_SPACE = bytes([9, 10, 11, 12, 13, 32])
_CAPITALS, _DIGITS = bytes(range(65, 91)), bytes(range(48, 58))


def _count(data: bytes, of: bytes) -> int:
    return len(data) - len(data.translate(None, of))


def _word_chars(data: bytes) -> int:
    later = np.frombuffer(data, dtype=np.int8)  # bytes 128 to 191, which start no code point, are under -64
    return len(data) - int(np.count_nonzero(later < -64)) - _count(data, _SPACE)


def _lines(data: bytes) -> list[bytes]:
    return [line for line in data.split(b"\n") if line.strip()]


def _repeat_words(data: bytes) -> int:
    """Words that stand in a window of three which the text holds twice or more."""
    words = next(word_hashes([data]))[0]
    if len(words) < 4:
        return 0
    _, place, n = np.unique(shingles(words, 3), return_inverse=True, return_counts=True)
    again = n[place] > 1
    covered = np.zeros(len(words), dtype=bool)
    for i in range(3):
        covered[i : len(words) - 2 + i] |= again
    return int(covered.sum())


MEASURES: dict[str, Callable[[bytes], int]] = {
    "n_words": lambda d: sum(len(b.split()) for b in blocks(d)),
    "word_chars": _word_chars,
    "n_symbols": lambda d: _count(d, b"#*$%&|<>"),
    "n_marks": lambda d: _count(d, b"!?"),
    "n_capitals": lambda d: _count(d, _CAPITALS),
    "n_digits": lambda d: _count(d, _DIGITS),
    "n_lines": lambda d: len(_lines(d)),
    "n_dup_lines": lambda d: len(x := _lines(d)) - len(set(x)),
    "n_repeat_words": _repeat_words,
}


class Text(dict):
    """The measures of a text, each taken when first asked for."""

    def __init__(self, data: bytes | None):
        self.data = data or b""

    def __missing__(self, name: str) -> int:
        value = self[name] = MEASURES[name](self.data)
        return value


@dataclass(frozen=True)
class Rule:
    name: str
    needs: tuple[str, ...]
    rejects: Callable[[Mapping[str, int]], bool]


#: The rules of the base, which the report names by itself.
BASE = (
    Rule("few words", ("n_words",), lambda m: m["n_words"] < 50),
    Rule("repeated words", ("n_repeat_words", "n_words"), lambda m: 100 * m["n_repeat_words"] > 50 * m["n_words"]),
)
RULES = (
    *BASE,
    Rule("symbols", ("n_symbols", "n_words"), lambda m: 100 * m["n_symbols"] > 10 * m["n_words"]),
    Rule("marks", ("n_marks", "n_words"), lambda m: 100 * m["n_marks"] > 50 * m["n_words"]),
    Rule("capitals", ("n_capitals", "word_chars"), lambda m: 100 * m["n_capitals"] > 30 * m["word_chars"]),
    Rule("digits", ("n_digits", "word_chars"), lambda m: 100 * m["n_digits"] > 30 * m["word_chars"]),
    Rule("repeated lines", ("n_dup_lines", "n_lines"), lambda m: 100 * m["n_dup_lines"] > 50 * m["n_lines"]),
    Rule("word length", ("word_chars", "n_words"), lambda m: not 3 * m["n_words"] <= m["word_chars"] <= 10 * m["n_words"]),
)
REPORTED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Plan:
    """Rules in the order of the cascade, with what the sample said of them: rows that
    the rule rejects of those that reach it, rows that reach it, and nanoseconds a row."""

    rules: tuple[Rule, ...]
    rejected: tuple[int, ...]
    reached: tuple[int, ...]
    cost: tuple[float, ...]


def order_rules(rules: tuple[Rule, ...], verdicts: Mapping[int, int], nanos: Mapping[str, float], taken: tuple[str, ...] = ()) -> Plan:
    """``verdicts`` counts sampled texts by their verdicts (bit i: rule i rejects),
    ``nanos`` is the cost of each measure, ``taken`` are measures taken anyway."""
    left, open_, have = dict(verdicts), list(range(len(rules))), set(taken)
    order, rejected, reached, costs = [], [], [], []
    while open_:
        cost = {i: 1.0 + sum(nanos.get(m, 0.0) for m in rules[i].needs if m not in have) for i in open_}  # 1 ns: the comparison
        hits = {i: sum(n for v, n in left.items() if v >> i & 1) for i in open_}
        # Where no rule rejects any more, the cheapest comes first.
        best = max(open_, key=lambda i: (hits[i] / cost[i], -cost[i], -i))
        order.append(rules[best])
        rejected.append(hits[best])
        reached.append(sum(left.values()))
        costs.append(cost[best])
        left = {v: n for v, n in left.items() if not v >> best & 1}
        have.update(rules[best].needs)
        open_.remove(best)
    return Plan(tuple(order), tuple(rejected), tuple(reached), tuple(costs))


def estimate(docs: DataFrame, rules: tuple[Rule, ...] = RULES, taken: tuple[str, ...] = (), sample: int = SAMPLE) -> Plan:
    """Time the measures and take all verdicts on a sample of about ``sample`` rows."""
    names = list(dict.fromkeys(m for r in rules for m in r.needs))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list[int]] = defaultdict(lambda: [0] * (1 + len(names)))
        for batch in batches:
            for value in batch.column("text").cast(pa.binary()):
                text, spent = Text(value.as_py()), []
                for name in names:
                    t0 = time.perf_counter_ns()
                    text[name]
                    spent.append(time.perf_counter_ns() - t0)
                row = found[sum(r.rejects(text) << i for i, r in enumerate(rules))]
                row[0] += 1
                for i, ns in enumerate(spent):
                    row[1 + i] += ns
        yield pa.record_batch(
            [pa.array(found, pa.int64()), *(pa.array([r[i] for r in found.values()], pa.int64()) for i in range(1 + len(names)))],
            ["verdicts", "texts", *(f"ns{i}" for i in range(len(names)))],
        )

    share = min(1.0, sample / max(1, docs.count()))
    some = docs.select("text").sample(False, share, SAMPLE_SEED)
    columns = ["texts", *(f"ns{i}" for i in range(len(names)))]
    seen = some.mapInArrow(look, f"verdicts long, {', '.join(f'{c} long' for c in columns)}").groupBy("verdicts").agg(*[F.sum(c).alias(c) for c in columns]).collect()
    texts = max(1, sum(r["texts"] for r in seen))
    nanos = {name: sum(r[f"ns{i}"] for r in seen) / texts for i, name in enumerate(names)}
    return order_rules(rules, {r["verdicts"]: r["texts"] for r in seen}, nanos, taken)


def first_rejection(text: Text, rules: tuple[Rule, ...]) -> str | None:
    """The first rule of the cascade that rejects the text."""
    return next((r.name for r in rules if r.rejects(text)), None)


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES, plan: Plan | None = None) -> DataFrame:
    """The rows of ``docs`` that pass the cascade; each text is read up to its first rejection."""
    chosen = (plan or estimate(docs, rules)).rules

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            good = [first_rejection(Text(t.as_py()), chosen) is None for t in texts]
            yield pa.record_batch([batch.column("row")], ["row"]).filter(pa.array(good, pa.bool_()))

    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("text").alias("text"))
    kept = rows.mapInArrow(passing, f"row {rows.schema['row'].dataType.simpleString()}")
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def quality_report(docs: DataFrame, rules: tuple[Rule, ...] = RULES, plan: Plan | None = None) -> DataFrame:
    """The reported measures of every document, whether the base rejects it, and whether
    the cascade (which has the rules of the base among it) lets it pass."""
    chosen = (plan or estimate(docs, rules, REPORTED)).rules
    out = ["doc_id", *REPORTED, "base_failed", "kept"]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for value in batch.column("text").cast(pa.binary()):
                text = Text(value.as_py())
                measures = [text[m] for m in REPORTED]
                rows.append((*measures, any(r.rejects(text) for r in BASE), first_rejection(text, chosen) is None))
            columns = list(zip(*rows, strict=True)) if rows else [()] * (len(out) - 1)
            kinds = [pa.int64()] * len(REPORTED) + [pa.bool_()] * 2
            yield pa.record_batch([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], out)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, {', '.join(f'{m} long' for m in REPORTED)}, base_failed boolean, kept boolean"
    return docs.select("doc_id", "text").mapInArrow(judge, schema)


#: The same rows for DuckDB, every rule written out.
RULES_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM d
), g AS (
  SELECT r, k, w[k] || ' ' || w[k + 1] || ' ' || w[k + 2] AS gram
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS k FROM w)
), a AS (
  SELECT r, k FROM (SELECT r, k, count(*) OVER (PARTITION BY r, gram) AS n FROM g) WHERE n > 1
), c AS (
  SELECT r, count(DISTINCT k + i) AS n_repeat_words FROM a, (SELECT unnest([0, 1, 2]) AS i) GROUP BY r
), l AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(text, E'\n')) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
), m AS (
  SELECT d.r, d.doc_id, len(w.w)::BIGINT AS n_words, length(regexp_replace(d.text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(d.text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         length(regexp_replace(d.text, '[^!?]', '', 'g')) AS n_marks, length(regexp_replace(d.text, '[^A-Z]', '', 'g')) AS n_capitals,
         length(regexp_replace(d.text, '[^0-9]', '', 'g')) AS n_digits, coalesce(l.n_lines, 0) AS n_lines,
         coalesce(l.n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(c.n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM d JOIN w ON w.r = d.r LEFT JOIN l ON l.r = d.r LEFT JOIN c ON c.r = d.r
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 100 * n_symbols > 10 * n_words OR 100 * n_marks > 50 * n_words OR 100 * n_capitals > 30 * word_chars
            OR 100 * n_digits > 30 * word_chars OR 100 * n_dup_lines > 50 * n_lines
            OR word_chars < 3 * n_words OR word_chars > 10 * n_words) AS kept
FROM b
"""
