"""Toxicity by a weighted finite-state grammar over clauses.

Five small transducers read the words of a clause side by side: insults carry
weights, a threat verb needs a target soon after it, a target just before an
insult makes it heavier, a negation before it or reported speech around it makes
it lighter. Their composition is one table; a clause scores the sum of what the
table puts out. A text's total, density and heaviest clause go through a
logistic curve whose coefficients are not negative: more of what the grammar puts out
never lowers a score.

Reported speech is what follows a verb of saying in its clause, and what stands in
quotation marks, up to the closing mark or the end of the line; the comma or colon
between the verb and its quotation does not end the clause. Words both said and quoted
are lighter than words only said.

Insult weights (whole words, and beginnings of words for languages that compound
or inflect) and the curve are learned from labels of documents that are not held
out, on at most ``TRAIN_DOCS`` of them. Language, source and id never enter a
score.

Defined results: a null or empty text scores like one without any match; null
labels are not learned from; a document labelled several times is toxic if any
label says so; without labels of both classes the seed words and a fixed curve
remain; repeated rows are scored each for itself; other columns are not read; an
empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import Stages, held_out, small_batches
from starmart.llm.quality import training_rows

#: Most labelled documents that weights and curve are learned from.
TRAIN_DOCS = 8000
#: Parts of the sample; each gets its features from the lexicon of the others.
FOLDS = 5
#: Most terms the learned lexicon may hold.
MOST_TERMS = 4000
THRESHOLD = 0.7

# Seed words of the grammar.
INSULTS = "idiot imbecile moron scum vermin stupid worthless pathetic disgusting loser trash clown".split()
THREATS = "kill hurt shoot stab murder strangle destroy".split()
TARGETS = "you your yours yourself he him she her they them their".split()
NEGATIONS = "not never no don't doesn't didn't isn't aren't wasn't cannot can't won't nicht kein keine jamais nunca".split()
REPORTS = "said says wrote writes claimed claims told quoted quotes reported reportedly according".split()

#: Weight of a seed insult that the labels say nothing about, and of a complete threat.
SEED_WEIGHT, THREAT_WEIGHT = 2.5, 4.0
#: Factors on an insult or threat: aimed at a target, negated, reported.
TARGETED, NEGATED, REPORTED = 1.5, 0.1, 0.5
#: Factor on what is quoted after a verb of saying.
SAID_IN_QUOTES = 0.35
#: How many words a negation, a target and a threat verb reach.
NEGATION_REACH, TARGET_REACH, THREAT_REACH = 3, 4, 3

#: Lengths of the beginnings of words that may become terms.
PREFIXES = (4, 5, 6, 7)

_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
_TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|[\"“”«»]")
_CLAUSE = re.compile(r"[.!?;:,|…]+")
_SAYING = re.compile(rf"\b({'|'.join(REPORTS)})\s*[,:]+")

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE = range(7)
_SYMBOL = {w: s for s, words in ((THREAT, THREATS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)) for w in words}
_SYMBOL |= {q: QUOTE for q in "\"“”«»"}


@dataclass(frozen=True)
class Transducer:
    """States 0..n-1 from 0; ``step(state, symbol)`` gives the next state, a factor
    on what the symbol puts out, and an amount put out besides."""

    states: int
    step: object = field(repr=False)


def _reach(symbol: int, n: int, factor: float, on: tuple[int, ...]) -> Transducer:
    """Changes ``on`` symbols by ``factor`` up to ``n`` words after ``symbol``."""

    def step(state: int, s: int):
        return (n if s == symbol else state if s == QUOTE else max(state - 1, 0)), (factor if state and s in on else 1.0), 0.0

    return Transducer(n + 1, step)


#: States of reported speech.
PLAIN, SAID, QUOTING, SAID_QUOTING = range(4)
_LIGHTER = {SAID: REPORTED, QUOTING: REPORTED, SAID_QUOTING: SAID_IN_QUOTES}


def _reported(state: int, s: int):
    nxt = state
    if s == REPORT and state == PLAIN:
        nxt = SAID
    elif s == QUOTE:
        nxt = {PLAIN: QUOTING, SAID: SAID_QUOTING}.get(state, PLAIN)
    return nxt, _LIGHTER.get(state, 1.0) if s in (INSULT, TARGET) else 1.0, 0.0


def _threat(state: int, s: int):
    if s == TARGET and state:
        return 0, 1.0, THREAT_WEIGHT
    return (THREAT_REACH if s == THREAT else max(state - 1, 0)), 1.0, 0.0


NEGATE = _reach(NEGATION, NEGATION_REACH, NEGATED, (INSULT, TARGET))
AIM = _reach(TARGET, TARGET_REACH, TARGETED, (INSULT,))
QUOTED = Transducer(4, _reported)
MENACE = Transducer(THREAT_REACH + 1, _threat)


PARTS = (NEGATE, AIM, QUOTED, MENACE)


def compose(*parts: Transducer) -> tuple[dict[tuple[int, int], tuple[int, float, float]], list[tuple[int, ...]]]:
    """One table for all transducers read side by side: (state, symbol) to the next
    state, the factor on an insult's weight, and a threat's amount after the factors;
    and the states of the parts that each of its states stands for."""
    states = list(product(*(range(p.states) for p in parts)))
    number = {s: i for i, s in enumerate(states)}
    table = {}
    for state, symbol in product(states, range(7)):
        steps = [p.step(s, symbol) for p, s in zip(parts, state, strict=True)]
        factor = math.prod(f for _, f, _ in steps)
        table[number[state], symbol] = number[tuple(n for n, _, _ in steps)], factor, factor * sum(a for _, _, a in steps)
    return table, states


GRAMMAR, STATES = compose(*PARTS)
#: The state that the next clause of a line starts in: open quotation marks stay open.
NEXT_CLAUSE = [STATES.index(tuple(s if p is QUOTED and s >= QUOTING else 0 for p, s in zip(PARTS, state, strict=True))) for state in STATES]


class Scorer:
    """Scores texts under a lexicon of insult weights (``xxxx*`` weighs words that begin so)."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = {w: SEED_WEIGHT for w in INSULTS} | lexicon
        # The first letters of all that weighs something, to tell most words apart at once.
        self._starts = {w.rstrip("*")[:4] for w in self.lexicon} | {w[:4] for w in THREATS}

    def weight(self, word: str) -> float:
        """The largest weight that the lexicon has for the word or a beginning of it."""
        if word[:4] not in self._starts:
            return 0.0
        starts = [self.lexicon.get(word[:k] + "*", 0.0) for k in PREFIXES if len(word) > k]
        return max(self.lexicon.get(word, 0.0), *starts, 0.0)

    def look_up(self, runs: list[str]) -> bool:
        """Whether any of the runs of text holds an insult or a threat verb."""
        starts = self._starts
        for run in set(runs):
            if run[:4] in starts or not run.isalpha():
                for word in (run,) if run.isalpha() else _WORD.findall(run):
                    if word[:4] in starts and (_SYMBOL.get(word) == THREAT or self.weight(word)):
                        return True
        return False

    def clause(self, clause: str, state: int = 0) -> tuple[float, int]:
        """What the grammar puts out for a clause, and the state the next one starts in."""
        total = 0.0
        for token in _TOKEN.findall(clause):
            weight = self.weight(token)
            state, factor, amount = GRAMMAR[state, INSULT if weight else _SYMBOL.get(token, OTHER)]
            total += weight * factor + amount
        return total, NEXT_CLAUSE[state]

    def clauses(self, text: str) -> list[float]:
        """What the grammar puts out for each clause of a text in lower case."""
        found = []
        for line in text.split("\n"):
            state = 0
            for clause in _CLAUSE.split(_SAYING.sub(r"\1 ", line)):
                total, state = self.clause(clause, state)
                found.append(total)
        return found

    def features(self, text: str) -> tuple[float, ...]:
        """Logarithms of the total, of the total per 100 words, and of the heaviest clause."""
        text = text.lower()
        runs = text.split()
        # Without an insult or a threat verb no clause puts anything out.
        if not self.look_up(runs):
            return 0.0, 0.0, 0.0
        scores = self.clauses(text)
        total = sum(scores)
        return math.log1p(total), math.log1p(100 * total / (len(runs) + 20)), math.log1p(max(scores))


@dataclass(frozen=True)
class Model:
    lexicon: dict[str, float]
    curve: tuple[float, ...] = (-4.0, 0.8, 0.8, 0.8)

    def probability(self, features: tuple[float, ...]) -> float:
        z = self.curve[0] + sum(c * f for c, f in zip(self.curve[1:], features, strict=True))
        return 1 / (1 + math.exp(-max(-35.0, min(35.0, z))))


def terms(text: str) -> set[str]:
    """The words of a text and the beginnings of its longer words."""
    words = {w for w in _WORD.findall(text.lower()) if len(w) > 1}
    return words | {w[:k] + "*" for w in words for k in PREFIXES if len(w) > k}


def weights(counts: list[tuple[str, float, float]], toxic: float, clean: float) -> dict[str, float]:
    """Weights of the terms that stand out in toxic documents: the log ratio of
    their shares, less its standard error."""
    out = {}
    for term, p, n in counts:
        if p < 3:
            continue
        ratio = math.log((p + 0.5) / (toxic + 1)) - math.log((n + 0.5) / (clean + 1))
        error = math.sqrt(1 / (p + 0.5) + 1 / (n + 0.5))
        if ratio >= 1.2 and ratio >= 2.5 * error:
            out[term] = min(ratio - error, 6.0)
    return dict(sorted(out.items(), key=lambda x: (-x[1], x[0]))[:MOST_TERMS])


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Logistic regression with a light ridge and no negative coefficient, by Newton
    steps: columns that would get one leave, the lowest first, and the rest is fit anew."""
    used = list(range(x.shape[1]))
    while True:
        z = np.column_stack([np.ones(len(x)), x[:, used]])
        beta = np.zeros(z.shape[1])
        ridge = np.diag([1e-3] + [0.3] * len(used))
        for _ in range(60):
            p = 1 / (1 + np.exp(-np.clip(z @ beta, -35, 35)))
            step = np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + ridge, z.T @ (p - y) + ridge @ beta)
            beta -= np.clip(step, -3, 3)
            if np.abs(step).max() < 1e-8:
                break
        if not used or beta[1:].min() >= 0:
            found = dict(zip(used, beta[1:], strict=True))
            return (float(beta[0]), *(float(found.get(i, 0.0)) for i in range(x.shape[1])))
        used.pop(int(np.argmin(beta[1:])))


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", most: int = TRAIN_DOCS) -> Model:
    """Learn the lexicon and the curve. The curve is fit on features that each fold
    of the sample gets from the lexicon of the other folds."""
    small_batches(docs.sparkSession)
    stages = Stages(docs.sparkSession, "toxicity")
    sample = training_rows(docs, labels, label, most).select(
        F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(FOLDS)).cast("int").alias("fold"),
        (F.col("good") > 0).alias("toxic"),
        F.coalesce("text", F.lit("")).alias("text"),
        "doc_id",
    )
    sample = stages.write(sample.repartition("doc_id"), "sample").drop("doc_id")
    columns = [f"{c}{k}" for k in range(FOLDS) for c in "pn"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [Counter() for _ in columns]
        for batch in batches:
            for row in batch.to_pylist():
                found[2 * row["fold"] + (not row["toxic"])].update(terms(row["text"]))
        every = sorted(set().union(*found))
        yield pa.record_batch([pa.array(every, pa.string())] + [pa.array([c[t] for t in every], pa.int64()) for c in found], ["term", *columns])

    counted = sample.mapInArrow(count, ", ".join(["term string", *(f"{c} long" for c in columns)]))
    counted = counted.groupBy("term").agg(*[F.sum(c).alias(c) for c in columns])
    toxic, clean = (sum(F.col(f"{c}{k}") for k in range(FOLDS)) for c in "pn")
    # Bounded: the terms of the most toxic documents, by surplus of toxic ones.
    surplus = toxic - 0.2 * clean
    top = counted.where((toxic >= 3) & (surplus > 0)).orderBy(surplus.desc(), "term").limit(5 * MOST_TERMS).collect()
    size = {(r["fold"], r["toxic"]): r["n"] for r in sample.groupBy("fold", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}

    def lexicon(folds: list[int]) -> dict[str, float]:
        n = [sum(size.get((k, t), 0) for k in folds) for t in (True, False)]
        return weights([(r["term"], *(sum(r[f"{c}{k}"] for k in folds) for c in "pn")) for r in top], *n)

    if not all(any(size.get((k, t)) for k in range(FOLDS)) for t in (True, False)):
        return Model({})
    others = [lexicon([k for k in range(FOLDS) if k != fold]) for fold in range(FOLDS)]

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorers = [Scorer(words) for words in others]
        for batch in batches:
            rows = batch.to_pylist()
            found = [scorers[r["fold"]].features(r["text"]) for r in rows]
            yield pa.record_batch([batch.column("toxic"), *(pa.array([f[i] for f in found], pa.float64()) for i in range(3))], ["toxic", *"abc"])

    rows = sorted(tuple(r) for r in sample.mapInArrow(features, "toxic boolean, a double, b double, c double").collect())
    stages.drop(sample)
    return Model(lexicon(list(range(FOLDS))), logistic(np.array([r[1:] for r in rows]), np.array([r[0] for r in rows], dtype=float)))


def score_toxicity(docs: DataFrame, model: Model, threshold: float = THRESHOLD, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default doc_id) with held_out, score and predicted for every document."""
    keep = ["doc_id"] if keep is None else keep
    small_batches(docs.sparkSession)

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.lexicon)
        for batch in batches:
            found = [model.probability(scorer.features(t.as_py() or "")) for t in batch.column("text")]
            yield pa.record_batch([batch.column("row"), pa.array(found, pa.float64())], ["row", "score"])

    rows = docs.select(F.struct(*keep, held_out("doc_id").alias("held_out")).alias("row"), F.col("text"))
    scored = rows.mapInArrow(scores, f"row {rows.schema['row'].dataType.simpleString()}, score double")
    return scored.select("row.*", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on ``labels`` and score all ``docs``."""
    return score_toxicity(docs, fit_toxicity(docs, labels))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the filter lets pass, with all their columns."""
    model = fit_toxicity(docs, labels)

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.lexicon)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            yield batch.filter(pa.array([model.probability(scorer.features(t.as_py() or "")) < threshold for t in texts], pa.bool_()))

    return docs.mapInArrow(passing, docs.schema)
