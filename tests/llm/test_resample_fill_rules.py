"""Importance resampling, fill-in-middle transformation and the cascade of quality rules against
plain Python, with nulls, empty and long texts, ties, repeated rows, clashing columns and empty tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_data import LONG, docs, no_docs  # noqa: F401
from pyspark.sql import functions as F

from starmart.llm import fill_middle, quality_rules, resampling
from starmart.llm.common import Stages

# ---- importance resampling


def plain_features(text, runs):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return w, [" ".join(w[i : i + k]) for k in range(1, runs + 1) for i in range(len(w) - k + 1)]


def plain_resample(rows, target, runs=1, buckets=10_000, seed=2024, percent=10, least=20):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in rows for f in plain_features(t, runs)[1])
    t = Counter(bucket(f) for x in target for f in plain_features(x, runs)[1])
    here, there = float(sum(s.values()) + buckets), float(sum(t.values()) + buckets)
    out = []
    for i, text in rows:
        w, fs = plain_features(text, runs)
        gain = [math.floor(1000 * math.log((t[b] + 1.0) * here / ((s[b] + 1.0) * there))) for b in map(bucket, fs)]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(w), len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    rank = {id(r): k + 1 for k, r in enumerate(able[: len(able) * percent // 100])}
    return sorted(((i, n, weight, score, rank.get(id(r))) for r in out for i, _, n, weight, score in [r]), key=str)


def texts(n, seed=4):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(200)] + ["É", "x-y", "Über", "漢字", "12"]
    return [" ".join(r.choices(words, k=r.randint(0, 60))) for _ in range(n)]


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize(("runs", "buckets", "percent", "least"), [(1, 10_000, 10, 20), (3, 97, 55, 5), (2, 1000, 100, 0), (1, 10, 0, 20)])
def test_resampling_matches_plain_python(spark, runs, buckets, percent, least):
    rows = list(enumerate(texts(400))) + [(7, "again " * 30), (7, "again " * 30), (None, "again " * 30), (None, "again " * 30), (None, None), (8, "")]
    target = texts(30, 5) + [None, ""]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    got = resampling.resample(df, aim, runs=runs, buckets=buckets, percent=percent, least=least)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert collected(got) == plain_resample(rows, target, runs, buckets, percent=percent, least=least)


def test_resampling_edge_cases(spark, docs, no_docs):  # noqa: F811
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert collected(resampling.resample(docs, docs.limit(3), least=1, percent=50)) == plain_resample(rows, [r["text"] for r in docs.limit(3).collect()], least=1, percent=50)
    assert collected(resampling.resample(docs, no_docs)) == plain_resample(rows, [])
    assert resampling.resample(no_docs, docs).count() == 0


def test_features_of_long_texts_run_on_over_blocks(monkeypatch):
    from starmart.llm import hashing

    text = "Ab-c " + " ".join(f"w{i % 50}é" for i in range(300))
    expected = sorted(zlib.crc32(f.encode()) % 997 for f in plain_features(text, 3)[1])
    monkeypatch.setattr(hashing, "BLOCK", 40)
    found, n = resampling.features(text.encode(), 3, 997)
    assert sorted(found.tolist()) == expected and n == 302
    assert resampling.features(None, 3)[1] == 0


@pytest.mark.parametrize("accuracy", [1, 2, 10, 1000])
@pytest.mark.parametrize("kinds", [2, 50, 10**9])
def test_bracket_holds_the_cutoff_however_rough_the_sketch(spark, accuracy, kinds):
    r = random.Random(kinds)
    scores = [r.randrange(kinds) for _ in range(3000)] + [17] * 1500
    df = spark.createDataFrame([(s,) for s in scores], "score long").repartition(7)
    ordered = sorted(scores, reverse=True)
    for k in (1, 2, 450, 2250, 4499, 4500):
        low, high, above = resampling.bracket(df, "score", k, len(scores), accuracy)
        assert low <= ordered[k - 1] <= high and above == sum(s > high for s in scores) < k


def test_draw_splits_equal_scores_and_ids(spark):
    # A third of all rows have one id, one score and one text.
    rows = [(None if i % 3 == 0 else i // 40, 25, 25, 5, 100 if i % 3 == 0 else i % 30) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, n_words long, n_features long, weight long, score long").repartition(6)
    for percent in (10, 40):
        got = resampling.draw(df, Stages(spark, "test"), percent=percent).where("rank IS NOT NULL").orderBy("rank").collect()
        expected = sorted(rows, key=lambda r: (-r[4], r[0] is None, r[0] or 0))[: 30 * percent]
        assert [r["rank"] for r in got] == list(range(1, 30 * percent + 1))
        assert [(r["doc_id"], r["score"]) for r in got] == [(r[0], r[4]) for r in expected]


# ---- fill-in-middle


def plain_fim(i, text, unit=r"[^\n]*\n|[^\n]+", seed=7, rate=100, suffix_first=50):
    text = text or ""
    units = re.findall(unit, text)
    n = len(units)
    digest = hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    spm = h[3] % 100 < suffix_first
    return n, "spm" if spm else "psm", p, m, s, f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"


SPECIAL = ["\n", "\n\n\n", "a", "a\n", "\na", "a\r\nb\r\n", "x<P", "P>y\n<", "<\n>", "$1\\2\n\\Q\\E$3\n{2}", "a<P>b\nc", "<S>", "line\n<M>", " a\u0085b\n\U0001f600\n", "<P<P<M\n>S>\n" * 3]


@pytest.mark.parametrize("options", [{}, {"seed": 3, "rate": 60, "suffix_first": 10}, {"unit": r"[^ ]*+ |[^ ]++"}])
def test_fill_in_middle_matches_plain_python(spark, docs, options):  # noqa: F811
    r = random.Random(2)
    made = ["".join(r.choice(["ab ", "é\n", "\n", "c", "\U0001f600"]) for _ in range(r.randint(1, 40))) for _ in range(200)]
    rows = list(enumerate(SPECIAL + made)) + [(None, "p\nq\nr\n"), (None, None), (-5, "m\nn\n"), (3, ""), (3, "a"), (77, LONG.replace(".", "\n"))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    plain = {k: v.replace("*+", "*").replace("++", "+") if k == "unit" else v for k, v in options.items()}
    done = fill_middle.fill_in_middle(df, **options).select("row.*", "n", "form", "prefix", "middle", "suffix", "output")
    got = sorted((tuple(r) for r in done.collect()), key=str)
    assert got == sorted(((i, t, *plain_fim(i, t, **plain)) for i, t in rows), key=str)
    forms = {row[3] for row in got}
    assert forms == {"plain", "psm", "spm"}
    back = fill_middle.fill_in_middle(df, **options).select("row.text", fill_middle.restored(F.col("output"), F.col("form")).alias("back")).collect()
    assert all(r["back"] == (r["text"] or "") for r in back)


def test_fill_middle_report_edge_cases(spark, docs, no_docs):  # noqa: F811
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    expected = []
    for r in docs.select("doc_id", "text").collect():
        n, form, p, m, _, out = plain_fim(*r)
        expected.append((r["doc_id"], n, form, None if p is None else len(p), None if m is None else len(m), sha(out), sha(r["text"] or "")))
    report = fill_middle.fill_middle_report(docs)
    assert collected(report) == sorted(expected, key=str)
    assert fill_middle.fill_middle_report(no_docs).count() == 0
    whole = fill_middle.fill_in_middle(docs).select("row.*")
    assert whole.columns == docs.columns and whole.count() == docs.count()
    with pytest.raises(ValueError, match="marks"):
        fill_middle.fill_in_middle(docs, marks=("<A>", "<A>", "<B>"))


def test_fill_in_middle_of_very_many_lines_needs_no_stack(spark):
    text = "l\n" * 500_000 + "end"
    df = spark.createDataFrame([(i, text) for i in range(4)], "doc_id long, text string")
    for row in fill_middle.fill_in_middle(df).collect():
        n, form, p, m, s, out = plain_fim(row["row"]["doc_id"], text)
        assert (row["n"], row["form"], row["output"]) == (n, form, out) and n == 500_001


def test_fill_in_middle_matches_once_without_python(spark, docs):  # noqa: F811
    plan = fill_middle.fill_in_middle(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_replace(") == 1 and plan.count("regexp_extract_all(") == 1
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


# ---- quality rules


def plain_measures(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    n = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_marks": len(re.findall("[!?]", text)),
        "n_capitals": len(re.findall("[A-Z]", text)),
        "n_digits": len(re.findall("[0-9]", text)),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


def plain_verdicts(m):
    return [
        m["n_words"] < 50,
        100 * m["n_repeat_words"] > 50 * m["n_words"],
        100 * m["n_symbols"] > 10 * m["n_words"],
        100 * m["n_marks"] > 50 * m["n_words"],
        100 * m["n_capitals"] > 30 * m["word_chars"],
        100 * m["n_digits"] > 30 * m["word_chars"],
        100 * m["n_dup_lines"] > 50 * m["n_lines"],
        not 3 * m["n_words"] <= m["word_chars"] <= 10 * m["n_words"],
    ]


def rule_texts():
    r = random.Random(8)
    word = lambda: "".join(r.choices("abcdefgé", k=r.randint(2, 7)))
    body = lambda k=60: " ".join(word() for _ in range(k))
    out = [body(), body(49), body(50), body(52).upper(), body() + " #" * 7, body() + " |" * 5, "!! ".join(body().split()), body(), "a " * 80]
    out += [" ".join("long" * 4 for _ in range(70)), " ".join(str(r.randrange(10**6)) for _ in range(70)), "a b c a b c", "a b c d", "x x x x", " \x0b\n\n \n", "é ü ß"]
    line = body(5)
    out += ["\n".join([body(12) for _ in range(5)] + [line] * k) for k in (1, 2, 6, 9)] + [line + "\n " + line + "\n" + line + "\r\n" + line, body(30) + "\n" + body(30) + "\n\n"]
    twice = body(40)
    return [*out, twice + " " + twice, twice + " " + body(50) + " " + twice, None, "", LONG]


def test_quality_rules_match_plain_python(spark, docs, no_docs):  # noqa: F811
    rows = list(enumerate(rule_texts())) + [(None, "same"), (3, "same"), (3, "same")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    expected, rejected = [], [0] * 8
    for i, t in rows:
        m = plain_measures(t)
        assert dict(m) == {k: quality_rules.Text((t or "").encode())[k] for k in m}, (i, t)
        v = plain_verdicts(m)
        rejected = [a + b for a, b in zip(rejected, v, strict=True)]
        expected.append((i, *(m[c] for c in quality_rules.REPORTED), v[0] or v[1], not any(v)))
    assert all(rejected) and any(row[-1] for row in expected)
    report = quality_rules.quality_report(df)
    assert report.columns == ["doc_id", *quality_rules.REPORTED, "base_failed", "kept"]
    assert collected(report) == sorted(expected, key=str)
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns and kept.schema["text"] == docs.schema["text"]
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, t in rows if not any(plain_verdicts(plain_measures(t))))
    assert quality_rules.quality_report(no_docs).count() == 0 and quality_rules.keep_good(no_docs).count() == 0


def test_verdicts_do_not_depend_on_the_order(spark):
    df = spark.createDataFrame(list(enumerate(rule_texts())), "doc_id long, text string")
    n = len(quality_rules.RULES)
    plans = [quality_rules.Plan(tuple(quality_rules.RULES[i] for i in np.random.RandomState(s).permutation(n)), (0,) * n, (0,) * n, (0.0,) * n) for s in range(3)]
    reports = [collected(quality_rules.quality_report(df, plan=p)) for p in [*plans, None]]
    assert all(r == reports[0] for r in reports)
    kept = [sorted(r["doc_id"] for r in quality_rules.keep_good(df, plan=p).collect()) for p in [*plans, None]]
    assert all(k == kept[0] == [r[0] for r in sorted(reports[0]) if r[-1]] for k in kept)


def test_order_by_rejections_per_cost():
    rule = lambda name, *needs: quality_rules.Rule(name, needs, lambda m: False)
    rules = (rule("dear", "d"), rule("cheap", "c"), rule("shares", "d", "s"), rule("idle", "i"), rule("same", "c"))
    # dear rejects 60 texts, 50 of which cheap rejects as well; shares rejects 20 others; same rejects what cheap does.
    verdicts = {0b00001: 10, 0b10011: 50, 0b00100: 20, 0: 20}
    nanos = {"d": 5000.0, "c": 99.0, "s": 99.0, "i": 10.0}
    plan = quality_rules.order_rules(rules, verdicts, nanos)
    assert [r.name for r in plan.rules] == ["cheap", "shares", "dear", "same", "idle"]
    assert plan.rejected == (50, 20, 10, 0, 0) and plan.reached == (100, 50, 30, 20, 20)
    assert plan.cost == (100.0, 5100.0, 1.0, 1.0, 11.0)
    # Measures taken anyway cost nothing: then the rule that rejects most comes first.
    plan = quality_rules.order_rules(rules, verdicts, nanos, ("d", "c"))
    assert [r.name for r in plan.rules][:2] == ["dear", "shares"]


def test_estimate_sees_costs_and_selectivity(spark):
    good = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300))
    df = spark.createDataFrame([(i, "short" if i % 4 else good) for i in range(400)], "doc_id long, text string")
    plan = quality_rules.estimate(df, sample=10**9)
    assert plan.reached[0] == 400 and plan.rules[0].name == "few words" and plan.rejected[0] == 300
    assert sum(plan.rejected) == 300 and plan.reached[1] == 100 and all(c > 0 for c in plan.cost)


def test_a_rejection_ends_the_text():
    text = quality_rules.Text(b"two words")
    assert quality_rules.first_rejection(text, quality_rules.RULES) == "few words"
    assert set(text) == {"n_words"}
