"""Operators on documents: brute force, planted cases, and nulls, empty and long
texts, repeated rows, clashing columns and empty tables."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import pytest
from conftest import SF_SMALL
from llm_data import docs, labels, no_docs, no_labels  # noqa: F401

from starmart.llm import common, jaccard_join, mixing, packing, pii, quality, sentence_dedup, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def by_id(df, *columns):
    return sorted(((r["doc_id"], *(r[c] for c in columns)) for r in df.collect()), key=str)


# ---- near duplicates


def jaccard_groups(rows):
    sets = defaultdict(set)
    for i, text in rows:
        w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        if i is not None and w:
            sets[i] |= {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
    group = {i: i for i in sets}

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    holders = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    pairs = {(a, b) for ids in holders.values() for a in ids for b in ids if a < b}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            group[max(x, y)] = min(x, y)
    return {i: (len(sets.get(i, ())), find(i) if i in sets else i) for i, _ in rows if i is not None}


@pytest.mark.parametrize("block", [1000, 3])
def test_similar_groups_match_all_pairs(spark, docs, block):
    r = random.Random(5)
    vocabulary = [f"v{i}" for i in range(400)]
    texts = []
    for _ in range(25):
        base = [r.choice(vocabulary) for _ in range(r.randint(1, 120))]
        for _ in range(r.randint(1, 6)):
            texts.append(" ".join(w if r.random() > 0.02 else r.choice(vocabulary) for w in base))
    texts += ["common opening that many texts share word for word " + " ".join(r.choices(vocabulary, k=9)) for _ in range(30)]
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.similar_groups(df, block=block).collect()}
    assert got == jaccard_groups(rows)


def test_similar_groups_edge_cases(docs, no_docs):
    got = jaccard_join.similar_groups(docs).collect()
    expected = jaccard_groups([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    assert len(got) == docs.count()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None} == expected
    assert [r["component_id"] for r in got if r["doc_id"] is None] == [None]
    assert expected[2][1] == 1 and expected[8][1] == 7 and expected[10][1] == 9 and expected[5] == (0, 5)
    kept = jaccard_join.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert [i for i, in by_id(kept)] == [1, 11, 13, 14, 4, 5, 6, 7, 9, None]
    assert jaccard_join.similar_groups(no_docs).count() == 0


def test_one_of_repeated_rows_stays(spark):
    text, other = " ".join(f"t{i}" for i in range(30)), " ".join(f"o{i}" for i in range(30))
    rows = [(1, text, "a"), (1, text.upper(), "b"), (1, other, "c"), (2, text, "d"), (2, text, "e"), (3, "lone", "f")]
    rows += [(None, text, "g"), (None, text, "h"), (None, other, "i"), (None, None, "j"), (None, "", "k"), (4, None, "l"), (4, None, "m")]
    df = spark.createDataFrame(rows, "doc_id long, text string, number string").repartition(3)
    kept = jaccard_join.drop_near_duplicates(df)
    assert kept.columns == df.columns
    got = [(r["doc_id"], (r["text"] or "").lower()) for r in kept.collect()]
    expected = [(1, text), (1, other), (3, "lone"), (None, text), (None, other), (None, ""), (None, ""), (4, ""), (4, "")]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert set(r["number"] for r in kept.collect()) <= set("abcdefghijklm")


# ---- repeated spans


def test_repeated_passage_goes_and_the_first_stays(spark):
    r = random.Random(3)
    line = lambda: " ".join(f"x{r.randrange(10**6)}" for _ in range(r.randint(4, 9))) + "."
    passage = " ".join(line() for _ in range(10))
    rows = [(i, " ".join([line() for _ in range(5)] + [passage] * (i % 3 == 0) + [line() for _ in range(4)])) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in sentence_dedup.repeated_spans(df).collect()}
    assert set(found) == {i for i in range(1, 30) if i % 3 == 0}
    for i, row in found.items():
        assert row["first_doc_id"] == 0 and [(s["begin"], s["end"]) for s in row["spans"]] == [(5, 15)]
    cleaned = dict(by_id(sentence_dedup.drop_repeats(df), "text"))
    for i, text in rows:
        assert cleaned[i] == (text if i % 3 or not i else text.replace(passage + " ", ""))


def test_rows_that_repeat_an_id_are_cut_each_by_itself(spark):
    r = random.Random(12)
    line = lambda: " ".join(f"y{r.randrange(10**6)}" for _ in range(8)) + "."
    passage, other, more = (" ".join(line() for _ in range(4)) for _ in range(3))
    kept = lambda rows: sorted(((x["doc_id"], x["text"]) for x in sentence_dedup.drop_repeats(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()), key=str)
    # Another text under the same id stays whole; the passage goes from the later row alone.
    assert kept([(1, passage), (2, passage), (2, other)]) == sorted([(1, passage), (2, ""), (2, other)], key=str)
    # Spans of one row never reach into a shorter one.
    rows = [(2, other + " " + passage + " " + more), (2, "short one."), (1, passage), (3, passage)]
    assert kept(rows) == sorted([(1, passage), (2, other + " " + more), (2, "short one."), (3, "")], key=str)
    # Of equal rows one keeps its text; null ids take no part.
    assert kept([(1, passage), (1, passage), (None, passage), (None, passage)]) == sorted([(1, passage), (1, ""), (None, passage), (None, passage)], key=str)


def test_a_hot_run_is_not_shuffled_to_its_occurrences(spark, monkeypatch):
    r = random.Random(14)
    line = lambda: " ".join(f"z{r.randrange(10**6)}" for _ in range(11)) + "."
    hot, warm = (" ".join(line() for _ in range(3)) for _ in range(2))
    rows = [(i, " ".join([line(), line(), *([hot] if i % 3 == 0 else []), *([warm] if i in (4, 8) else []), line()])) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = []
    for share in (0.001, 0.05, 2.0):
        monkeypatch.setattr(sentence_dedup, "HOT", share)
        found.append(sorted((x["doc_id"], x["first_doc_id"], x["n_removed"]) for x in sentence_dedup.repeated_spans(df).collect()))
    assert found[0] == found[1] == found[2] == [(i, 0 if i % 3 == 0 else 4, 3) for i in range(1, 300) if i % 3 == 0 or i == 8]


def test_repeated_spans_edge_cases(docs, no_docs):
    found = {r["doc_id"]: r["first_doc_id"] for r in sentence_dedup.repeated_spans(docs).collect()}
    assert found == {2: 1, 9: 9, 10: 9, 15: 1}  # 9 repeats itself, the long sentence of 1 is in 15
    cleaned = sentence_dedup.drop_repeats(docs)
    assert cleaned.columns == docs.columns and cleaned.count() == docs.count()
    assert dict(by_id(cleaned, "text"))[2] == "" and dict(by_id(cleaned, "text"))[4] is None
    assert sentence_dedup.repeated_spans(no_docs).count() == 0


def every_run_removed(rows, least=2, words_=20, long=40):
    """Removed sentences of each document, and the least document with one of its later runs, by all runs of all lengths."""
    places, removed, first = defaultdict(set), defaultdict(set), {}
    for i, text in rows:
        said = [tuple(words(s)) for s in re.split(r"(?<=[.!?])[\x20\x09-\x0D]+|\n", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if words(s)]
        for b in range(len(said)):
            for e in range(b + 1, len(said) + 1):
                run = sum(said[b:e], ())
                if (e - b >= least and len(run) >= words_) or (e - b == 1 and len(run) >= long):
                    places[run].add((i, b, e))
    for found in places.values():
        for i, b, e in sorted(found)[1:]:
            removed[i] |= set(range(b, e))
            first[i] = min(first.get(i, i), min(found)[0])
    return {i: (sorted(s), first[i]) for i, s in removed.items()}


def spans_removed(df):
    return {r["doc_id"]: ([k for s in r["spans"] for k in range(s["begin"], s["end"])], r["first_doc_id"]) for r in sentence_dedup.repeated_spans(df).collect()}


def test_short_last_sentences_of_a_passage_go(spark):
    r = random.Random(7)
    line = lambda n: " ".join(f"y{r.randrange(10**6)}" for _ in range(n)) + "."
    passage = " ".join(line(n) for n in (15, 12, 5))
    rows = [(i, " ".join([line(8), passage, line(9)])) for i in range(3)]  # amid other text
    rows.append((3, line(45) + " Short end."))
    rows += [(4, rows[3][1]), (5, passage), (6, rows[0][1])]  # exact copies, and the passage alone
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = spans_removed(df)
    assert got == every_run_removed(rows)
    assert got == {1: ([1, 2, 3], 0), 2: ([1, 2, 3], 0), 4: ([0, 1], 3), 5: ([0, 1, 2], 0), 6: ([0, 1, 2, 3, 4], 0)}
    cleaned = dict(by_id(sentence_dedup.drop_repeats(df), "text"))
    assert cleaned[1] == rows[1][1].replace(passage + " ", "") and cleaned[6] == ""


def test_repeated_spans_are_those_of_every_run(spark):
    r = random.Random(11)
    line = lambda: " ".join(r.choice("abc") for _ in range(r.choice((1, 2, 4, 7, 13, 19, 25, 42)))) + r.choice(".!?")
    pool = [line() for _ in range(12)]
    rows = [(i, " ".join(r.choice(pool) if r.random() < 0.8 else line() for _ in range(r.randint(1, 12)))) for i in range(60)]
    assert spans_removed(spark.createDataFrame(rows, "doc_id long, text string")) == every_run_removed(rows)
    given = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    assert spans_removed(given) == every_run_removed([tuple(r) for r in given.collect()])


# ---- mixing and packing


def test_mix_takes_near_its_targets(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    plan = mixing.mix_plan(docs).collect()
    taken, target, size = defaultdict(int), {}, {}
    for row in plan:
        assert 0 <= row["copies"] <= 2 and row["size"] == len(words(row["row"]["text"]))
        s = row["row"]["source"]
        taken[s] += row["size"] * row["copies"]
        target[s], size[s] = row["target"], row["source_size"]
    assert sum(target.values()) == pytest.approx(1.5 * sum(size.values()))
    longest = max(r["size"] for r in plan)
    for s in target:
        assert target[s] <= 2 * size[s] and abs(taken[s] - target[s]) <= 2 * longest
    assert by_id(mixing.mix_report(docs), "taken") == by_id(mixing.mix_report(docs.repartition(5)), "taken")
    assert mixing.mix(docs).count() == sum(r["copies"] for r in plan)


def test_mix_edge_cases(docs, no_docs):
    report = mixing.mix_report(docs).collect()
    assert len(report) == docs.count()
    assert {r["doc_id"]: (r["size"], r["taken"]) for r in report}[4] == (0, 0)
    assert mixing.mix(docs).columns == docs.columns
    assert mixing.mix_report(no_docs).count() == 0
    # Sources by code point, null last, weigh 3, 1, 2 in turn.
    assert {r["source_size"] for r in report if r["doc_id"] in (4, 3)} == {61}


def brute_pack(lengths, permitted):
    """Best fit by looking at every open bin."""
    room, used, bins = [], [], []
    for n in lengths:
        fitting = [(room[b], b) for b in range(len(room)) if room[b] >= n]
        if fitting:
            least = min(f[0] for f in fitting)
            b = max(b for free, b in fitting if free == least)
        else:
            b = len(room)
            room.append(min((s for s in permitted if s >= n), key=lambda s: (packing.sequence_cost(s) / s, s)))
            used.append(0)
        room[b] -= n
        used[b] += n
        bins.append(b)
    return sorted(used), [min(s for s in permitted if s >= u) for u in used]


def test_pack_is_best_fit():
    r = random.Random(2)
    for _ in range(20):
        lengths = sorted((r.randint(1, 100) for _ in range(200)), reverse=True)
        bins, offsets, sizes = packing.pack(lengths, (32, 64, 100))
        used = defaultdict(int)
        for b, o, n in zip(bins, offsets, lengths, strict=True):
            assert o == used[b]
            used[b] += n
        expected, shrunk = brute_pack(lengths, (32, 64, 100))
        assert sorted(used.values()) == expected and sorted(sizes) == sorted(shrunk)
        assert all(used[b] <= sizes[b] for b in used)


def test_packing_places_every_word(docs, no_docs):
    placed = packing.pack_documents(docs, shard_pieces=4).collect()
    got, bins = defaultdict(int), defaultdict(list)
    for row in placed:
        got[row["doc_id"]] += row["n_words"]
        bins[row["bin_id"]].append((row["bin_offset"], row["n_words"], row["bin_used"], row["bin_size"]))
    expected = defaultdict(int)
    for row in docs.select("doc_id", "text").collect():
        if words(row["text"]):
            expected[row["doc_id"]] += len(words(row["text"]))
    assert got == expected
    for parts in bins.values():
        at = 0
        for offset, n, used, size in sorted(parts):
            assert offset == at
            at += n
            assert size in packing.LENGTHS
        assert at == used <= size
    assert packing.pack_documents(no_docs).count() == 0


def test_equal_and_null_ids_spread_over_shards(spark):
    rows = [(None, "a b c")] * 40 + [(7, "a b c")] * 40 + [(i, "a b") for i in range(20)]
    placed = packing.pack_documents(spark.createDataFrame(rows, "doc_id long, text string"), shard_pieces=10).collect()
    shards = defaultdict(int)
    for row in placed:
        shards[row["bin_id"] >> 32] += 1
    assert len(placed) == 100 and sorted(shards.values()) == [10] * 10


# ---- personal data

BASE_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_base(text):
    out = []
    for k, (kind, pattern) in enumerate(BASE_PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            double = [d for i, d in enumerate(reversed(digits)) if i % 2]
            luhn = (sum(d for i, d in enumerate(reversed(digits)) if not i % 2) + sum(sum(divmod(2 * d, 10)) for d in double)) % 10 == 0
            fine = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 12 <= len(digits) <= 19 and luhn,
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if fine:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans_are_the_patterns():
    r = random.Random(8)
    pieces = ["a.b@c.de", "@", "x@y", "1.2.3.4", "256.1.1.1", "10.0.0.1.2.3.4.5", "4012888888881881", "4012 8888-8888 1881", "+1 (555) 010-9999", "+", "é", " ", ".", "-", "0", "77", "a@b.c@d.e", "+49", "漢"]
    for _ in range(4000):
        text = "".join(r.choice(pieces) for _ in range(r.randint(0, 12)))
        assert pii.base_spans(text)[0] == plain_base(text), text


def test_windows_cover_every_digit_and_at_sign():
    r = random.Random(4)
    for _ in range(300):
        text = "".join(r.choice("aaaaaaaaaaaaaaaaaaaaaaaaaaaaaa 7@") for _ in range(r.randint(0, 500)))
        starts = pii.window_starts(text)
        assert starts == sorted(set(starts)) and all(s % pii.STRIDE == 0 for s in starts)
        for i, c in enumerate(text):
            if c in "7@":
                expected = [s for s in range(0, len(text), pii.STRIDE) if s <= i < s + pii.WINDOW and (s == 0 or s < len(text) - pii.WINDOW + pii.STRIDE)]
                assert set(expected) <= set(starts), (text, i)


def test_gradients_of_the_network():
    import numpy as np

    r = np.random.RandomState(0)
    net = pii.Tagger()
    x, y = r.randint(0, pii.CLASSES, (2, pii.WINDOW)), np.zeros((2, pii.WINDOW), int)
    y[0, 5:9], y[1, 10:13] = [1, 2, 2, 2], [5, 6, 6]
    _, grads = net.loss(x, y)
    for name, at in {"xf": (x[0, 3], 5), "hb": (2, 7), "zf": (3,), "out": (4, 2), "bias": (1,), "move": (0, 1), "first": (0,)}.items():
        old = net.p[name][at]
        sides = []
        for e in (1e-5, -1e-5):
            net.p[name][at] = old + e
            sides.append(net.loss(x, y)[0])
        net.p[name][at] = old
        assert grads[name][at] == pytest.approx((sides[0] - sides[1]) / 2e-5, rel=1e-4, abs=1e-7)


def plain_viterbi(net, classes):
    import numpy as np

    emit = np.concatenate([net._lstm(classes[None], d, None) for d in "fb"], axis=2)[0] @ net.p["out"] + net.p["bias"]
    follows = lambda a, b: b % 2 == 1 or b == 0 or a in (b - 1, b)  # I only after B or I of its kind
    best = {t: (net.p["first"][t] + emit[0, t], [t]) for t in range(pii.TAGS) if t % 2 or t == 0}
    for i in range(1, pii.WINDOW):
        step = {}
        for t in range(pii.TAGS):
            come = [(score + net.p["move"][a, t], path) for a, (score, path) in best.items() if follows(a, t)]
            if come:
                score, path = max(come, key=lambda x: x[0])
                step[t] = score + emit[i, t], [*path, t]
        best = step
    return max(best.values(), key=lambda x: x[0])


def test_decoding_is_the_best_allowed_path():
    import numpy as np

    r = np.random.RandomState(9)
    net = pii.Tagger(5)
    net.p["move"] = r.randn(pii.TAGS, pii.TAGS)
    net.p["first"] = r.randn(pii.TAGS)
    net.p["out"] *= 5
    x = r.randint(0, pii.CLASSES, (6, pii.WINDOW))
    for classes, tags in zip(x, net.decode(x), strict=True):
        assert tags.tolist() == plain_viterbi(net, classes)[1]


def test_reconciled_spans_are_those_of_the_central_tags():
    """With windows that agree, spans of any length come back whole, over all borders."""
    import numpy as np

    r = random.Random(31)
    for _ in range(300):
        size, spans, at = r.randint(1, 400), [], 0
        while (at := at + r.randint(1, 90)) < size:
            end = min(size, at + r.randint(1, 120))
            spans.append((at, r.randrange(len(pii.KINDS)), end))
            at = end
        tags = np.zeros(size + pii.WINDOW, dtype=np.int8)
        for s, k, e in spans:
            tags[s:e] = 2 + 2 * k
            tags[s] = 1 + 2 * k
        starts = list(range(0, max(1, size - pii.WINDOW + pii.STRIDE), pii.STRIDE))
        assert pii._reconcile(starts, np.stack([tags[s : s + pii.WINDOW] for s in starts]), size) == spans


def test_planted_windows_are_labelled_where_the_secret_stands():
    import numpy as np

    words = "lorem ipsum dolor sit amet consectetur " * 4
    kinds = set()
    for seed in range(300):
        window, tags = pii.planted(words, seed)
        assert len(window) <= pii.WINDOW and len(tags) == pii.WINDOW and not tags[len(window) :].any()
        marked = np.flatnonzero(tags)
        assert set(tags[marked].tolist()) <= {1 + 2 * pii.SECRET, 2 + 2 * pii.SECRET}
        if len(marked):
            value = window[marked[0] : marked[-1] + 1]
            assert len(marked) == len(value) and pii._RUN.fullmatch(value) and not pii.unlabelled(window, tags)
        kinds.add(bool(len(marked)))
    assert kinds == {True, False}
    assert pii.unlabelled('x = "8b540ef2c226668020056c24"', np.zeros(pii.WINDOW, np.int8)) and not pii.unlabelled("version 12.4 of 2019", np.zeros(pii.WINDOW, np.int8))


def test_network_finds_secrets_outside_its_sample(spark):
    """Trained on a part of the documents; every token of the others is found whole, and nothing else is added."""
    from pyspark.sql import functions as F

    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where(F.col("text").rlike("[0-9@]"))
    learned, others = docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1")
    net = pii.fit_pii(learned)
    seen = {r["text"] for r in learned.select("text").collect()}
    rows = [(10**6, 'api_key: "Zk39fQx7PlmN2vB8tYw4RsD1"'), (10**6 + 1, "released in 2019 as version 12.4, 300 pages"), (None, None)]
    given = others.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    text = {r["doc_id"]: r["text"] or "" for r in given.collect()}
    found = right = there = 0
    for row in pii.pii_spans(given, net).collect():
        got = {x for x in row["spans"].split(",") if x.startswith("secret")}
        assert row["n_added"] >= len(got)
        if row["doc_id"] is None or row["doc_id"] >= 10**6:
            assert (len(got) == 1) == (row["doc_id"] == 10**6) and row["n_spans"] == len(got)
        elif text[row["doc_id"]] not in seen:
            true = {f"secret:{m.start(1)}:{m.end(1)}" for m in re.finditer(r'(?i)token = "([0-9a-f]{40})"', text[row["doc_id"]])}
            found, right, there = found + len(got), right + len(got & true), there + len(true)
    assert there > 50 and right >= 0.9 * there and right >= 0.9 * found, (there, right, found)
    hidden = pii.redact_documents(others, net).where(F.col("text").rlike('(?i)token = "[0-9a-f]{40}"')).count()
    assert hidden <= 0.1 * there


def test_network_learns_the_spans_and_base_spans_stay(spark, docs, no_docs):
    r = random.Random(6)
    fake = lambda: r.choice([f"u{r.randrange(99)}@m{r.randrange(9)}.example.org", f"{r.randrange(256)}.{r.randrange(256)}.{r.randrange(256)}.{r.randrange(256)}", f"+1 ({r.randrange(100, 999)}) 555-{r.randrange(1000, 9999)}"])
    rows = [(i, " ".join(r.choice(["lorem", "Ipsum", "dolor,", "sit.", fake()]) for _ in range(40))) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    net = pii.fit_pii(df)
    found = total = 0
    for _, text in rows[:40]:
        starts = pii.window_starts(text)
        import numpy as np

        tags = net.decode(np.stack([pii._classes(text[s : s + pii.WINDOW]) for s in starts]))
        base = set(plain_base(text))
        found += len(base & set(pii._reconcile(starts, tags, len(text))))
        total += len(base)
    assert found >= 0.85 * total
    marked = {r["doc_id"]: r for r in pii.pii_spans(docs, net).collect()}
    assert [marked[14][f"n_{k}"] for k in pii.BASE_KINDS] == [1, 1, 1, 1]
    assert all(r["n_spans"] == len([x for x in r["spans"].split(",") if x]) for r in marked.values())
    text = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    for i, row in marked.items():
        base = pii._listed(plain_base(text[i] or ""))
        assert set(base.split(",")) - {""} <= set(row["spans"].split(","))
    assert marked[4]["spans"] == "" and marked[4]["base_sha256"].startswith("e3b0c442")
    done = pii.redact_documents(docs, net)
    assert done.columns == docs.columns and done.count() == docs.count()
    clean = {r["doc_id"]: (r["text"], r["n_chars"]) for r in done.select("doc_id", "text", "n_chars").collect()}
    assert clean[4] == (None, None) and "[EMAIL]" in clean[14][0] and "@" not in clean[14][0] and clean[14][1] == len(clean[14][0])
    assert clean[1][0] == text[1]
    assert pii.pii(no_docs).count() == 0


# ---- classifiers


@pytest.mark.parametrize("run", [toxicity.toxicity, quality.quality])
def test_classifier_edge_cases(docs, no_docs, labels, no_labels, run):
    for d, l in ((docs, labels), (docs, no_labels), (no_docs, labels)):
        rows = run(d, l).collect()
        assert len(rows) == d.count()
        assert all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in rows)


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    for run, label, least, threshold in ((toxicity.toxicity, "toxic", 0.85, 0.7), (quality.quality, "quality", 0.97, 0.5)):
        rows = run(docs, labels).join(labels, "doc_id").where("held_out").collect()
        good, bad = ([r["score"] for r in rows if r[label] == v] for v in (1, 0))
        assert sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / len(good) / len(bad) > least
        assert all(r["predicted"] == (r["score"] >= threshold) for r in rows)
        assert sum(b >= threshold for b in bad) <= 0.1 * len(bad)


def test_labels_of_held_out_documents_are_not_read(spark, docs, labels):
    from starmart.llm.common import held_out

    import zlib

    ids = {r["doc_id"] for r in docs.where(held_out("doc_id")).select("doc_id").collect()}
    assert ids == {i for i in range(1, 16) if zlib.crc32(str(i).encode()) % 3 == 1}
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(cast(doc_id AS string)) % 3 = 1 THEN 1 - quality ELSE quality END AS quality")
    a, b = (sorted(map(str, quality.quality(docs, x).collect())) for x in (labels, flipped))
    assert a == b


def test_grammar_weighs_context():
    scorer = toxicity.Scorer({})
    total = lambda text: sum(scorer.clauses(text.lower()))
    assert total("you are an idiot") > total("an idiot") > total("not an idiot") > 0
    assert total("he said an idiot") < total("an idiot")
    assert total("i will kill you") > 0 == total("kill the process")
    assert total("not now, an idiot") == total("an idiot")  # a clause ends the negation


def test_reported_speech_is_lighter_inside_quotation_marks():
    total = lambda text: sum(toxicity.Scorer({}).clauses(text.lower()))
    plain, said, quoted = total("you are an idiot"), total("he said you are an idiot"), total('he said "you are an idiot"')
    assert plain > said > quoted > 0
    for text in ('he said: "you are an idiot"', 'he said, "you are an idiot"', "he wrote « you are an idiot »", 'he said "well. you are an idiot"'):
        assert total(text) == quoted, text
    # What follows the closing mark, another clause or another line is not reported.
    for text in ('he said "hello" you are an idiot', "he said hello. you are an idiot", 'he said "hello\nyou are an idiot'):
        assert total(text) == plain, text


def test_composed_table_equals_its_transducers_one_by_one():
    r = random.Random(17)
    for _ in range(200):
        symbols, state, states = [r.randrange(7) for _ in range(30)], 0, [0] * len(toxicity.PARTS)
        for s in symbols:
            factor, amount = 1.0, 0.0
            for i, part in enumerate(toxicity.PARTS):
                states[i], f, a = part.step(states[i], s)
                factor, amount = factor * f, amount + a
            state, got, put = toxicity.GRAMMAR[state, s]
            assert toxicity.STATES[state] == tuple(states) and got == pytest.approx(factor) and put == pytest.approx(factor * amount)
            if r.random() < 0.2:  # a clause ends: only open quotation marks stay
                state = toxicity.NEXT_CLAUSE[state]
                at = toxicity.PARTS.index(toxicity.QUOTED)
                states = [s if i == at and s >= toxicity.QUOTING else 0 for i, s in enumerate(states)]
                assert toxicity.STATES[state] == tuple(states)


def test_curve_never_falls():
    import numpy as np

    r = np.random.RandomState(5)
    x = np.abs(r.randn(400, 3))
    y = (x[:, 0] - 2 * x[:, 1] + 0.3 * r.randn(400) > 0).astype(float)
    curve = toxicity.logistic(x, y)
    assert curve[1] > 0 and curve[2] == 0 and min(curve[1:]) >= 0


def test_learned_model_orders_sentences(spark):
    d = "/root/testdata/sf0.01"
    model = toxicity.fit_toxicity(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet"))
    assert min(model.curve[1:]) >= 0
    scorer = toxicity.Scorer(model.lexicon)
    texts = ["you are an idiot.", "he said you are an idiot.", 'he said "you are an idiot."', "you are not an idiot.", "you are a friend."]
    scores = [model.probability(scorer.features(t)) for t in texts]
    assert scores == sorted(scores, reverse=True) and scores[0] >= toxicity.THRESHOLD > scores[3] > scores[4]


def test_filter_drops_planted_toxic_texts_and_keeps_the_others(spark):
    r = random.Random(21)
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    clean = lambda n: " ".join(r.choice(["the", "house", "river", "and", "slowly", "green", "walks", "over"]) for _ in range(n))
    insults = ["you are a worthless idiot", "they are pathetic vermin", "shut up you disgusting moron", "you stupid loser, i will kill you"]
    planted = [(10**7 + i, ". ".join([clean(12), *r.sample(insults, 3), clean(12)]) + ".") for i in range(20)]
    others = [(10**7 + 100 + i, clean(60) + ".") for i in range(20)] + [(10**7 + 200, None), (None, ""), (None, clean(9))]
    given = docs.limit(0).unionByName(spark.createDataFrame(planted + others, "doc_id long, text string"), allowMissingColumns=True)
    kept = toxicity.drop_toxic(docs.unionByName(given), labels).where("doc_id IS NULL OR doc_id >= 10000000")
    assert kept.columns == docs.columns
    assert sorted(((x["doc_id"], x["text"]) for x in kept.collect()), key=str) == sorted(others, key=str)


# ---- pipeline


@pytest.mark.parametrize(
    "operate",
    [
        lambda docs, labels: toxicity.drop_toxic(docs, labels),
        lambda docs, labels: toxicity.score_toxicity(docs, toxicity.Model({})),
        lambda docs, labels: jaccard_join.drop_near_duplicates(docs),
        lambda docs, labels: pii.fit_pii(docs),
        lambda docs, labels: pii.pii_spans(docs, None),
        lambda docs, labels: pii.redact_documents(docs),
    ],
)
def test_texts_reach_python_in_small_batches(spark, operate):
    import pyarrow as pa

    def sizes(batches):
        for b in batches:
            yield pa.record_batch([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "bytes"])

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    given = spark.range(0, 6000, 1, 1).selectExpr("id AS doc_id", "concat(id, ' ', repeat('river ', 300)) AS text")
    labels = spark.createDataFrame([(0, 1, 1)], "doc_id long, toxic int, quality int")
    try:
        for bound, most in (("64m", common.BATCH_BYTES), ("100k", 100 << 10)):
            spark.conf.set(key, bound)
            operate(spark.createDataFrame([(1, "mail a@b.org now"), (2, None)], "doc_id long, text string"), labels)
            found = given.mapInArrow(sizes, "n long, bytes long").collect()
            assert sum(r["n"] for r in found) == 6000
            assert max(r["bytes"] for r in found) <= 1.1 * most  # a lower bound of the session stays
    finally:
        spark.conf.set(key, before)


def test_pipeline_stages_match_plain_versions(spark, tmp_path):
    import corpus_pipeline
    from pyspark.sql import functions as F

    given = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    least = given.agg(F.min("doc_id")).first()[0]
    copies = given.where(F.col("doc_id") < least + 20).withColumn("doc_id", F.col("doc_id") + 10**6)
    docs, tables = given.unionByName(copies), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_SMALL).write.parquet(f"{tmp_path}/{name}")
        tables[name] = docs.collect(), spark.read.parquet(f"{tmp_path}/{name}").collect()
        docs = spark.read.parquet(f"{tmp_path}/{name}")

    before, after = tables["toxicity"]
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    toxic = {r["doc_id"] for r in toxicity.toxicity(given.unionByName(copies), labels).collect() if r["score"] >= toxicity.THRESHOLD}
    assert toxic and sorted(after) == sorted(r for r in before if r["doc_id"] not in toxic)

    before, after = tables["near_duplicates"]
    groups = jaccard_groups([(r["doc_id"], r["text"]) for r in before])
    assert sorted(after) == sorted(r for r in before if groups[r["doc_id"]][1] == r["doc_id"]) and len(after) < len(before)

    before, after = tables["personal_data"]
    new = {r["doc_id"]: r for r in after}
    assert len(after) == len(before) and set(new) == {r["doc_id"] for r in before}
    for r in before:
        out, text = new[r["doc_id"]], r["text"]
        assert {k: v for k, v in out.asDict().items() if k not in ("text", "n_chars")} == {k: v for k, v in r.asDict().items() if k not in ("text", "n_chars")}
        at = 0
        for part in re.split(r"\[(?:EMAIL|IP|CARD|PHONE)\]", out["text"]):  # nothing but spans has changed
            assert text.find(part, at) >= 0
            at = text.find(part, at) + len(part)
        assert not plain_base(out["text"]) and out["n_chars"] == len(out["text"])
        assert re.search("[@0-9]", text) or out["text"] == text
    assert any(plain_base(r["text"]) for r in before)

    before, after = tables["mixing"]
    old, size = {r["doc_id"]: r for r in before}, defaultdict(int)
    copies, taken = defaultdict(int), defaultdict(int)
    for r in before:
        size[r["source"]] += len(words(r["text"]))
    for r in after:
        assert r == old[r["doc_id"]]
        copies[r["doc_id"]] += 1
        taken[r["source"]] += len(words(r["text"]))
    assert max(copies.values()) <= 2
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(size))}
    low, high = 0.0, 2.0 * sum(size.values())
    for _ in range(100):  # the level at which sources, at most twice each, give one and a half times the words
        level = (low + high) / 2
        low, high = (level, high) if sum(min(2 * size[s], weight[s] * level) for s in size) < 1.5 * sum(size.values()) else (low, level)
    longest = max(len(words(r["text"])) for r in before)
    for s in size:
        assert abs(taken[s] - min(2 * size[s], weight[s] * level)) <= 2 * longest

    before, after = tables["packing"]
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in after:
        pieces[r["doc_id"]].append((r["start_word"], r["n_words"]))
        bins[r["bin_id"]].append((r["bin_offset"], r["n_words"], r["bin_used"], r["bin_size"]))
    expected = defaultdict(list)
    for r in before:
        n, most = len(words(r["text"])), max(packing.LENGTHS)
        expected[r["doc_id"]] += [(k, min(most, n - k)) for k in range(0, n, most)]
    assert {i: sorted(x) for i, x in pieces.items()} == {i: sorted(x) for i, x in expected.items() if x}
    for parts in bins.values():
        at = 0
        for offset, n, used, full in sorted(parts):
            assert offset == at and full in packing.LENGTHS
            at += n
        assert at == used <= full
