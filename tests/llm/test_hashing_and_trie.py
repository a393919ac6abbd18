"""Word hashes against Python's split; prefix-tree joins against all pairs."""

from __future__ import annotations

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from starmart.llm import hashing
from starmart.llm.hashing import shingles, word_hashes
from starmart.llm.sentence_dedup import sentences
from starmart.llm.trie import Groups, Trie, linking_pairs

TEXT = st.text(st.sampled_from("aAbB\t \n\x0b\x0c\r.é漢!"), max_size=80)


def lower(text: str) -> bytes:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text).encode()


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXT, max_size=6))
def test_equal_words_have_equal_hashes(texts):
    known: dict[int, bytes] = {}
    for text, (words, _) in zip(texts, word_hashes([t.encode() for t in texts], lower=True), strict=True):
        expected = lower(text).split()
        assert len(words) == len(expected)
        for h, w in zip(words.tolist(), expected, strict=True):
            assert known.setdefault(h, w) == w
    assert len(set(known.values())) == len(known)


def test_blocks_change_nothing(monkeypatch):
    text = " ".join(random.Random(1).choice(["ab", "Cde.", "f\ng", "h" * 50]) for _ in range(2000)).encode()
    whole = [next(word_hashes([text], True, True)), sentences(text)]
    monkeypatch.setattr(hashing, "BLOCK", 97)
    cut = [next(word_hashes([text], True, True)), sentences(text)]
    for a, b in zip(whole, cut, strict=True):
        assert all((x == y).all() for x, y in zip(a, b, strict=True))


def test_shingles_of_short_texts():
    words, _ = next(word_hashes([b"a b c"]))
    assert len(shingles(words, 5)) == 1 and len(shingles(words[:0], 5)) == 0
    assert shingles(words, 5)[0] != shingles(words[:2], 5)[0]
    assert shingles(words, 2)[0] == shingles(words[:2], 2)[0]


def test_sentences_end_at_marks_and_line_feeds():
    _, starts, ends, first = sentences("One two. Three!\nFour five\nsix\t7.5 x".encode())
    assert [starts[i] for i in first] == [0, 9, 16, 26]


def families(seed: int) -> list[np.ndarray]:
    r = np.random.RandomState(seed)
    out = []
    for _ in range(15):
        base = np.unique(r.randint(0, 1 << 62, r.randint(1, 200)).astype(np.uint64))
        for _ in range(r.randint(1, 9)):
            kept = base[r.rand(len(base)) > r.choice([0, 0.03, 0.1, 0.2])]
            new = r.randint(0, 1 << 62, int(len(base) * r.choice([0, 0.05, 0.1]))).astype(np.uint64)
            out.append(np.unique(np.concatenate([kept, new])))
    return out


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b))
    return bool(len(a) and len(b)) and 100 * both >= 80 * (len(a) + len(b) - both)


def test_trie_finds_what_all_pairs_find():
    for seed in range(4):
        sets = families(seed)
        trie = Trie(sets)
        for query in sets:
            assert set(trie.similar(query, 80)) == {i for i, s in enumerate(sets) if similar(query, s)}


def test_linking_pairs_join_the_same_groups():
    def joined(sets, pairs):
        groups = Groups(list(range(len(sets))))
        for i, j in pairs:
            assert similar(sets[i], sets[j])
            groups.join(i, j)
        return [groups.find(i) for i in range(len(sets))]

    for seed in range(4):
        sets = families(10 + seed)
        every = [(i, j) for i in range(len(sets)) for j in range(i) if similar(sets[i], sets[j])]
        assert joined(sets, linking_pairs(sets, list(range(len(sets))), None, 80)) == joined(sets, every)
        sides = [i % 2 for i in range(len(sets))]
        across = [(i, j) for i, j in every if i % 2 != j % 2]
        assert joined(sets, linking_pairs(sets, list(range(len(sets))), sides, 80)) == joined(sets, across)
