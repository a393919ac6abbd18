"""A prefix tree over sorted token sets, for exact Jaccard joins.

Sets share the nodes of their common beginnings, so the overlap of a query with a
beginning is counted once for all sets that have it. A subtree is left as soon as
what is matched so far and what can still match, from the lengths that remain on
both sides, is too little for any set below.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np

#: Tokens of a node compared at a time, before the bound is looked at again.
STEP = 96


def least_overlap(a: int, b: int, percent: int) -> int:
    """Least intersection for 100 * intersection >= percent * union."""
    return -(-percent * (a + b) // (100 + percent))


@dataclass(slots=True)
class _Node:
    part: np.ndarray  # tokens of the edge into this node
    depth: int  # tokens up to the end of the edge
    shortest: int  # of the sets below
    longest: int
    ends: list[int] = field(default_factory=list)
    children: list[_Node] = field(default_factory=list)


def _common(a: np.ndarray, b: np.ndarray, at: int) -> int:
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[at:n] != b[at:n])
    return at + int(differ[0]) if len(differ) else n


class Trie:
    """Of ``sets``: arrays of tokens in rising order, each token once."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        order = sorted((i for i, s in enumerate(sets) if len(s)), key=lambda i: sets[i].astype(">u8").tobytes())
        self.roots: list[_Node] = []
        todo = [(self.roots, order, 0)]
        while todo:
            siblings, some, depth = todo.pop()
            at = 0
            while at < len(some):
                token, to = sets[some[at]][depth], at + 1
                while to < len(some) and sets[some[to]][depth] == token:
                    to += 1
                group, at = some[at:to], to
                first = sets[group[0]]
                # In order, so what the first and the last share, all share.
                end = _common(first, sets[group[-1]], depth + 1) if len(group) > 1 else len(first)
                sizes = [len(sets[i]) for i in group]
                node = _Node(first[depth:end], end, min(sizes), max(sizes), [i for i in group if len(sets[i]) == end])
                siblings.append(node)
                rest = [i for i in group if len(sets[i]) > end]
                if rest:
                    todo.append((node.children, rest, end))

    def similar(self, query: np.ndarray, percent: int, skip: Callable[[int], bool] | None = None) -> Iterator[int]:
        """Indices of the sets that have the Jaccard similarity with ``query``, one by
        one, but those that ``skip`` (asked when their turn comes) passes over."""
        size = len(query)
        todo = [(n, 0, 0) for n in self.roots]
        while todo:
            node, matched, used = todo.pop()
            if 100 * node.longest < percent * size or 100 * size < percent * node.shortest:
                continue
            if skip and len(node.ends) == 1 and not node.children and skip(node.ends[0]):
                continue
            need = least_overlap(size, max(node.shortest, -(-percent * size // 100)), percent)
            start = node.depth - len(node.part)
            alive = True
            for at in range(0, len(node.part), STEP):
                if matched + min(size - used, node.longest - start - at) < need:
                    alive = False
                    break
                part, rest = node.part[at : at + STEP], query[used:]
                place = rest.searchsorted(part)
                if used < size:
                    matched += int(np.count_nonzero(rest.take(place, mode="clip") == part))
                used += int(place[-1])  # a match of the last token stays in the rest, where nothing meets it again
            if not alive:
                continue
            for i in node.ends:
                if matched >= least_overlap(size, len(self.sets[i]), percent) and not (skip and skip(i)):
                    yield i
            if matched + min(size - used, node.longest - node.depth) >= need:
                todo.extend((c, matched, used) for c in node.children)


class Groups:
    """Union-find over small indices, from given group ids."""

    def __init__(self, ids: list[int]):
        first: dict[int, int] = {}
        self.parent = [first.setdefault(g, i) for i, g in enumerate(ids)]

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.find(i), self.find(j)
        self.parent[max(a, b)] = min(a, b)


def linking_pairs(sets: list[np.ndarray], groups: list[int], sides: list[int] | None, percent: int) -> list[tuple[int, int]]:
    """Pairs of similar sets that tie all similar ones of different groups together:
    pairs whose sets are in one group already, or become so, are left out. With
    ``sides`` only pairs of different sides are looked for."""
    united = Groups(groups)
    trie = Trie(sets if sides is None else [s if side == 0 else s[:0] for s, side in zip(sets, sides, strict=True)])
    out = []
    for i, query in enumerate(sets):
        if sides is not None and sides[i] == 0:
            continue
        if not len(query):
            continue
        passed = lambda j: (sides is None and j >= i) or united.find(j) == united.find(i)  # noqa: B023, E731
        for j in trie.similar(query, percent, passed):
            if united.find(i) != united.find(j):
                united.join(i, j)
                out.append((i, j))
    return out
