"""64-bit hashes of words and n-grams over whole texts, vectorised.

Texts are UTF-8 bytes; words are what ``bytes.split()`` would give, the runs of
bytes other than space and 9 to 13. A word's hash is a polynomial in a random
odd multiplier over random byte values, mixed at the end; the position's power
is divided out by the multiplier's inverse modulo 2**64, so all words of a block
are hashed by one segmented sum. Long texts are hashed in blocks cut between
words, which bounds the memory by the block and the longest word.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

_random = np.random.RandomState(20240607)


def _values(n: int) -> np.ndarray:
    return _random.randint(0, 1 << 32, n, dtype=np.uint64) << np.uint64(32) | _random.randint(
        0, 1 << 32, n, dtype=np.uint64
    )


_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_BYTE = _values(256)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True

#: Byte values with A-Z as a-z.
LOWER = _BYTE.copy()
LOWER[65:91] = _BYTE[97:123]

# Shapes: classes of bytes, of which runs of capitals, other letters and digits count once.
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[65:91] = 65
_CLASS[97:123] = 97
_CLASS[128:] = 97
_CLASS[48:58] = 48
_ONCE = np.zeros(256, dtype=bool)
_ONCE[[65, 97, 48]] = True

#: Bytes hashed at a time.
BLOCK = 1 << 18


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base & 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


class _Powers:
    up = _powers(_MULTIPLIER, 1 << 16)
    down = _powers(_INVERSE, 1 << 16)

    @classmethod
    def grow(cls, n: int) -> None:
        if n > len(cls.up):
            n = 1 << int(n).bit_length()
            cls.up, cls.down = _powers(_MULTIPLIER, n), _powers(_INVERSE, n)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a fixed, invertible finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def distinct(x: np.ndarray) -> np.ndarray:
    """The values of ``x`` in order, each once."""
    x = np.sort(x)
    return x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) else x


def _segments(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a block."""
    inside = np.empty(len(data) + 2, dtype=bool)
    inside[0] = inside[-1] = False
    np.logical_not(_SPACE[data], out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[0::2], edges[1::2]


def _sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of each segment, modulo 2**64."""
    total = np.empty(len(values) + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum(values, out=total[1:])
    return total[ends] - total[starts]


def multiply_up(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``n`` powers of the multiplier and of its inverse."""
    _Powers.grow(n)
    return _Powers.up, _Powers.down


def words_of_block(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes (A-Z as a-z) of the words of a block."""
    starts, ends = _segments(data)
    up, down = multiply_up(len(data) + 1)
    return starts, ends, mix(_sums(LOWER[data] * up[: len(data)], starts, ends) * down[starts])


def _block_words(data: np.ndarray, lower: bool, shapes: bool):
    starts, ends = _segments(data)
    n = len(data)
    _Powers.grow(n + 1)
    table = LOWER if lower else _BYTE
    words = mix(_sums(table[data] * _Powers.up[:n], starts, ends) * _Powers.down[starts])
    if not shapes:
        return starts, words, None
    kind = _CLASS[data]
    keep = np.ones(n, dtype=bool)
    keep[1:] = (kind[1:] != kind[:-1]) | ~_ONCE[kind[1:]]
    place = np.cumsum(keep)
    shape = _sums(np.where(keep, _BYTE[kind] * _Powers.up[place], 0), starts, ends)
    first = place[starts] if len(starts) else np.zeros(0, dtype=np.int64)
    return starts, words, mix(shape * _Powers.down[first])


def blocks(text: bytes) -> Iterator[bytes]:
    """A text in blocks of about BLOCK bytes, cut at white space."""
    at, n = 0, len(text)
    while n - at > BLOCK:
        end = at + BLOCK
        while end < n and text[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        yield text[at:end]
        at = end
    yield text[at:]


def word_hashes(
    texts: Iterable[bytes | None], lower: bool = False, shapes: bool = False
) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
    """For each text the hashes of its words in order, and of their shapes.

    Short texts are hashed together, a block at a time."""
    group: list[bytes] = []
    held = 0

    def flush():
        data = np.frombuffer(b"\n".join(group), dtype=np.uint8)
        starts, words, shape = _block_words(data, lower, shapes)
        ends = np.cumsum([len(t) + 1 for t in group])
        cuts = np.searchsorted(starts, ends)
        last = 0
        for cut in cuts:
            yield words[last:cut], shape[last:cut] if shapes else None
            last = cut

    for text in texts:
        text = text or b""
        if len(text) > BLOCK:
            if group:
                yield from flush()
                group, held = [], 0
            parts = [_block_words(np.frombuffer(b, dtype=np.uint8), lower, shapes) for b in blocks(text)]
            yield np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts]) if shapes else None
            continue
        group.append(text)
        held += len(text) + 1
        if held > BLOCK // 2:
            yield from flush()
            group, held = [], 0
    if group:
        yield from flush()


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every run of ``n`` words; of the whole sequence where it is
    shorter; none without words. Sequences of different lengths hash apart."""
    k = min(n, len(words))
    if not k:
        return np.zeros(0, dtype=np.uint64)
    out = np.full(len(words) - k + 1, np.uint64(k), dtype=np.uint64)
    for i in range(k):
        out = (out ^ words[i : len(words) - k + 1 + i]) * np.uint64(_MULTIPLIER)
        out ^= out >> np.uint64(29)
    return mix(out)
