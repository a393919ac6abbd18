"""Personal data: base patterns, and a character-level bidirectional LSTM with CRF
transitions that adds spans the patterns miss.

The patterns (email, ip, card, phone) mark every whole text; their spans always
stay. They also label the windows that the network learns from, a bounded sample. What
no pattern marks is planted there with its label: phone numbers without their prefix,
and secrets (tokens, keys, passwords) written in many ways among the sample's words, beside
harmless values written alike. So the network finds a fifth kind, ``secret``.
The network is written and trained in numpy. It reads every stretch of text that
holds a digit or an at sign - no span of these kinds is without one - in
overlapping windows; each character takes its tag from the window it lies most
central in, and spans are read off the tags of the whole text. A span of the
network is added where it meets no base span and no match that a pattern's own
check (octets, Luhn, digit counts) has thrown out. A secret takes the whole run of its
characters, of which the network must have marked half or more; digits in it that look like
a failed card number do not matter.

Positions are code points, ends exclusive. Defined results: a null or empty text
has no spans; without any labelled window only the patterns work; repeated rows
are each marked; columns other than the id and the text are not read; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import small_batches

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret")
EMAIL, IP, CARD, PHONE, SECRET = range(5)
Span = tuple[int, int, int]  # start, kind, end: sorted as spans are listed

#: Characters a window has, and from one window's start to the next's.
WINDOW, STRIDE = 80, 40
#: Most documents and windows that the network learns from.
TRAIN_DOCS, TRAIN_WINDOWS = 3000, 3000
HIDDEN, BATCH, STEPS, RATE = 16, 64, 350, 0.03

_SEEN = re.compile(r"[0-9@]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits is tried from its start only: from within, the same would follow.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PREFIX = re.compile(r"\+[0-9]{1,3}[\x20-]+(?=[0-9(])")
_RUN = re.compile(r"[A-Za-z0-9_+/=-]+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _digits(text: str) -> list[int]:
    return [ord(c) - 48 for c in text if "0" <= c <= "9"]


def _luhn(digits: list[int]) -> bool:
    doubled = (2 * d - 9 * (d > 4) for d in digits[-2::-2])
    return (sum(digits[-1::-2]) + sum(doubled)) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            last = domain.end()
        at = text.find("@", at + 1)


def base_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Spans of the base patterns, and the matches that a pattern's check threw out."""
    if not _SEEN.search(text):
        return [], []
    kept = [(s, EMAIL, e) for s, e in _emails(text)]
    dropped = []
    for m in _IP.finditer(text):
        fine = all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m.group().split("."))
        (kept if fine else dropped).append((m.start(), IP, m.end()))
    for m in _CARD.finditer(text):
        n = sum("0" <= c <= "9" for c in m.group())
        if 12 <= n <= 19 and _luhn(_digits(m.group())):
            kept.append((m.start(), CARD, m.end()))
        elif n >= 12:
            dropped.append((m.start(), CARD, m.end()))
    for m in _PHONE.finditer(text):
        (kept if 9 <= len(_digits(m.group())) <= 15 else dropped).append((m.start(), PHONE, m.end()))
    return sorted(kept), sorted(dropped)


# ---- the network

_PUNCTUATION = "@._%+-() \n\t/:,;*#\"'&$!|=?[]<>"
CLASSES = 5 + len(_PUNCTUATION) + 1
_ASCII = np.full(128, CLASSES - 1, dtype=np.int8)
_ASCII[48:58], _ASCII[97:123], _ASCII[65:91] = 1, 2, 3
for _i, _c in enumerate(_PUNCTUATION):
    _ASCII[ord(_c)] = 5 + _i

TAGS = 1 + 2 * len(KINDS)  # O, then B and I of each kind
_FORBIDDEN = -1e4


def _classes(window: str) -> np.ndarray:
    """Character classes of a window, padded with class 0."""
    points = np.frombuffer(window.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    out = np.zeros(WINDOW, dtype=np.int8)
    out[: len(points)] = np.where(points < 128, _ASCII[np.minimum(points, 127)], 4)
    return out


def _allowed() -> np.ndarray:
    """Added to the transitions: I only follows B or I of its kind."""
    out = np.zeros((TAGS, TAGS))
    for k in range(len(KINDS)):
        inside = 2 + 2 * k
        out[:, inside] = _FORBIDDEN
        out[[inside - 1, inside], inside] = 0
    return out


_ALLOWED = _allowed()


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


class Tagger:
    """Class embeddings into a forward and a backward LSTM, tag scores, a linear-chain CRF."""

    def __init__(self, seed: int = 3):
        r, h = np.random.RandomState(seed), HIDDEN
        self.p = {}
        for d in "fb":
            self.p["x" + d] = r.randn(CLASSES, 4 * h) * 0.3
            self.p["h" + d] = r.randn(h, 4 * h) / np.sqrt(h)
            bias = np.zeros(4 * h)
            bias[h : 2 * h] = 1.0  # forget little at first
            self.p["z" + d] = bias
        self.p["out"] = r.randn(2 * h, TAGS) * 0.3
        self.p["bias"] = np.zeros(TAGS)
        self.p["move"] = np.zeros((TAGS, TAGS))
        self.p["first"] = np.zeros(TAGS)

    def _lstm(self, x: np.ndarray, d: str, keep: list | None):
        wx, wh, z, n = self.p["x" + d], self.p["h" + d], self.p["z" + d], HIDDEN
        h = c = np.zeros((len(x), n))
        out = np.empty((len(x), WINDOW, n))
        for t in range(WINDOW) if d == "f" else range(WINDOW - 1, -1, -1):
            a = wx[x[:, t]] + h @ wh + z
            gates = _sigmoid(a[:, : 3 * n])
            g = np.tanh(a[:, 3 * n :])
            last, before = c, h
            c = gates[:, n : 2 * n] * c + gates[:, :n] * g
            tc = np.tanh(c)
            h = gates[:, 2 * n :] * tc
            out[:, t] = h
            if keep is not None:
                keep.append((t, gates, g, last, before, tc))
        return out

    def _lstm_back(self, x: np.ndarray, d: str, kept: list, up: np.ndarray, grads: dict) -> None:
        wh, n = self.p["h" + d], HIDDEN
        gx, gh, gz = np.zeros_like(self.p["x" + d]), np.zeros_like(wh), np.zeros_like(self.p["z" + d])
        dh = dc = np.zeros((len(x), n))
        for t, gates, g, last, before, tc in reversed(kept):
            i, f, o = gates[:, :n], gates[:, n : 2 * n], gates[:, 2 * n :]
            dh = dh + up[:, t]
            dc = dc + dh * o * (1 - tc * tc)
            da = np.concatenate([dc * g * i * (1 - i), dc * last * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1)
            np.add.at(gx, x[:, t], da)
            gh += before.T @ da
            gz += da.sum(0)
            dh, dc = da @ wh.T, dc * f
        grads["x" + d], grads["h" + d], grads["z" + d] = gx, gh, gz

    def _first(self) -> np.ndarray:
        first = self.p["first"].copy()
        first[2::2] = _FORBIDDEN
        return first

    def loss(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Mean negative log likelihood of the tags, and its gradients."""
        n, kf, kb, grads = len(x), [], [], {}
        hidden = np.concatenate([self._lstm(x, "f", kf), self._lstm(x, "b", kb)], axis=2)
        emit = hidden @ self.p["out"] + self.p["bias"]
        move, first = self.p["move"] + _ALLOWED, self._first()
        alpha, beta = np.empty_like(emit), np.zeros_like(emit)
        alpha[:, 0] = first + emit[:, 0]
        for t in range(1, WINDOW):
            alpha[:, t] = _lse(alpha[:, t - 1][:, :, None] + move, 1) + emit[:, t]
        for t in range(WINDOW - 2, -1, -1):
            beta[:, t] = _lse(move + (emit[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
        whole = _lse(alpha[:, -1], 1)
        d_emit = np.exp(alpha + beta - whole[:, None, None])
        d_first = d_emit[:, 0].sum(0)
        d_move = np.zeros((TAGS, TAGS))
        for t in range(1, WINDOW):
            pair = alpha[:, t - 1][:, :, None] + move + (emit[:, t] + beta[:, t])[:, None, :] - whole[:, None, None]
            d_move += np.exp(pair).sum(0)
        rows = np.arange(n)
        score = first[y[:, 0]] + emit[rows, 0, y[:, 0]]
        for t in range(1, WINDOW):
            score = score + move[y[:, t - 1], y[:, t]] + emit[rows, t, y[:, t]]
        d_emit[rows[:, None], np.arange(WINDOW), y] -= 1
        np.add.at(d_first, y[:, 0], -1)
        np.add.at(d_move, (y[:, :-1].ravel(), y[:, 1:].ravel()), -1)
        d_emit /= n
        grads["out"] = np.einsum("bth,btk->hk", hidden, d_emit)
        grads["bias"], grads["move"], grads["first"] = d_emit.sum((0, 1)), d_move / n, d_first / n
        up = d_emit @ self.p["out"].T
        self._lstm_back(x, "f", kf, up[:, :, :HIDDEN], grads)
        self._lstm_back(x, "b", kb, up[:, :, HIDDEN:], grads)
        return float((whole - score).mean()), grads

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = STEPS) -> Tagger:
        """Adam on batches drawn from the windows, the rate falling to a tenth."""
        r = np.random.RandomState(11)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(v) for k, v in self.p.items()}
        for step in range(1, steps + 1):
            some = r.choice(len(x), min(BATCH, len(x)), replace=False)
            _, grads = self.loss(x[some], y[some])
            norm = np.sqrt(sum((g * g).sum() for g in grads.values()))
            rate = RATE * (1 - 0.9 * step / steps)
            for k, g in grads.items():
                g = g * min(1.0, 5.0 / (norm + 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                self.p[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
        return self

    def decode(self, x: np.ndarray) -> np.ndarray:
        """The best tag sequence of each window (Viterbi)."""
        emit = np.concatenate([self._lstm(x, "f", None), self._lstm(x, "b", None)], axis=2) @ self.p["out"] + self.p["bias"]
        move = self.p["move"] + _ALLOWED
        best, back = self._first() + emit[:, 0], np.zeros((len(x), WINDOW, TAGS), dtype=np.int8)
        for t in range(1, WINDOW):
            reach = best[:, :, None] + move
            back[:, t] = reach.argmax(1)
            best = reach.max(1) + emit[:, t]
        tags = np.empty((len(x), WINDOW), dtype=np.int8)
        tags[:, -1] = best.argmax(1)
        rows = np.arange(len(x))
        for t in range(WINDOW - 1, 0, -1):
            tags[:, t - 1] = back[rows, t, tags[:, t]]
        return tags


# ---- windows

def window_starts(text: str) -> list[int]:
    """Starts of the windows, on a grid of STRIDE, that hold a digit or an at sign."""
    out: list[int] = []
    at, last = 0, max(0, -(-(len(text) - WINDOW) // STRIDE)) * STRIDE
    while m := _SEEN.search(text, at):
        p = m.start()
        low = max(0, -(-(p - WINDOW + 1) // STRIDE) * STRIDE)
        out.extend(s for s in range(low, min(p // STRIDE * STRIDE, last) + 1, STRIDE) if not out or s > out[-1])
        at = max(p + 1, out[-1] + WINDOW - STRIDE)  # what is before lies in the windows listed
    return out


def _reconcile(starts: list[int], tags: np.ndarray, size: int) -> list[Span]:
    """Spans of a text from the tags of its windows, each character's from the window
    it is most central in (neighbours overlap by half, so the middle half of each
    window counts, and all of it at the ends of a stretch)."""
    edge = (WINDOW - STRIDE) // 2
    spans: list[Span] = []
    kind, begin, end = -1, 0, -1

    def close():
        if kind >= 0:
            spans.append((begin, kind, end))

    for i, s in enumerate(starts):
        low = s + edge if i and starts[i - 1] + STRIDE == s else s
        high = s + WINDOW - edge if i + 1 < len(starts) and starts[i + 1] == s + STRIDE else min(s + WINDOW, size)
        if low != end and kind >= 0 and low > end:
            close()
            kind = -1
        for p in np.flatnonzero(tags[i, low - s : high - s]) + low:
            tag = int(tags[i, p - s])
            k = (tag - 1) // 2
            if kind == k and p == end and tag % 2 == 0:
                end = p + 1
                continue
            close()
            kind, begin, end = k, int(p), int(p) + 1
    close()
    return [(b, k, int(e)) for b, k, e in spans]


def _plausible(kind: int, text: str) -> bool:
    """The least a span of a kind must hold."""
    n = sum("0" <= c <= "9" for c in text)
    if kind == EMAIL:
        return "@" in text[1:-1]
    if kind == SECRET:
        return len(text) >= LEAST_SECRET and n >= 2 and sum(c.isalpha() for c in text) >= 2
    return n >= 4 and text.count(".") >= 3 if kind == IP else n >= (12 if kind == CARD else 7)


def _whole_run(text: str, span: Span) -> Span | None:
    """The run of characters of a secret that a span lies in, if it marks half of it."""
    s, k, e = span
    runs = [m.span() for m in _RUN.finditer(text, _run_start(text, s), e + 200)]
    most = max(runs, key=lambda r: min(e, r[1]) - max(s, r[0]), default=None)
    if most is None or 2 * (min(e, most[1]) - max(s, most[0])) < most[1] - most[0]:
        return None
    return most[0], k, most[1]


def _run_start(text: str, at: int) -> int:
    while at and _RUN.match(text[at - 1]):
        at -= 1
    return at


def added_spans(text: str, starts: list[int], tags: np.ndarray, base: list[Span], dropped: list[Span]) -> list[Span]:
    """The network's spans that meet no base span and no match thrown out."""
    out: list[Span] = []
    for span in sorted(_reconcile(starts, tags, len(text))):
        whole = _whole_run(text, span) if span[1] == SECRET else span
        if whole is None or (out and whole[0] < out[-1][2]):
            continue
        s, k, e = whole
        taken = base if k == SECRET else base + dropped
        if _plausible(k, text[s:e]) and not any(a < e and s < b for a, _, b in taken):
            out.append(whole)
    return out


def _without_prefix(window: str, tags: np.ndarray) -> tuple[str, np.ndarray] | None:
    """The window with its first phone number's country prefix taken out, if it has
    one: numbers are also written without, which the base pattern cannot mark."""
    begin = np.flatnonzero(tags == 1 + 2 * PHONE)
    prefix = _PREFIX.match(window, begin[0]) if len(begin) else None
    if not prefix:
        return None
    a, b = prefix.span()
    tags = np.concatenate([tags[:a], tags[b:], np.zeros(b - a, dtype=np.int8)])
    tags[a] = 1 + 2 * PHONE
    return window[:a] + window[b:], tags


#: A secret has this many characters at least.
LEAST_SECRET = 16
_NAMES = "token key secret password passwd api_key apikey access_token auth private_key client_secret".split()
_ASSIGN = (" = ", "=", ": ", ":", " : ", " => ")
_SIGNS = {
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "mixed": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}


def planted(text: str, seed: int) -> tuple[str, np.ndarray]:
    """A window of the text with a secret written into it (one time in four a harmless
    value in its place), cut anywhere around it, and its tags."""
    r = random.Random(seed)
    at = r.randrange(len(text) + 1)
    name, quote = r.choice(_NAMES), r.choice(["'", '"', '"', ""])
    name = r.choice([name, name.upper(), name.capitalize()])
    signs = _SIGNS[r.choice(list(_SIGNS))]
    value = "".join(r.choice(signs) for _ in range(r.choice([20, 24, 32, 40, 40, 48, 64])))
    kind = SECRET
    if r.random() < 0.25:
        words = re.findall(r"[^\W\d_]+", text) or ["none"]
        value, kind = r.choice([r.choice(words), " ".join(r.choices(words, k=3)), str(r.randrange(10**6)), f"{r.randrange(9)}.{r.randrange(20)}"]), None
    lead = text[max(0, at - 40) : at].rstrip() + " " + name + r.choice(_ASSIGN) + quote
    whole = lead + value + quote + r.choice([" ", ", ", "\n", "; ", "!! ", "*** "]) + text[at : at + WINDOW]
    low = max(0, len(lead) - WINDOW + 20)
    start = r.randint(low, max(low, len(lead) + len(value) - 10))
    spans = [] if kind is None else [(len(lead), kind, len(lead) + len(value))]
    return whole[start : start + WINDOW], _tags(start, spans)


def unlabelled(window: str, tags: np.ndarray) -> bool:
    """Whether a window holds a run that may be a secret and has no label: it would teach
    that secrets are none, so it is left out of the sample."""
    return any(_plausible(SECRET, m.group()) and not tags[m.start() : m.end()].any() for m in _RUN.finditer(window))


def _tags(start: int, spans: list[Span]) -> np.ndarray:
    out = np.zeros(WINDOW, dtype=np.int8)
    for s, k, e in spans:
        a, b = max(s, start) - start, min(e, start + WINDOW) - start
        if a < b and not out[a:b].any():
            out[a:b] = 2 + 2 * k
            if s >= start:
                out[a] = 1 + 2 * k
            # A span cut by the window's start is left out, as its beginning is not seen;
            # a secret can be longer than windows overlap, and goes on.
            elif k == SECRET:
                out[a] = 1 + 2 * k
            else:
                out[a:b] = 0
    return out


def find_spans(texts: list[str], tagger: Tagger | None, group: int = 512) -> list[tuple[list[Span], list[Span]]]:
    """Base and added spans of each text; windows of several texts are decoded together."""
    out: list[tuple[list[Span], list[Span]]] = []
    pending: list[tuple[int, list[int]]] = []
    waiting: list[np.ndarray] = []
    parts: dict[int, list[np.ndarray]] = {}
    dropped_of: dict[int, list[Span]] = {}

    def decode():
        tags, at = tagger.decode(np.stack(waiting)), 0
        for i, starts in pending:
            parts.setdefault(i, []).append((starts, tags[at : at + len(starts)]))
            at += len(starts)
        pending.clear()
        waiting.clear()

    for i, text in enumerate(texts):
        base, dropped = base_spans(text)
        out.append((base, []))
        dropped_of[i] = dropped
        if tagger is None or not _SEEN.search(text):
            continue
        starts = window_starts(text)
        for a in range(0, len(starts), group):
            some = starts[a : a + group]
            pending.append((i, some))
            waiting.extend(_classes(text[s : s + WINDOW]) for s in some)
            if len(waiting) >= group:
                decode()
    if waiting:
        decode()
    for i, found in parts.items():
        starts = [s for some, _ in found for s in some]
        tags = np.concatenate([t for _, t in found])
        out[i] = out[i][0], added_spans(texts[i], starts, tags, out[i][0], dropped_of[i])
    return out


# ---- on tables

def _texts(batch: pa.RecordBatch, field: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """A batch in slices of about two million characters."""
    column = batch.column(batch.schema.get_field_index(field))
    at, texts, held = 0, [], 0
    for i, value in enumerate(column):
        texts.append(value.as_py() or "")
        held += len(texts[-1])
        if held > 2_000_000:
            yield batch.slice(at, i + 1 - at), texts
            at, texts, held = i + 1, [], 0
    if texts:
        yield batch.slice(at), texts


def fit_pii(docs: DataFrame, most: int = TRAIN_DOCS, windows: int = TRAIN_WINDOWS) -> Tagger | None:
    """Train the network on windows that the base patterns label, from the documents
    with the least hash among those with a digit or an at sign."""
    small_batches(docs.sparkSession)
    seen = docs.where(F.col("text").rlike("[0-9@]")).select(F.xxhash64("text").alias("h"), "text")
    # The hashes alone are ordered; texts are only read up to the last of them, each text once.
    upto = seen.select("h").distinct().orderBy("h").limit(most).agg(F.max("h")).first()[0]
    sample = seen.where(F.col("h") <= F.lit(upto)).groupBy("h").agg(F.min("text").alias("text")).select("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in {t for _, some in _texts(batch) for t in some}:
                spans, _ = base_spans(text)
                digest = hashlib.md5(text.encode("utf-8", "replace")).hexdigest()
                for seed in (digest[:15], digest[15:30]):
                    w, t = planted(text, int(seed, 16))
                    rows.append((hashlib.md5(w.encode("utf-8", "replace")).hexdigest(), _classes(w).tobytes(), t.tobytes()))
                for s in window_starts(text):
                    window = text[s : s + WINDOW]
                    tags = _tags(s, spans)
                    if unlabelled(window, tags):
                        continue
                    for w, t in filter(None, ((window, tags), _without_prefix(window, tags))):
                        rows.append((hashlib.md5(w.encode("utf-8", "replace")).hexdigest(), _classes(w).tobytes(), t.tobytes()))
            yield pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.binary(), pa.binary()))], ["h", "x", "y"])

    found = sample.mapInArrow(cut, "h string, x binary, y binary").orderBy("h", "y").limit(windows).collect()
    if not found or not any(any(r["y"]) for r in found):
        return None
    x, y = (np.stack([np.frombuffer(r[c], dtype=np.int8) for r in found]).astype(np.int64) for c in ("x", "y"))
    return Tagger().fit(x, y)


def _listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def pii_spans(docs: DataFrame, tagger: Tagger | None) -> DataFrame:
    """doc_id, the number of base spans of each kind, the digest of the base spans,
    all spans as text, how many of them the network added, and how many there are."""
    small_batches(docs.sparkSession)
    kind = dict(docs.dtypes)["doc_id"]

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in _texts(batch):
                found = find_spans(texts, tagger)
                columns = [pa.array([sum(k == n for _, k, _ in base) for base, _ in found], pa.int64()) for n in range(4)]
                digests = [hashlib.sha256(_listed(base).encode()).hexdigest() for base, _ in found]
                every = [_listed(sorted(base + added)) for base, added in found]
                n_added, n_spans = [len(added) for _, added in found], [len(base) + len(added) for base, added in found]
                yield pa.record_batch(
                    [part.column("doc_id"), *columns, pa.array(digests, pa.string()), pa.array(every, pa.string()), pa.array(n_added, pa.int64()), pa.array(n_spans, pa.int64())],
                    ["doc_id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans", "n_added", "n_spans"],
                )

    counts = ", ".join(f"n_{k} long" for k in BASE_KINDS)
    return docs.select("doc_id", "text").mapInArrow(mark, f"doc_id {kind}, {counts}, base_sha256 string, spans string, n_added long, n_spans long")


def pii(docs: DataFrame) -> DataFrame:
    """Train on a sample of ``docs`` and mark all of them."""
    return pii_spans(docs, fit_pii(docs))


def redact(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind; of overlapping spans the first
    names the kind and the union is replaced."""
    out, at = [], 0
    for s, k, e in sorted(spans):
        if s >= at:
            out += [text[at:s], f"[{KINDS[k].upper()}]"]
        at = max(at, e)
    return "".join(out) + text[at:]


def redact_documents(docs: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """``docs`` with all spans redacted, and ``n_chars`` (if there) counted anew."""
    small_batches(docs.sparkSession)
    tagger = tagger or fit_pii(docs)
    names = docs.columns

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in _texts(batch):
                i = part.schema.get_field_index("text")
                null = part.column(i).is_null().to_pylist()
                done = [None if n else redact(t, base + added) for t, n, (base, added) in zip(texts, null, find_spans(texts, tagger), strict=True)]
                yield part.set_column(i, "text", pa.array(done, pa.string()))

    out = docs.mapInArrow(clean, docs.schema)
    if "n_chars" in names:
        kind = docs.schema["n_chars"].dataType
        changed = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind))
        out = out.withColumn("n_chars", changed)
    return out
