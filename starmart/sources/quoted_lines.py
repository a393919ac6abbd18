"""Records of CSV files whose quoted cells hold line breaks, read in splits.

A line feed ends a record unless it stands inside a quoted cell, which depends on all
quotes before it. A line is a function of that state: starting outside a cell it ends in
or outside of one, and so it does starting inside. These functions compose, so the files
need not be read from the start:

1. Every split is read as lines and folded to its two outcomes (starting outside, starting
   inside), with the places of the first record and of one left open at the end, and the
   number of records that start there.
2. The outcomes of all splits are chained in the order of files and blocks, one step per
   split: the state each starts in, and the records before it. The driver holds one small
   row per split, as it does for the tasks of the scan itself.
3. The splits are read again, now with the state they start in. Records within a split are
   glued there; the lines of a record that crosses into another split are picked out by
   their places and meet in a shuffle that holds nothing else.

In a well-formed file every quote changes the state, so the states of a batch of lines are
the parity of the quotes before them. A quote that neither opens nor closes a cell where
it stands (in a bare cell, or before text after a closing quote) is found by its
neighbours, and its line is followed cell by cell. The other outcome of a split is followed
like that only until both agree, mostly a line or two.

So a record's number in the whole input is known where it is read, without a sort.

Only this fold, which needs the lines' order, runs in Arrow batches. Lines are read with
the line feed as the only separator, so carriage returns inside cells survive.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The warehouse has no other Python on executors: these functions are sent whole, so that
# reading a file needs no installed package there (numpy and pyarrow are enough).
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Beyond this many splits the table of crossing records is joined by a shuffle.
_BROADCAST_SPLITS = 500_000


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line with its split."""
    split = (F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.col("_metadata.file_block_length"))
    return spark.read.option("lineSep", "\n").text(path).select(
        split[0].alias("file_path"),
        split[1].alias("block_start"),
        F.xxhash64(*split).alias("split"),
        F.col("value").alias("line"),
    )


def end_state(line: bytes, inside: bool) -> bool:
    """Whether a line ends inside a quoted cell, cell by cell. A cell that starts with a
    quote runs to the one that closes it and on to the comma; any other runs to the comma."""
    at = 0
    while True:
        if inside:
            at = line.find(b'"', at)
            if at < 0:
                return True
            if line[at + 1 : at + 2] == b'"':
                at += 2
                continue
            inside = False
        elif line[at : at + 1] == b'"':
            inside, at = True, at + 1
            continue
        at = line.find(b",", at) + 1
        if not at:
            return False


class Lines:
    """A batch of lines as bytes, with the quotes in them."""

    def __init__(self, lines: pa.Array):
        self.text = lines.cast(pa.large_binary())
        cuts = np.frombuffer(self.text.buffers()[1], np.int64)[self.text.offset : self.text.offset + len(lines) + 1]
        held = self.text.buffers()[2]
        self.data = np.frombuffer(held, np.uint8)[cuts[0] : cuts[-1]] if held else np.zeros(0, np.uint8)
        self.cuts = cuts - cuts[0]
        self.quotes = np.flatnonzero(self.data == 34)
        self.of = np.searchsorted(self.cuts, self.quotes, side="right") - 1
        size = np.diff(self.cuts)
        self.blank = size == 0
        one = np.flatnonzero(size == 1)
        self.blank[one] = self.data[self.cuts[one]] == 13

    def states(self, state: bool) -> np.ndarray:
        """Whether each line starts inside a cell, and at the end the state after the last."""
        before = np.searchsorted(self.quotes, self.cuts)
        if not len(self.quotes):
            return np.full(len(self.cuts), state)
        near = np.concatenate([[0], self.data, [0]])
        left, right = near[self.quotes], near[self.quotes + 2]
        first, end = self.cuts[self.of], self.cuts[self.of + 1]
        opens = (self.quotes == first) | (left == 44) | (left == 34)
        closes = (self.quotes + 1 == end) | (right == 44) | (right == 34) | ((self.quotes + 2 == end) & (right == 13))
        even = np.arange(len(self.quotes)) % 2 == 0
        # Quotes out of place, where the first one opens a cell and where it closes one.
        odd = [np.flatnonzero(np.where(even, ~opens, ~closes)), np.flatnonzero(np.where(even, ~closes, ~opens))]
        out, at, turn = np.empty(len(self.cuts), dtype=bool), 0, int(state)
        while True:
            k = np.searchsorted(odd[turn], before[at])
            if k == len(odd[turn]):
                out[at:] = (before[at:] + turn) % 2 == 1
                return out
            line = self.of[odd[turn][k]]
            out[at : line + 1] = (before[at : line + 1] + turn) % 2 == 1
            at = line + 1
            turn = int(end_state(self.text[line].as_py(), bool(out[line]))) ^ int(before[at] % 2)

    def states_until(self, state: bool, others: np.ndarray) -> np.ndarray:
        """The same, followed cell by cell until the states agree with ``others``."""
        out, at = np.empty(len(self.cuts), dtype=bool), 0
        for line in np.unique(self.of):
            out[at : line + 1] = state
            state, at = end_state(self.text[line].as_py(), state), line + 1
            if state == others[at]:
                out[at:] = others[at:]
                return out
        out[at:] = state
        return out


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, int]]:
    """Stretches of a task's batches that lie in one split, with its key and the rows
    that the task has seen before: a line's place is its number in its task."""
    seen = 0
    for batch in batches:
        split = batch.column("split").to_numpy()
        cuts = np.flatnonzero(np.diff(split)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(split)], strict=True):
            if b > a:
                yield batch.slice(a, b - a), int(split[a]), seen + int(a)
        seen += len(split)


_OUTCOME = "file_path string, block_start long, split long, " + ", ".join(
    f"end{s} boolean, start{s} long, tail{s} long, n{s} long" for s in (0, 1)
)


def _outcomes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per split, for both states at its start: the state at its end, the place of the first
    record, and of one that is still open, and how many records with text start."""
    names = [c.split()[0] for c in _OUTCOME.split(", ")]
    now: dict = {}

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{k: now[k] for k in names}], pa.schema([pa.field(k, _ARROW[k.rstrip("01")]) for k in names]))

    for run, split, seen in _runs(batches):
        if now.get("split") != split:
            if now:
                yield done()
            now = {"file_path": run.column("file_path")[0].as_py(), "block_start": run.column("block_start")[0].as_py(), "split": split}
            now |= {"end0": False, "end1": True} | {f"{k}{s}": None for k in ("start", "tail") for s in (0, 1)} | {"n0": 0, "n1": 0}
        lines = Lines(run.column("line"))
        outside = lines.states(now["end0"])
        inside = outside if now["end1"] == now["end0"] else lines.states_until(now["end1"], outside)
        for s, states in enumerate((outside, inside)):
            starts = np.flatnonzero(~states[:-1])
            now[f"n{s}"] += int((~states[:-1] & ~lines.blank).sum())
            if len(starts):
                if now[f"start{s}"] is None:
                    now[f"start{s}"] = seen + int(starts[0])
                now[f"tail{s}"] = seen + int(starts[-1])
            now[f"end{s}"] = bool(states[-1])
            if not now[f"end{s}"]:
                now[f"tail{s}"] = None
    if now:
        yield done()


_ARROW = {"file_path": pa.string(), "block_start": pa.int64(), "split": pa.int64(), "end": pa.bool_(), "start": pa.int64(), "tail": pa.int64(), "n": pa.int64()}


@dataclass(frozen=True)
class Splits:
    """The splits of the files by their key: the state each starts in, the number of the
    first record that starts there, and whether that is its file's header. A header has
    the number before the next record's, so the other records count from 0 without gaps."""

    keys: np.ndarray
    inside: np.ndarray
    number: np.ndarray
    header: np.ndarray

    def find(self, split: int) -> int:
        at = int(np.searchsorted(self.keys, split))
        if at == len(self.keys) or self.keys[at] != split:
            raise RuntimeError("the files changed or were split anew since they were scanned; read them again")
        return at


def chain(outcomes: list) -> tuple[Splits, list[tuple]]:
    """Follow every file from its first split to its last: the splits, and the places of
    the records that cross from one to another."""
    state, home, file, records, headed = False, None, None, 0, False
    found, crossing = [], []
    for r in sorted(outcomes, key=lambda r: (r["file_path"], r["block_start"])):
        if r["file_path"] != file:
            state, home, file, headed = False, None, r["file_path"], False
        s = int(state)
        tail, n = r[f"tail{s}"], r[f"n{s}"]
        header = n > 0 and not headed
        headed = headed or header
        found.append((r["split"], state, records - header, header))
        records += n - header
        if state or tail is not None:
            # Lines before ``start`` (all, where no record starts here) belong to the record open since split ``home``.
            crossing.append((r["split"], r["block_start"], state, r[f"start{s}"], home, tail, records - 1, header and n == 1))
        state, home = r[f"end{s}"], r["split"] if tail is not None else home
    found.sort()
    return Splits(*(np.array([f[i] for f in found], dtype=t) for i, t in enumerate((np.int64, bool, np.int64, bool)))), crossing


_RECORD = "number long, header boolean, record string"


def _joined(text: pa.Array, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Lines glued to records that follow each other."""
    if not len(starts):
        return pa.array([], pa.string())
    cuts = pa.array(np.append(starts, ends[-1]) - starts[0], pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(cuts, text.slice(starts[0], ends[-1] - starts[0])), "\n")


def _records_within(splits: Splits):
    """Glue the records that start and end in one split."""

    def glue(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, number, header, open_, place = None, False, 0, -1, None, 0
        for run, split, _ in _runs(batches):
            if split != now:
                # What is still open at the end of a split crosses into the next.
                at = splits.find(split)
                now, state, number, open_ = split, bool(splits.inside[at]), int(splits.number[at]), None
                header = number if splits.header[at] else None
            text = run.column("line").cast(pa.string())
            lines = Lines(text)
            states = lines.states(state)
            state = bool(states[-1])
            starts = np.flatnonzero(~states[:-1])
            ends = np.append(starts[1:], len(text))
            numbers = number + np.cumsum(~lines.blank[starts]) - 1
            number += int((~lines.blank[starts]).sum())
            first = int(starts[0]) if len(starts) else len(text)
            if open_ is not None:
                open_ += text.slice(0, first).to_pylist()
            last = (int(starts[-1]), int(numbers[-1])) if state and len(starts) else None
            if last is not None:
                starts, ends, numbers = starts[:-1], ends[:-1], numbers[:-1]
            joined = _joined(text, starts, ends)
            if open_ is not None and (first < len(text) or not state):
                numbers, joined = np.append(numbers, place), pa.concat_arrays([joined, pa.array(["\n".join(open_)], pa.string())])
                open_ = None
            if last is not None:
                open_, place = text.slice(last[0]).to_pylist(), last[1]
            filled = pc.invert(pc.is_in(joined, pa.array(["", "\r"], pa.string())))
            headers = np.zeros(len(numbers), dtype=bool) if header is None else numbers == header
            yield pa.record_batch([pa.array(numbers, pa.int64()), pa.array(headers), joined], ["number", "header", "record"]).filter(filled)

    return glue


def _records_across(spark: SparkSession, lines: DataFrame, crossing: list[tuple]) -> DataFrame:
    """Glue the records whose lines lie in several splits."""
    columns = "of long, block_start long, is_inside boolean, upto long, home long, tail long, number long, is_header boolean"
    places = _if_few(spark.createDataFrame(crossing, columns), len(crossing))
    # The place of a line, its number in its task: the low bits of this documented layout.
    placed = lines.select("split", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("position"), "line")
    head = F.col("is_inside") & (F.col("upto").isNull() | (F.col("position") < F.col("upto")))
    tail = F.col("tail").isNotNull() & (F.col("position") >= F.col("tail"))
    met = placed.join(places, F.col("split") == F.col("of")).where(head | tail)
    line = F.struct("block_start", "position", "line")
    glued = met.groupBy(F.when(tail, F.col("split")).otherwise(F.col("home")).alias("opened")).agg(
        F.array_sort(F.collect_list(line)).alias("lines"),
        *[F.max(F.when(tail, F.col(c))).alias(c) for c in ("number", "is_header")],
    )
    text = F.array_join(F.transform("lines", lambda x: x["line"]), "\n")
    return glued.select("number", F.col("is_header").alias("header"), text.alias("record"))


def _if_few(table: DataFrame, rows: int) -> DataFrame:
    """Broadcast a table of splits, which has a few short columns, up to a bound."""
    return F.broadcast(table) if rows <= _BROADCAST_SPLITS else table


def csv_records(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """The records of the files, blank ones left out, and the number of splits. ``number``
    counts them from 0 in the order of files and lines, headers aside; ``header`` is set
    for each file's first; ``record`` is the text without the line end."""
    lines = _lines(spark, path)
    outcomes = lines.mapInArrow(_outcomes, _OUTCOME).collect()  # a row per split
    splits, crossing = chain(outcomes)
    short = lines.select("split", "line")
    records = short.mapInArrow(_records_within(splits), _RECORD)  # sent along: 18 bytes a split
    if crossing:
        records = records.unionByName(_records_across(spark, short, crossing))
    ends: Column = F.col("record").endswith("\r")
    text = F.when(ends, F.expr("left(record, length(record) - 1)")).otherwise(F.col("record"))
    return records.withColumn("record", text), len(outcomes)
