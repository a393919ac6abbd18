"""Best-fit packing into bins of several permitted sequence lengths.

Documents are measured in words and cut into pieces of at most the largest
length. Pieces are numbered by length, id and place and dealt in turn into shards of
at most ``shard_pieces`` pieces, whether or not ids repeat or are null; each is packed on its own: longest first, a piece goes to the open bin that it
leaves the least room in; where none has room, a bin of the length with the
least cost per word among those that hold the piece is opened. At the end each
bin shrinks to the smallest permitted length that holds its contents.

Defined results: a null or empty text has no words and no pieces; repeated rows
are packed each for itself; columns other than the id and the text are not read;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import Stages, with_rank, word_count

#: Permitted sequence lengths, in words.
LENGTHS = (512, 1024, 2048, 4096)
#: Most pieces of a shard. Shards are equal but for one piece, however many pieces there are.
SHARD_PIECES = 4096


def sequence_cost(length: int) -> float:
    """Cost of one sequence: a fixed part, a linear part and a quadratic part for attention."""
    return 128 + length + length * length / 16384


def pack(
    lengths: list[int], permitted: tuple[int, ...] = LENGTHS, cost: Callable[[int], float] = sequence_cost
) -> tuple[list[int], list[int], list[int]]:
    """Best fit for pieces given longest first: (bin, offset) of each piece and the
    final length of each bin."""
    sizes = sorted(permitted)
    opens = {}  # the length to open for a piece, by the smallest permitted length that holds it
    for i, size in enumerate(sizes):
        opens[size] = min(sizes[i:], key=lambda s: (cost(s) / s, s))
    room: dict[int, list[int]] = {}  # free words -> open bins with just that many
    free = 0  # bit r is set where some bin has r words free
    used: list[int] = []
    bins, offsets = [], []
    for n in lengths:
        fitting = free >> n
        if fitting:
            r = n + (fitting & -fitting).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                free ^= 1 << r
        else:
            r = opens[next(s for s in sizes if s >= n)]
            b = len(used)
            used.append(0)
        bins.append(b)
        offsets.append(used[b])
        used[b] += n
        left = r - n
        if left:
            if not room.setdefault(left, []):
                free |= 1 << left
            room[left].append(b)
    return bins, offsets, [next(s for s in sizes if s >= u) for u in used]


def pack_documents(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    lengths: tuple[int, ...] = LENGTHS,
    cost: Callable[[int], float] = sequence_cost,
    shard_pieces: int = SHARD_PIECES,
) -> DataFrame:
    """Place every word of every document: doc_id, piece (from 0), start_word,
    n_words, bin_id, bin_offset, bin_used and bin_size, one row per piece."""
    most = max(lengths)
    stages = Stages(docs.sparkSession, "pack")
    sized = docs.select(F.col(doc_id).alias("doc_id"), word_count(text).alias("n")).where("n > 0")
    pieces = sized.select(
        "doc_id", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / most))).alias("piece")
    ).select(
        "doc_id",
        "piece",
        (F.col("piece") * most).alias("start_word"),
        F.least(F.lit(most), F.col("n") - F.col("piece") * most).cast("long").alias("n_words"),
    )
    # The last key spreads equal pieces over ranges; which of them gets which number is all the same.
    pieces = stages.write(pieces.withColumn("copy", F.monotonically_increasing_id()), "pieces")
    shards = max(1, -(-pieces.count() // shard_pieces))
    pieces = with_rank(stages, pieces, [F.col(c) for c in ("n_words", "doc_id", "piece", "copy")], "rank").drop("copy")

    def packed(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["n_words", "doc_id", "piece"], ascending=[False, True, True], ignore_index=True)
        bins, offsets, sizes = pack(part["n_words"].tolist(), lengths, cost)
        bins = np.asarray(bins, dtype=np.int64)
        used = np.bincount(bins, weights=part["n_words"]).astype(np.int64)
        return part[["doc_id", "piece", "start_word", "n_words"]].assign(
            bin_id=(np.int64(key[0]) << 32) + bins,
            bin_offset=np.asarray(offsets, dtype=np.int64),
            bin_used=used[bins],
            bin_size=np.asarray(sizes, dtype=np.int64)[bins],
        )

    shard = F.pmod(F.col("rank"), F.lit(shards).cast("long")).alias("shard")
    kind = dict(docs.dtypes)[doc_id]
    return pieces.groupBy(shard).applyInPandas(
        packed,
        f"doc_id {kind}, piece long, start_word long, n_words long, "
        "bin_id long, bin_offset long, bin_used long, bin_size long",
    )
