"""N-gram Jaccard join: exact groups of documents with similar shingle sets.

Each text becomes the set of its distinct word shingles, as 64-bit tokens in one
global order: tokens that stand out as frequent last, otherwise by hash. Two sets
of the needed similarity share tokens among the first few of each, a fifth of the
set and one more for each that they must share (the prefix filter). So only sets
meet that share such a token, and only those that share enough of them with others:

1. Documents with equal sets are one class, whose least document stands for it.
2. For every prefix token the least class left that has it is its centre. Each centre's
   set is looked up in a prefix tree of the sets that share its tokens and are
   close enough in size, in blocks of bounded size. That takes one comparison per
   class and centre, however large a group of near copies is.
3. What these links join is contracted. Only the classes of tokens that still have
   several components are joined with each other, again by prefix trees, and only
   across components. Together the steps look at every pair that shares a prefix
   token, save those whose documents are connected already.

The frequent tokens (counted over all texts: those with several uses within a
slice of the corpus, the most used ``FREQUENT`` of them) only shape the order; any
order gives the same links.

Defined results: a null or empty text, or one without words, has an empty set and
no links; a null id gets a null component and no links; rows that repeat an id
are one document as far as links go; other columns are not read; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import Stages, components, small_batches
from starmart.llm.hashing import distinct, shingles, word_hashes
from starmart.llm.trie import Trie, linking_pairs

WORDS, PERCENT = 5, 80
#: How many frequent tokens are put last in the order (8 bytes each go to every task).
FREQUENT = 500_000
#: Tokens counted together in a slice, and the least count there that makes a token known.
SLICE, SEVERAL = 2_000_000, 2
#: Most document ids that are broadcast (8 bytes each) to pick texts.
BROADCAST_IDS = 1_000_000
#: The prefix is longer by one token for so many of a set. Similar sets then share as
#: many more tokens, which rules out documents that share only a passage with others.
LONGER = 10
#: Most sets in one prefix tree.
BLOCK = 1000

_HIGH = np.uint64(1 << 62)


def _tokens(words: np.ndarray, n: int) -> np.ndarray:
    return shingles(words, n) >> np.uint64(2)


def _ordered(words: np.ndarray, n: int, frequent: np.ndarray) -> np.ndarray:
    """The distinct tokens of a text in the global order, as non-negative longs."""
    tokens = distinct(_tokens(words, n))
    if len(frequent) and len(tokens):
        place = frequent.searchsorted(tokens)
        late = frequent.take(place, mode="clip") == tokens
        if late.any():
            tokens = np.concatenate([tokens[~late], tokens[late] | _HIGH])
    return tokens.view(np.int64)


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Batches of fewer rows, so that few sets are held at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _texts(batch: pa.RecordBatch) -> Iterator[bytes | None]:
    for value in batch.column("text").cast(pa.binary()):
        yield value.as_py()


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def frequent_tokens(stages: Stages, docs: DataFrame, words: int = WORDS, most: int = FREQUENT) -> np.ndarray:
    """The most used tokens of those used several times in a slice, ``most`` at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def several() -> pa.RecordBatch:
            tokens = np.concatenate(held)
            held.clear()
            tokens.sort()
            first = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
            uses = np.diff(np.append(first, len(tokens)))
            many = uses >= SEVERAL
            return pa.record_batch([pa.array(tokens[first[many]].view(np.int64)), pa.array(uses[many])], ["token", "uses"])

        for batch in batches:
            for found, _ in word_hashes(_texts(batch), lower=True):
                held.append(distinct(_tokens(found, words)))
                size += len(held[-1])
                if size >= SLICE:
                    yield several()
                    held, size = [], 0
        if size:
            yield several()

    counted = docs.select("text").mapInArrow(count, "token long, uses long").groupBy("token").agg(F.sum("uses").alias("uses"))
    counted = stages.write(counted, "frequent")
    # The least number of uses that at most ``most`` tokens reach; only those come to the driver, 8 bytes each.
    left, least = most, None
    for row in counted.groupBy("uses").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("uses").desc()).toLocalIterator():
        left -= row["n"]
        if left < 0:
            break
        least = row["uses"]
    if least is None:
        return np.zeros(0, dtype=np.uint64)
    tokens = counted.where(F.col("uses") >= least).select("token").toArrow()["token"].to_numpy()
    stages.drop(counted)
    return np.sort(tokens.astype(np.uint64))


def _sets(docs: DataFrame, words: int, percent: int, frequent: np.ndarray, whole: bool) -> DataFrame:
    """doc_id, n_shingles, a fingerprint of the set in two longs, and its tokens: all
    (``whole``) or those of the prefix."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = shared.value
        for batch in _slices(batches):
            sizes, a, b, tokens = [], [], [], []
            for found, _ in word_hashes(_texts(batch), lower=True):
                ordered = _ordered(found, words, last)
                n = len(ordered)
                sizes.append(n)
                a.append(int(np.bitwise_xor.reduce(_spread(ordered, 0x9E3779B97F4A7C15))) if n else 0)
                b.append(int(_spread(ordered, 0xC2B2AE3D27D4EB4F).sum(dtype=np.int64)) if n else 0)
                tokens.append(ordered if whole else ordered[: n - -(-percent * n // 100) + n // LONGER + 1])
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), _lists(tokens)],
                ["doc_id", "n_shingles", "print_a", "print_b", "tokens"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n_shingles long, print_a long, print_b long, tokens array<long>"
    return docs.select("doc_id", "text").mapInArrow(read, schema)


def _spread(tokens: np.ndarray, factor: int) -> np.ndarray:
    x = tokens.view(np.uint64) * np.uint64(factor)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E6C63D0676A9A99)
    return (x ^ (x >> np.uint64(29))).view(np.int64)


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[dict[str, list]]:
    """Rows of sorted batches, a group of equal ``keys`` at a time."""
    held: dict[str, list] = {}
    last = None
    for batch in batches:
        names = batch.schema.names
        columns = {n: batch.column(n).to_pylist() for n in names if n != "tokens"}
        lists = batch.column("tokens")
        flat, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
        for i in range(batch.num_rows):
            key = tuple(columns[k][i] for k in keys)
            if key != last:
                if last is not None:
                    yield held
                held, last = {n: [] for n in names}, key
            for n in columns:
                held[n].append(columns[n][i])
            # A copy, so that a batch does not outlive its turn.
            held["tokens"].append(flat[offsets[i] : offsets[i + 1]].copy())
    if last is not None:
        yield held


def _star_links(percent: int):
    """Links of centres (``role`` 0, first in each group) with the sets of their blocks."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["centre", "salt"]):
            members = [i for i, role in enumerate(group["role"]) if role]
            trie = Trie([group["tokens"][i] for i in members])
            found = {members[j] for i, role in enumerate(group["role"]) if not role for j in trie.similar(group["tokens"][i], percent)}
            nodes = [group["node"][i] for i in sorted(found)]
            yield pa.record_batch([pa.array([group["centre"][0]] * len(nodes), pa.int64()), pa.array(nodes, pa.int64())], ["a", "b"])

    return links


def _block_links(percent: int):
    """Links across components within a block, or between its two sides."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["centre", "left", "right"]):
            sides = group["side"] if group["left"][0] != group["right"][0] else None
            pairs = linking_pairs(group["tokens"], group["component"], sides, percent)
            yield pa.record_batch(
                [pa.array([group["node"][i] for i, _ in pairs], pa.int64()), pa.array([group["node"][j] for _, j in pairs], pa.int64())],
                ["a", "b"],
            )

    return links


def _close(a: str, b: str, percent: int) -> Column:
    """Whether two sizes allow the similarity."""
    return (F.col(a) * 100 >= F.col(b) * percent) & (F.col(b) * 100 >= F.col(a) * percent)


def _whole_sets(docs: DataFrame, nodes: DataFrame, words: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """(node, tokens) of the documents in ``nodes``."""
    nodes = nodes.distinct()
    # Few ids go to every task; many meet their texts in a shuffle.
    nodes = F.broadcast(nodes) if nodes.count() <= BROADCAST_IDS else nodes
    texts = docs.select("doc_id", "text").join(nodes, F.col("doc_id") == F.col("node"), "left_semi")
    sets = _sets(texts, words, percent, frequent, whole=True).where("n_shingles > 0")
    return sets.select(F.col("doc_id").cast("long").alias("node"), "tokens")


def similar_groups(docs: DataFrame, *, words: int = WORDS, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles and component_id (the least doc_id reachable by links)."""
    small_batches(docs.sparkSession)
    stages = Stages(docs.sparkSession, "jaccard")
    frequent = frequent_tokens(stages, docs, words)
    sets = stages.write(_sets(docs, words, percent, frequent, whole=False), "sets")

    # 1. Classes of equal sets. Copies fold into one row before the shuffle.
    prints = ["n_shingles", "print_a", "print_b"]
    some = sets.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = stages.write(some.groupBy(*prints).agg(F.min("doc_id").cast("long").alias("node"), F.first("tokens").alias("tokens")), "classes")
    members = stages.write(sets.select("doc_id", *prints), "members")
    stages.drop(sets)

    # 2. Tokens that several classes have, of the classes that share enough of them with others.
    sizes = stages.write(classes.select("node", "n_shingles"), "sizes")
    uses = classes.select("node", "n_shingles", F.explode("tokens").alias("token"))
    several = uses.groupBy("token").agg(F.count(F.lit(1)).alias("many")).where("many > 1").select("token")
    shared = stages.write(uses.join(several, "token"), "shared-tokens")
    stages.drop(classes)
    # The least a set shares with the smallest set that can be similar to it.
    least = F.floor(F.ceil(F.col("n_shingles") * percent / 100) / LONGER) + 1
    enough = shared.groupBy("node", "n_shingles").agg(F.count(F.lit(1)).alias("common")).where(F.col("common") >= least)
    shared = stages.write(shared.join(enough.select("node"), "node"), "shared")
    # The least class of a token is its centre.
    centres = shared.groupBy("token").agg(F.min("node").alias("centre"), F.count(F.lit(1)).alias("many")).where("many > 1")
    shared = shared.join(centres, "token").where("node > centre")
    shared = stages.write(shared.select("token", "centre", "node", "n_shingles", "many"), "centred")

    centre_size = sizes.select(F.col("node").alias("centre"), F.col("n_shingles").alias("centre_size"))
    star = shared.select("centre", "node", "n_shingles").distinct().join(centre_size, "centre")
    star = stages.write(star.where(_close("n_shingles", "centre_size", percent)).select("centre", "node"), "pairs")
    each = star.groupBy("centre").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("salts"))
    star = star.join(each, "centre").select("centre", "node", F.pmod(F.xxhash64("node"), F.col("salts")).cast("int").alias("salt"))
    star = stages.write(star, "star")
    heads = star.select("centre", "salt").distinct().select("centre", "salt", F.col("centre").alias("node"), F.lit(0).alias("role"))
    rows = star.select("centre", "salt", "node", F.lit(1).alias("role")).unionByName(heads)
    whole = stages.write(_whole_sets(docs, rows.select("node"), words, percent, frequent), "whole")
    rows = rows.join(whole, "node").repartition("centre", "salt").sortWithinPartitions("centre", "salt", "role", "node")
    links = stages.write(rows.select("centre", "salt", "role", "node", "tokens").mapInArrow(_star_links(percent), "a long, b long"), "links")

    # 3. Tokens whose other classes are still of several components, and of sizes that
    # could be similar: their classes are joined with each other, a centre's together.
    joined = components(stages, links)
    rest = shared.where("many > 2").join(joined, "node", "left")
    rest = rest.select("token", "centre", "node", "n_shingles", F.coalesce("component", "node").alias("component"))
    spread = rest.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    rest = rest.join(spread.select("token"), "token")
    by_size = Window.partitionBy("token").orderBy("n_shingles", "node")
    # Whoever has a partner close enough in size has a neighbour in the order of sizes that is.
    near = [_close("n_shingles", f, percent) for f in ("smaller", "larger")]
    rest = rest.withColumns({"smaller": F.lag("n_shingles").over(by_size), "larger": F.lead("n_shingles").over(by_size)})
    rest = rest.where(F.coalesce(near[0], F.lit(False)) | F.coalesce(near[1], F.lit(False)))
    at = stages.write(rest.select("centre", "node", "component").distinct(), "mixed")
    many = at.groupBy("centre").agg(F.count(F.lit(1)).alias("many"))
    at = at.join(many, "centre")
    # A component too large for one tree is cut into parts of its own; the others are dealt into shared parts.
    share = at.groupBy("centre", "component").agg(F.count(F.lit(1)).alias("here"))
    parts = at.join(share, ["centre", "component"]).select(
        "centre",
        "node",
        "component",
        F.when(F.col("here") > block, F.col("component")).otherwise(F.lit(-1)).alias("of"),
        F.pmod(F.xxhash64("node"), F.ceil(F.when(F.col("here") > block, F.col("here")).otherwise(F.col("many")) / block)).alias("part"),
    )
    parts = stages.write(parts.withColumn("part", F.struct("of", "part")), "parts")
    kinds = parts.select("centre", "part").distinct()
    two = kinds.select("centre", F.col("part").alias("left")).join(kinds.select("centre", F.col("part").alias("right")), "centre")
    two = two.where((F.col("left") <= F.col("right")) & ((F.col("left.of") != F.col("right.of")) | (F.col("left.of") == -1)))
    sided = two.select("centre", "left", "right", F.lit(0).alias("side"), F.col("left").alias("part")).unionByName(
        two.where("left < right").select("centre", "left", "right", F.lit(1).alias("side"), F.col("right").alias("part"))
    )
    key = lambda c: F.xxhash64(f"{c}.of", f"{c}.part").alias(c)
    rows = sided.join(parts, ["centre", "part"]).select("centre", key("left"), key("right"), "side", "node", "component")
    whole = stages.write(_whole_sets(docs, parts.select("node"), words, percent, frequent), "whole-parts")
    rows = rows.join(whole, "node").repartition("centre", "left", "right")
    rows = rows.sortWithinPartitions("centre", "left", "right", "side", "node")
    rows = rows.select("centre", "left", "right", "side", "node", "component", "tokens")
    across = stages.write(rows.mapInArrow(_block_links(percent), "a long, b long"), "across")
    whole_links = links.unionByName(across)
    final = components(stages, whole_links)

    named = members.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*prints).agg(F.min("doc_id").cast("long").alias("node"))
    named = named.join(final, "node", "left").select(*prints, F.coalesce("component", "node").alias("component"))
    named = named.select(*[F.col(c).alias(f"c_{c}") for c in prints], "component")
    same = [F.col(c) == F.col(f"c_{c}") for c in prints]
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", F.col("doc_id").cast("long")))
    return members.join(named, same, "left").select("doc_id", "n_shingles", component.alias("component_id"))


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """One document of each group, the one with the least id. Of rows that repeat that
    id, or have a null id, one of each set of shingles stays; rows without words stay."""
    stages = Stages(docs.sparkSession, "near-duplicates")
    groups = similar_groups(docs, **options)
    gone = stages.write(groups.where("component_id <> doc_id").select(F.col("doc_id").alias("gone")).distinct(), "gone")
    kept = docs.select("doc_id").join(gone, F.col("doc_id") == F.col("gone"), "left_anti")
    many = kept.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("doc_id").alias("gone"))
    many = stages.write(many, "repeated")
    if not many.limit(1).count():
        return docs.join(gone, docs["doc_id"] == gone["gone"], "left_anti")
    # Only rows that repeat an id, or have none, are numbered and compared.
    again = docs.where("doc_id IS NULL").unionByName(docs.join(many, docs["doc_id"] == many["gone"], "left_semi"))
    again = again.select(F.struct(*docs.columns).alias("row"), "doc_id", "text", F.monotonically_increasing_id().alias("number"))
    again = stages.write(again, "numbered")
    empty = np.zeros(0, dtype=np.uint64)
    words, percent = options.get("words", WORDS), options.get("percent", PERCENT)
    sets = _sets(again.select(F.col("number").alias("doc_id"), "text"), words, percent, empty, whole=False)
    sets = sets.select(F.col("doc_id").alias("number"), "n_shingles", "print_a", "print_b").join(again.select("number", "doc_id"), "number")
    # Texts without words have no set to share: each is by itself.
    alone = F.when(F.col("n_shingles") == 0, F.col("number"))
    stays = sets.groupBy("doc_id", "n_shingles", "print_a", "print_b", alone.alias("alone")).agg(F.min("number").alias("number"))
    once = again.join(stays.select("number"), "number", "left_semi").select("row.*")
    out = gone.unionByName(many)
    return docs.where("doc_id IS NOT NULL").join(out, docs["doc_id"] == out["gone"], "left_anti").unionByName(once)
