"""Links between texts that share most of their word shingles.

SimHash at four of 64 bits finds few of the texts whose five-word shingles overlap by 0.8
(about ten bits differ there); these links can be added to it. All such pairs are found.
Two sets at a likeness of 0.8 share a shingle among the first fifth of each, in any
order that is the same for all texts; here rare shingles come first, so boilerplate seldom
makes a candidate. Which are rare is judged by a sample; that decides the cost alone.
Bands of minimal hashes give the likeliest links beforehand, cheaply: what they connect
needs no comparing. Candidates are left out only by bounds that no pair at 0.8 can break,
and all others are verified on the full sets of shingle hashes.

Texts are compared in lower case (A-Z) by words between blanks. A text with fewer words
than a shingle, or none, has no links here. Copies of a text are one node, its ``text_key``;
the node of a null text is that of an empty one. An empty table gives no links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.llm.common import staged
from adloom.llm.graph import components, thinned
from adloom.llm.words import Powers, RunHashes, WordHashes, hashes_of, mixed
from adloom.operators.sizes import broadcast_if_small

WORDS = 5
LIKENESS = 0.8
BANDS, ROWS = 32, 8
CHUNK = 1 << 12  # shingles hashed at a time
SKETCH_BITS = 4  # of each bucket of shingle hashes
PER_LONG = 64 // SKETCH_BITS
CUT = 256  # members of a band that one task compares with the others
SAMPLE = 8  # one text in so many tells which shingles are common
COMMON = 1 << 19  # common shingles that every task knows, at most
FIRST = 16  # keys of a text by which a pair that meets under several is taken once
_SLACK = 1e-6  # for likenesses that have no exact double
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


class Shingles:
    """Distinct hashes of the shingles of texts, one text after the other."""

    def __init__(self, words: int):
        self.words = words
        self.known = WordHashes()
        self.powers = Powers()

    def of(self, text: str | None) -> np.ndarray:
        parts = (text or "").encode().translate(_LOWER).split()
        if len(parts) < self.words:
            return np.empty(0, np.uint64)
        return np.unique(RunHashes(hashes_of(parts, self.known), self.powers).of(self.words))


def _draw() -> tuple[np.ndarray, np.ndarray]:
    """Factors and offsets of the hash functions, the same in every task."""
    draw = np.random.default_rng(0)
    factors = draw.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
    return factors, draw.integers(0, 1 << 63, BANDS * ROWS, np.uint64)


def _least(shingles: np.ndarray, factors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The minimal hash of a set by every function."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), CHUNK):
        part = shingles[at : at + CHUNK, None] * factors[None, :] + offsets[None, :]
        np.minimum(least, part.min(axis=0), out=least)
    return least


def _band_keys(least: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """A key per band: a hash of the band's number and of its minimal hashes."""
    bands = mixed(least * factors[::-1]).reshape(BANDS, ROWS).sum(axis=1, dtype=np.uint64)
    return mixed(bands + np.arange(BANDS, dtype=np.uint64))


def _folded(shingles: np.ndarray) -> np.ndarray:
    """Shingle hashes dealt over buckets and XORed there: two sets differ in no more buckets
    than they have shingles that only one of them holds."""
    buckets = np.zeros(BANDS * ROWS, np.uint64)
    np.bitwise_xor.at(buckets, (shingles % np.uint64(len(buckets))).astype(np.intp), shingles)
    return buckets


def _sketch(values: np.ndarray) -> np.ndarray:
    """The last bits of every mixed value, packed."""
    bits = (mixed(values) & np.uint64((1 << SKETCH_BITS) - 1)).reshape(-1, PER_LONG)
    places = np.arange(PER_LONG, dtype=np.uint64) * np.uint64(SKETCH_BITS)
    return np.bitwise_or.reduce(bits << places, axis=1).view(np.int64)


def _differing(x: Column, y: Column) -> Column:
    """How many of their values two sketches differ in."""
    ones = F.lit(int("1" * PER_LONG, 1 << SKETCH_BITS))

    def count(a: Column, b: Column) -> Column:
        bits = a.bitwiseXOR(b)
        for by in (1, 2):
            bits = bits.bitwiseOR(F.shiftrightunsigned(bits, by))
        return F.bit_count(bits.bitwiseAND(ones))

    # sixteen counts written out would be a method too large for the JVM to compile
    return F.aggregate(F.zip_with(x, y, count), F.lit(0), lambda total, n: total + n)


def band_keys(texts: DataFrame, words: int) -> DataFrame:
    """(key, node) rows: every text that has shingles in each of its bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(words)
        factors, offsets = _draw()
        for batch in batches:
            keys, nodes = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
            for node, text in zip(batch["node"].to_numpy(), batch["text"]):
                found = shingles.of(text.as_py())
                if len(found):
                    keys.append(_band_keys(_least(found, factors, offsets), factors))
                    nodes.append(np.full(BANDS, node))
            yield pa.record_batch(
                {"key": np.concatenate(keys).view(np.int64), "node": np.concatenate(nodes)}
            )

    return texts.mapInArrow(run, "key bigint, node bigint")


def common_shingles(texts: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles most common in a sample of the texts, in order, and in how
    many texts of it each is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(words)
        for batch in batches:
            sets = [shingles.of(t.as_py()) for t in batch["text"]]
            yield pa.record_batch({"hash": np.concatenate([*sets, np.empty(0, np.uint64)]).view(np.int64)})

    sample = texts.where(F.pmod(F.xxhash64("node"), F.lit(SAMPLE)) == 0)
    once = sample.groupBy("node").agg(F.min("text").alias("text")).select("text")
    met = once.mapInArrow(run, "hash bigint").groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
    several = staged(met.where("n > 1"), "common-shingles")
    left, least = COMMON, 2
    for n, count in sorted(map(tuple, several.groupBy("n").count().collect()), reverse=True):
        left -= count
        if left < 0:
            least = n + 1
            break
    rows = several.where(F.col("n") >= least).toArrow()  # at most COMMON
    hashes = rows["hash"].to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], rows["n"].to_numpy()[order]


def _prefix(
    shingles: np.ndarray, common: np.ndarray, counts: np.ndarray, likeness: float
) -> np.ndarray:
    """The rarest of sorted shingle hashes: as many as a set this alike cannot lack all of."""
    length = len(shingles) - math.ceil(likeness * len(shingles) - _SLACK) + 1
    if len(common):
        at = np.minimum(np.searchsorted(common, shingles), len(common) - 1)
        weight = np.where(common[at] == shingles, counts[at], 0)
        shingles = shingles[np.argsort(weight, kind="stable")]
    return shingles[:length]


def prefix_keys(texts: DataFrame, words: int, likeness: float) -> DataFrame:
    """(key, node) rows: every text with its rarest shingles. Two texts at ``likeness``
    share a key."""
    known = texts.sparkSession.sparkContext.broadcast(common_shingles(texts, words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(words)
        for batch in batches:
            keys, nodes = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
            for node, text in zip(batch["node"].to_numpy(), batch["text"]):
                found = shingles.of(text.as_py())
                if len(found):
                    keys.append(_prefix(found, *known.value, likeness))
                    nodes.append(np.full(len(keys[-1]), node))
            yield pa.record_batch(
                {"key": np.concatenate(keys).view(np.int64), "node": np.concatenate(nodes)}
            )

    return texts.mapInArrow(run, "key bigint, node bigint")


def shingle_sets(texts: DataFrame, words: int) -> DataFrame:
    """(node, set, sketch) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(words)
        for batch in batches:
            sets = [shingles.of(t.as_py()) for t in batch["text"]]
            sketches = [_sketch(_folded(s)) for s in sets]
            longs = pa.list_(pa.int64())
            yield pa.record_batch(
                {
                    "node": batch["node"],
                    "set": pa.array([s.view(np.int64) for s in sets], longs),
                    "sketch": pa.array(sketches, longs),
                }
            )

    return texts.mapInArrow(run, "node bigint, set array<bigint>, sketch array<bigint>")


def _verified(pairs: DataFrame, sets: DataFrame, likeness: float) -> DataFrame:
    """Those of the pairs (a, b) whose shingle sets overlap by ``likeness`` or more."""
    one = sets.select(F.col("node").alias("a"), F.col("set").alias("_a"))
    other = sets.select(F.col("node").alias("b"), F.col("set").alias("_b"))
    shared = F.size(F.array_intersect("_a", "_b"))
    alike = shared >= likeness * (F.size("_a") + F.size("_b") - shared)
    # sizes alone rule out most pairs of unequal texts before sets are intersected
    near = F.least(F.size("_a"), F.size("_b")) >= likeness * F.greatest(F.size("_a"), F.size("_b"))
    return pairs.join(one, "a").join(other, "b").where(near).where(alike).select("a", "b")


def _apart_pairs(crowd: DataFrame, roots: DataFrame, sets: DataFrame, likeness: float) -> DataFrame:
    """Pairs (a, b) that share a key, lie in different components and whose sizes and
    sketches do not rule out this likeness: sets of x and y shingles at a likeness of t
    differ in (x + y)(1 - t)/(1 + t) at most. A pair comes under the first key that both
    have, or under all where that is not among the first of each. A large crowd is dealt
    over several tasks: one side is cut, the other goes to every cut."""
    members = crowd.select("key", "node").join(roots, "node")
    parted = (
        members.groupBy("key")
        .agg(F.min("root").alias("_first"), F.max("root").alias("_last"), F.count(F.lit(1)).alias("n"))
        .where("_first < _last")
        .select("key", F.ceil(F.col("n") / CUT).cast("int").alias("cuts"))
    )
    inside = staged(members.join(parted, "key"), "apart-members")
    nodes = (
        inside.groupBy("node")
        .agg(F.slice(F.array_sort(F.collect_list("key")), 1, FIRST).alias("keys"))
        .join(sets.select("node", "sketch", F.size("set").alias("size")), "node")
    )
    rows = staged(inside.join(nodes, "node"), "apart-nodes")
    cut = F.pmod(F.xxhash64("node"), F.col("cuts")).cast("int")
    x = rows.withColumn("cut", cut).alias("x")
    y = rows.withColumn("cut", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))).alias("y")
    sizes = F.col("x.size") + F.col("y.size")
    meet = (
        (F.col("x.key") == F.col("y.key"))
        & (F.col("x.cut") == F.col("y.cut"))
        & (F.col("x.node") < F.col("y.node"))
        & (F.col("x.root") != F.col("y.root"))
        & (F.least("x.size", "y.size") >= likeness * F.greatest("x.size", "y.size") - _SLACK)
        & (
            _differing(F.col("x.sketch"), F.col("y.sketch"))
            <= sizes * ((1 - likeness) / (1 + likeness)) + _SLACK
        )
        & F.coalesce(F.col("x.key") == F.array_min(F.array_intersect("x.keys", "y.keys")), F.lit(True))
    )
    return x.join(y, meet).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))


def similar_texts(
    docs: DataFrame, key: Column, words: int = WORDS, likeness: float = LIKENESS
) -> DataFrame:
    """Pairs (a, b) of text keys, a < b, that connect all texts linked by ``likeness``.

    In a band one node, drawn anew for each, is the pivot, and the others are compared with
    it. What those links connect needs no comparing; pairs with a common prefix key that
    they leave apart are compared where sizes and sketches allow it.
    """
    texts = docs.select(key.alias("node"), "text")
    keys = staged(band_keys(texts, words), "band-keys")
    drawn = F.struct(F.xxhash64("key", "node").alias("draw"), "node")
    shared = staged(
        keys.groupBy("key")
        .agg(F.min(drawn)["node"].alias("pivot"), F.min("node").alias("_a"), F.max("node").alias("_z"))
        .where("_a < _z")
        .select("key", "pivot"),
        "shared-bands",
    )
    crowd = staged(
        keys.join(broadcast_if_small(shared), "key").select("key", "pivot", "node").distinct(),
        "band-crowds",
    )
    prefixes = staged(prefix_keys(texts, words, likeness), "prefix-keys")
    met = staged(
        prefixes.groupBy("key")
        .agg(F.min("node").alias("_a"), F.max("node").alias("_z"))
        .where("_a < _z")
        .select("key"),
        "shared-prefixes",
    )
    meeting = staged(prefixes.join(broadcast_if_small(met), "key").distinct(), "prefix-crowds")
    wanted = staged(
        crowd.select("node").unionAll(meeting.select("node")).distinct(), "candidate-nodes"
    )
    sets = staged(
        shingle_sets(
            texts.join(broadcast_if_small(wanted), "node", "left_semi")
            .groupBy("node")
            .agg(F.min("text").alias("text")),
            words,
        ),
        "shingle-sets",
    )
    stars = crowd.where("pivot <> node").select(
        F.least("pivot", "node").alias("a"), F.greatest("pivot", "node").alias("b")
    )
    linked = staged(_verified(stars.distinct(), sets, likeness), "linked-to-pivots")
    roots = staged(components(staged(thinned(linked), "thinned-stars"), wanted), "star-roots")
    rest = staged(_apart_pairs(meeting, roots, sets, likeness).distinct(), "prefix-rest")
    return linked.unionAll(_verified(rest, sets, likeness))
