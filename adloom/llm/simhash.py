"""Near duplicates by SimHash, found with Golay-code fuzzy hashing.

The 64 fingerprint bits are cut into segments of 22, 21 and 21. A segment, padded to 23
bits, lies within three bits of exactly one word of the binary Golay code. Its keys are
the codewords nearest to it and to each of its 23 neighbours: one key where it lies within
two bits of a codeword, six where it lies three away. Two segments within two bits of each
other have a neighbour in common, and so share a key.

Fingerprints with at most four differing bits meet in one of two ways. Either a segment is
equal, and of the other two one differs in at most two bits: the key is the equal segment
and the other's codeword. Or every segment differs, then two of them in exactly one bit
each, so that half of either is equal, and the third in at most two: the key is the two
equal halves and the third's codeword. Every candidate is verified on all 64 bits.

Only distinct fingerprints are joined; copies stay rows of a membership. An empty or null
text has fingerprint zero. Rows with a null ``doc_id`` have a fingerprint and the component
of the documents it links to; where those have no id, the component is null. Repeated rows
share their component. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.llm.common import shuffle_partitions, staged
from adloom.llm.graph import components, thinned
from adloom.llm.similar import similar_texts
from adloom.operators.sizes import broadcast_if_small

WORDS = 4
SEED = 42
MAX_BITS = 4
CHUNK = 1 << 16  # shingles whose bits are counted at a time

# Fixed value: generator polynomial of the binary Golay code.
GENERATOR = 0b101011100011
CODE_BITS, DATA_BITS = 23, 12
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # lowest bit, width
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """Bits set in over half of the hashes of a text's shingles."""
    parts = (text or "").encode().translate(_LOWER).split()
    if not parts:
        return 0
    line = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends[min(words, len(parts)) - 1 :].tolist()
    hashed = xxhash.xxh64_intdigest
    total = np.zeros(64, np.int64)
    for at in range(0, len(ends), CHUNK):
        part = ends[at : at + CHUNK]
        h = np.fromiter(
            (hashed(line[s:e], SEED) for s, e in zip(starts[at:], part)), ">u8", len(part)
        )
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * total > len(ends))
    return int.from_bytes(bits.tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """One row per document: doc_id, ``text_key`` (a hash that with doc_id tells documents
    apart) and ``fp``, the fingerprint as a signed number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t.as_py(), words) for t in batch["text"]]
            yield pa.record_batch(
                {
                    "doc_id": batch["doc_id"],
                    "text_key": batch["text_key"],
                    "fp": pa.array(np.array(values, np.uint64).view(np.int64)),
                }
            )

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", text_key(F.col("text")), "text").mapInArrow(
        run, f"doc_id {kind}, text_key bigint, fp bigint"
    )


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_key")


def _remainder(word: np.ndarray) -> np.ndarray:
    """Syndrome: remainder of a 23-bit word by the generator, over GF(2)."""
    rest = word.astype(np.int64)
    for bit in range(CODE_BITS - 1, CODE_BITS - DATA_BITS - 1, -1):
        rest ^= np.where(rest >> bit & 1, GENERATOR << (bit - (CODE_BITS - DATA_BITS)), 0)
    return rest


def correction() -> np.ndarray:
    """Error pattern of every syndrome: each of up to three bits has its own."""
    bits = np.int64(1) << np.arange(CODE_BITS)
    patterns = [0]
    for a in range(CODE_BITS):
        patterns.append(int(bits[a]))
        for b in range(a):
            patterns.append(int(bits[a] | bits[b]))
            patterns += [int(bits[a] | bits[b] | bits[c]) for c in range(b)]
    patterns = np.array(patterns, np.int64)
    table = np.zeros(1 << (CODE_BITS - DATA_BITS), np.int64)
    table[_remainder(patterns)] = patterns
    return table


def codewords_near(words: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Data parts of the codewords nearest to each word and its neighbours: 24 columns,
    with repeats."""
    flips = np.concatenate([[0], np.int64(1) << np.arange(CODE_BITS)])
    around = words[:, None] ^ flips[None, :]
    return (around ^ table[_remainder(around)]) >> (CODE_BITS - DATA_BITS)


def _keys(fps: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and key of all keys. A key has its kind above, then the equal bits, then the
    codeword."""
    u = fps.view(np.uint64)
    segments = [((u >> np.uint64(at)) & np.uint64((1 << w) - 1)).astype(np.int64) for at, w in SEGMENTS]
    near = [codewords_near(s, table) for s in segments]
    for codes in near:
        codes.sort(axis=1)
    halves = [(s & 0x7FF, s >> 11) for s in segments]
    rows, keys = [], []

    def add(kind: int, equal: np.ndarray, codes: np.ndarray) -> None:
        new = np.ones(codes.shape, bool)
        new[:, 1:] = codes[:, 1:] != codes[:, :-1]
        row, column = np.nonzero(new)
        rows.append(row)
        keys.append((np.int64(kind) << 40) | (equal[row] << DATA_BITS) | codes[row, column])

    kind = 0
    for i in range(3):
        for j in range(3):
            if j != i:
                add(kind, segments[i], near[j])
                kind += 1
    for k in range(3):
        i, j = (s for s in range(3) if s != k)
        for a in range(2):
            for b in range(2):
                add(kind, halves[i][a] << 11 | halves[j][b], near[k])
                kind += 1
    return np.concatenate(rows), np.concatenate(keys)


def golay_keys(distinct: DataFrame) -> DataFrame:
    """(key, fp) rows of distinct fingerprints, about a hundred each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = correction()
        for batch in batches:
            fps = batch["fp"].to_numpy()
            for at in range(0, len(fps), 2000):
                part = fps[at : at + 2000]
                rows, keys = _keys(part, table)
                yield pa.record_batch({"key": pa.array(keys), "fp": pa.array(part[rows])})

    # a fingerprint makes a hundred rows, so the few megabytes of them are spread first
    spread = distinct.select("fp").repartition(shuffle_partitions(distinct.sparkSession), "fp")
    return spread.mapInArrow(run, "key bigint, fp bigint")


def _first_kind(diff: Column) -> Column:
    """The first kind of key by which two fingerprints with these differing bits meet."""
    masks = [((1 << w) - 1) << at for at, w in SEGMENTS]
    low = [0x7FF << at for at, _ in SEGMENTS]
    high = [m ^ h for m, h in zip(masks, low)]

    def count(mask: int) -> Column:
        return F.bit_count(diff.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask)))

    cases = []
    for i in range(3):
        cases += [(count(masks[i]) == 0) & (count(masks[j]) <= 2) for j in range(3) if j != i]
    for k in range(3):
        i, j = (s for s in range(3) if s != k)
        for a in (low, high):
            cases += [
                (count(a[i] | b[j]) == 0) & (count(masks[k]) <= 2) for b in (low, high)
            ]
    first = F.lit(len(cases))
    for kind in range(len(cases) - 1, -1, -1):
        first = F.when(cases[kind], F.lit(kind)).otherwise(first)
    return first


def _apart(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def links(distinct: DataFrame) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints with at most four differing bits, a < b, that
    connect all fingerprints so linked, though not each pair of a crowd directly.

    Keys that only one fingerprint has are dropped by an aggregation. Of the others, the
    smallest fingerprint is the pivot: those linked to it are connected through it and need
    no comparing with one another, so a crowd of near copies gives a star and not all its
    pairs. Whatever is not linked to the pivot is compared with the rest of its key, under
    the first kind of key a pair meets by.
    """
    keys = staged(golay_keys(distinct), "golay-keys")
    shared = staged(
        keys.groupBy("key")
        .agg(F.min("fp").alias("pivot"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
        .drop("_n"),
        "shared-keys",
    )
    linked = _apart(F.col("fp"), F.col("pivot")) <= MAX_BITS
    crowd = staged(keys.join(broadcast_if_small(shared), "key").withColumn("linked", linked), "crowds")
    stars = crowd.where("linked and fp > pivot").select(
        F.col("pivot").alias("a"), F.col("fp").alias("b")
    )
    left = crowd.select("key", F.col("fp").alias("x"), F.col("linked").alias("_linked"))
    right = crowd.where("not linked").select(F.col("key").alias("_key"), F.col("fp").alias("y"))
    diff = F.col("x").bitwiseXOR(F.col("y"))
    near = (
        (F.col("key") == F.col("_key"))
        & (F.col("_linked") | (F.col("x") < F.col("y")))
        & (F.bit_count(diff) <= MAX_BITS)
        & (F.shiftright("key", 40) == _first_kind(diff))
    )
    rest = left.join(right, near).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    return stars.unionAll(rest).distinct()


def _of_fingerprints(texts: DataFrame, marked: DataFrame) -> DataFrame:
    """Pairs of text keys as pairs of the texts' fingerprints, those that differ."""
    own = marked.select("text_key", "fp").distinct()
    one = own.select(F.col("text_key").alias("a"), F.col("fp").alias("x"))
    other = own.select(F.col("text_key").alias("b"), F.col("fp").alias("y"))
    return (
        texts.join(one, "a")
        .join(other, "b")
        .where("x <> y")
        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        .distinct()
    )


def _classes(docs: DataFrame, words: int, shingles: bool = False) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text_key, fp) of all documents, and (fp, root) of all fingerprints.
    With ``shingles``, texts that share most of their shingles are linked too."""
    marked = staged(fingerprints(docs, words), "fingerprints")
    distinct = staged(marked.select("fp").distinct(), "distinct-fingerprints")
    linked = staged(links(distinct), "fingerprint-links")
    if shingles:
        texts = staged(similar_texts(docs, text_key(F.col("text"))), "similar-texts")
        linked = linked.unionAll(_of_fingerprints(texts, marked)).distinct()
    pairs = staged(thinned(linked), "thinned-links")
    rooted = components(pairs, distinct.select(F.col("fp").alias("node")))
    return marked, staged(rooted.select(F.col("node").alias("fp"), "root"), "classes")


def near_duplicates(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Per document its fingerprint (16 hex digits) and component: the smallest doc_id
    reachable over links, its own included."""
    marked, classes = _classes(docs, words)
    # smallest ids by fingerprint first: copies are one row before the roots are joined
    firsts = marked.groupBy("fp").agg(F.min("doc_id").alias("first")).join(classes, "fp")
    names = firsts.groupBy("root").agg(F.min("first").alias("component_id"))
    members = staged(classes.join(names, "root").select("fp", "component_id"), "members")
    return marked.join(members, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def without_near_duplicates(
    docs: DataFrame, words: int = WORDS, shingles: bool = True
) -> DataFrame:
    """One document of each component: that with the smallest doc_id, where several share
    it the one with the smallest text key, and of rows that repeat it one. Components take
    the links of fingerprints, with ``shingles`` also those of texts whose five-word
    shingles overlap by 0.8."""
    marked, classes = _classes(docs, words, shingles)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    firsts = marked.groupBy("fp").agg(F.min(order).alias("first")).join(classes, "fp")
    kept = staged(
        firsts.groupBy("root").agg(F.min("first").alias("first")).select(
            F.col("first.doc_id").alias("_id"), F.col("first.text_key").alias("_key")
        ),
        "survivors",
    )
    rows = docs.withColumn("_own", text_key(F.col("text")))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_key"))
    return (
        rows.join(kept, same, "left_semi")
        .groupBy("doc_id", "_own")
        .agg(F.min(F.struct(*docs.columns)).alias("_row"))
        .select("_row.*")
    )
