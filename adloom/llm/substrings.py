"""Repeated word runs across documents, by prefix-partitioned suffix trees.

Every window of ``WINDOW`` words starts a suffix, of which the first ``WINDOW`` words count.
Suffixes that could repeat are split by their prefix into groups that fit a task's memory:
the prefix is ``DEPTHS[0]`` words long, and the next of ``DEPTHS`` for the groups that would
still hold more than ``GROUP_ROWS``, step by step. A group's suffixes are sorted by the
hashes of their prefixes at all depths, which lays its subtree out depth first: what two
neighbours share is the depth of their lowest common node. The internal nodes as deep as a
window that join several documents are the repeats. A prefix still hot at the last depth is
split into its deepest nodes themselves, of which only the smallest place is needed; that is
aggregated before anything is shuffled. Neighbouring windows whose first places are neighbours
too make up one long repeat (``long_repeats``).

A suffix's path through the inner nodes is one number, ``BITS`` of a hash for each depth; two
inner nodes that share their bits are read as one, which joins nothing below them. The deepest
nodes hold equal words by 128 bits of the SHA-256 of the words themselves.

Which suffixes could repeat is decided exactly beforehand. The smallest ``GRAM``-word hash
in a window is its anchor; equal windows have equal anchors, so a window whose anchor lies
in one document only is unique. Documents whose words all equal an earlier document's are
settled by that alone, and their windows are left out: the earlier document has them all.

Words are runs of bytes other than white space, unchanged. A null or empty text has none.
Documents with a null ``doc_id`` keep all their words and cover no others. Rows that repeat
a ``doc_id`` are one document for the comparison and keep a row each. An empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adloom.llm.common import shuffle_partitions, staged
from adloom.llm.words import (
    Powers,
    RunHashes,
    WordHashes,
    hashes_of,
    sliding_max,
    sliding_min,
)
from adloom.operators.sizes import broadcast_if_small

WINDOW = 50
GRAM = 10
DEPTHS = (10, 20, 40)  # words of a prefix
BITS = (32, 16, 16)  # of the path, for each depth
AFTER = (32, 16, 0)  # bits of the path behind those of each depth
GROUP_ROWS = 20_000  # suffixes of a group; about 1 MB


def _anchors(runs: RunHashes, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchor of every window, and the distinct anchors of the text."""
    grams = runs.of(gram)
    width = window - gram + 1
    if len(grams) < width:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    least = sliding_min(grams, width)
    return least, np.unique(least)


def word_facts(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Per row: a key of its text, word count, digest of the word sequence and anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, powers = WordHashes(), Powers()
        for batch in batches:
            counts, digests, anchors = [], [], []
            for text in batch["text"]:
                words = (text.as_py() or "").encode().split()
                runs = RunHashes(hashes_of(words, known), powers)
                counts.append(len(words))
                digests.append(hashlib.sha256(b" ".join(words)).digest()[:16])
                anchors.append(_anchors(runs, window, gram)[1].view(np.int64))
            yield pa.record_batch(
                {
                    "doc_id": batch["doc_id"],
                    "text_key": batch["text_key"],
                    "n_words": pa.array(counts, pa.int64()),
                    "digest": pa.array(digests, pa.binary()),
                    "anchors": pa.array(anchors, pa.list_(pa.int64())),
                }
            )

    return _keyed(docs).mapInArrow(
        run,
        "doc_id bigint, text_key bigint, n_words bigint, digest binary, anchors array<bigint>",
    )


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows with a key of their text: with doc_id it tells rows apart as far as results do."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"),
        "text",
    )


def _paths(runs: RunHashes, at: np.ndarray, window: int) -> np.ndarray:
    """The first words of each suffix as one number, the shortest prefix in the highest bits;
    depths that are no shorter than a window have no bits set."""
    path = np.zeros(len(at), np.uint64)
    for depth, bits, after in zip(DEPTHS, BITS, AFTER):
        if depth < window:
            path |= runs.of(depth)[at] >> np.uint64(64 - bits) << np.uint64(after)
    return path.view(np.int64)


_NODE = ["words_high", "words_low"]  # of the deepest node: what a window's words are


def _digests(words: list[bytes], at: np.ndarray, window: int) -> np.ndarray:
    """Two numbers that stand for the words of each window: a row per place."""
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    parts = (
        hashlib.sha256(line[a:b]).digest()[:16]
        for a, b in zip(starts[at].tolist(), ends[at + window - 1].tolist())
    )
    return np.frombuffer(b"".join(parts), np.int64).reshape(-1, 2)


def suffixes(candidates: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Suffixes whose anchor is shared: their place, their path and the digest of their words.
    ``candidates`` has doc_id, text_key, text and the shared anchors of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, powers = WordHashes(), Powers()
        for batch in batches:
            for i, text in enumerate(batch["text"]):
                words = (text.as_py() or "").encode().split()
                runs = RunHashes(hashes_of(words, known), powers)
                least, _ = _anchors(runs, window, gram)
                shared = batch["shared"][i].values.to_numpy(zero_copy_only=False)
                at = np.nonzero(np.isin(least, shared.view(np.uint64)))[0]
                if not len(at):
                    continue
                row = pa.array(np.full(len(at), i, np.int32))
                digests = _digests(words, at, window)
                columns = {
                    "doc_id": batch["doc_id"].take(row),
                    "text_key": batch["text_key"].take(row),
                    "at": pa.array(at.astype(np.int32)),
                    "path": pa.array(_paths(runs, at, window)),
                }
                for k, name in enumerate(_NODE):
                    columns[name] = pa.array(np.ascontiguousarray(digests[:, k]))
                yield pa.record_batch(columns)

    hashed = "".join(f", {name} bigint" for name in ["path", *_NODE])
    return candidates.select("doc_id", "text_key", "text", "shared").mapInArrow(
        run, f"doc_id bigint, text_key bigint, at int{hashed}"
    )


def shared_depth(columns: list[np.ndarray], before: list[int] | None) -> np.ndarray:
    """How many levels each sorted suffix shares with the one before it; ``before`` is the
    suffix ahead of the first one."""
    depth = np.zeros(len(columns[0]), np.int64)
    same = np.ones(len(depth), bool)
    for k, column in enumerate(columns):
        same[1:] &= column[1:] == column[:-1]
        same[0] &= before is not None and before[k] == column[0]
        depth += same
    return depth


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Read a sorted group as its tree: neighbours that share all levels are leaves of one
    node as deep as a window. Its first leaf lies in its smallest document; those of other
    documents repeat it. Only the last leaf and its node's first one are carried over."""
    last, first_doc, first_at = None, 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        path = batch["path"].to_numpy()
        columns = [*(path >> after for after in AFTER), *(batch[name].to_numpy() for name in _NODE)]
        docs, places = batch["doc_id"].to_numpy(), batch["at"].to_numpy()
        opens = shared_depth(columns, last) < len(columns)
        first = np.maximum.accumulate(np.where(opens, np.arange(len(docs)), -1))
        smallest = np.where(first < 0, first_doc, docs[first])
        start = np.where(first < 0, first_at, places[first])
        last = [column[-1] for column in columns]
        first_doc, first_at = smallest[-1], start[-1]
        repeated = pa.array(docs > smallest)
        yield pa.record_batch(
            {
                "doc_id": batch["doc_id"],
                "text_key": batch["text_key"],
                "at": batch["at"],
                "first_doc": pa.array(smallest.astype(np.int64)),
                "first_at": pa.array(start.astype(np.int32)),
            }
        ).filter(repeated)


_PLACES = ["doc_id", "text_key", "at", "first_doc", "first_at"]


def repeated_windows(found: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(doc_id, text_key, at) of windows that a smaller document has too, with the smallest
    place that has them, (first_doc, first_at)."""
    rest, groups = found, None
    for after in AFTER:
        prefixes = rest.select("*", F.shiftright("path", after).alias("_prefix"))
        hot = staged(
            prefixes.groupBy("_prefix").count().where(F.col("count") > group_rows).select("_prefix"),
            "hot-prefixes",
        )
        hot_prefix = broadcast_if_small(hot)
        settled = prefixes.join(hot_prefix, "_prefix", "left_anti").drop("_prefix")
        settled = settled.withColumn("_after", F.lit(after).cast("byte"))
        groups = settled if groups is None else groups.unionByName(settled)
        rest = prefixes.join(hot_prefix, "_prefix", "left_semi").drop("_prefix")
        if hot.isEmpty():
            break
    place = F.struct(F.col("doc_id").alias("first_doc"), F.col("at").alias("first_at"))
    nodes = rest.groupBy(*_NODE).agg(F.min(place).alias("_first"), F.max("doc_id").alias("_last"))
    found_hot = (
        rest.join(nodes.where("_first.first_doc < _last").drop("_last"), _NODE)
        .where("doc_id > _first.first_doc")
        .select("doc_id", "text_key", "at", "_first.*")
    )
    group = F.expr("shiftright(path, cast(_after as int))")
    return (
        groups.repartition(shuffle_partitions(found.sparkSession), "_after", group)
        .sortWithinPartitions("_after", "path", *_NODE, "doc_id", "at")
        .mapInArrow(_walk, "doc_id bigint, text_key bigint, at int, first_doc bigint, first_at int")
        .unionByName(found_hot)
    )


def long_repeats(windows: DataFrame, window: int = WINDOW) -> DataFrame:
    """Windows that follow one another both in their document and at their first places,
    joined: doc_id, text_key, start, words, first_doc, first_start. Each is as long as it can
    be; a document's windows meet in one task, the others' do not."""
    along = F.col("at") - F.col("first_at")
    mine = Window.partitionBy("doc_id", "text_key", "first_doc", "_along").orderBy("at")
    rows = windows.select(*_PLACES).distinct().withColumn("_along", along)
    return (
        rows.withColumn("_run", F.col("at") - F.row_number().over(mine))
        .groupBy("doc_id", "text_key", "first_doc", "_along", "_run")
        .agg(F.min("at").alias("start"), (F.max("at") - F.min("at") + window).alias("words"))
        .select(
            "doc_id", "text_key", "start", "words", "first_doc",
            (F.col("start") - F.col("_along")).alias("first_start"),
        )
    )


def _earlier_copies(facts: DataFrame, window: int) -> DataFrame:
    """Rows marked ``copy`` where a smaller document has the same words throughout."""
    first = (
        facts.where((F.col("n_words") >= window) & F.col("doc_id").isNotNull())
        .groupBy("digest")
        .agg(F.min("doc_id").alias("_first"), F.max("doc_id").alias("_last"))
        .where("_first < _last")
        .drop("_last")
    )
    return facts.join(first, "digest", "left").withColumn(
        "copy", F.coalesce(F.col("doc_id") > F.col("_first"), F.lit(False))
    )


def shared_suffixes(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """The suffixes that could repeat, and (doc_id, text_key) of whole copies, which give none."""
    facts = staged(word_facts(docs, window, gram), "word-facts")
    marked = staged(
        _earlier_copies(facts.drop("anchors"), window).select("doc_id", "text_key", "copy").distinct(),
        "copies",
    )
    copies = marked.where("copy").select("doc_id", "text_key")
    own = (
        facts.where(F.col("doc_id").isNotNull())
        .select("doc_id", "text_key", "anchors")
        .join(copies, ["doc_id", "text_key"], "left_anti")
        .select("doc_id", "text_key", F.explode("anchors").alias("anchor"))
    )
    shared = staged(
        own.groupBy("anchor")
        .agg(F.min("doc_id").alias("_lo"), F.max("doc_id").alias("_hi"))
        .where("_lo < _hi")
        .select("anchor"),
        "shared-anchors",
    )
    # lists are bounded by their document
    of_doc = staged(
        own.join(shared, "anchor", "left_semi")
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set("anchor").alias("shared")),
        "candidates",
    )
    texts = _keyed(docs).join(of_doc, ["doc_id", "text_key"])
    return staged(suffixes(texts, window, gram), "suffixes"), copies


def removed_ranges(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Per (doc_id, text_key) with something to remove: ``copy`` (all of it), or the starts
    ``at`` of the windows an earlier document has."""
    found, copies = shared_suffixes(docs, window, gram)
    windows = repeated_windows(found).groupBy("doc_id", "text_key").agg(F.collect_set("at").alias("at"))
    return windows.unionByName(
        copies.withColumn("at", F.lit(None).cast("array<int>"))
    ).withColumn("copy", F.col("at").isNull())


def covered(at: np.ndarray, n: int, window: int) -> np.ndarray:
    """Words covered by windows that start at these places."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, at, 1)
    np.add.at(edges, np.minimum(at + window, n), -1)
    return np.cumsum(edges[:n]) > 0


def without_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """One row per document: its words, those removed, and the text that stays."""
    ranges = staged(removed_ranges(docs, window, gram), "removed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, kept, digests = [], [], [], []
            for i, text in enumerate(batch["text"]):
                words = (text.as_py() or "").encode().split()
                stay = words
                if batch["copy"][i].as_py():
                    stay = []
                elif (at := batch["at"][i]).is_valid:
                    places = at.values.to_numpy(zero_copy_only=False).astype(np.int64)
                    gone = covered(places, len(words), window)
                    stay = [w for w, g in zip(words, gone.tolist()) if not g]
                line = b" ".join(stay)
                counts.append(len(words))
                removed.append(len(words) - len(stay))
                kept.append(line)
                digests.append(hashlib.sha256(line).hexdigest())
            yield pa.record_batch(
                {
                    "doc_id": batch["doc_id"],
                    "n_words": pa.array(counts, pa.int64()),
                    "n_removed": pa.array(removed, pa.int64()),
                    "kept_text": pa.array(kept, pa.binary()).cast(pa.string()),
                    "kept_sha256": pa.array(digests, pa.string()),
                }
            )

    same = ["doc_id", "text_key"]
    rows = _keyed(docs).join(ranges, same, "left").select("doc_id", "text", "at", "copy")
    return rows.mapInArrow(
        run, "doc_id bigint, n_words bigint, n_removed bigint, kept_text string, kept_sha256 string"
    )
