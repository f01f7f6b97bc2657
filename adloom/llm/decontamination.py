"""Benchmark decontamination by greedy string tiling.

Benchmark items are a stated query set. Their runs of ``SEED_WORDS`` words are hashed by
Karp-Rabin, sorted, and given to the tasks in blocks of bounded size; documents are never
shuffled. A document whose runs meet an item's is tiled against it: matching runs that
follow one another in both make matches (their words' own hashes are compared), the longest is marked first, what overlaps marked
words is cut back to what is still free and tried again, until no match of ``SEED_WORDS``
is left. An item is leaked where the marked words reach ``COVERAGE`` of it, in whatever
order its parts stand in the document.

Words are compared in lower case and without punctuation. Null and empty texts have none.
Letters of scripts that part no words are words of their own. An item shorter than a seed
has one hash for all its words and is leaked where a document holds it whole. Rows that
repeat are reported each; a null id is kept; an empty table of either kind gives no pairs.
"""

from __future__ import annotations

import heapq
import re
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom.llm.words import Powers, RunHashes, WordHashes, hashes_of, plain_words

SEED_WORDS = 5
COVERAGE = 0.5
MOST_PLACES = 1 << 16  # equal seeds of a document and an item that are made one by one
BLOCK_BYTES = 8 * 1024 * 1024  # text of the items compared at a time

# Scripts written without blanks: Thai to Lao, Myanmar, Khmer, kana and Han.
_UNPARTED = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff])")


def words_of(text: str | None) -> list[bytes]:
    """Plain words, and single letters of scripts without blanks."""
    if text and not text.isascii() and _UNPARTED.search(text):
        text = _UNPARTED.sub(r" \1 ", text)
    return plain_words(text)


Tile = tuple[int, int, int]  # first word in the document, in the item, words


@dataclass(frozen=True)
class Seeds:
    """All seeds of a block of items, sorted by hash, and the items shorter than a seed:
    by their number of words, hash and item. ``words`` are hashes of each item's words."""

    hashes: np.ndarray
    item: np.ndarray
    at: np.ndarray
    words: list[np.ndarray]
    short: dict[int, dict[int, list[int]]]


def seeds_of(texts: Sequence[str | None], seed_words: int = SEED_WORDS) -> Seeds:
    known, powers = WordHashes(), Powers()
    hashes, item, at, all_words = [], [], [], []
    short: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
    for i, text in enumerate(texts):
        words = words_of(text)
        all_words.append(hashes_of(words, known))
        own = RunHashes(all_words[-1], powers)
        runs = own.of(seed_words)
        if 0 < len(words) < seed_words:
            short[len(words)][int(own.of(len(words))[0])].append(i)
        hashes.append(runs)
        item.append(np.full(len(runs), i, np.int32))
        at.append(np.arange(len(runs), dtype=np.int32))
    joined = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
    order = np.argsort(joined, kind="stable")
    return Seeds(
        joined[order],
        np.concatenate(item)[order] if item else np.empty(0, np.int32),
        np.concatenate(at)[order] if at else np.empty(0, np.int32),
        all_words,
        {n: dict(found) for n, found in short.items()},
    )


def short_matches(own: RunHashes, seeds: Seeds) -> dict[int, int]:
    """Where a document first holds each item shorter than a seed."""
    found: dict[int, int] = {}
    for n, items in seeds.short.items():
        runs = own.of(n)
        hits = np.flatnonzero(np.isin(runs, np.fromiter(items, np.uint64, len(items))))
        for p in hits[::-1].tolist():
            found.update(dict.fromkeys(items[int(runs[p])], p))
    return found


def seed_matches(
    runs: np.ndarray, seeds: Seeds
) -> Iterator[tuple[int, int, Callable[[], tuple[np.ndarray, np.ndarray]]]]:
    """Per item that shares a seed: the item, how many places have equal seeds, and how to
    make them. Places are counted before any is made: a text that repeats an item's words
    has as many as both lengths multiplied."""
    if not len(seeds.hashes):
        return
    near = np.minimum(np.searchsorted(seeds.hashes, runs), len(seeds.hashes) - 1)
    hit = np.flatnonzero(seeds.hashes[near] == runs)
    if not len(hit):
        return
    hit = hit[np.argsort(runs[hit], kind="stable")]
    hashes, first, count = np.unique(runs[hit], return_index=True, return_counts=True)
    low = np.searchsorted(seeds.hashes, hashes)
    width = np.searchsorted(seeds.hashes, hashes, side="right") - low
    which = np.repeat(np.arange(len(hashes)), width)
    entry = np.arange(len(which)) + np.repeat(low - np.cumsum(width) + width, width)
    order = np.argsort(seeds.item[entry], kind="stable")
    which, entry = which[order], entry[order]
    items, starts = np.unique(seeds.item[entry], return_index=True)
    for item, a, b in zip(items.tolist(), starts, [*starts[1:], len(entry)]):
        mine, at = which[a:b], seeds.at[entry[a:b]]
        n = count[mine]

        def places(mine=mine, at=at, n=n) -> tuple[np.ndarray, np.ndarray]:
            inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            return hit[np.repeat(first[mine], n) + inside], np.repeat(at, n)

        yield item, int(n.sum()), places


def tile(places: list[tuple[int, int]], seed_words: int = SEED_WORDS) -> list[Tile]:
    """Greedy tiling from the places of equal seeds: longest first, nothing overlaps."""
    known = set(places)
    matches = []
    for p, q in places:
        if (p - 1, q - 1) in known:
            continue
        n = 1
        while (p + n, q + n) in known:
            n += 1
        matches.append((-(n + seed_words - 1), p, q))
    heapq.heapify(matches)
    used_text: set[int] = set()
    used_item: set[int] = set()
    tiles = []
    while matches:
        size, p, q = heapq.heappop(matches)
        free = [p + k not in used_text and q + k not in used_item for k in range(-size)]
        if all(free):
            tiles.append((p, q, -size))
            used_text.update(range(p, p - size))
            used_item.update(range(q, q - size))
            continue
        start = None
        for k, is_free in enumerate([*free, False]):
            if is_free and start is None:
                start = k
            elif not is_free and start is not None:
                if k - start >= seed_words:
                    heapq.heappush(matches, (start - k, p + start, q + start))
                start = None
    return tiles


def tile_by_length(
    text: np.ndarray, item: np.ndarray, powers: Powers, seed_words: int = SEED_WORDS
) -> list[Tile]:
    """The same tiles in memory of both lengths added: hashes of free runs of one length tell
    whether any is shared, the greatest such length is found by halving, and its first
    place is marked."""
    own, other = RunHashes(text, powers), RunHashes(item, powers)
    used_text, used_item = np.zeros(len(text), bool), np.zeros(len(item), bool)

    def free(used: np.ndarray, n: int) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(used)))
        return np.flatnonzero(sums[n:] == sums[: len(sums) - n])

    def first_shared(n: int) -> tuple[int, int] | None:
        if n > min(len(text), len(item)):
            return None
        at_text, at_item = free(used_text, n), free(used_item, n)
        if not len(at_text) or not len(at_item):
            return None
        runs, known = own.of(n)[at_text], other.of(n)[at_item]
        at_item = at_item[np.argsort(known, kind="stable")]
        known = np.sort(known)
        low = np.searchsorted(known, runs)
        for k in np.flatnonzero(known[np.minimum(low, len(known) - 1)] == runs):
            p, j = int(at_text[k]), int(low[k])
            while j < len(known) and known[j] == runs[k]:
                q = int(at_item[j])
                if np.array_equal(text[p : p + n], item[q : q + n]):
                    return p, q
                j += 1
        return None

    tiles: list[Tile] = []
    size = min(len(text), len(item))  # of the longest run that may be left
    while size >= seed_words:
        found, best = first_shared(size), size
        low, high = seed_words, size - 1
        if found is None:
            while low <= high:
                middle = (low + high + 1) // 2
                shared = first_shared(middle)
                if shared is None:
                    high = middle - 1
                else:
                    found, best, low = shared, middle, middle + 1
        if found is None:
            break
        tiles.append((*found, best))
        used_text[found[0] : found[0] + best] = True
        used_item[found[1] : found[1] + best] = True
        size = best
    return tiles


def tiles_of(
    text: np.ndarray,
    item: np.ndarray,
    count: int,
    places: Callable[[], tuple[np.ndarray, np.ndarray]],
    powers: Powers,
) -> list[Tile]:
    """Tiles of a document's words against an item's, from their equal seeds, whose words are
    compared; by whole lengths where there are too many of them to be made."""
    if count > MOST_PLACES:
        return tile_by_length(text, item, powers)
    at_text, at_item = places()
    same = np.ones(len(at_text), bool)
    for k in range(SEED_WORDS):
        same &= text[at_text + k] == item[at_item + k]
    return tile(list(zip(at_text[same].tolist(), at_item[same].tolist())))


def _blocks(benchmark: DataFrame) -> Iterator[list]:
    """The items, in blocks of about ``BLOCK_BYTES`` of text."""
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + size // BLOCK_BYTES
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for number in range(blocks):
        yield (
            benchmark.select("item_id", "text")
            .where(block == number)
            .orderBy("item_id", "text")
            .collect()
        )


def with_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    coverage: float = COVERAGE,
    carry: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """The columns to carry and ``leaks``: the items a document leaks, each with the words
    covered and its tiles. Blocks of items pass over the documents one after the other."""
    rows = docs.select(*dict.fromkeys([*carry, "text"]))
    columns = rows.columns
    item_type = benchmark.schema["item_id"].dataType
    rows = rows.withColumn("leaks", F.array().cast(T.ArrayType(_leak(item_type))))
    for items in _blocks(benchmark):
        rows = _with_block(rows, items, coverage)
    return rows.select(*(c for c in columns if c in carry), "leaks")


def _leak(item_type: T.DataType) -> T.StructType:
    tile_type = T.StructType([T.StructField(n, T.IntegerType()) for n in ("at", "item_at", "words")])
    return T.StructType(
        [
            T.StructField("item_id", item_type),
            T.StructField("item_words", T.IntegerType()),
            T.StructField("covered", T.IntegerType()),
            T.StructField("tiles", T.ArrayType(tile_type)),
        ]
    )


def _with_block(rows: DataFrame, items: list, coverage: float) -> DataFrame:
    """Add what the documents leak of one block of items."""
    seeds = seeds_of([r["text"] for r in items])
    ids = [r["item_id"] for r in items]

    def leaked(text: str | None, known: WordHashes, powers: Powers) -> list[dict]:
        words = hashes_of(words_of(text), known)
        own = RunHashes(words, powers)
        tiled = {
            i: tiles_of(words, seeds.words[i], count, places, powers)
            for i, count, places in seed_matches(own.of(SEED_WORDS), seeds)
        }
        for i, p in short_matches(own, seeds).items():
            tiled[i] = [(p, 0, len(seeds.words[i]))]
        out = []
        for i, tiles in sorted(tiled.items()):
            covered = sum(n for _, _, n in tiles)
            if covered >= coverage * len(seeds.words[i]):
                out.append(
                    {
                        "item_id": ids[i],
                        "item_words": len(seeds.words[i]),
                        "covered": covered,
                        "tiles": [dict(zip(("at", "item_at", "words"), t)) for t in sorted(tiles)],
                    }
                )
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, powers = WordHashes(), Powers()
        for batch in batches:
            new = [leaked(t.as_py(), known, powers) for t in batch["text"]]
            at = batch.schema.get_field_index("leaks")
            before = batch["leaks"]
            if any(new):
                lists = [b + n for b, n in zip(before.to_pylist(), new)]
                before = pa.array(lists, before.type)
            yield batch.set_column(at, batch.schema.field(at), before)

    return rows.mapInArrow(run, rows.schema)


def leaked_pairs(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """One row per document and item it leaks: words of the item, of them covered, tiles and
    the longest, and where the tiles lie in the document (word:item word:words)."""
    pairs = with_leaks(docs, benchmark, coverage).select("doc_id", F.explode("leaks").alias("_l"))
    tiles = F.col("_l.tiles")
    text = F.transform(
        tiles, lambda t: F.concat_ws(":", *(t[n].cast("string") for n in ("at", "item_at", "words")))
    )
    return pairs.select(
        "doc_id",
        F.col("_l.item_id").alias("item_id"),
        F.col("_l.item_words").alias("item_words"),
        F.col("_l.covered").alias("covered_words"),
        (F.col("_l.covered") / F.col("_l.item_words")).alias("coverage"),
        F.size(tiles).alias("n_tiles"),
        F.array_max(F.transform(tiles, lambda t: t["words"])).alias("longest"),
        F.concat_ws(",", text).alias("tiles"),
    )
