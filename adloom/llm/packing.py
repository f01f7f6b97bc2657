"""Packing of tokenised documents into sequences by best-two-fit.

A bin takes the longest piece left and is filled greedily with the longest that still
fits. A gap that nothing fits is then widened: the bin's smallest piece is put back where
two pieces left over fill its place and the gap more tightly. Only documents longer than a
sequence are cut; their first piece takes the remainder and the others fill a sequence each.

A null text is empty and still has its end token. Rows with a null or repeated ``doc_id``
are packed like any others, each on its own. An empty table gives no rows; other columns
are ignored. Texts of any length are tokenised whole, runs of a million blanks included.

Pieces are packed in groups of about ``GROUP_PIECES``, dealt by hash. A group wastes at
most about one sequence, so the result is within a few parts in ten thousand of one
global packing, and no task holds more than its group's lengths.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.llm.common import staged
from adloom.llm.tokens import encoder, text_ids

CAPACITY = 1024
END_TOKEN = 2
GROUP_PIECES = 50_000
_SEQUENCE_BITS = 40  # sequence numbers inside a group

PIECES = "_row bigint, doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"


def token_pieces(
    docs: DataFrame, ranks_path: str, pattern: str, capacity: int = CAPACITY, keep_ids: bool = False
) -> DataFrame:
    """One row per piece of every document: where it starts, its length and checksum, and
    with ``keep_ids`` its token ids. ``_row`` tells rows apart whatever their ``doc_id``."""
    kind = dict(docs.dtypes)["doc_id"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = encoder(ranks_path, pattern)
        for batch in batches:
            at, starts, lengths, checks, ids_of, numbers = [], [], [], [], [], []
            for i, text in enumerate(batch["text"]):
                ids = np.array([*text_ids(encoding, text.as_py()), END_TOKEN], "<u4")
                first = (len(ids) - 1) % capacity + 1
                cuts = [0, *range(first, len(ids), capacity), len(ids)]
                for k in range(len(cuts) - 1):
                    part = ids[cuts[k] : cuts[k + 1]]
                    at.append(i)
                    numbers.append(k)
                    starts.append(cuts[k])
                    lengths.append(len(part))
                    checks.append(zlib.crc32(part.tobytes()))
                    if keep_ids:
                        ids_of.append(part.astype(np.int32))
            rows = pa.array(at, pa.int32())
            columns = {
                "_row": batch["_row"].take(rows),
                "doc_id": batch["doc_id"].take(rows),
                "piece": pa.array(numbers, pa.int32()),
                "start": pa.array(starts, pa.int64()),
                "length": pa.array(lengths, pa.int64()),
                "ids_crc32": pa.array(checks, pa.int64()),
            }
            if keep_ids:
                columns["ids"] = pa.array(ids_of, pa.list_(pa.int32()))
            yield pa.record_batch(columns)

    schema = PIECES.format(kind=kind) + (", ids array<int>" if keep_ids else "")
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), "doc_id", "text")
    return staged(rows.mapInArrow(cut, schema), "pieces")


def best_two_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every length. Lengths left are the bits of a number, so the
    longest that fits, and a pair with a given sum, are found by a few shifts."""
    order = np.argsort(lengths, kind="stable")
    left = np.bincount(lengths, minlength=capacity + 1).tolist()
    upto = np.cumsum(np.bincount(lengths, minlength=capacity + 1)).tolist()
    bits = sum(1 << n for n, count in enumerate(left) if count)
    mirror = sum(1 << (capacity - n) for n, count in enumerate(left) if count)
    bins = np.zeros(len(lengths), np.int64)
    offsets = np.zeros(len(lengths), np.int64)

    def take(n: int) -> None:
        nonlocal bits, mirror
        left[n] -= 1
        if not left[n]:
            bits ^= 1 << n
            mirror ^= 1 << (capacity - n)

    def put_back(n: int) -> None:
        nonlocal bits, mirror
        if not left[n]:
            bits |= 1 << n
            mirror |= 1 << (capacity - n)
        left[n] += 1

    def pair_of(total: int) -> tuple[int, int] | None:
        both = bits & (mirror >> (capacity - total))
        if total % 2 == 0 and left[total // 2] == 1:
            both &= ~(1 << (total // 2))
        longer = both.bit_length() - 1
        return (longer, total - longer) if longer > 0 else None

    number = 0
    while bits:
        room, held = capacity, []
        while fits := bits & ((1 << (room + 1)) - 1):
            n = fits.bit_length() - 1
            take(n)
            held.append(n)
            room -= n
        if room and len(held) > 1:
            smallest = held[-1]
            for total in range(smallest + room, smallest, -1):
                if pair := pair_of(total):
                    held.pop()
                    for n in pair:
                        take(n)
                        held.append(n)
                    put_back(smallest)
                    break
        offset = 0
        for n in held:
            # lengths put back are handed out again, so places are taken when a bin closes
            upto[n] -= 1
            item = order[upto[n]]
            bins[item], offsets[item] = number, offset
            offset += n
        number += 1
    return bins, offsets


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``, at most ``capacity`` tokens a sequence."""
    groups = max(1, -(-pieces.count() // group_pieces))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches), arrow)  # lengths of one bounded group
        if not rows.num_rows:
            return
        bins, offsets = best_two_fit(rows["length"].to_numpy(), capacity)
        group = TaskContext.get().partitionId() << _SEQUENCE_BITS
        rows = rows.append_column("sequence_id", pa.array(bins + group))
        yield from rows.append_column("offset", pa.array(offsets)).to_batches(10_000)

    narrow = pieces.drop("ids")
    kind = dict(narrow.dtypes)["doc_id"]
    arrow = pa.schema(
        [
            ("_row", pa.int64()), ("doc_id", {"string": pa.string(), "int": pa.int32()}.get(kind, pa.int64())),
            ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
        ]
    )
    dealt = narrow.repartition(groups, F.xxhash64("_row", "piece"))
    schema = PIECES.format(kind=kind) + ", sequence_id bigint, offset bigint"
    return dealt.mapInArrow(fill, schema)


def pack_documents(
    docs: DataFrame, ranks_path: str, pattern: str, capacity: int = CAPACITY
) -> DataFrame:
    """One row per piece with the sequence and the offset it is packed at."""
    return pack(token_pieces(docs, ranks_path, pattern, capacity), capacity).drop("_row")


def packed_tokens(
    docs: DataFrame, ranks_path: str, pattern: str, capacity: int = CAPACITY
) -> DataFrame:
    """The sequences themselves: their token ids, the pieces' ids one after the other."""
    pieces = token_pieces(docs, ranks_path, pattern, capacity, keep_ids=True)
    places = staged(pack(pieces, capacity).select("_row", "piece", "sequence_id", "offset"), "places")
    filled = pieces.join(places, ["_row", "piece"])
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most ``capacity`` of them
    return filled.groupBy("sequence_id").agg(F.flatten(parts["ids"]).alias("ids"))
