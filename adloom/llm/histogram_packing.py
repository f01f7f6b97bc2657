"""Packing by shortest-pack-first over the histogram of lengths.

Documents are cut only where they are longer than a sequence; what is left of each is one
piece. The plan sees nothing but how many pieces there are of each length. Lengths are
placed longest first; a length goes to the shortest pack, and all packs of one pattern take
it at once, so patterns and their counts change, not single packs. Where no pack has room
a new one opens and, being the shortest, takes the next pieces of that length too.

Patterns that are then neither full nor a power of two long would be padded. The emptiest of
them are taken apart and fill the gaps of the others, cut where a gap ends: patterns lie on
one line of tokens, the gaps on another, and a piece is cut where they meet. What remains
makes full sequences and then one for every bit of the rest, so nothing is padded.

Pieces find their pattern by rank: pieces ordered by length have a place each, and every
pattern owns a run of places of each of its lengths.

The histogram has at most ``capacity`` rows and a plan a few patterns per length, whatever
the number of documents. A null text is empty and has its end token alone. Rows with a null
or repeated ``doc_id`` are packed each on its own. An empty table gives no rows; other
columns are ignored. Texts of any length are tokenised whole. Pieces of equal length are
interchangeable; which gets which place is settled when their order is written.
"""

from __future__ import annotations

import heapq
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.llm.common import running_total, staged
from adloom.llm.tokens import encoder, text_ids
from adloom.operators.sizes import broadcast_if_small

CAPACITY = 2048
END_TOKEN = 1

Content = tuple[tuple[int, int], ...]  # (length, how many of it), in the order they lie


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[tuple[int, Content]]:
    """Patterns and how many packs have each."""
    packs: dict[int, list[tuple[int, Content]]] = defaultdict(list)  # by the room they have
    rooms: list[int] = []  # their keys, negative, as a heap

    def add(count: int, content: Content, room: int) -> None:
        if not packs[room]:
            heapq.heappush(rooms, -room)
        packs[room].append((count, content))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            while rooms and not packs[-rooms[0]]:
                heapq.heappop(rooms)
            room = -rooms[0] if rooms else 0
            if room >= length:
                count, content = packs[room].pop()
                taken = min(count, left)
                if taken < count:
                    packs[room].append((count - taken, content))
                if content[-1][0] == length:
                    longer = (*content[:-1], (length, content[-1][1] + 1))
                else:
                    longer = (*content, (length, 1))
                add(taken, longer, room - length)
                left -= taken
            else:
                each = capacity // length
                for count, n in ((left // each, each), (1, left % each)):
                    if count and n:
                        add(count, ((length, n),), capacity - n * length)
                left = 0
    return [pack for room in sorted(packs) for pack in packs[room]]


@dataclass
class Plan:
    """Where every piece goes. ``runs``: first place, pattern, pieces per pack, offset and
    length. ``patterns``: first sequence, fill, and where its tokens start on the line of
    those taken apart (-1: stays whole). ``slots`` of that line: where they start, their
    size, first sequence and offset in it."""

    runs: np.ndarray
    patterns: np.ndarray
    slots: np.ndarray


def plan_packs(histogram: dict[int, int], capacity: int) -> Plan:
    """The plan for so many pieces of each length."""
    fills = [
        (sum(length * n for length, n in content), count, content)
        for count, content in shortest_pack_first(histogram, capacity)
    ]
    padded = [p for p in fills if p[0] < capacity and p[0] & (p[0] - 1)]
    whole = [p for p in fills if not (p[0] < capacity and p[0] & (p[0] - 1))]
    padded.sort(key=lambda p: -p[0])
    supply, wanted = sum(fill * count for fill, count, _ in padded), 0
    filled, apart = [], []
    for fill, count, content in padded:
        # one more pack to fill takes its tokens from the supply and asks for its gap
        k = 0 if apart else min(count, (supply - wanted) // capacity)
        supply -= k * fill
        wanted += k * (capacity - fill)
        if k:
            filled.append((fill, k, content))
        if k < count:
            apart.append((fill, count - k, content))

    patterns, slots, runs = [], [], defaultdict(list)
    sequence = line = gaps = 0
    for kept, group in ((True, whole), (True, filled), (False, apart)):
        for fill, count, content in group:
            if group is filled:
                slots.append((gaps, capacity - fill, sequence, fill))
                gaps += count * (capacity - fill)
            offset = 0
            for length, n in content:
                runs[length].append((count * n, len(patterns), n, offset, length))
                offset += length * n
            patterns.append((sequence, fill, -1 if kept else line))
            if kept:
                sequence += count
            else:
                line += count * fill
    rest = line - gaps
    sizes = [(capacity, rest // capacity)] if rest >= capacity else []
    sizes += [(1 << b, 1) for b in range(capacity.bit_length(), -1, -1) if rest % capacity >> b & 1]
    for size, count in sizes:
        slots.append((gaps, size, sequence, 0))
        gaps += size * count
        sequence += count

    place, table = 0, []
    for length in sorted(runs):
        for pieces, *run in runs[length]:
            table.append((place, *run))
            place += pieces
    return Plan(
        np.array(table, np.int64).reshape(-1, 5),
        np.array(patterns, np.int64).reshape(-1, 3),
        np.array(slots, np.int64).reshape(-1, 4),
    )


def token_pieces(
    docs: DataFrame, ranks_path: str, pattern: str, capacity: int, end_token: int, keep_ids: bool
) -> DataFrame:
    """One row per piece: full ones, and the rest of every document with its token ids."""
    kind = dict(docs.dtypes)["doc_id"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = encoder(ranks_path, pattern)
        for batch in batches:
            at, starts, lengths, checks, totals, parts = [], [], [], [], [], []
            for i, text in enumerate(batch["text"]):
                ids = np.array([*text_ids(encoding, text.as_py()), end_token], "<u4")
                for start in range(0, len(ids), capacity):
                    part = ids[start : start + capacity]
                    at.append(i)
                    starts.append(start)
                    lengths.append(len(part))
                    checks.append(zlib.crc32(part.tobytes()))
                    totals.append(len(ids))
                    parts.append(part if keep_ids or len(part) < capacity else part[:0])
            rows = pa.array(at, pa.int32())
            ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
            flat = np.concatenate([np.empty(0, "<u4"), *parts]).astype(np.int32)
            yield pa.record_batch(
                {
                    "_row": batch["_row"].take(rows),
                    "doc_id": batch["doc_id"].take(rows),
                    "start": pa.array(starts, pa.int64()),
                    "length": pa.array(lengths, pa.int64()),
                    "ids_crc32": pa.array(checks, pa.int64()),
                    "doc_tokens": pa.array(totals, pa.int64()),
                    "ids": pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                }
            )

    schema = (
        f"_row bigint, doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, "
        "doc_tokens bigint, ids array<int>"
    )
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), "doc_id", "text")
    return staged(rows.mapInArrow(cut, schema), "pieces")


def _placed(pieces: DataFrame, plan: Plan) -> DataFrame:
    """Narrow rows of pieces with their sequence and offset, and ``line``, where the piece
    starts on the line of tokens to cut (-1: it stays whole)."""
    narrow = pieces.drop("ids")
    names = narrow.columns
    ordered = running_total(narrow, [F.col("length"), F.col("_row"), F.col("start")])
    known = pieces.sparkSession.sparkContext.broadcast(plan)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, pattern, each, offset, length = known.value.runs.T
        for batch in batches:
            before = batch["before"].to_numpy()
            run = np.searchsorted(first, before, "right") - 1
            copy, k = np.divmod(before - first[run], each[run])
            sequence, fill, line = known.value.patterns[pattern[run]].T
            inside = offset[run] + k * length[run]
            cut = np.where(line < 0, -1, line + copy * fill + inside)
            columns = {name: batch[name] for name in names}
            columns["sequence_id"] = pa.array(sequence + copy)
            columns["offset"] = pa.array(inside)
            columns["line"] = pa.array(cut)
            yield pa.record_batch(columns)

    fields = ", ".join(f"{name} {kind}" for name, kind in narrow.dtypes)
    return staged(
        ordered.select(*names, "before").mapInArrow(
            place, f"{fields}, sequence_id bigint, offset bigint, line bigint"
        ),
        "places",
    )


def _cuts(slots: np.ndarray, start: int, length: int) -> list[tuple[int, int, int, int]]:
    """(start, length, sequence, offset) of the parts of a run of tokens on the line."""
    found, at, end = [], start, start + length
    row = int(np.searchsorted(slots[:, 0], at, "right")) - 1
    while at < end:
        first, size, sequence, offset = (int(v) for v in slots[row])
        last = int(slots[row + 1, 0]) if row + 1 < len(slots) else end
        while at < min(end, last):
            copy, inside = divmod(at - first, size)
            taken = min(size - inside, end - at)
            found.append((at - start, taken, sequence + copy, offset + inside))
            at += taken
        row += 1
    return found


def _cut_up(apart: DataFrame, pieces: DataFrame, plan: Plan, keep_ids: bool) -> DataFrame:
    """The pieces on the line, cut where slots end."""
    known = pieces.sparkSession.sparkContext.broadcast(plan.slots)
    kind = dict(pieces.dtypes)["doc_id"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines, sizes = batch["line"].to_pylist(), batch["length"].to_pylist()
            at, made, checks, parts = [], [], [], []
            for i, (line, size) in enumerate(zip(lines, sizes)):
                ids = batch["ids"][i].values.to_numpy()
                for one in _cuts(known.value, line, size):
                    part = ids[one[0] : one[0] + one[1]]
                    at.append(i)
                    made.append(one)
                    checks.append(zlib.crc32(part.astype("<u4").tobytes()))
                    if keep_ids:
                        parts.append(part)
            rows = pa.array(at, pa.int32())
            start, length, sequence, offset = np.array(made, np.int64).reshape(-1, 4).T
            origin = batch["start"].take(rows).to_numpy()
            columns = {
                "doc_id": batch["doc_id"].take(rows),
                "start": pa.array(origin + start),
                "length": pa.array(length),
                "ids_crc32": pa.array(checks, pa.int64()),
                "doc_tokens": batch["doc_tokens"].take(rows),
                "sequence_id": pa.array(sequence),
                "offset": pa.array(offset),
            }
            if keep_ids:
                columns["ids"] = pa.array(parts, pa.list_(pa.int32()))
            yield pa.record_batch(columns)

    schema = (
        f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
        "sequence_id bigint, offset bigint" + (", ids array<int>" if keep_ids else "")
    )
    whole = pieces.select("_row", "start", "ids")
    return broadcast_if_small(apart).join(whole, ["_row", "start"]).mapInArrow(cut, schema)


def pack_by_histogram(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    capacity: int = CAPACITY,
    end_token: int = END_TOKEN,
    keep_ids: bool = False,
) -> DataFrame:
    """One row per piece with the sequence and the offset it lies at, and with ``keep_ids``
    its token ids."""
    pieces = token_pieces(docs, ranks_path, pattern, capacity, end_token, keep_ids)
    counts = pieces.groupBy("length").count().collect()  # at most ``capacity`` rows
    plan = plan_packs({row["length"]: row["count"] for row in counts}, capacity)
    placed = _placed(pieces, plan)
    kept = placed.where("line < 0").drop("line")
    if keep_ids:
        kept = kept.join(pieces.select("_row", "start", "ids"), ["_row", "start"])
    cut = _cut_up(placed.where("line >= 0").drop("sequence_id", "offset"), pieces, plan, keep_ids)
    return kept.drop("_row").unionByName(cut)


def packed_sequences(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    capacity: int = CAPACITY,
    end_token: int = END_TOKEN,
) -> DataFrame:
    """The sequences themselves: token ids, and where each document's part begins."""
    pieces = pack_by_histogram(docs, ranks_path, pattern, capacity, end_token, True)
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most ``capacity`` of them
    return pieces.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.offset").alias("begins")
    )
