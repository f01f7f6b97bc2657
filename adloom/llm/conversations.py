"""Repair of conversation structure by least-cost edits, streamed in turn order.

Rows are dealt by conversation and sorted by turn inside each partition; a task then reads
them as a stream and carries the state of a dynamic programme from one Arrow batch to the
next. Role initials must come to ``(s?(ua)+)?``, an automaton of four states, so what is
carried is bounded: for every state the least cost of reaching it, the rank of the edits
that do so in ASCII order, and a running hash of the repaired lines. Two ways of reaching
states after the same row never are prefixes of one another, so ranks decide every tie.

A row leaves one byte per state behind: the state it came from, the insertions before it and
its edit. The edits are read back through these bytes when the conversation ends. Beyond
``SPILL_ROWS`` rows they go to a file in the shared folder, which the task removes after
reading; a lost task leaves at most such a file, and its repetition writes another.

Nulls in text, role and key count as one space; rows with a null turn come first. Rows of
the same turn are ordered by role and text. A null conversation id is a conversation. A row
repeated whole is a duplicate. Conversations whose rows are all dropped are empty. Texts of
any length are read whole. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adloom.llm.files import delete_file, folder, open_input, open_output
from adloom.session import work_folder

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3  # what edits cost
SPILL_ROWS = 1 << 20
BLANKS = " \t\n\x0b\x0c\r"
SENTENCE_ENDS = ".!?"

START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
TURN_AFTER = (USER, USER, ASSISTANT, USER)  # the state a user or assistant turn leads to
ROLES = {USER: "user", ASSISTANT: "assistant"}
KEPT = {  # the states kept rows lead to, by initial
    "s": {START: SYSTEM},
    "u": {START: USER, SYSTEM: USER, ASSISTANT: USER},
    "a": {USER: ASSISTANT},
}
LETTERS = "DIKR"

RESULT = (
    "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
    "cost bigint, audit string, repaired_sha256 string"
)


def _or_space(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(" "))


def damaged(rows: DataFrame) -> DataFrame:
    """The rows with faults put in by a checksum of their key: ``dropped`` rows stay marked,
    so that their conversation is not lost."""
    key = F.concat_ws(":", _or_space(F.col("conv_id")), _or_space(F.col("turn")))
    fault = F.crc32(key.cast("binary")) % 20
    text = (
        F.when(F.col("fault") == 1, F.lit(""))
        .when(F.col("fault") == 2, F.translate("text", SENTENCE_ENDS, ""))
        .otherwise(F.col("text"))
    )
    copies = F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(0))).otherwise(F.array(F.lit(0)))
    return (
        rows.select(
            "conv_id",
            "turn",
            _or_space(F.col("role")).alias("role"),
            _or_space(F.col("text")).alias("text"),
            fault.alias("fault"),
        )
        .select(
            "conv_id",
            "turn",
            F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
            text.alias("text"),
            (F.col("fault") == 0).alias("dropped"),
            F.explode(copies).alias("_copy"),
        )
        .drop("_copy")
    )


@lru_cache(maxsize=None)
def _edits(initial: str, required: bool, truncated: bool) -> tuple[tuple[int, int, int, str], ...]:
    """(state before, state after, cost, letters) of all ways to take one row, with up to
    two insertions before it; a third would lead back to a state without a cost."""
    ways = []
    extra = TRUNCATED if truncated else 0
    for state in range(4):
        at = state
        for inserted in range(3):
            spent, letters = inserted * INSERT, "I" * inserted
            ways.append((state, at, spent + DELETE, letters + "D"))
            if not required:
                if at in KEPT.get(initial, ()):
                    ways.append((state, KEPT[initial][at], spent + KEEP + extra, letters + "K"))
                ways.append((state, TURN_AFTER[at], spent + REROLE + extra, letters + "R"))
            at = TURN_AFTER[at]
    return tuple(ways)


@lru_cache(maxsize=None)
def _byte(before: int, letters: str) -> int:
    return before | (len(letters) - 1) << 2 | LETTERS.index(letters[-1]) << 4


class Backpointers:
    """Four bytes a row, the oldest in a file of the shared folder once they are many."""

    def __init__(self, root: str, limit: int):
        self.root, self.limit = root, limit
        self.uri, self.out = "", None
        self.recent = bytearray()
        self.spilled = 0

    def add(self, row: bytes) -> None:
        self.recent += row
        if len(self.recent) >= 4 * self.limit:
            if self.out is None:
                self.uri = f"{folder(self.root)}/back-{uuid.uuid4().hex}"
                self.out = open_output(self.uri)
            self.out.write(bytes(self.recent))
            self.spilled += len(self.recent)
            self.recent = bytearray()

    def backwards(self) -> Iterator[bytes]:
        """Blocks of whole rows, the last first."""
        yield bytes(self.recent)
        if self.out is not None:
            self.out.close()
            with open_input(self.uri) as source:
                for at in range(self.spilled - 4 * self.limit, -1, -4 * self.limit):
                    source.seek(at)
                    yield source.read(4 * self.limit)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            delete_file(self.uri)


@dataclass
class _State:
    cost: int
    rank: int
    digest: "hashlib._Hash"
    empty: bool = True  # no line yet


@dataclass
class Conversation:
    """What is carried from row to row."""

    back: Backpointers
    states: dict[int, _State] = field(
        default_factory=lambda: {START: _State(0, 0, hashlib.sha256())}
    )
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    turns: int = 0
    first_turn: int | None = None
    last_turn: int | None = None
    initial: str | None = None

    def add(self, turn: int | None, role: str, text: str, seen: bool) -> None:
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = initial

        end = text.rstrip(BLANKS)[-1:]
        blank, cut = not end, False
        if blank:
            self.blank += 1
        elif seen:
            self.duplicate += 1
        elif end not in SENTENCE_ENDS:
            self.truncated += 1
            cut = True
        self._take(role, text, _edits(initial, blank or seen, cut))

    def _take(self, role: str, text: str, ways) -> None:
        best: dict[int, tuple] = {}
        for before, after, cost, letters in ways:
            state = self.states.get(before)
            if state is not None:
                found = (state.cost + cost, state.rank, letters, before)
                if after not in best or found < best[after]:
                    best[after] = found
        order = sorted(best, key=lambda after: best[after][1:3])
        reached, marks = {}, bytearray(4)
        for after, (cost, _, letters, before) in best.items():
            origin = self.states[before]
            digest, empty = _with_lines(origin, before, letters, role, text)
            reached[after] = _State(cost, order.index(after), digest, empty)
            marks[after] = _byte(before, letters)
        self.states = reached
        self.back.add(bytes(marks))

    def end(self) -> tuple[int, str, str]:
        """Cost, edits and hash of the cheapest repair."""
        ways = []
        for before, state in self.states.items():
            at = before
            for inserted in range(3):
                if at in ENDS:
                    ways.append((state.cost + inserted * INSERT, state.rank, "I" * inserted, before))
                at = TURN_AFTER[at]
        cost, _, letters, before = min(ways)
        digest, _ = _with_lines(self.states[before], before, letters, None, None)
        parts, at = [letters], before
        for block in self.back.backwards():
            made = []
            for row in range(len(block) - 4, -1, -4):
                mark = block[row + at]
                made.append(LETTERS[mark >> 4])
                made.append("I" * (mark >> 2 & 3))
                at = mark & 3
            parts.append("".join(reversed(made)))
        return cost, "".join(reversed(parts)), digest.hexdigest()

    def result(self) -> tuple:
        gaps = 0
        if self.first_turn is not None:
            gaps = self.last_turn - self.first_turn + 1 - self.turns
        return (gaps, self.blank, self.duplicate, self.truncated, self.illegal, *self.end())


def _with_lines(state: _State, at: int, letters: str, role: str | None, text: str | None):
    """The hash of the repaired lines after these edits of one row."""
    if letters == "D" or not letters:
        return state.digest, state.empty  # never changed in place, so states may share it
    digest, empty = state.digest.copy(), state.empty
    for letter in letters:
        if letter == "D":
            continue
        made = ROLES[TURN_AFTER[at]]
        line = {"I": f"{made}:", "R": f"{made}:{text}", "K": f"{role}:{text}"}[letter]
        digest.update((line if empty else "\n" + line).encode())
        at, empty = TURN_AFTER[at], False
    return digest, empty


def repaired(rows: DataFrame, spill_rows: int = SPILL_ROWS) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text, dropped): its faults,
    and cost, edits and result of its cheapest repair."""
    kind = dict(rows.dtypes)["conv_id"]
    root = work_folder(rows.sparkSession, "backpointers")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, talk = None, None
        try:
            for batch in batches:
                ids, results = [], []
                columns = [batch[c].to_pylist() for c in ("conv_id", "turn", "role", "text", "dropped", "seen")]
                for conv, turn, role, text, dropped, seen in zip(*columns):
                    if talk is None or conv != known:
                        if talk is not None:
                            ids.append(known)
                            results.append(talk.result())
                            talk.back.close()
                        known, talk = conv, Conversation(Backpointers(root, spill_rows))
                    if not dropped:
                        talk.add(turn, role, text, seen)
                if ids:
                    yield _batch(batch.schema.field("conv_id").type, ids, results)
            if talk is not None:
                yield _batch(batch.schema.field("conv_id").type, [known], [talk.result()])
        finally:
            if talk is not None:
                talk.back.close()

    # one shuffle: both the window and the stream find their rows dealt by conversation
    dealt = rows.repartition("conv_id")
    earlier = Window.partitionBy("conv_id", "dropped", "role", "text").orderBy("turn")
    marked = dealt.withColumn("seen", F.row_number().over(earlier) > 1)
    ordered = marked.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text", "seen")
    return ordered.select("conv_id", "turn", "role", "text", "dropped", "seen").mapInArrow(
        run, f"conv_id {kind}, {RESULT}"
    )


def _batch(kind: pa.DataType, ids: list, results: list[tuple]) -> pa.RecordBatch:
    names = [part.split()[0] for part in RESULT.split(", ")]
    columns = [pa.array(ids, kind)]
    for name, values in zip(names, zip(*results)):
        columns.append(pa.array(values, pa.string() if name in ("audit", "repaired_sha256") else pa.int64()))
    return pa.RecordBatch.from_arrays(columns, ["conv_id", *names])


def repaired_turns(rows: DataFrame, repairs: DataFrame) -> DataFrame:
    """The repaired conversations themselves: (conv_id, position, edit, role, text).

    Edits are joined with the rows they took, both numbered inside their conversation.
    """
    order = Window.partitionBy("conv_id").orderBy(
        F.col("turn").asc_nulls_first(), "role", "text"
    )
    numbered = rows.where("not dropped").select(
        F.col("conv_id").alias("_conv"),
        F.row_number().over(order).cast("bigint").alias("_row"),
        F.col("role").alias("_role"),
        F.col("text").alias("_text"),
    )
    edits = repairs.select("conv_id", F.posexplode(F.split("audit", "")).alias("_at", "edit")).where(
        "edit <> ''"
    )
    so_far = Window.partitionBy("conv_id").orderBy("_at")
    taken = F.sum(F.when(F.col("edit") != "I", 1).otherwise(0)).over(so_far)
    made = edits.withColumn("_taken", F.when(F.col("edit") != "I", taken))
    lines = made.join(
        numbered,
        F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("_taken") == F.col("_row")),
        "left",
    ).where("edit <> 'D'")
    placed = lines.withColumn("position", F.row_number().over(so_far).cast("bigint"))
    system = F.max(F.when(F.col("position") == 1, (F.col("edit") == "K") & (F.substring("_role", 1, 1) == "s")))
    first = F.coalesce(system.over(Window.partitionBy("conv_id")), F.lit(False)).cast("int")
    role = F.when((F.col("position") - first) % 2 == 1, F.lit("user")).otherwise(F.lit("assistant"))
    return placed.select(
        "conv_id",
        "position",
        "edit",
        F.when(F.col("edit") == "K", F.col("_role")).otherwise(role).alias("role"),
        F.coalesce("_text", F.lit("")).alias("text"),
    )
