"""Hard negatives by an inverted multi-index, exact.

Vectors are cut in two halves, each with a codebook of its own; the two codes of a vector
name its cell. Every code has a radius, the distance of its farthest vector, so an anchor's
inner product with any vector of a cell is at most the sum of two half bounds: that with the
code, plus the anchor half's norm times the radius. A heap walks the pairs of codes in falling
order of that sum, the multi-sequence way. It stops when no cell left can change the answer:

1. Cells are taken until they hold ``PROBE_ROWS`` rows; the anchor's best rows of its own
   label in them give a score that its positives reach at least.
2. The heap goes on while sums reach that score. The positives are then certain.
3. Every positive has a window of scores for its negatives. The best in the cells so far
   give a score for each window, its lower end where it is not yet full.
4. The heap goes on while sums reach the least of these. The windows are then certain.

The codebooks are fitted on ``SAMPLE_ROWS`` rows drawn by hash; every row is indexed, and
bounds hold for all of them, so the sample decides the cost alone. Rows of the index lie
sorted by cell and are dealt by range, a cell of many rows over several tasks. Anchors are
taken in slices of ``SLICE``, neighbours in the order of cells; a slice and its cells
(65,536 bits an anchor at most) are what is sent to the tasks, and a task sends back
the best few of each anchor.

Rows with a null label, a null vector or a component that is null or not finite take no
part. Shorter vectors count as padded with zeros. A null ``vec_id`` is no anchor and comes
after all others in ties. Repeated rows are rows of their own, each anchor, positive and
negative of the others. Scores are exact up to 2**53. An empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adloom.llm.common import running_total, shuffle_partitions, staged
from adloom.session import work_folder

SAMPLE_ROWS = 20_000
ITERATIONS = 8
ROWS_PER_CELL = 200
MOST_CODES = 256  # of a half
PROBE_ROWS = 4096
SLICE = 4096
BLOCK = 1024  # anchors and rows multiplied at a time
KEPT = 1 << 18  # candidates a task holds before it sorts them out
_SLACK = 1e-6  # rounding of bounds, as a part of their size

FOUND = "anchor int, place int, score bigint, vec_id bigint, row bigint"
RESULT = (
    "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, "
    "positive_score bigint, negative_score bigint"
)


def quantised(embeddings: DataFrame) -> DataFrame:
    """Rows that take part: whole components, labels shifted where ``vec_id`` says so."""

    def fine(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    vec_id, label = F.col("vec_id").cast("bigint"), F.col("label").cast("bigint")
    return embeddings.where(
        F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", fine)
    ).select(
        F.monotonically_increasing_id().alias("row"),
        vec_id.alias("vec_id"),
        F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * 256)).alias("v"),
    )


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows, padded with zeros."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    made = np.zeros((len(lengths), width))
    at = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    made[np.repeat(np.arange(len(lengths)), lengths), at] = values
    return made


def _nearest(x: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return np.argmin((codes**2).sum(axis=1)[None, :] - 2 * (x @ codes.T), axis=1)


def codebook(sample: np.ndarray, codes: int) -> np.ndarray:
    """At most so many centres of the sample, by Lloyd's rounds."""
    if not sample.shape[1]:
        return np.zeros((1, 0))
    distinct = np.unique(sample, axis=0)
    draw = np.random.default_rng(0).permutation(len(distinct))[:codes]
    centres = distinct[draw].astype(np.float64)
    for _ in range(ITERATIONS):
        own = _nearest(sample, centres)
        counts = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


@dataclass
class MultiIndex:
    """Codebooks and radii of both halves, rows per cell, and the sorted rows."""

    width: int
    halves: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]
    cells: np.ndarray
    rows: DataFrame | None

    def bounds(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Upper bounds of both half scores, vectors by codes."""
        made = []
        cut = self.halves[0].shape[1]
        for part, codes, radius in zip((x[:, :cut], x[:, cut:]), self.halves, self.radii):
            reach = np.linalg.norm(part, axis=1)[:, None] * radius[None, :]
            score = part @ codes.T
            made.append(score + reach + _SLACK * (np.abs(score) + reach + 1))
        return made[0], made[1]


def build_index(rows: DataFrame) -> MultiIndex:
    """Index all rows (row, vec_id, label, v)."""
    spark = rows.sparkSession
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("v")), F.lit(0)).alias("width")).first()
    width = size["width"]
    wanted = round((size["n"] / ROWS_PER_CELL) ** 0.5)
    codes = max(2, min(MOST_CODES, wanted))
    drawn = rows.orderBy(F.xxhash64("row")).limit(SAMPLE_ROWS).select("v").toArrow()
    sample = _matrix(drawn["v"].combine_chunks(), width)
    cut = width // 2
    halves = (codebook(sample[:, :cut], codes), codebook(sample[:, cut:], codes))
    many = len(halves[1])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch["v"], width)
            columns = {name: batch[name] for name in ("row", "vec_id", "label", "v")}
            for name, part, centres in zip("ab", (x[:, :cut], x[:, cut:]), halves):
                own = _nearest(part, centres)
                columns[name] = pa.array(own.astype(np.int32))
                columns[f"far_{name}"] = pa.array(np.linalg.norm(part - centres[own], axis=1))
            yield pa.record_batch(columns)

    coded = rows.mapInArrow(
        assign,
        "row bigint, vec_id bigint, label bigint, v array<bigint>, a int, far_a double, b int, far_b double",
    ).withColumn("cell", F.col("a") * many + F.col("b"))
    index = staged(
        coded.repartitionByRange(shuffle_partitions(spark), "cell", "row").sortWithinPartitions("cell", "row"),
        "multi-index",
    )
    cells = np.zeros(len(halves[0]) * many, np.int64)
    radii = (np.zeros(len(halves[0])), np.zeros(many))
    per_cell = index.groupBy("cell").agg(F.count(F.lit(1)), F.max("far_a"), F.max("far_b"))
    for cell, n, far_a, far_b in per_cell.collect():  # MOST_CODES squared rows at most
        cells[cell] = n
        for radius, code, far in zip(radii, divmod(cell, many), (far_a, far_b)):
            radius[code] = max(radius[code], far)
    return MultiIndex(width, halves, radii, cells, index.drop("a", "b", "far_a", "far_b"))


def multi_sequence(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """(sum, i, j) of all pairs in falling order of first[i] + second[j]."""
    one, two = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    x, y = first[one].tolist(), second[two].tolist()
    heap = [(-(x[0] + y[0]), 0, 0)]
    done = [0] * len(x)  # pairs taken of each row
    while heap:
        bound, i, j = heapq.heappop(heap)
        yield -bound, int(one[i]), int(two[j])
        done[i] = j + 1
        # a pair comes in when its neighbours before it are out
        if i + 1 < len(x) and done[i + 1] == j:
            heapq.heappush(heap, (-(x[i + 1] + y[j]), i + 1, j))
        if j + 1 < len(y) and (i == 0 or done[i - 1] > j + 1):
            heapq.heappush(heap, (-(x[i] + y[j + 1]), i, j + 1))


def cells_to_visit(
    index: MultiIndex, vectors: np.ndarray, least: np.ndarray | None, visited: np.ndarray | None
) -> np.ndarray:
    """Bits of the cells each anchor takes: while their sums reach ``least``, or else until
    they hold enough rows; without those visited before."""
    first, second = index.bounds(vectors)
    many = len(index.halves[1])
    made = np.zeros((len(vectors), len(index.cells)), bool)
    for k in range(len(vectors)):
        held = 0
        for bound, i, j in multi_sequence(first[k], second[k]):
            if bound < least[k] if least is not None else held >= PROBE_ROWS:
                break
            cell = i * many + j
            if index.cells[cell]:
                made[k, cell] = True
                held += index.cells[cell]
    packed = np.packbits(made, axis=1)
    return packed if visited is None else packed & ~visited


@dataclass
class Anchors:
    """A slice of anchors, and what is looked for: own labels, or other labels in windows."""

    rows: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    visits: np.ndarray
    count: int
    low: np.ndarray | None = None  # anchors by windows; an empty window has low > high
    high: np.ndarray | None = None


class _Best:
    """The best candidates of every anchor and place that a task has met."""

    def __init__(self, anchors: int, places: int, count: int):
        self.places, self.count = places, count
        self.least = np.full((anchors, places), -np.inf)
        self.parts: list[np.ndarray] = []
        self.held = 0

    def add(self, at: np.ndarray, place: int, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """Scores of anchors ``at`` by rows, -inf where a row is no candidate."""
        least = self.least[at, place]
        unset = np.isinf(least)
        if unset.any() and scores.shape[1] >= self.count:
            top = np.partition(scores[unset], -self.count, axis=1)[:, -self.count]
            least[unset] = top
            self.least[at, place] = least
        a, r = np.nonzero((scores >= least[:, None]) & (scores > -np.inf))
        if len(a):
            found = np.stack([at[a], np.full(len(a), place), scores[a, r].astype(np.int64), ids[r], rows[r]])
            self.parts.append(found)
            self.held += len(a)
            if self.held > KEPT:
                self.prune()

    def prune(self) -> np.ndarray:
        if not self.parts:
            return np.empty((5, 0), np.int64)
        found = np.concatenate(self.parts, axis=1)
        key = found[0] * self.places + found[1]
        found = found[:, np.lexsort((found[4], found[3], -found[2], key))]
        key = found[0] * self.places + found[1]
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        rank = np.arange(len(key)) - np.repeat(starts, np.diff(np.r_[starts, len(key)]))
        last = found[:, rank == self.count - 1]
        self.least[last[0], last[1]] = np.maximum(self.least[last[0], last[1]], last[2])
        found = found[:, rank < self.count]
        self.parts, self.held = [found], found.shape[1]
        return found


_NO_ID = np.iinfo(np.int64).max  # a null vec_id, in ties after all others


def visit(index: MultiIndex, anchors: Anchors) -> DataFrame:
    """The best rows of every anchor (and window) in the cells that it visits."""
    cells = np.flatnonzero(np.unpackbits(np.bitwise_or.reduce(anchors.visits, axis=0)))
    first, last = (int(cells[0]), int(cells[-1])) if len(cells) else (0, -1)
    known = index.rows.sparkSession.sparkContext.broadcast(anchors)
    width = index.width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = known.value
        places = 1 if own.low is None else own.low.shape[1]
        best = _Best(len(own.rows), places, own.count)
        for batch in batches:
            cell = batch["cell"].to_numpy()
            for start in range(0, len(cell), BLOCK):
                part = batch.slice(start, BLOCK)
                _search(own, best, part, cell[start : start + BLOCK], _matrix(part["v"], width))
        found = best.prune()
        names = [f.split()[0] for f in FOUND.split(", ")]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        columns = [pa.array(c.astype(np.int64)).cast(k) for c, k in zip(found, kinds)]
        columns[3] = pc.if_else(pc.equal(columns[3], _NO_ID), pa.scalar(None, pa.int64()), columns[3])
        yield pa.RecordBatch.from_arrays(columns, names)

    return index.rows.where(F.col("cell").between(first, last)).mapInArrow(run, FOUND)


def _search(own: Anchors, best: _Best, part: pa.RecordBatch, cell: np.ndarray, x: np.ndarray) -> None:
    """Compare a block of rows with the anchors that visit their cells."""
    labels, rows = part["label"].to_numpy(), part["row"].to_numpy()
    ids = part["vec_id"].fill_null(_NO_ID).to_numpy()
    distinct, which = np.unique(cell, return_inverse=True)
    bits = own.visits[:, distinct >> 3] >> (7 - (distinct & 7)).astype(np.uint8) & 1 > 0
    wanting = np.flatnonzero(bits.any(axis=1))
    for start in range(0, len(wanting), BLOCK):
        at = wanting[start : start + BLOCK]
        scores = own.vectors[at] @ x.T
        fits = bits[at][:, which]
        same = own.labels[at][:, None] == labels[None, :]
        if own.low is None:
            fits &= same & (own.rows[at][:, None] != rows[None, :])
            best.add(at, 0, np.where(fits, scores, -np.inf), ids, rows)
        else:
            fits &= ~same
            for place in range(own.low.shape[1]):
                low, high = own.low[at, place][:, None], own.high[at, place][:, None]
                inside = fits & (scores >= low) & (scores <= high)
                best.add(at, place, np.where(inside, scores, -np.inf), ids, rows)


def _ranked(found: DataFrame, count: int) -> DataFrame:
    """The first rows of every anchor and place, with their ``rank`` from 1."""
    order = Window.partitionBy("anchor", "place").orderBy(
        F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row"
    )
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def _visits(
    index: MultiIndex, anchors: DataFrame, least: np.ndarray | None = None, visited: np.ndarray | None = None
) -> pa.Table:
    """A slice of anchors in order of ``anchor``, with the bits of the cells they visit."""
    plain = MultiIndex(index.width, index.halves, index.radii, index.cells, None)
    known = anchors.sparkSession.sparkContext.broadcast((plain, least, visited))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, least, visited = known.value
        for batch in batches:
            at = batch["anchor"].to_numpy()
            bits = cells_to_visit(
                own,
                _matrix(batch["v"], own.width),
                None if least is None else least[at],
                None if visited is None else visited[at],
            )
            yield pa.record_batch(
                {**{n: batch[n] for n in ("anchor", "row", "label", "v")}, "visits": pa.array([b.tobytes() for b in bits], pa.binary())}
            )

    rows = anchors.select("anchor", "row", "label", "v").mapInArrow(
        run, "anchor int, row bigint, label bigint, v array<bigint>, visits binary"
    )
    return rows.toArrow().sort_by("anchor")  # SLICE rows at most


def _bits(table: pa.Table) -> np.ndarray:
    return np.stack([np.frombuffer(b.as_py(), np.uint8) for b in table["visits"]])


def _lowest(found: DataFrame, count: int, floor: np.ndarray) -> np.ndarray:
    """Per anchor and place the score of the last of so many rows, or else the floor."""
    made = floor.copy()
    full = found.where(F.col("rank") == count).select("anchor", "place", "score").toArrow()
    at = full["anchor"].to_numpy(), full["place"].to_numpy()
    made[at] = np.maximum(made[at], full["score"].to_numpy())
    return made


def _mine(index: MultiIndex, anchors: DataFrame, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    """Negatives of one slice of anchors (anchor, row, vec_id, label, v)."""
    drawn = _visits(index, anchors)
    n, visited = drawn.num_rows, _bits(drawn)
    own = Anchors(
        drawn["row"].to_numpy(),
        drawn["label"].to_numpy(),
        _matrix(drawn["v"].combine_chunks(), index.width),
        visited,
        positives,
    )
    first = staged(visit(index, own), "probed")
    ranked = _ranked(first, positives)
    least = _lowest(ranked, positives, np.full((n, 1), -np.inf))[:, 0]
    own.visits = _bits(_visits(index, anchors, least, visited))
    near = staged(_ranked(first.unionAll(visit(index, own)), positives), "positives")

    windows = near.select("anchor", F.col("rank").alias("window"), "score").toArrow()
    at = windows["anchor"].to_numpy(), windows["window"].to_numpy() - 1
    score = windows["score"].to_numpy()
    own.low, own.high = np.full((n, positives), np.inf), np.full((n, positives), -np.inf)
    own.low[at] = -(-low * score // high)
    own.high[at] = score
    own.count = negatives
    visited = visited | own.visits
    own.visits = visited
    second = staged(visit(index, own), "negatives")
    floor = np.where(own.low <= own.high, own.low, np.inf)
    least = _lowest(_ranked(second, negatives), negatives, floor).min(axis=1)
    own.visits = _bits(_visits(index, anchors, least, visited))
    found = _ranked(second.unionAll(visit(index, own)), negatives)

    pairs = near.select(
        "anchor", (F.col("rank") - 1).alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    names = anchors.select("anchor", F.col("vec_id").alias("anchor_id"))
    # a slice has SLICE anchors at most, and a few positives each
    return (
        found.join(F.broadcast(pairs), ["anchor", "place"])
        .join(F.broadcast(names), "anchor")
        .select(
            "anchor_id",
            "positive_id",
            F.col("rank").cast("int").alias("rank"),
            F.col("vec_id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
    )


def hard_negatives(
    embeddings: DataFrame,
    every: int = 100,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
) -> DataFrame:
    """For every anchor (``vec_id`` divisible by ``every``) and each of its first positives,
    the first rows of other labels that score between low/high and all of the positive."""
    spark = embeddings.sparkSession
    index = build_index(staged(quantised(embeddings), "vectors"))
    chosen = running_total(index.rows.where(F.col("vec_id") % every == 0), [F.col("cell"), F.col("row")])
    anchors = staged(
        chosen.select(
            (F.col("before") % SLICE).cast("int").alias("anchor"),
            F.floor(F.col("before") / SLICE).alias("slice"),
            "row", "vec_id", "label", "v",
        ),
        "anchors",
    )
    slices = anchors.agg(F.max("slice").alias("last")).first()["last"]
    path = work_folder(spark, "hard-negatives")
    spark.createDataFrame([], RESULT).write.parquet(path)
    for at in range(0 if slices is None else slices + 1):
        own = anchors.where(F.col("slice") == at).drop("slice")
        _mine(index, own, positives, negatives, low, high).write.mode("append").parquet(path)
    return spark.read.schema(RESULT).parquet(path)
