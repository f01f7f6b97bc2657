"""Toxicity by compression distance.

Two Zstandard dictionaries are trained, one on windows of toxic text and one on windows of
ordinary text. A window that the toxic dictionary makes shorter than the ordinary one
speaks for toxicity; how many windows of a text do so, at several margins, is turned into a
score by a logistic fit on labelled texts that trained neither dictionary.

A window is a word in a fixed frame. The frame is in both dictionaries, so a window is
compressed at all, and a word that a dictionary holds extends the frame's match instead of
costing literals. Wider windows were tried (two and four words) and separate worse, as the
prose around a word costs more or fewer bytes by chance than the word saves. A dictionary
is filled with whole windows, the most telling ones nearest its end: Zstandard's own trainer
cuts segments for long samples and drops short words. How telling a window must be for the
toxic dictionary is calibrated with the rest.

Only training may sample: at most ``SAMPLE`` labelled rows a class, those smallest by hash,
each with its whole text, however long, or with none. Scoring takes whole texts of every row. A null or
empty text has no windows and gets the score of a text without evidence. A row without
``doc_id`` is scored like any other. Repeated rows score alike; a document labelled more
than once is toxic where one label says so. Without labelled rows of both classes every
score is 0. Other columns are carried only where asked for.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.llm.words import plain_words

SAMPLE = 2000
FOLDS = 5  # documents whose checksum leaves remainder 0 train nothing
TOXIC_BYTES = 16 * 1024
ORDINARY_BYTES = 64 * 1024
TELLING = (5, 10, 20, 40)  # least weight of a toxic window, one of these
MARGINS = (1, 2, 3, 4, 5, 6)  # bytes by which the toxic dictionary must be shorter
FRAME = b"\n\n\n\n\n\n\n %b\n"
RIDGE = 1e-2
_KNOWN_WINDOWS = 1 << 19

# Short matches count, and a dictionary's few kilobytes are searched in full.
_COMPRESSION = {
    "format": zstandard.FORMAT_ZSTD1_MAGICLESS,
    "write_checksum": 0,
    "write_content_size": 0,
    "write_dict_id": 0,
    "strategy": zstandard.STRATEGY_BTULTRA2,
    "min_match": 3,
    "window_log": 17,
    "hash_log": 15,
    "chain_log": 16,
    "search_log": 8,
    "target_length": 64,
}


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


@dataclass(frozen=True)
class Model:
    """What the executors need: a few kilobytes."""

    toxic: bytes
    ordinary: bytes
    weights: tuple[float, ...]


def _compressor(dictionary: bytes):
    form = zstandard.ZstdCompressionParameters(**_COMPRESSION)
    # never shorter than the eight bytes a dictionary must have
    data = zstandard.ZstdCompressionDict(
        dictionary.rjust(8), dict_type=zstandard.DICT_TYPE_RAWCONTENT
    )
    data.precompute_compress(compression_params=form)
    return zstandard.ZstdCompressor(dict_data=data, compression_params=form).compress


class Lengths(dict):
    """Bytes that the toxic dictionary saves over the ordinary one, per window."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        super().__init__()
        self.toxic, self.ordinary = _compressor(toxic), _compressor(ordinary)

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KNOWN_WINDOWS:
            self.clear()
        window = FRAME % word
        saved = self[word] = len(self.ordinary(window)) - len(self.toxic(window))
        return saved


def evidence(text: str | None, saved: Lengths) -> list[float]:
    """Per margin, the logarithm of one more than the windows that reach it."""
    gains = [g for g in map(saved.__getitem__, plain_words(text)) if g > 0]
    return [math.log1p(sum(g >= m for g in gains)) for m in MARGINS]


def _distinctive(toxic: list[list[bytes]], ordinary: list[list[bytes]]) -> dict[bytes, float]:
    """How much more often a window's documents are toxic, by log odds of document counts."""
    seen = [Counter(w for words in texts for w in set(words)) for texts in (toxic, ordinary)]
    return {
        w: math.sqrt(n)
        * (
            math.log((n + 0.5) / (len(toxic) + 1))
            - math.log((seen[1][w] + 0.5) / (len(ordinary) + 1))
        )
        for w, n in seen[0].items()
    }


def _dictionary(words: list[bytes], size: int) -> bytes:
    """Framed windows up to a size, the first words last, where they cost least."""
    chosen, used = [], 0
    for word in words:
        window = FRAME % word
        used += len(window)
        if used > size:
            break
        chosen.append(window)
    return b"".join(reversed(chosen))


def train_dictionaries(
    toxic: list[str], ordinary: list[str], telling: float
) -> tuple[bytes, bytes]:
    """From the toxic texts the windows that set them apart, from the ordinary ones those
    that most of them have."""
    words = [[plain_words(t) for t in texts] for texts in (toxic, ordinary)]
    apart = _distinctive(*words)
    most = sorted((w for w, v in apart.items() if v >= telling), key=lambda w: (-apart[w], w))
    seen = Counter(w for text in words[1] for w in set(text))
    usual = sorted(seen, key=lambda w: (-seen[w], w))
    return _dictionary(most, TOXIC_BYTES), _dictionary(usual, ORDINARY_BYTES)


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights of a ridge logistic fit by Newton's steps; the last one is the constant."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], RIDGE)
    ridge[-1] = 1e-9
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        slope = x.T @ (weight * (y - p)) - ridge * w
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(bend, slope)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Train on a bounded sample of the labelled rows that are not held out."""
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    totals = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    mixed = F.xxhash64("doc_id")
    chosen = None
    for label in (0, 1):
        rows = known.where(F.col("toxic") == label).orderBy(mixed, "doc_id").limit(sample)
        chosen = rows if chosen is None else chosen.unionAll(rows)
    texts = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .join(F.broadcast(chosen), "doc_id")  # at most two samples of ids
        .orderBy(F.xxhash64("doc_id"), "text")
        .limit(2 * sample)
        .collect()
    )
    by_label = {k: [r["text"] for r in texts if r["toxic"] == k] for k in (0, 1)}
    if min(map(len, by_label.values())) < 2:
        return None
    half = {k: (t[::2], t[1::2]) for k, t in by_label.items()}
    y = np.array([k for k in (0, 1) for _ in half[k][1]])
    # the sample is even, the fit weighs the classes as they are among all labelled rows
    weight = np.array([totals[k] / len(half[k][1]) for k in (0, 1) for _ in half[k][1]])
    weight *= len(weight) / weight.sum()
    best = None
    for telling in TELLING:
        toxic, ordinary = train_dictionaries(half[1][0], half[0][0], telling)
        saved = Lengths(toxic, ordinary)
        x = np.array([evidence(t, saved) for k in (0, 1) for t in half[k][1]])
        w = fit_logistic(x, y, weight)
        margin = (2 * y - 1) * (x @ w[:-1] + w[-1])
        loss = (weight * np.logaddexp(0, -margin)).sum()
        if best is None or loss < best[0]:
            best = loss, Model(toxic, ordinary, tuple(w))
    return best[1]


@lru_cache(maxsize=2)
def _lengths(toxic: bytes, ordinary: bytes) -> Lengths:
    return Lengths(toxic, ordinary)


def score(docs: DataFrame, model: Model | None, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns to carry, and ``score`` from 0 to 1, in one pass without a shuffle."""
    columns = [*carry] if "text" in carry else [*carry, "text"]
    rows = docs.select(*columns)
    carried = rows.select(*carry).schema
    if model is None:
        return rows.select(*carry, F.lit(0.0).alias("score"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        saved = _lengths(model.toxic, model.ordinary)
        weights = np.array(model.weights)
        for batch in batches:
            x = np.array([evidence(t.as_py(), saved) for t in batch["text"]])
            x = x.reshape(-1, len(MARGINS))
            z = x @ weights[:-1] + weights[-1]
            values = pa.array(1 / (1 + np.exp(-z)))
            yield batch.select([*carry]).append_column("score", values)

    return rows.mapInArrow(run, carried.add("score", "double"))
