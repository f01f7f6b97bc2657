"""Measured sizes. Nothing is broadcast on a guess."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A broadcast side larger than this is shuffled instead.
BROADCAST_LIMIT = 64 * 1024 * 1024
ROW_BYTES = 16
FIELD_BYTES = 16


def _size_row(df: DataFrame) -> DataFrame:
    """One row: bytes the rows take in memory, from their count and text lengths."""
    fixed = ROW_BYTES + FIELD_BYTES * len(df.columns)
    text = reduce(
        add,
        (F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in df.columns),
        F.lit(fixed),
    )
    return df.agg(F.coalesce(F.sum(text.cast("bigint")), F.lit(0)).alias("bytes"))


def measured_bytes(*frames: DataFrame) -> list[int]:
    """Sizes of all frames from one job that returns one number per frame."""
    sized = [_size_row(df).select(F.lit(i).alias("i"), "bytes") for i, df in enumerate(frames)]
    rows = reduce(DataFrame.unionAll, sized).collect()
    return [row["bytes"] for row in sorted(rows)]


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Hint a broadcast where the measured size allows it; else leave the join to a
    shuffle, which adaptive execution splits where a key is hot."""
    return F.broadcast(df) if measured_bytes(df)[0] <= limit else df
