"""Shards cut from a Hilbert curve over document metadata.

Language, source and size are each quantised to equal-frequency bins, a cell's place on
the Hilbert curve orders the documents, and runs of equal row counts become shards. Files
written from them hold narrow ranges of all dimensions at once, so a filter on any of
them skips most files by their statistics.

Nulls form the lowest bin of their dimension; a null text is empty. Equal rows are all
kept and placed next to each other. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.llm.common import running_total, staged

ROW_OVERHEAD = 16  # bytes counted for a row besides its text
DIMENSIONS = ("lang", "source", "size")
BITS = 4  # bins per dimension: 2 ** BITS


def hilbert_index(cell: tuple[int, ...], bits: int) -> int:
    """Place of a cell on the Hilbert curve through a cube of 2**bits a side: undo the
    rotations of each level from the top, then read the Gray-coded bits across."""
    x = list(cell)
    n = len(x)
    level = 1 << (bits - 1)
    while level > 1:
        low = level - 1
        for i in range(n):
            if x[i] & level:
                x[0] ^= low
            else:
                swap = (x[0] ^ x[i]) & low
                x[0] ^= swap
                x[i] ^= swap
        level >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = 0
    for b in range(bits - 1, 0, -1):
        if x[-1] >> b & 1:
            flip ^= (1 << b) - 1
    x = [v ^ flip for v in x]
    return sum(
        (x[i] >> b & 1) << (b * n + n - 1 - i) for b in range(bits) for i in range(n)
    )


def curve(dimensions: int, bits: int) -> list[int]:
    """Curve places of all cells; a cell's number has its first coordinate on top."""
    side = 1 << bits
    cells = range(side**dimensions)
    shifts = [bits * (dimensions - 1 - d) for d in range(dimensions)]
    return [hilbert_index(tuple(c >> s & side - 1 for s in shifts), bits) for c in cells]


def _sortable(df: DataFrame, name: str) -> Column:
    """A value as text that sorts like the value; numbers are padded."""
    if dict(df.dtypes)[name] == "string":
        return F.col(name)
    return F.lpad(F.col(name).cast("string"), 20, "0")


def bin_edges(rows: DataFrame, names: tuple[str, ...], bits: int) -> dict[str, list]:
    """Per dimension at most 2**bits pairs (smallest value, bin), by frequency over all
    rows. Values are counted before they are ordered, so a frequent one is a single row."""
    pairs = F.array(
        *(F.struct(F.lit(n).alias("name"), _sortable(rows, n).alias("value")) for n in names)
    )
    counts = (
        rows.select(F.explode(pairs).alias("_p")).select("_p.*").dropna().groupBy("name", "value").count()
    )
    ordered = running_total(counts, [F.col("name"), F.col("value")], F.col("count"))
    own = ordered.groupBy("name").agg(F.min("before").alias("first"), F.sum("count").alias("all"))
    edges = (
        ordered.join(F.broadcast(own), "name")  # one row per dimension
        .withColumn("bin", F.floor((F.col("before") - F.col("first")) * (1 << bits) / F.col("all")))
        .groupBy("name", "bin")
        .agg(F.min("value").alias("value"))
        .orderBy("name", "value")
        .collect()
    )
    return {n: [(e["value"], e["bin"]) for e in edges if e["name"] == n] for n in names}


def _bin(value: Column, edges: list[tuple[str, int]]) -> Column:
    """Bin of the last edge at or below a value; the lowest bin for nulls."""
    if not edges:
        return F.lit(0)
    starts = F.array(*(F.lit(v) for v, _ in edges))
    bins = F.array(*(F.lit(int(b)) for _, b in edges))
    reached = F.size(F.filter(starts, lambda s: s <= value))
    return F.coalesce(F.try_element_at(bins, F.nullif(reached, F.lit(0))), F.lit(0))


def with_curve(rows: DataFrame, names: tuple[str, ...] = DIMENSIONS, bits: int = BITS) -> DataFrame:
    """Add ``curve``, the Hilbert place of a row's quantised dimensions."""
    edges = bin_edges(rows, names, bits)
    cell = F.lit(0)
    for n in names:
        cell = cell * (1 << bits) + _bin(_sortable(rows, n), edges[n])
    places = rows.sparkSession.createDataFrame(
        list(enumerate(curve(len(names), bits))), "_cell int, curve int"
    )
    # 2 ** (bits * dimensions) rows, whatever the input
    return rows.withColumn("_cell", cell.cast("int")).join(F.broadcast(places), "_cell").drop("_cell")


def assign_shards(docs: DataFrame, shards: int, bits: int = BITS) -> DataFrame:
    """One row per document: its size, checksum, place on the curve, shard and slot.

    Shards are runs along the curve whose row counts differ by at most one; slots count
    from 0 along the run. Equal texts of equal metadata lie side by side.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    narrow = staged(
        docs.select(
            "doc_id",
            "lang",
            "source",
            (F.octet_length(text).cast("bigint") + ROW_OVERHEAD).alias("size"),
            F.crc32(text).alias("text_crc32"),
        ),
        "shard-rows",
    )
    order = [F.col(c) for c in ("curve", "text_crc32", "size", "doc_id")]
    placed = running_total(with_curve(narrow, DIMENSIONS, bits), order)
    # whole-number division both ways, exact for any count
    return placed.withColumn("shard", F.expr(f"(before * {shards}) div total")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.expr(f"before - (shard * total + {shards - 1}) div {shards}").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
        "lang",
        "source",
    )


def write_shards(docs: DataFrame, assigned: DataFrame, path: str) -> None:
    """Write whole documents, a folder per shard and sorted along the curve in each file.
    ``doc_id`` must be unique here."""
    places = assigned.select("doc_id", "shard", "slot")
    rows = docs.drop("shard", "slot").join(places, "doc_id")
    rows.hint("rebalance", "shard").sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).parquet(path)
