"""Document fingerprints as threshold-scaled sketches, in SQL expressions only.

Every shingle of five words is hashed to 64 bits, and every hash below a fixed fraction of
the range is kept, so a sketch grows with its document and two sketches of very unequal
documents can be compared: the share of one's hashes that the other has estimates its
containment. A text with words but no hash below the limit keeps its smallest one, which
tells texts apart but says nothing of containment: that is null then. Sketches of parts
merge to the sketch of the whole (up to shingles that span the parts).

Words are in lower case, parted by ASCII white space; a shorter text is one shingle. A null
text is empty and has an empty sketch; two empty sketches are alike (1), one is like no
other (0). Equal texts have equal fingerprints. An empty table gives no rows; other columns
are ignored. Rows that repeat a ``doc_id`` follow one another in the order of their texts;
rows without one have no next document, and their edited text only loses its end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adloom.llm.common import running_total, staged
from adloom.operators.sizes import broadcast_if_small

SHINGLE_WORDS = 5
FRACTION = 4  # one hash in so many is kept
_LIMIT = -(1 << 63) + (1 << 64) // FRACTION  # hashes are signed
_SPACE = " \t\n\x0b\f\r"
BUCKET_ROWS = 512  # neighbours that meet in one window
UNEVEN = 8  # times as many before ranges are cut by rank, not by the width of ids


def word_hashes(text: Column) -> Column:
    trimmed = F.btrim(F.lower(text), F.lit(_SPACE))
    words = F.split(trimmed, r"[\x20\x09-\x0D]+")
    return F.when(trimmed == "", F.array().cast("array<bigint>")).otherwise(
        F.transform(words, lambda w: F.xxhash64(w))
    )


def shingle_hashes(words: Column) -> Column:
    """Hashes of all shingles, from a column of word hashes."""
    size = F.size(words)
    full = F.transform(
        F.slice(words, F.lit(1), F.greatest(size - (SHINGLE_WORDS - 1), F.lit(0))),
        lambda w, i: F.xxhash64(w, *(F.get(words, i + k) for k in range(1, SHINGLE_WORDS))),
    )
    short = F.when(size == 0, F.array().cast("array<bigint>")).otherwise(F.array(F.xxhash64(words)))
    return F.when(size < SHINGLE_WORDS, short).otherwise(full)


def kept_hashes(shingles: Column) -> Column:
    """The sketch, in order: hashes below the limit, or the smallest one where none is."""
    low = F.filter(shingles, lambda h: h < _LIMIT)
    some = F.when(
        (F.size(low) == 0) & (F.size(shingles) > 0), F.array(F.array_min(shingles))
    ).otherwise(low)
    return F.array_sort(F.array_distinct(some))


def with_sketch(rows: DataFrame, text: str, name: str) -> DataFrame:
    """Add a text column's sketch. Each step is a column of its own, so that no array is
    computed again for each of its elements."""
    return (
        rows.withColumn("_words", word_hashes(F.col(text)))
        .withColumn("_shingles", shingle_hashes(F.col("_words")))
        .withColumn(name, kept_hashes(F.col("_shingles")))
        .drop("_words", "_shingles")
    )


def merged(a: Column, b: Column) -> Column:
    """Sketch of both texts together."""
    return kept_hashes(F.array_union(a, b))


def likeness(a: Column, b: Column) -> Column:
    """Share of the hashes of both that both have."""
    both, either = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def containment(part: Column, whole: Column) -> Column:
    """Share of ``part``'s hashes below the limit that ``whole`` has: 1 for a part without
    words, null (unknown) where its sketch has no hash below the limit."""
    low = F.filter(part, lambda h: h < _LIMIT)
    share = F.when(F.size(low) > 0, F.size(F.array_intersect(low, whole)) / F.size(low))
    return F.when(F.size(part) == 0, F.lit(1.0)).otherwise(share)


def as_text(sketch: Column) -> Column:
    """Sixteen hexadecimal digits a hash."""
    return F.concat_ws("", F.transform(sketch, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))))


def _in_ranges(known: DataFrame, bucket_rows: int) -> DataFrame:
    """Rows with the ``bucket`` of their id: ranges of one width, or, where ids lie so
    unevenly that one range would be crowded, of as many rows."""
    lo, hi, n = known.agg(F.min("doc_id"), F.max("doc_id"), F.count(F.lit(1))).first()
    width = max(1, (hi - lo + 1) * bucket_rows // n) if n else 1
    even = F.expr(f"doc_id div {width}")
    most = known.groupBy(even).count().agg(F.max("count")).first()[0] or 0
    if most <= UNEVEN * bucket_rows:
        return known.withColumn("bucket", even)
    ids = known.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_rows"))
    ranked = running_total(ids, [F.col("doc_id")], F.col("_rows"))
    ranges = staged(ranked.select("doc_id", F.expr(f"before div {bucket_rows}").alias("bucket")), "id-ranges")
    return known.join(ranges, "doc_id")


def with_next(docs: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(doc_id, text, sketch) with ``next_text`` and ``next_sketch`` of the next document by
    descending doc_id, the first one for the last.

    Ids are cut into ranges of about ``bucket_rows`` documents, so texts are shuffled once
    (twice where ids lie very unevenly) and sorted in small windows. A range's first document
    is also sent to the range before it, whose last document it follows.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    known = _in_ranges(rows.where(F.col("doc_id").isNotNull()), bucket_rows)
    firsts = known.groupBy("bucket").agg(F.max("doc_id").alias("doc_id"))
    placed = staged(running_total(firsts, [F.col("bucket")]), "first-of-range")
    above = placed.select(F.col("bucket").alias("bucket"), F.col("before").alias("_place"))
    heads = staged(
        placed.select("doc_id", F.expr("(before + 1) % total").alias("_place"))
        .join(above, "_place")
        .select("doc_id", F.col("bucket").alias("_before")),
        "range-heads",
    )
    # without an id: any even spread, no neighbour
    spread = F.pmod(F.xxhash64("text"), F.lit(1 << 20))
    lone = rows.where(F.col("doc_id").isNull()).select("doc_id", "text", spread.alias("bucket"))
    real = known.select("doc_id", "text", "bucket").unionAll(lone).withColumn("real", F.lit(True))
    sent = known.join(broadcast_if_small(heads), "doc_id").select(
        "doc_id", "text", F.col("_before").alias("bucket"), F.lit(False).alias("real")
    )
    marked = with_sketch(real.unionAll(sent), "text", "sketch")
    unknown = F.col("doc_id").isNull()
    following = Window.partitionBy(unknown, "bucket").orderBy(
        F.desc("real"), F.desc("doc_id"), "text"
    )
    return (
        marked.select(
            "doc_id",
            "text",
            "sketch",
            "real",
            F.lead("text").over(following).alias("next_text"),
            F.lead("sketch").over(following).alias("next_sketch"),
        )
        .where("real")
        .select(
            "doc_id",
            "text",
            "sketch",
            F.when(unknown, F.lit("")).otherwise(F.col("next_text")).alias("next_text"),
            F.when(unknown, F.array().cast("array<bigint>"))
            .otherwise(F.col("next_sketch"))
            .alias("next_sketch"),
        )
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per document its sketch and that of its edited text, whose last third is replaced by
    the beginning of the next document, and how alike it is to either."""
    third = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - third).cast("int")),
        F.substring(F.col("next_text"), F.lit(1), third),
    )
    rows = (
        with_next(docs)
        .withColumn("n_chars", F.char_length("text").cast("bigint"))
        .withColumn("edited", edited)
    )
    return with_sketch(rows, "edited", "edited_sketch").select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )
