"""Training-corpus pipeline: from raw documents to packed token sequences.

Every stage takes what the one before kept, as Parquet reread, and all but the last return
the columns of documents, others that came with them included. Extra columns never clash
with the stages' own: they travel under names of their own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.llm.common import staged, table
from adloom.llm.decontamination import with_leaks
from adloom.llm.packing import pack_documents
from adloom.llm.queries import tokenizer
from adloom.llm.secrets import find_secrets, redacted
from adloom.llm.simhash import without_near_duplicates
from adloom.llm.toxicity import fit, score

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
REJECTED_FROM = 0.5

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _own_names(stage: Stage) -> Stage:
    """Give extra columns plain numbered names inside a stage, and their own names back."""

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = docs.columns
        inside = [n if n in COLUMNS else f"_extra{i}" for i, n in enumerate(names)]
        return stage(spark, docs.toDF(*inside), sf_dir).select(*inside).toDF(*names)

    return run


@_own_names
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression distance scores as toxic go."""
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model, docs.columns).where(F.col("score") < REJECTED_FROM)


@_own_names
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that with the smallest doc_id. Near
    are the fingerprints that the SimHash operator links, by its own shingles and bits."""
    return without_near_duplicates(docs, shingles=False)


@_own_names
def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, in whatever order, go."""
    benchmark = table(spark, sf_dir, "benchmark")
    return with_leaks(docs, benchmark, carry=docs.columns).where(F.size("leaks") == 0)


@_own_names
def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are replaced by a mark; documents stay, ``n_chars`` follows."""
    found = find_secrets(docs, docs.columns)
    some = F.size("spans") > 0
    clean = redacted(F.col("text"), F.col("spans"))
    return found.withColumn("text", clean).withColumn(
        "n_chars",
        F.when(some, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(
            F.col("n_chars")
        ),
    )


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, placed in sequences."""
    return pack_documents(docs, *tokenizer())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaked),
    ("secrets", redact_secrets),
    ("packing", pack),
]

# Models, fingerprints and tokens cannot be expressed in SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
