"""Which ids to ask for, what came back, what is missing."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: how often an id that never answers is asked for.
ATTEMPTS = 3


def distinct_ids(df: DataFrame, *columns: str, keep_null: bool = False) -> DataFrame:
    ids = df.select(*columns)
    return (ids if keep_null else ids.dropna()).distinct()


def fetched(requested: DataFrame, received: DataFrame, on: Sequence[str]) -> DataFrame:
    """Every requested id with what was received for it; one without an answer stays
    as a placeholder whose other columns are null."""
    return requested.join(received, list(on), "left")


def fetched_in_attempts(
    requested: DataFrame, received: DataFrame, on: Sequence[str], attempts: int = ATTEMPTS
) -> DataFrame:
    """All rows of a fetch that asks again for the ids that failed.

    ``received`` has an ``attempt`` column from 1, one row per id and attempt. An id
    first answered in attempt n leaves n-1 placeholders and its answer, however late n
    is; one never answered leaves ``attempts`` placeholders. One join, whatever the attempts.
    Where it also has a ``run`` column, an id takes the answers of its latest run alone.
    """
    on = list(on)
    fields = [c for c in received.columns if c not in (*on, "run", "attempt")]
    if "run" in received.columns:
        latest = F.max(F.struct("run", (-F.col("attempt")).alias("_early"), F.struct("attempt", *fields).alias("_own")))
        answer = received.groupBy(*on).agg(latest["_own"].alias("_answer"))
    else:
        answer = received.groupBy(*on).agg(F.min(F.struct("attempt", *fields)).alias("_answer"))
    tried = requested.join(answer, on, "left").withColumn(
        "attempt",
        F.explode(F.sequence(F.lit(1), F.coalesce("_answer.attempt", F.lit(attempts)))),
    )
    answered = F.col("attempt") == F.col("_answer.attempt")
    return tried.select(
        *on, "attempt", *(F.when(answered, F.col(f"_answer.{c}")).alias(c) for c in fields)
    )


def union_attempts(*frames: DataFrame) -> DataFrame:
    """All attempts one after the other, placeholders included."""
    return reduce(DataFrame.unionByName, frames)


def failed_ids(requested: DataFrame, received: DataFrame, on: Sequence[str]) -> DataFrame:
    """Requested ids without an answer: the next attempt's request."""
    return requested.join(received, list(on), "left_anti")


def coverage(requested: DataFrame, received: DataFrame, on: Sequence[str]) -> DataFrame:
    """One row: distinct ids requested, and how many of them were received."""
    on = list(on)
    got = received.select(*on).distinct().withColumn("_got", F.lit(True))
    return (
        requested.select(*on)
        .distinct()
        .join(got, on, "left")
        .agg(F.count(F.lit(1)).alias("requested"), F.count("_got").alias("received"))
    )


def missing_days(expected: DataFrame, facts: DataFrame, on: Sequence[str]) -> DataFrame:
    """Expected days without facts. They stay as they are: an upsert only touches
    days that have new rows."""
    on = list(on)
    return expected.join(facts.select(*on).distinct(), on, "left_anti")
