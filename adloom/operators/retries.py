"""A queue of ids whose fetch failed, kept from run to run.

One row per id: how often it failed, the class of its last failure and when it may be asked
for again. Retryable failures wait longer each time; others are never asked for again by
themselves. A run's requests are derived from the queue, and the queue after it from what
the run was told; both are joins on the ids, so no list of them passes through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RETRYABLE = "retryable"
# Seconds before the second attempt, and how many more before each later one.
FIRST_WAIT = 60
MORE_WAIT = 30

FIELDS = "attempts int, class string, next_try timestamp"


def due(queue: DataFrame, wanted: DataFrame, at: datetime, on: Sequence[str]) -> DataFrame:
    """What a run at this time asks for: wanted ids that are not queued, and queued ones
    whose failure may pass and whose time has come, wanted again or not."""
    on = list(on)
    fresh = wanted.select(*on).dropna().distinct().join(queue.select(*on), on, "left_anti")
    ready = queue.where((F.col("class") == RETRYABLE) & (F.col("next_try") <= F.lit(at)))
    return fresh.unionByName(ready.select(*on))


def queue_after(
    queue: DataFrame,
    requested: DataFrame,
    received: DataFrame,
    failures: DataFrame,
    at: datetime,
    on: Sequence[str],
) -> DataFrame:
    """The queue after a run that asked for ``requested`` (distinct ids) and received
    answers for some. ``failures`` have a ``class``; of several for an id one that is not
    retryable counts, and an id that nothing was said about may be asked for again. An id
    that is answered leaves the queue."""
    on = list(on)
    lost = requested.join(received.select(*on).distinct(), on, "left_anti")
    hopeless = F.max(F.when(F.col("class") != RETRYABLE, F.col("class")))
    told = failures.groupBy(*on).agg(hopeless.alias("_told"))
    before = queue.select(*on, F.col("attempts").alias("_before"))
    attempts = (F.coalesce("_before", F.lit(0)) + 1).cast("int")
    kind = F.coalesce("_told", F.lit(RETRYABLE))
    wait = F.lit(FIRST_WAIT) + F.lit(MORE_WAIT) * (attempts - 1)
    failed = (
        lost.join(told, on, "left")
        .join(before, on, "left")
        .select(
            *on,
            attempts.alias("attempts"),
            kind.alias("class"),
            F.when(kind == RETRYABLE, F.timestamp_add("SECOND", wait, F.lit(at))).alias("next_try"),
        )
    )
    return queue.join(requested.select(*on), on, "left_anti").select(*failed.columns).unionByName(failed)
