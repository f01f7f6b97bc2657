"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adloom.session import work_folder

_PART_BITS = 33  # monotonically_increasing_id keeps the partition above these bits


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Write rows once to the shared folder and read them back, so that nothing is
    computed twice and a lost executor costs one read."""
    path = work_folder(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def running_total(df: DataFrame, order: Sequence[Column], weight: Column | None = None) -> DataFrame:
    """Rows with ``before``: the weights (rows, where none is given) of all rows that
    come earlier in the global order, and ``total``, the weights of all rows.

    Rows are range-partitioned and sorted; only one sum per partition meets in one
    task. Rows that tie in ``order`` come in any order, the same for all readers.
    """
    one = F.lit(1).cast("bigint") if weight is None else weight.cast("bigint")
    rows = staged(
        df.withColumn("_weight", one)
        .repartitionByRange(shuffle_partitions(df.sparkSession), *order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_at", _PART_BITS)),
        "ordered",
    )
    sums = rows.groupBy("_part").agg(F.sum("_weight").alias("_sum"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = sums.select(
        "_part",
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"),
        F.sum("_sum").over(whole).alias("total"),
    )
    placed = rows.join(F.broadcast(starts), "_part")  # one row per shuffle partition
    if weight is None:
        inside = F.col("_at") - F.shiftleft(F.col("_part"), _PART_BITS)
    else:
        inside = F.coalesce(
            F.sum("_weight").over(
                Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        )
    return placed.withColumn("before", F.col("_start") + inside).drop(
        "_weight", "_at", "_part", "_start"
    )
