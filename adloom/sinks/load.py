"""Loading tables: append, and upsert on plain Parquet.

Tables are folders partitioned by shard (and by date, for facts). An upsert
replaces whole partitions with dynamic partition overwrite: new files are written
aside and moved in when the job commits, so a failed or repeated task leaves no
half-written rows. Delete and append are one commit per partition, but two tables
are not changed together.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from adloom.operators.sizes import broadcast_if_small
from adloom.operators.upsert import key_set, matching_count, upsert
from adloom.schemas import TABLES, Table, require_columns
from adloom.session import work_folder
from adloom.sinks.catalog import add_partitions, ensure_table
from adloom.sources.tables import delete_folder, put_in_place, read_path, table_exists

MODES = ("insert", "upsert")
CODEC = {"compression": "zstd"}


@dataclass(frozen=True)
class Audit:
    """What one load did."""

    table: str
    mode: str
    rows_in: int = 0
    rows_deleted: int = 0
    rows_written: int = 0


def stage(
    df: DataFrame, purpose: str = "stage", partition: Sequence[str] = (), path: str | None = None
) -> DataFrame:
    """Write rows once to the shared work folder, or to ``path``, and read them back: later
    steps do not recompute them, and a lost executor costs one read of the staged files.
    With ``partition`` they lie gathered in folders, so that a step that needs some of
    these reads no others, and shuffles no rows to gather them again."""
    path = path or work_folder(df.sparkSession, purpose)
    if partition:
        laid_out(df, partition, ()).write.partitionBy(*partition).options(**CODEC).parquet(path)
    else:
        df.write.options(**CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staged_for(df: DataFrame, purpose: str) -> Iterator[DataFrame]:
    """Rows staged for some steps alone, and deleted once these are through."""
    path = work_folder(df.sparkSession, purpose)
    try:
        yield stage(df, path=path)
    finally:
        delete_folder(df.sparkSession, path)


def laid_out(df: DataFrame, partition: Sequence[str], cluster: Sequence[str]) -> DataFrame:
    """Rows gathered by partition and sorted by cluster columns inside it.

    Rebalancing rather than repartitioning: adaptive execution splits a partition
    that holds much of the table over several tasks and joins small ones.
    """
    gathered = df.hint("rebalance", *partition)
    order = [*partition, *cluster]
    return gathered.sortWithinPartitions(*order) if order else gathered


def _lookup_options(cluster: Sequence[str]) -> dict[str, str]:
    """Bloom filters on the cluster columns. A partition split over several files has all
    ids' range in each, so that least and greatest values alone skip none of them. Filters
    take the size, from half a kilobyte to a megabyte, that a file's ids need; a column
    stored by its dictionary gets none, as readers ask the dictionary."""
    if not cluster:
        return {}
    sized = {"parquet.bloom.filter.adaptive.enabled": "true", "parquet.bloom.filter.candidates.number": "12"}
    return {**sized, **{f"parquet.bloom.filter.enabled#{name}": "true" for name in cluster}}


def write(
    df: DataFrame,
    path: str,
    mode: str,
    partition: Sequence[str] = (),
    cluster: Sequence[str] = (),
) -> int:
    """Write and return the rows written, counted by the write itself.

    ``mode`` is 'append', 'overwrite' (the whole table) or 'replace' (only the
    partitions that have rows).
    """
    counted = Observation("rows")
    rows = laid_out(df, partition, cluster)
    writer = rows.observe(counted, F.count(F.lit(1)).alias("n")).write
    if mode == "replace":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode(mode).option("partitionOverwriteMode", "static")
    if partition:
        writer = writer.partitionBy(*partition)
    writer.options(**CODEC, **_lookup_options(cluster)).parquet(path)
    df.sparkSession.catalog.refreshByPath(path)
    return counted.get["n"]


def load(
    df: DataFrame,
    path: str,
    mode: str,
    keys: Sequence[str] | None = None,
    partition: Sequence[str] = (),
    cluster: Sequence[str] = (),
    shard: Sequence[str] = (),
    table: str | None = None,
) -> Audit:
    """Append ``df`` to the table at ``path`` after deleting the rows it replaces.

    'insert' deletes nothing. 'upsert' deletes the rows that share the new rows'
    ``keys`` within the same ``shard``. The table is created by its first load. An
    empty ``df`` changes nothing. ``df`` is read more than once; pass a staged one if it
    is costly. With ``table``, a name in the catalog, old rows are found by its
    partitions, and the partitions written are added to it.

    Rows are counted on their way in and on their way to the files; the load fails where
    the two disagree.
    """
    spark = df.sparkSession
    if mode not in MODES:
        raise ValueError(f"unsupported mode {mode!r}; use one of {', '.join(MODES)}")
    exists = table_exists(spark, path)
    if mode == "upsert" and exists:
        if not keys:
            raise ValueError("an upsert into an existing table needs keys")
        require_columns(df, *shard, *keys)
    require_columns(df, *partition, *cluster)

    rows_in = df.count()
    if not rows_in:
        return Audit(path, mode)
    deleted = kept = 0
    if mode == "insert" or not exists:
        written = write(df, path, "append", partition, cluster)
    else:
        scope = [*shard, *(k for k in keys if k not in shard)]
        target = spark.table(table) if table else read_path(spark, path, df.schema)
        by_partition = bool(partition) and set(partition) <= set(scope)
        if by_partition:
            target = _near(target, df, partition)
        deleted = matching_count(target, df, scope).first()["matched"]
        if set(scope) == set(partition):
            written = _replace_partitions(df, path, scope, partition, cluster)
        elif by_partition:
            written, there = _rewrite_partitions(df, target, path, scope, partition, cluster)
            kept = there - deleted
        else:
            written, there = _rewrite_table(df, target, path, scope, partition, cluster)
            kept = there - deleted
    if written != rows_in + kept:
        raise RuntimeError(f"{path}: {rows_in} rows in and {kept} kept, but {written} written")
    if table and partition:
        add_partitions(spark, table, df, partition)
    return Audit(path, mode, rows_in=rows_in, rows_deleted=deleted, rows_written=written - kept)


def _near(target: DataFrame, df: DataFrame, partition: Sequence[str]) -> DataFrame:
    """Target rows within the new rows' bounds of every partition column, those without a
    value only where the new rows have such. Of a table in the catalog only the folders
    of these partitions are listed and opened; a path is listed whole first."""
    wanted = [agg for c in partition for agg in (F.min(c), F.max(c), F.count_if(F.col(c).isNull()))]
    bounds = list(df.agg(*wanted).first())
    near = []
    for at, c in enumerate(partition):
        low, high, loose = bounds[3 * at : 3 * at + 3]
        within = F.col(c) == F.lit(low) if low == high else F.col(c).between(F.lit(low), F.lit(high))
        if low is None:
            within = F.col(c).isNull()
        elif loose:
            within = F.col(c).isNull() | within
        near.append(within)
    return target.where(reduce(and_, near))


def _null_in(columns: Sequence[str]):
    return reduce(or_, (F.col(c).isNull() for c in columns))


def _replace_partitions(df, path, scope, partition, cluster) -> int:
    """The key is the partition: the target is not read at all. Rows with a null key
    would replace the null partition, so they are appended on their own."""
    keyed = write(df.where(~_null_in(scope)), path, "replace", partition, cluster)
    loose = df.where(_null_in(scope))
    if loose.isEmpty():
        return keyed
    return keyed + write(loose, path, "append", partition, cluster)


def _rewrite_partitions(df, target, path, scope, partition, cluster) -> tuple[int, int]:
    """The partition is part of the key: only the partitions the new rows fall in are
    read and rewritten. Spark allows that for a dynamic overwrite, which moves the old
    files away only at commit. Returns rows written and rows there were."""
    touched = broadcast_if_small(df.select(*partition).distinct())
    same = reduce(and_, (target[c].eqNullSafe(touched[c]) for c in partition))
    old = target.join(touched, same, "left_semi")
    there = old.count()
    return write(upsert(old, df, scope), path, "replace", partition, cluster), there


def _rewrite_table(df, target, path, scope, partition, cluster) -> tuple[int, int]:
    """A key may be anywhere: the whole result is written beside the table, then put in
    its place. A write that fails leaves the table as it was."""
    there = target.count()
    return write_aside(upsert(target, df, scope), path, partition, cluster), there


def write_in_steps(
    df: DataFrame,
    path: str,
    partition: Sequence[str],
    cluster: Sequence[str],
    steps: Sequence[Column],
) -> int:
    """Append rows by steps, each of the rows that meet its condition; without any, at once.
    Shuffle files of a step go before the next one."""
    parts = [df.where(step) for step in steps] or [df]
    return sum(write(part, path, "append", partition, cluster) for part in parts)


def write_aside(
    df: DataFrame,
    path: str,
    partition: Sequence[str] = (),
    cluster: Sequence[str] = (),
    steps: Sequence[Column] = (),
) -> int:
    """Write a whole table beside ``path`` and put it in its place once it is whole."""
    new = f"{path.rstrip('/')}_next-{uuid.uuid4().hex}"
    try:
        written = write_in_steps(df, new, partition, cluster, steps)
    except Exception:
        delete_folder(df.sparkSession, new)
        raise
    put_in_place(df.sparkSession, new, path)
    return written


def load_table(
    df: DataFrame, warehouse: str, name: str, mode: str = "upsert", database: str | None = None
) -> Audit:
    """Load one of the known tables with its own schema, keys and layout. With
    ``database`` the table is created there if absent, and its partitions are kept."""
    table: Table = TABLES[name]
    full_name = None
    if database:
        full_name = ensure_table(
            df.sparkSession, database, warehouse, name, table.schema, table.partition
        )
    return load(
        df.to(table.schema),
        f"{warehouse}/{name}",
        mode,
        keys=table.keys,
        partition=table.partition,
        cluster=table.cluster,
        shard=table.shard,
        table=full_name,
    )


def register_tables(spark: SparkSession, warehouse: str, database: str) -> list[str]:
    """Make tables loaded by path readable by name: database and tables are created if
    absent. Returns the names of those that hold something."""
    registered = []
    for name, table in TABLES.items():
        if table_exists(spark, f"{warehouse}/{name}"):
            full_name = ensure_table(spark, database, warehouse, name, table.schema, table.partition)
            spark.sql(f"alter table {full_name} recover partitions")
            registered.append(name)
    return registered
