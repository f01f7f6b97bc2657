"""Month shards: one table per department, account, level and month.

    {company}_table_{platform}_{department}_{account}_{level}_m{MM}{YYYY}
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from adloom.schemas import SHARD, STAGED_COLUMNS, TABLES, schema
from adloom.sources.tables import empty, folders

# The name's separator, the parts holding the shard, the month suffix.
SEPARATOR = "_"
DEPARTMENT_PART = 3
ACCOUNT_PART = 4
MONTH_SUFFIX_LENGTH = 6

THREADS = 8
DIFFERENT_TYPES = ("CANNOT_MERGE_SCHEMAS", "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE")


def shard_of(prefix: str, department: Column, account: Column, level: str, day: Column) -> Column:
    """Name of the month shard a row belongs to, null without a date."""
    return F.concat(
        F.lit(prefix), department, F.lit(SEPARATOR), account,
        F.lit(f"{SEPARATOR}{level}{SEPARATOR}m"), F.date_format(day, "MMyyyy"),
    )


def discover_shards(names: list[str], prefix: str, level: str) -> list[str]:
    """Names matching the SQL pattern ``{prefix}%_{level}_m______``, where an underscore
    stands for any one character. Six of them keep ``_ad_metadata`` out."""
    like = f"{prefix}%_{level}_m{'_' * MONTH_SUFFIX_LENGTH}"
    pattern = re.compile("".join({"%": ".*", "_": "."}.get(c, re.escape(c)) for c in like))
    return [name for name in names if pattern.fullmatch(name)]


def department_of(name: Column) -> Column:
    return F.split(name, SEPARATOR)[DEPARTMENT_PART]


def account_of(name: Column) -> Column:
    return F.split(name, SEPARATOR)[ACCOUNT_PART]


def staged_schema(level: str):
    types = {f.name: f.dataType.simpleString() for f in TABLES[f"{level}_insights"].schema}
    return schema(", ".join(f"{name} {types[name]}" for name in STAGED_COLUMNS[level]))


def _staged(facts: DataFrame, name: Column, level: str) -> DataFrame:
    """Staging columns of shard rows; the shard comes out of the table name."""
    return facts.withColumns(
        {"department": department_of(name), "account": account_of(name), "date": F.to_date("date")}
    ).select(*STAGED_COLUMNS[level])


def union_shards(spark: SparkSession, prefix: str, level: str) -> DataFrame:
    """Union of all shard tables and views the catalog lists."""
    names = discover_shards([t.name for t in spark.catalog.listTables()], prefix, level)
    if not names:
        return empty(spark, staged_schema(level))
    return reduce(
        DataFrame.unionByName, (_staged(spark.table(n), F.lit(n), level) for n in sorted(names))
    )


def _stored_schema(spark: SparkSession, paths: list[str]) -> StructType | None:
    """Columns as the footers of all files below have them; none without a file."""
    reader = spark.read.option("recursiveFileLookup", "true").option("mergeSchema", "true")
    try:
        return reader.parquet(*paths).schema
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise


def alike(spark: SparkSession, paths: list[str]) -> list[tuple[StructType, list[str]]]:
    """The paths in groups whose files agree in their column types, with these types.

    Footers are read by Spark, all of a group in one job. Where they disagree the group is
    halved, down to single files.
    """
    try:
        stored = _stored_schema(spark, paths)
    except Py4JJavaError as error:  # Spark's own exceptions of running jobs stay unwrapped
        if not any(f"[{condition}]" in str(error) for condition in DIFFERENT_TYPES):
            raise
        if len(paths) == 1:
            inside = folders(spark, f"{paths[0]}/[!_.]*")
            if not inside or inside == paths:
                raise
            paths = inside  # the same files: they need no second look as a whole
        parts = [paths[: len(paths) // 2], paths[len(paths) // 2 :]]
        return [group for part in parts if part for group in alike(spark, part)]
    return [(stored, paths)] if stored is not None else []


def _shard_parts(spark: SparkSession, shard: str, lo: date | None, hi: date | None) -> list[str]:
    """A shard's day folders of the range, or the shard's own folder where it has none."""
    days = folders(spark, f"{shard}/date=*")
    if not days:
        return [shard]
    first, last = (lo or date.min).isoformat(), (hi or date.max).isoformat()
    return [d for d in days if first <= d.rsplit("=", 1)[1] <= last]


def read_shard_files(
    spark: SparkSession,
    root: str,
    prefix: str,
    level: str,
    lo: date | None = None,
    hi: date | None = None,
) -> DataFrame:
    """All shard folders under a root, in one scan per set of stored column types.

    A union has one plan branch per shard; thousands of account-months are better read as
    one file listing, with the shard taken from the file's path. A shard holds files, or
    day folders ``date=YYYY-MM-DD`` of them; of the latter only days of the range are
    listed. Writers that guess types leave a number whole on one day and not on another,
    so types are taken from the footers and cast to the fixed ones; a column that some
    files lack is null there.
    """
    found = folders(spark, f"{root}/{prefix}*_{level}_m{'?' * MONTH_SUFFIX_LENGTH}")
    fixed = {f.name: f.dataType for f in TABLES[f"{level}_insights"].schema if f.name not in SHARD}
    with ThreadPoolExecutor(THREADS) as threads:
        # only footers and folder names pass here; threads wait for Spark's jobs
        parts = threads.map(lambda shard: _shard_parts(spark, shard, lo, hi), found)
        checked = threads.map(lambda paths: alike(spark, paths) if paths else [], parts)
        groups: dict[tuple, list[str]] = {}
        for stored, paths in (group for shard in checked for group in shard):
            columns = tuple((f.name, f.dataType) for f in sorted(stored, key=lambda f: f.name) if f.name in fixed)
            groups.setdefault(columns, []).extend(paths)
    if not groups:
        return empty(spark, staged_schema(level))

    path = F.col("_metadata.file_path")
    # a pattern that begins with plain text is sought by that text, far fewer steps per row
    rest = F.regexp_extract(path, f"/{re.escape(prefix)}([^/]*_{level}_m[^/]{{{MONTH_SUFFIX_LENGTH}}})/", 1)
    name = F.concat(F.lit(prefix), rest)
    day = F.try_to_date(F.nullif(F.regexp_extract(path, "/date=([^/]+)/", 1), F.lit("")))
    frames = []
    for columns, paths in groups.items():
        stored = StructType([StructField(*column) for column in columns])
        files = spark.read.schema(stored).option("recursiveFileLookup", "true").parquet(*paths)
        values = {c: (F.col(c) if c in stored.names else F.lit(None)).cast(kind) for c, kind in fixed.items()}
        values["date"] = F.coalesce(F.to_date("date"), day) if "date" in stored.names else day
        rows = files.select(name.alias("_shard"), *(value.alias(c) for c, value in values.items()))
        frames.append(_staged(rows, F.col("_shard"), level))
    rows = reduce(DataFrame.unionByName, frames)
    # a file of a shard without day folders may hold any day
    bounds = [F.col("date") >= F.lit(lo)] * (lo is not None) + [F.col("date") <= F.lit(hi)] * (hi is not None)
    return reduce(DataFrame.where, bounds, rows)
