"""Parquet tables under a warehouse folder, read with their fixed schema."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from adloom.schemas import TABLES


def is_missing_path(error: Exception) -> bool:
    return isinstance(error, AnalysisException) and error.getCondition() == "PATH_NOT_FOUND"


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, full schema."""
    return spark.createDataFrame([], schema)


def table_exists(spark: SparkSession, path: str) -> bool:
    """One look at the folder; reading it would list every partition."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, by the names of their own level alone: what lies
    below them is not listed."""
    found = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    matching = found.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(found)
    return sorted(status.getPath().toString() for status in matching or [])


def delete_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def put_in_place(spark: SparkSession, new: str, live: str) -> None:
    """Let a folder that is whole take the place of another by two renames; the other is
    put back where the second one fails."""
    Path = spark._jvm.org.apache.hadoop.fs.Path
    fs = Path(live).getFileSystem(spark._jsc.hadoopConfiguration())
    old = f"{new}-old"
    if fs.exists(Path(live)) and not fs.rename(Path(live), Path(old)):
        raise OSError(f"could not move {live} away")
    if not fs.rename(Path(new), Path(live)):
        fs.rename(Path(old), Path(live))
        raise OSError(f"could not move {new} to {live}")
    fs.delete(Path(old), True)
    spark.catalog.refreshByPath(live)


def read_path(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at a path, or no rows of its schema where nothing was loaded yet."""
    if not table_exists(spark, path):
        return empty(spark, schema)
    return spark.read.schema(schema).parquet(path)


def read_table(
    spark: SparkSession, warehouse: str, name: str, database: str | None = None
) -> DataFrame:
    """One of the known tables, by name where the catalog has it."""
    if database and spark.catalog.tableExists(f"{database}.{name}"):
        return spark.table(f"`{database}`.`{name}`")
    return read_path(spark, f"{warehouse}/{name}", TABLES[name].schema)
