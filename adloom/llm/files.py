"""Files that tasks write to and read from the shared folder, and files given to executors.

A task writes under a name no other attempt uses and returns that name as a row. Spark
commits only the rows of attempts that succeed, so a lost executor or a repeated attempt
leaves at most a file that no row names.
"""

from __future__ import annotations

import uuid

import pyarrow.fs as pafs
from pyspark import SparkFiles
from pyspark.sql import SparkSession


def _resolve(uri: str):
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def folder(uri: str) -> str:
    """Create a folder and give it back."""
    fs, path = _resolve(uri)
    fs.create_dir(path, recursive=True)
    return uri


def attempt_name(prefix: str, suffix: str) -> str:
    return f"{prefix}-{uuid.uuid4().hex}{suffix}"


def open_output(uri: str):
    fs, path = _resolve(uri)
    return fs.open_output_stream(path, compression=None)


def open_input(uri: str):
    fs, path = _resolve(uri)
    return fs.open_input_file(path)


def delete_file(uri: str) -> None:
    fs, path = _resolve(uri)
    fs.delete_file(path)


def give_to_executors(spark: SparkSession, uri: str) -> str:
    """Let every executor, also one that joins later, fetch a file to its own disk once.
    Returns the name ``local_file`` finds it by."""
    spark.sparkContext.addFile(uri)
    return uri.rsplit("/", 1)[1]


def local_file(name: str) -> str:
    return SparkFiles.get(name)
