"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # rows gathered by a part of the keys of a join are not shuffled for it again
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # shuffle files go once the job that wrote them has ended, not when the driver next
    # collects its garbage; a frame that is run again makes them anew
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


# Read when the application starts: pipelines that run at once share the cluster evenly.
START_SETTINGS = {"spark.scheduler.mode": "FAIR"}

# For tables of many terabytes. Adaptive execution joins shuffle partitions but never
# makes more than it starts with, so it starts with many; about 128 MB go to a task.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.files.maxPartitionBytes": "256MB",
}


def configure(spark: SparkSession, **options: str) -> SparkSession:
    """Apply the settings, and any others, to a session that already runs."""
    for key, value in {**SETTINGS, **options}.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "adloom", master: str | None = None, **options: str) -> SparkSession:
    """A session with the settings above; without a local master, also the cluster's."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    cluster = {} if (master or "").startswith("local") else CLUSTER_SETTINGS
    for key, value in {**SETTINGS, **START_SETTINGS, **cluster, **options}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new path under the shared folder the cluster names in
    ``spark.checkpoint.dir``; a temporary one only where a local session names none."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="adloom-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/adloom/{purpose}-{uuid.uuid4().hex}"
