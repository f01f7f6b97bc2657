import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from adloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            # thousands of day folders in a few megabytes: let every core write and list some
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16KB",
            "spark.sql.sources.parallelPartitionDiscovery.parallelism": "16",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("work")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples, by name order of its columns."""

    def collect(df, *columns):
        columns = columns or sorted(df.columns)
        return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)

    return collect
