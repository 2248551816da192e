import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "3g").config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse"))).config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false").config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def rows():
    """A frame as a sorted list of tuples, nulls first."""

    def take(df, *cols):
        return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=lambda t: [(x is not None, str(x)) for x in t])

    return take
