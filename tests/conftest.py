import json
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def lines(spark):
    """Bronze rows of some resources given as dicts."""

    def make(*resources):
        rows = [(r.get("resourceType"), r.get("id"), json.dumps(r)) for r in resources]
        return spark.createDataFrame(rows, "resource_type STRING, id STRING, value STRING")

    return make


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of tuples."""

    def collect(df, *columns):
        data = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in data.collect()), key=repr)

    return collect
