import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyline.session import TUNING  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[8]").appName("tallyline-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
    )
    for name, value in TUNING.items():
        builder = builder.config(name, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Rows and a DDL schema to a DataFrame."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


@pytest.fixture
def evaluate(frame):
    """Value of a Column expression for each given text."""

    def run(expression, values, kind="string"):
        df = frame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
        return [r["y"] for r in df.select("i", expression.alias("y")).orderBy("i").collect()]

    return run
