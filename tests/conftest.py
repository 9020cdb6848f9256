import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__  # noqa: E402, F401
from switchback.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def values(spark):
    """Evaluates a column expression over a list of inputs."""
    from pyspark.sql import functions as F

    def run(build, inputs, kind="string"):
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, c {kind}")
        return [r["x"] for r in rows.select("i", build(F.col("c")).alias("x")).orderBy("i").collect()]

    return run
