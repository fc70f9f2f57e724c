import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from tillrecon.session import with_settings  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("tillrecon-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    session = with_settings(builder).getOrCreate()
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def value(spark):
    """Values of an expression over a list of texts."""

    def evaluate(expression, *texts):
        from pyspark.sql import functions as F

        rows = [(i, t) for i, t in enumerate(texts)]
        df = spark.createDataFrame(rows, "i int, x string").select("i", expression(F.col("x")).alias("y"))
        return [r["y"] for r in sorted(df.collect(), key=lambda r: r["i"])]

    return evaluate
