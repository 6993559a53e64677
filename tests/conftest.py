import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", f"{shared}/scratch")
        .config("spark.sql.warehouse.dir", f"{shared}/warehouse")
        .config("spark.sql.maxMetadataStringLength", "4000")
        # Ids of executions are their number only while none is forgotten.
        .config("spark.sql.ui.retainedExecutions", "100000")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Value of a column expression over one row."""

    def run(expression):
        return spark.range(1).select(expression.alias("x")).first()["x"]

    return run


@pytest.fixture
def mapped(spark):
    """Values of a function of a column over a list of texts, in order."""

    def run(texts, function):
        rows = [(i, text) for i, text in enumerate(texts)]
        df = spark.createDataFrame(rows, "i int, c string")
        values = df.select("i", function(df["c"]).alias("x"))
        return [row["x"] for row in values.orderBy("i").collect()]

    return run


def plan_of(df):
    """The physical plan as text."""
    return df._jdf.queryExecution().toString()


@pytest.fixture
def plan():
    return plan_of
