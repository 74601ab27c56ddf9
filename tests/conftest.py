import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def texts(spark):
    def build(values, column="text"):
        return spark.createDataFrame([(value,) for value in values], f"{column} string")

    return build


def column(df):
    """Values of a one-column result, sorted, nulls first."""
    return sorted((row[0] for row in df.collect()), key=lambda v: (v is not None, v))


def physical_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
