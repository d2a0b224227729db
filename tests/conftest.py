import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def rows_of():
    """The rows of a DataFrame as sorted tuples; null first."""

    def sort_key(row):
        return tuple((x is not None, str(type(x)), x if not isinstance(x, (list, dict)) else str(x)) for x in row)

    return lambda df: sorted((tuple(r) for r in df.collect()), key=sort_key)
