import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def micro(spark):
    """Five posts small enough to score by hand."""
    return spark.createDataFrame(
        [
            (1, "ann", "d1", "tech", "Spark runs fast spark"),
            (2, "bob", "d2", "tech", "spark sql engine"),
            (3, "cat", "d3", "food", "bread, fresh bread"),
            (4, "ann", "d4", None, "no flair"),
            (5, "dan", "d5", "tech", "fast bread!"),
        ],
        "id bigint, author string, created string, flair string, text string",
    )


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
