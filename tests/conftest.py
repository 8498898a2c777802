import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from simsearch.plans.session import with_settings


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        with_settings(SparkSession.builder)
        .master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def songs(spark):
    """The hand-worked corpus: no stopwords, no stemming."""
    rows = [
        (0, "love love night"), (1, "love song"), (2, "night train"),
        (3, "blue train song"), (4, "train"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string")


def tuples(df):
    return sorted(tuple(row) for row in df.collect())
