import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"
CHECKED = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def star(spark):
    from ratingloom.sources.star import Star

    return Star(spark, SMALL)


@pytest.fixture
def ratings(spark):
    """Rows (user, item, rating, 'yyyy-MM-dd HH:mm:ss') as a ratings table."""

    def make(rows):
        df = spark.createDataFrame(
            rows, "userId long, movieId long, rating double, timestamp string")
        return df.withColumn("timestamp", df.timestamp.cast("timestamp"))

    return make
