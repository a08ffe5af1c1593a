import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("townsquare-tests")
        .config("spark.sql.shuffle.partitions", "8")
        # Small tables would be merged into one partition; the tests want several.
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="townsquare-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def twitter(spark):
    return spark.createDataFrame(
        [
            ("tw1", "2022-05-01", "This solar roof is great!", "mia", 1300, 12, 31, "twitter"),
            ("tw2", "2022-05-02", "Wind farms keep growing", "noor", 4100, 45, 92, "twitter"),
            ("tw3", "2022-05-03", "Grid news today", "ola", 260, 3, 4, "twitter"),
        ],
        "id string, created_at string, text string, user_id string, user_followers_count long, "
        "retweet_count long, favorite_count long, data_source string",
    )


@pytest.fixture
def reddit(spark):
    return spark.createDataFrame(
        [
            ("rd1", "2022-05-01 10:00:00", "Heat pumps", "Ours has run for a year", 90, 12, "heating", "reddit"),
            ("rd2", "2022-05-02 11:00:00", "Draughty doors", None, -40, 7, None, "reddit"),
            ("rd3", "2022-05-03 12:00:00", "Attic plans", "Which wool to take", 66, 9, "insulation", "reddit"),
        ],
        "post_id string, datetime string, title string, text string, score long, comments long, tag string, "
        "data_source string",
    )


def column(df, name):
    return [row[name] for row in df.collect()]
