"""Posts derived from general event and document tables.

One post per event: even events play the Twitter-like platform, odd ones the Reddit-like one. The
text is the document whose id equals the event's; a post replies to the author of the event
before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give every core a share of a small input; a no-op once the scan has a task per core anyway.

    Text work is bound by computation, and a small file is a single task.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def posts_from_tables(spark: SparkSession, folder: str, text: bool = False, replies: bool = False) -> DataFrame:
    """The post view; ``text`` and ``replies`` each cost a join on a unique key, so ask only if needed."""
    events = spark.read.parquet(f"{folder}/events.parquet")
    even = F.col("event_id") % 2 == 0
    posts = events.select(
        F.col("event_id"),
        F.col("event_id").cast("string").alias("id"),
        F.col("ts").alias("created_at"),
        F.when(even, "twitter").otherwise("reddit_kaggle").alias("data_source"),
        F.col("user_id").cast("string").alias("user_id"),
        F.when(~even, F.col("user_id").cast("string")).alias("author"),
        F.col("event_type").alias("subreddit"),
        F.when(even, F.col("value")).alias("user_followers_count"),
        F.when(even, F.floor(F.col("value") * 0.3).cast("double")).alias("retweet_count"),
        F.when(even, F.floor(F.col("value") * 0.7).cast("double")).alias("favorite_count"),
        F.when(~even, F.floor(F.col("value")).cast("double")).alias("score"),
        F.when(~even, F.regexp_extract("props", "([0-9]+)", 1).cast("double")).alias("comments"),
    )
    if text:
        documents = spark.read.parquet(f"{folder}/documents.parquet").select(
            F.col("doc_id").alias("event_id"), "text"
        )
        posts = spread(posts, "event_id").join(documents, "event_id", "left")
    if replies:
        previous = events.select(
            (F.col("event_id") + 1).alias("event_id"), F.col("user_id").cast("string").alias("in_reply_to_user_id")
        )
        posts = posts.join(previous, "event_id", "left")
    return posts.drop("event_id")
