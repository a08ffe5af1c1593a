"""The daily monitor as a stream (K5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from townsquare.plans.monitor import SENTIMENT_DROP


def daily_stream(posts: DataFrame, lateness: str = "2 days", keep_time: bool = False) -> DataFrame:
    """K5: per closed day and source the posts, summed engagement and mean sentiment.

    ``posts`` is a streaming DataFrame with ``created_at`` and ``data_source``. State holds one row
    per open (day, source). A window closes, and later rows for it are dropped, once the
    watermark (newest time seen minus ``lateness``) passes its end. ``keep_time`` adds ``closed_at``, the
    event time of the closed window, for a further stateful step.
    """
    aggregates = [F.count(F.lit(1)).alias("count")]
    if "total_engagement" in posts.columns:
        aggregates.append(F.sum("total_engagement").alias("total_engagement"))
    if "sentiment_compound" in posts.columns:
        aggregates.append(F.avg("sentiment_compound").alias("mean_sentiment"))
    timed = posts.withColumn("created_at", F.col("created_at").cast("timestamp")).withWatermark("created_at", lateness)
    closed = timed.groupBy(F.window("created_at", "1 day"), "data_source").agg(*aggregates)
    if keep_time:
        closed = closed.withColumn("closed_at", F.window_time("window"))
    return closed.withColumn("day", F.to_date("window.start")).drop("window")


def sentiment_drop_stream(posts: DataFrame, threshold: float = SENTIMENT_DROP, lateness: str = "2 days") -> DataFrame:
    """K5: closed days whose mean sentiment lies below the threshold."""
    return daily_stream(posts, lateness).filter(F.col("mean_sentiment") < threshold)


def start_daily(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the closed days to a Parquet table, taking the input at hand and then stopping."""
    return (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
