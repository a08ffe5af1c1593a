"""Alerts over roll-ups (K1-K4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from townsquare.functions.filters import in_date_range, in_sources, source_contains, with_time
from townsquare.operators.rollups import (
    daily_sentiment,
    daily_volume,
    daily_volume_by_source,
    day,
    histogram,
    kpis,
    top_categories,
    top_posts,
)
from townsquare.sources.readers import load_run

SENTIMENT_DROP = -0.1
SENTIMENT_DAYS = 3
VOLUME_SIGMA = 2.0
VOLUME_MIN_DAYS = 5
WEAK_CORRELATION = 0.3


def sentiment_alerts(
    df: DataFrame, threshold: float = SENTIMENT_DROP, days: int = SENTIMENT_DAYS, column: str = "sentiment_compound"
) -> DataFrame:
    """K1: those of the last calendar days whose mean sentiment lies below the threshold."""
    recent = daily_sentiment(df, column).orderBy(F.desc("day")).limit(days)
    return recent.filter(F.col("mean_sentiment") < threshold)


def volume_alerts(df: DataFrame, sigma: float = VOLUME_SIGMA, min_days: int = VOLUME_MIN_DAYS) -> DataFrame:
    """K2: calendar days with more than mean + sigma · std posts; needs more than five days."""
    daily = daily_volume(df)
    stats = daily.agg(
        F.struct(
            F.count(F.lit(1)).alias("days"), F.avg("count").alias("mean"), F.stddev_samp("count").alias("std")
        )
    ).scalar()
    limit = stats["mean"] + sigma * stats["std"]
    return daily.withColumn("limit", limit).filter((stats["days"] > min_days) & (F.col("count") > F.col("limit")))


WATCH_SCHEMA = (
    "data_source string, day date, count long, mean_sentiment double, recent_sentiment double, limit double, "
    "volume_alert boolean, sentiment_alert boolean"
)


def daily_watch(
    df: DataFrame,
    drop: float = SENTIMENT_DROP,
    sigma: float = VOLUME_SIGMA,
    min_days: int = VOLUME_MIN_DAYS,
    column: str = "sentiment_compound",
    through: Column | None = None,
) -> DataFrame:
    """K1, K2 and E7 day by day: each source's calendar days with what was known when they closed.

    ``limit`` is mean + sigma · std of the source's daily counts up to that day, ``recent_sentiment`` the mean of the
    last three calendar days' mean sentiments. Every day from a source's first one to ``through``
    (default: the last day of all) has a row, with 0 posts where there are none. Windows span days, not posts.
    """
    daily = (
        df.select(day().alias("day"), "data_source", F.col(column).alias("value"))
        .filter("day is not null and data_source is not null")
        .groupBy("data_source", "day")
        .agg(F.count(F.lit(1)).alias("count"), F.avg("value").alias("mean_sentiment"))
    )
    end = daily.agg(F.max("day")).scalar() if through is None else through
    days = Window.partitionBy("data_source").orderBy("day")
    spans = daily.filter(F.col("day") <= end).withColumn("__last", F.coalesce(F.date_sub(F.lead("day").over(days), 1), end))
    own = F.col("__day") == F.col("day")
    filled = spans.withColumn("__day", F.explode(F.sequence("day", "__last"))).select(
        "data_source", F.col("__day").alias("day"), F.when(own, F.col("count")).otherwise(0).alias("count"),
        F.when(own, F.col("mean_sentiment")).alias("mean_sentiment"),
    )
    upto = days.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    watched = filled.withColumns(
        {
            "recent_sentiment": F.avg("mean_sentiment").over(days.rowsBetween(1 - SENTIMENT_DAYS, Window.currentRow)),
            "limit": F.avg("count").over(upto) + sigma * F.stddev_samp("count").over(upto),
            "__days": F.count(F.lit(1)).over(upto),
        }
    )
    return watched.withColumns(
        {
            "volume_alert": F.coalesce((F.col("__days") > min_days) & (F.col("count") > F.col("limit")), F.lit(False)),
            "sentiment_alert": F.coalesce(F.col("mean_sentiment") < drop, F.lit(False)),
        }
    ).drop("__days")


def weak_correlations(correlations: DataFrame, below: float = WEAK_CORRELATION) -> DataFrame:
    """K3: named correlations whose absolute value is small; an undefined one counts as 0."""
    r = F.coalesce("correlation", F.lit(0.0))
    return correlations.filter(F.abs(r) < below).select("name", "correlation")


def control_limits(df: DataFrame, sigma: float = VOLUME_SIGMA) -> DataFrame:
    """K4: one row with the mean of the (day, source) counts and mean + sigma · std."""
    stats = daily_volume_by_source(df).agg(
        F.avg("count").alias("centre_line"), F.stddev_samp("count").alias("std")
    )
    return stats.select("centre_line", (F.col("centre_line") + sigma * F.col("std")).alias("upper_limit"))


ALERT_SCHEMA = "level string, title string, detail string"


def alerts(
    df: DataFrame,
    correlations: DataFrame | None = None,
    sentiment_drop: float = SENTIMENT_DROP,
    volume_sigma: float = VOLUME_SIGMA,
    weak_correlation: float = WEAK_CORRELATION,
) -> DataFrame:
    """K1-K3 as one list: a row per kind of alert and, for correlations, per name."""

    def dates(found: DataFrame, level: str, title: str) -> DataFrame:
        listed = found.agg(F.array_sort(F.collect_list(F.col("day").cast("string"))).alias("days"))
        return listed.filter(F.size("days") > 0).select(
            F.lit(level).alias("level"), F.lit(title).alias("title"), F.array_join("days", ", ").alias("detail")
        )

    parts = []
    if "created_at" in df.columns:
        if "sentiment_compound" in df.columns:
            parts.append(dates(sentiment_alerts(df, sentiment_drop), "critical", "sentiment drop"))
        parts.append(dates(volume_alerts(df, volume_sigma), "warning", "volume anomaly"))
    if correlations is not None:
        parts.append(
            weak_correlations(correlations, weak_correlation).select(
                F.lit("info").alias("level"),
                F.lit("weak correlation").alias("title"),
                F.col("name").alias("detail"),
            )
        )
    out = df.sparkSession.createDataFrame([], ALERT_SCHEMA)
    for part in parts:
        out = out.unionByName(part)
    return out


def monitoring(
    spark: SparkSession,
    base: str,
    run_id: str,
    sources: Sequence[str] | None = None,
    dates: tuple | None = None,
    correlations: DataFrame | None = None,
    **limits: float,
) -> dict[str, DataFrame]:
    """The monitoring read: one stored run, filtered, as figures, volumes and alerts.

    ``sources`` and ``dates`` narrow everything; categories, histogram and top posts are those
    of the Reddit-like posts.
    """
    posts = with_time(load_run(spark, base, run_id))
    if sources is not None:
        posts = posts.filter(in_sources(sources))
    if dates is not None:
        posts = posts.filter(in_date_range(*dates))
    reddit = posts.filter(source_contains("reddit"))
    return {
        "kpis": kpis(posts),
        "daily_volume": daily_volume_by_source(posts),
        "top_categories": top_categories(reddit),
        "histogram": histogram(reddit),
        "top_posts": top_posts(reddit),
        "alerts": alerts(posts, correlations, **limits),
    }
