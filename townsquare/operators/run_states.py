"""Roll-ups over stored runs from mergeable states (E2, E4, E6, E9): a new run costs one pass over its own posts.

A run's state is two small tables. ``daily`` has a row per day and source (either may be null) with counts, sums, means and
squared deviations; ``engagement`` has a row per source and distinct engagement with its count, which keeps medians exact. States of several
runs are united and merged; the results equal those of ``rollups`` over the posts of all these runs together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from townsquare.functions.filters import source_contains
from townsquare.operators.ranks import exact_quantiles
from townsquare.operators.rollups import DAILY_MEANS, DAILY_SUMS, day, fill_calendar


def post_states(posts: DataFrame) -> dict[str, DataFrame]:
    """The states of one run's posts; none without sources and times. Columns the posts lack have no state.

    Null values do not count; an empty table has empty states.
    """
    if not {"data_source", "created_at"} <= set(posts.columns):
        return {}
    sums = [c for c in DAILY_SUMS if c in posts.columns]
    means = [c for c in DAILY_MEANS if c in posts.columns]
    figures = [F.count(F.lit(1)).alias("posts")]
    for c in sums:
        figures += [F.count(c).alias(f"{c}_n"), F.sum(c).alias(f"{c}_sum")]
    for c in means:
        figures += [F.count(c).alias(f"{c}_n"), F.avg(c).alias(f"{c}_mean"), (F.var_pop(c) * F.count(c)).alias(f"{c}_m2")]
    states = {"daily": posts.groupBy(day().alias("day"), "data_source").agg(*figures)}
    if "total_engagement" in sums:
        known = posts.filter("data_source is not null and total_engagement is not null")
        value = F.col("total_engagement").cast("double").alias("total_engagement")
        states["engagement"] = known.groupBy("data_source", value).agg(F.count(F.lit(1)).alias("posts"))
    return states


def _mean(column: str) -> Column:
    return F.try_divide(F.sum(F.col(f"{column}_n") * F.col(f"{column}_mean")), F.sum(f"{column}_n"))


def platform_summary(daily: DataFrame, engagement: DataFrame | None = None, digits: int = 4) -> DataFrame:
    """E2 from states. Deviations are merged around the common mean, so no large sums of squares cancel."""
    known = daily.filter("data_source is not null")
    c = "sentiment_polarity"
    aggregates = []
    if f"{c}_n" in daily.columns:
        centre = known.groupBy("data_source").agg(_mean(c).alias("__mean"))
        known = known.join(centre, "data_source")
        around = F.sum(F.col(f"{c}_m2") + F.col(f"{c}_n") * F.pow(F.col(f"{c}_mean") - F.col("__mean"), F.lit(2)))
        aggregates += [
            F.round(F.max("__mean"), digits).alias(f"{c}_mean"),
            F.round(F.sqrt(F.try_divide(around, F.sum(f"{c}_n") - 1)), digits).alias(f"{c}_std"),
            F.sum(f"{c}_n").alias(f"{c}_count"),
        ]
    c = "total_engagement"
    if engagement is None or f"{c}_n" not in daily.columns:
        return known.groupBy("data_source").agg(*(aggregates or [F.sum("posts").alias("count")]))
    aggregates += [
        F.round(F.try_divide(F.sum(f"{c}_sum"), F.sum(f"{c}_n")), digits).alias(f"{c}_mean"),
        F.round(F.sum(f"{c}_sum"), digits).alias(f"{c}_sum"),
    ]
    medians = exact_quantiles(engagement, c, {f"{c}_median": 0.5}, ["data_source"], weight="posts")
    rounded = medians.withColumn(f"{c}_median", F.round(f"{c}_median", digits))
    return known.groupBy("data_source").agg(*aggregates).join(rounded, "data_source", "left")


def daily_metrics(daily: DataFrame) -> DataFrame:
    """E4 from states."""
    means = [c for c in DAILY_MEANS if f"{c}_n" in daily.columns]
    sums = [c for c in DAILY_SUMS if f"{c}_n" in daily.columns]
    merged = daily.filter("day is not null").groupBy("day").agg(
        *(_mean(c).alias(c) for c in means), *(F.coalesce(F.sum(f"{c}_sum"), F.lit(0)).alias(c) for c in sums)
    )
    return fill_calendar(merged, zero=sums).dropna()


def daily_volume_by_source(daily: DataFrame) -> DataFrame:
    """E6 from states."""
    known = daily.filter("day is not null and data_source is not null")
    return known.groupBy("day", "data_source").agg(F.sum("posts").alias("count"))


def kpis(daily: DataFrame) -> DataFrame:
    """E9 from states."""
    has = "total_engagement_sum" in daily.columns
    posts = F.coalesce(F.sum("posts"), F.lit(0))

    def part(name: str) -> Column:
        return F.coalesce(F.sum(F.when(source_contains(name), F.col("posts"))), F.lit(0))

    return daily.agg(
        posts.alias("total_posts"),
        part("reddit").alias("reddit_posts"),
        part("twitter").alias("twitter_posts"),
        (F.coalesce(F.sum("total_engagement_sum"), F.lit(0.0)) if has else F.lit(0.0)).alias("total_engagement"),
    )
