"""Aggregations, calendar roll-ups, top lists, histogram and pivot."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from townsquare.functions.filters import available, source_contains
from townsquare.functions.text import domain_tags
from townsquare.operators.ranks import exact_quantiles
from townsquare.schema import TECHNOLOGY_DOMAINS, UNKNOWN
from townsquare.sources.readers import seeded_sample

DAILY_SUMS = ("total_engagement", "reddit_engagement", "word_count")
DAILY_MEANS = ("sentiment_polarity",)


def day(column: str = "created_at") -> Column:
    return F.to_date(column)


def label_frequency(df: DataFrame, column: str = "sentiment_label") -> DataFrame:
    """Rows per label."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def platform_summary(df: DataFrame, digits: int = 4) -> DataFrame:
    """Sentiment mean/std/count and engagement mean/sum/median per platform.

    The median is taken from running counts, so a platform with most of the rows is not gathered
    in one task as a percentile aggregate would do.
    """
    known = df.filter(F.col("data_source").isNotNull())
    aggregates = []
    if "sentiment_polarity" in df.columns:
        aggregates += [
            F.round(F.avg("sentiment_polarity"), digits).alias("sentiment_polarity_mean"),
            F.round(F.stddev_samp("sentiment_polarity"), digits).alias("sentiment_polarity_std"),
            F.count("sentiment_polarity").alias("sentiment_polarity_count"),
        ]
    if "total_engagement" not in df.columns:
        return known.groupBy("data_source").agg(*(aggregates or [F.count(F.lit(1)).alias("count")]))
    aggregates += [
        F.round(F.avg("total_engagement"), digits).alias("total_engagement_mean"),
        F.round(F.sum("total_engagement"), digits).alias("total_engagement_sum"),
    ]
    medians = exact_quantiles(known, "total_engagement", {"total_engagement_median": 0.5}, ["data_source"])
    rounded = medians.withColumn("total_engagement_median", F.round("total_engagement_median", digits))
    return known.groupBy("data_source").agg(*aggregates).join(rounded, "data_source", "left")


def domain_engagement(
    df: DataFrame, domains: Iterable[str] = TECHNOLOGY_DOMAINS, text_column: str = "text_cleaned"
) -> DataFrame:
    """Per domain its posts, mean engagement and mean sentiment; a post may be in several."""
    tags = (
        F.col("tech_keywords")
        if "tech_keywords" in df.columns and text_column not in df.columns
        else domain_tags(F.col(text_column), domains)
    )
    aggregates = [F.count(F.lit(1)).alias("count")]
    if "total_engagement" in df.columns:
        aggregates.append(F.avg("total_engagement").alias("mean_engagement"))
    if "sentiment_polarity" in df.columns:
        aggregates.append(F.avg("sentiment_polarity").alias("mean_sentiment"))
    return df.withColumn("domain", F.explode(tags)).groupBy("domain").agg(*aggregates)


def fill_calendar(daily: DataFrame, zero: Sequence[str] = (), day_column: str = "day") -> DataFrame:
    """Add the days missing between the first and last one: ``zero`` columns get 0, others null.

    Each day is stretched up to the next one, so the roll-up is computed once and not joined with
    itself. The window spans days (one row each), not posts.
    """
    following = F.date_sub(F.lead(day_column).over(Window.orderBy(day_column)), 1)
    spans = daily.withColumn("__last", F.coalesce(following, F.col(day_column)))
    stretched = spans.withColumn("__day", F.explode(F.sequence(F.col(day_column), F.col("__last"))))
    own = F.col("__day") == F.col(day_column)
    return stretched.select(
        F.col("__day").alias(day_column),
        *(
            (F.when(own, F.col(c)).otherwise(F.lit(0)) if c in zero else F.when(own, F.col(c))).alias(c)
            for c in daily.columns
            if c != day_column
        ),
    )


def daily_metrics(df: DataFrame) -> DataFrame:
    """Per calendar day mean sentiment and summed engagement and words, complete days only."""
    means = [c for c in DAILY_MEANS if c in df.columns]
    sums = [c for c in DAILY_SUMS if c in df.columns]
    daily = (
        df.withColumn("day", day())
        .filter(F.col("day").isNotNull())
        .groupBy("day")
        .agg(*(F.avg(c).alias(c) for c in means), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums))
    )
    return fill_calendar(daily, zero=sums).dropna()


def daily_describe(daily: DataFrame) -> DataFrame:
    """E5: count, mean, std, min, quartiles and max of each daily column, one row per column.

    ``daily`` holds a row per calendar day, so the exact percentile aggregate stays small.
    """
    names = [c for c in daily.columns if c != "day"]
    entries = []
    for name in names:
        v = F.col(name).cast("double")
        quartiles = F.percentile(v, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
        entries.append(
            F.struct(
                F.lit(name).alias("column"),
                F.count(v).alias("count"),
                F.avg(v).alias("mean"),
                F.stddev_samp(v).alias("std"),
                F.min(v).alias("min"),
                quartiles[0].alias("q25"),
                quartiles[1].alias("q50"),
                quartiles[2].alias("q75"),
                F.max(v).alias("max"),
            )
        )
    return daily.agg(F.array(*entries).alias("entries")).select(F.inline("entries"))


def daily_volume_by_source(df: DataFrame) -> DataFrame:
    """Posts per day and source, observed pairs only."""
    return (
        df.select(day().alias("day"), "data_source")
        .filter("day is not null and data_source is not null")
        .groupBy("day", "data_source")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def daily_sentiment(df: DataFrame, column: str = "sentiment_compound") -> DataFrame:
    """Mean sentiment per calendar day, null on days without posts."""
    daily = df.select(day().alias("day"), column).filter("day is not null")
    return fill_calendar(daily.groupBy("day").agg(F.avg(column).alias("mean_sentiment")))


def daily_volume(df: DataFrame) -> DataFrame:
    """Posts per calendar day, 0 on days without posts."""
    daily = df.select(day().alias("day")).filter("day is not null")
    return fill_calendar(daily.groupBy("day").agg(F.count(F.lit(1)).alias("count")), zero=["count"])


def kpis(df: DataFrame) -> DataFrame:
    """One row with total, Reddit-like and Twitter-like posts and summed engagement."""
    engagement = F.coalesce(F.sum("total_engagement"), F.lit(0.0)) if "total_engagement" in df.columns else F.lit(0.0)
    return df.agg(
        F.count(F.lit(1)).alias("total_posts"),
        F.count_if(source_contains("reddit")).alias("reddit_posts"),
        F.count_if(source_contains("twitter")).alias("twitter_posts"),
        engagement.alias("total_engagement"),
    )


def top_categories(df: DataFrame, column: str = "subreddit", n: int = 10) -> DataFrame:
    """The ``n`` categories with most posts, ties by name."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("posts"))
    return counts.orderBy(F.desc("posts"), column).limit(n)


POST_COLUMNS = ("id", "created_at", "subreddit", "text_cleaned", "total_engagement", "sentiment_label")


def top_posts(df: DataFrame, n: int = 50, columns: Sequence[str] = POST_COLUMNS) -> DataFrame:
    """The ``n`` posts with most engagement, ties by id."""
    return available(df, columns).orderBy(F.desc("total_engagement"), "id").limit(n)


def histogram(df: DataFrame, column: str = "total_engagement", bins: int = 30) -> DataFrame:
    """Rows per bin of equal width; empty bins have no row, a constant column fills bin 1.

    The range is a scalar subquery. The last bin includes its upper end.
    """
    value = F.col(column).cast("double")
    span = df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()
    lo, hi = span["lo"], span["hi"]
    place = F.coalesce(F.floor(F.try_divide((value - lo) * bins, hi - lo)), F.lit(0))
    numbered = df.filter(value.isNotNull()).select(F.least(F.lit(bins), place + 1).cast("int").alias("bin"))
    return numbered.groupBy("bin").agg(F.count(F.lit(1)).alias("count"))


def top_users(df: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` users with most summed engagement; posts without a known user do not count."""
    known = df.filter(F.col("user_id").isNotNull() & (F.col("user_id") != UNKNOWN))
    sums = known.groupBy("user_id").agg(F.sum("total_engagement").alias("total_engagement"))
    return sums.orderBy(F.desc("total_engagement"), "user_id").limit(n)


def platforms(df: DataFrame) -> list[str]:
    """The distinct platforms, sorted. Names only: a row per source system."""
    names = df.select("data_source").filter("data_source is not null").distinct()
    return sorted(row["data_source"] for row in names.collect())


def platform_pivot(
    df: DataFrame, names: Sequence[str], value: str = "total_engagement", grain: str = "day"
) -> DataFrame:
    """Mean engagement per time (rows) and platform (columns), complete rows only.

    ``grain='day'`` compares days; ``'exact'`` compares raw timestamps.
    """
    time = day() if grain == "day" else F.col("created_at")
    keyed = df.select(time.alias("time"), "data_source", value).filter("time is not null")
    return keyed.groupBy("time").pivot("data_source", list(names)).agg(F.avg(value)).dropna()


def distinct_users(df: DataFrame) -> DataFrame:
    """The distinct users."""
    return df.select("user_id").filter("user_id is not null").distinct()


def date_extent(df: DataFrame) -> DataFrame:
    """One row with the first and last day."""
    return df.agg(F.min(day()).alias("first_day"), F.max(day()).alias("last_day"))


def sentiment_points(df: DataFrame) -> DataFrame:
    """Sentiment against engagement, every post."""
    return available(df, ("id", "data_source", "sentiment_compound", "total_engagement", "word_count"))


def sentiment_grid(df: DataFrame, bins: int = 40, seed: int = 42) -> DataFrame:
    """E16, bounded: sentiment against engagement as cells, each with its count and one post that stands for it.

    Sentiment has ``bins`` equal cells from -1 to 1, engagement a cell per power of two, so there are at most 64 times
    ``bins`` rows per source whatever the number of posts. The post is the one with the least MD5 of seed and id.
    """
    score, amount = F.col("sentiment_compound"), F.greatest(F.col("total_engagement").cast("double"), F.lit(0.0))
    known = df.filter("sentiment_compound is not null and total_engagement is not null")
    cells = known.select(
        "data_source",
        F.least(F.lit(bins), F.floor((score + 1) / 2 * bins) + 1).cast("int").alias("sentiment_bin"),
        F.floor(F.log2(amount + 1)).cast("int").alias("engagement_bin"),
        F.struct(
            F.md5(F.concat(F.lit(f"{seed}|"), F.col("id").cast("string"))).alias("order"),
            "id", score.alias("sentiment_compound"), amount.alias("total_engagement"),
        ).alias("post"),
    )
    return cells.groupBy("data_source", "sentiment_bin", "engagement_bin").agg(
        F.count(F.lit(1)).alias("count"), F.min("post").alias("post")
    ).select("data_source", "sentiment_bin", "engagement_bin", "count", "post.id", "post.sentiment_compound", "post.total_engagement")


def length_points(df: DataFrame, n: int = 1000, seed: int = 42, key: str | None = None) -> DataFrame:
    """Sentiment against word count, a bounded repeatable sample."""
    return seeded_sample(available(df, ("id", "data_source", "word_count", "sentiment_compound")), n, seed, key)
