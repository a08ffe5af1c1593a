"""Time, engagement and scaling features."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parse_time(df: DataFrame, column: str) -> Column:
    """A timestamp from ISO text or, in a numeric column, from Unix seconds; else null."""
    data_type = df.schema[column].dataType
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return F.col(column)
    if isinstance(data_type, T.NumericType):
        return F.timestamp_seconds(F.col(column).cast("double"))
    return F.try_to_timestamp(F.trim(F.col(column).cast("string")))


def _magnitude(df: DataFrame, column: str) -> Column:
    if column not in df.columns:
        return F.lit(0.0)
    return F.abs(F.coalesce(F.nanvl(F.col(column).cast("double"), F.lit(0.0)), F.lit(0.0)))


def twitter_engagement(df: DataFrame) -> Column:
    """|retweets| + |favourites|; 0 where the table has no retweet column."""
    if "retweet_count" not in df.columns:
        return F.lit(0.0)
    return _magnitude(df, "retweet_count") + _magnitude(df, "favorite_count")


def reddit_engagement(df: DataFrame) -> Column:
    """|score| + 2·|comments|; 0 where the table has no score column."""
    if "score" not in df.columns:
        return F.lit(0.0)
    return _magnitude(df, "score") + 2 * _magnitude(df, "comments")


def with_engagement(df: DataFrame) -> DataFrame:
    """Engagement per platform and in total."""
    parts = df.withColumns(
        {"twitter_engagement": twitter_engagement(df), "reddit_engagement": reddit_engagement(df)}
    )
    return parts.withColumn("total_engagement", F.col("twitter_engagement") + F.col("reddit_engagement"))


def with_engagement_rate(df: DataFrame, stats_from: DataFrame | None = None) -> DataFrame:
    """C11: total engagement as a share of the table's maximum, 0 where that is not positive.

    The maximum is a scalar subquery: one partial aggregate, its single value inlined in the plan.
    ``stats_from`` may name a cheaper table holding the same ``total_engagement`` values.
    """
    top = (df if stats_from is None else stats_from).agg(F.max("total_engagement")).scalar()
    return df.withColumn("engagement_rate", F.when(top > 0, F.col("total_engagement") / top).otherwise(F.lit(0.0)))


def with_z_scores(
    df: DataFrame,
    columns: Iterable[str] = ("total_engagement", "word_count"),
    stats_from: DataFrame | None = None,
    drop_constant: bool = False,
) -> DataFrame:
    """``<column>_normalized`` = (value − mean) / sample standard deviation.

    Where a column does not vary the result is null; ``drop_constant`` looks at the data first
    (one small job) and leaves such a column out altogether.
    """
    base = df if stats_from is None else stats_from
    names = [c for c in columns if c in df.columns]
    if not names:
        return df
    stats = base.agg(
        F.struct(
            *(F.avg(c).alias(f"{c}_mean") for c in names), *(F.stddev_samp(c).alias(f"{c}_std") for c in names)
        ).alias("stats")
    )
    if drop_constant:
        row = stats.first()["stats"]
        return df.withColumns(
            {
                f"{c}_normalized": (F.col(c) - F.lit(row[f"{c}_mean"])) / F.lit(row[f"{c}_std"])
                for c in names
                if row[f"{c}_std"]
            }
        )
    one = stats.scalar()
    return df.withColumns(
        {
            f"{c}_normalized": F.when(one[f"{c}_std"] > 0, (F.col(c) - one[f"{c}_mean"]) / one[f"{c}_std"])
            for c in names
        }
    )
