"""Load-time shaping: renames, defaults, column names and the union of sources."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from townsquare.functions.features import parse_time
from townsquare.schema import DEFAULT_SUBREDDIT, REDDIT_RENAMES
from townsquare.sources.readers import with_source

# Columns that later steps compute with; sources disagree on their types (long, double, string).
METRIC_COLUMNS = (
    "user_followers_count",
    "retweet_count",
    "favorite_count",
    "score",
    "comments",
    "author_post_karma",
)
KEY_COLUMNS = ("id", "user_id", "in_reply_to_user_id", "author")


def normalise_names(df: DataFrame) -> DataFrame:
    """Lower-case, stripped column names."""
    return df.toDF(*(c.lower().strip() for c in df.columns))


def rename_reddit(df: DataFrame) -> DataFrame:
    """The Reddit-like source's names mapped to the shared ones."""
    return df.withColumnsRenamed(REDDIT_RENAMES)


def default_column(df: DataFrame, name: str = "subreddit", value: str = DEFAULT_SUBREDDIT) -> DataFrame:
    """``value`` where the column is absent or null."""
    if name not in df.columns:
        return df.withColumn(name, F.lit(value))
    return df.withColumn(name, F.coalesce(F.col(name), F.lit(value)))


def _shared_types(df: DataFrame) -> DataFrame:
    casts = {c: F.col(c).cast("double") for c in METRIC_COLUMNS if c in df.columns}
    casts |= {c: F.col(c).cast("string") for c in KEY_COLUMNS if c in df.columns}
    if "created_at" in df.columns and not isinstance(
        df.schema["created_at"].dataType, (T.TimestampType, T.TimestampNTZType)
    ):
        casts["created_at"] = parse_time(df, "created_at")
    return df.withColumns(casts) if casts else df


def shape_source(df: DataFrame, source: str) -> DataFrame:
    """A6, A11-A13 and C7 for one source; timestamps are parsed here, per source."""
    shaped = normalise_names(df)
    if "reddit" in source.lower():
        shaped = default_column(rename_reddit(shaped))
    return _shared_types(with_source(shaped, source))


def combine_sources(frames: Mapping[str, DataFrame]) -> DataFrame | None:
    """Union of the sources by column name; columns a source lacks become null."""
    shaped = [shape_source(df, source) for source, df in frames.items() if df is not None]
    if not shaped:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), shaped)
