"""Explicit schemas of the raw inputs and of the enriched post table."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "array<string>": T.ArrayType(T.StringType()),
}


def _struct(columns: str) -> T.StructType:
    """A flat schema from ``name type, …``; unlike DDL parsing it needs no session at import."""
    pairs = (column.split() for column in columns.split(", "))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


TWITTER_RAW = _struct(
    "id string, created_at string, text string, user_id string, user_screen_name string, "
    "user_followers_count long, retweet_count long, favorite_count long, reply_count long, "
    "lang string, source string, data_source string, twitter_engagement long, "
    "in_reply_to_user_id string"
)

REDDIT_RAW = _struct(
    "post_id string, datetime string, title string, text string, score long, comments long, "
    "tag string, author_post_karma long, data_source string, author string"
)

ENRICHED_POST = _struct(
    "id string, created_at timestamp, data_source string, subreddit string, title string, "
    "text string, user_id string, in_reply_to_user_id string, author string, "
    "user_followers_count double, retweet_count double, favorite_count double, score double, "
    "comments double, author_post_karma double, text_cleaned string, text_tokens_clean string, "
    "word_count int, twitter_engagement double, reddit_engagement double, "
    "total_engagement double, engagement_rate double, sentiment_compound double, "
    "sentiment_label string, sentiment_polarity double, total_engagement_normalized double, "
    "word_count_normalized double, tech_keywords array<string>"
)

# Renames applied to the Reddit-like source at load.
REDDIT_RENAMES = {"post_id": "id", "datetime": "created_at", "tag": "subreddit"}
DEFAULT_SUBREDDIT = "technology"
UNKNOWN = "unknown"

# Default business domains looked for in the post text.
TECHNOLOGY_DOMAINS = (
    "Artificial Intelligence",
    "Machine Learning",
    "Cloud Computing",
    "Big Data",
    "Cybersecurity",
    "Blockchain",
    "IoT",
    "Data Science",
    "5G",
)
