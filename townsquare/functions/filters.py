"""Row filters, projections and null handling."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from townsquare.schema import UNKNOWN


def text_or_title(df: DataFrame) -> Column:
    """B1: the post's text, else its title; whichever columns exist."""
    present = [F.col(c) for c in ("text", "title") if c in df.columns]
    return F.coalesce(*present) if present else F.lit(None).cast("string")


def fill_unknown(df: DataFrame, value: str = UNKNOWN) -> DataFrame:
    """B2: null strings become ``'unknown'``."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.fillna(value, subset=names) if names else df


def fill_metrics(df: DataFrame, columns: Iterable[str] = ("total_engagement", "word_count")) -> DataFrame:
    """Null (or NaN) in the named metrics becomes 0; other numbers stay as they are."""
    names = [c for c in columns if c in df.columns]
    return df.fillna(0, subset=names) if names else df


def audience(df: DataFrame, karma_as_audience: bool = False) -> Column:
    """Followers, else karma, else 0.

    By default the choice is by column presence, as after a union of sources: karma counts only
    where the table has no follower column. ``karma_as_audience`` falls back row by row.
    """
    columns = [c for c in ("user_followers_count", "author_post_karma") if c in df.columns]
    if not karma_as_audience:
        columns = columns[:1]
    return F.coalesce(*(F.col(c).cast("double") for c in columns), F.lit(0.0))


def in_sources(sources: Iterable[str]) -> Column:
    """Membership of the post's source in a list."""
    return F.col("data_source").isin(list(sources))


def in_date_range(first: dt.date, last: dt.date, column: str = "created_at") -> Column:
    """Calendar days ``first`` to ``last``, both included.

    Written as half-open timestamp bounds, which Parquet can use to skip row groups.
    """
    start = dt.datetime.combine(first, dt.time())
    stop = dt.datetime.combine(last, dt.time()) + dt.timedelta(days=1)
    bounds = [F.lit(value.isoformat(sep=" ")) for value in (start, stop)]
    return (F.col(column) >= bounds[0].cast("timestamp_ntz")) & (F.col(column) < bounds[1].cast("timestamp_ntz"))


def source_contains(part: str, ignore_case: bool = True) -> Column:
    """Substring match on the source; a null source does not match."""
    source = F.coalesce(F.col("data_source"), F.lit(""))
    return F.lower(source).contains(part.lower()) if ignore_case else source.contains(part)


def source_is(name: str) -> Column:
    """Exact source."""
    return F.col("data_source") == name


def longer_than(column: str, length: int = 10) -> Column:
    """Non-null text with more than ``length`` characters."""
    return F.length(column) > length


def complete_pairs(df: DataFrame, x: str, y: str) -> DataFrame:
    """The two columns as doubles, rows with both present (null and NaN count as absent)."""
    pair = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    return pair.dropna(subset=["x", "y"])


def with_time(df: DataFrame, column: str = "created_at") -> DataFrame:
    """Rows whose timestamp could be parsed."""
    return df.filter(F.col(column).isNotNull())


def available(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Those of the named columns that exist, in the order named."""
    return df.select(*(c for c in columns if c in df.columns))
