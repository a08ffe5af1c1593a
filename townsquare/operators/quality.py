"""Data-quality checks of raw tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from townsquare.functions.features import parse_time

# Columns whose nulls and variance are checked, and date columns in order of choice.
METRIC_COLUMNS = ("score", "retweet_count", "user_followers_count", "author_post_karma")
DATE_COLUMNS = ("created_at", "created_utc", "date", "timestamp")
OLDEST_YEAR = 2010
MAX_NULL_SHARE = 0.5

# Columns each kind of source must have, as raw files carry them.
REQUIRED_COLUMNS: Mapping[str, Sequence[str]] = {
    "twitter": ("id", "text", "created_at", "user_followers_count", "retweet_count"),
    "reddit": ("post_id", "score", "datetime", "text"),
    "commercial": ("amazon_tech_sales_velocity", "created_at"),
}
# The stricter Reddit list for tables that use the shared names.
STRICT_REDDIT_COLUMNS = ("id", "title", "score", "subreddit", "created_utc")
REDDIT_TEXT_COLUMNS = ("text", "selftext", "body", "title")

ISSUES_SCHEMA = "check string, column string, value double, message string"
REPORT_SCHEMA = (
    "dataset string, source string, status string, missing array<string>, "
    "issues array<struct<check:string,column:string,value:double,message:string>>"
)


def detect_source(df: DataFrame, filename: str) -> str:
    """The kind of source: by the rows' tag, else the file name, else the columns.

    The tag looked at is the one of the smallest id, which does not depend on row order.
    """
    columns = set(df.columns)
    hints = []
    if "data_source" in columns:
        key = next((c for c in ("id", "post_id") if c in columns), "data_source")
        first = df.agg(F.min_by(F.col("data_source").cast("string"), key)).first()[0]
        hints.append((first or "").lower())
    hints.append(filename.lower())
    for hint in hints:
        for kind in ("twitter", "reddit"):
            if kind in hint:
                return kind
    if columns & {"subreddit", "author_post_karma"}:
        return "reddit"
    if columns & {"retweet_count", "user_followers_count"}:
        return "twitter"
    return "unknown"


def missing_columns(
    df: DataFrame, source: str, required: Mapping[str, Sequence[str]] = REQUIRED_COLUMNS
) -> list[str]:
    """Required columns the table lacks; Reddit-like tables need some text column too."""
    columns = set(df.columns)
    missing = [c for c in required.get(source, ()) if c not in columns]
    if source == "reddit" and not columns & set(REDDIT_TEXT_COLUMNS):
        missing.append("content_text")
    return missing


def schema_report(df: DataFrame, source: str, required: Mapping[str, Sequence[str]] = REQUIRED_COLUMNS) -> DataFrame:
    """D2, D3 as rows: one per missing column."""
    rows = [(source, c) for c in missing_columns(df, source, required)]
    return df.sparkSession.createDataFrame(rows, "source string, column string")


def _date_column(df: DataFrame) -> str | None:
    return next((c for c in DATE_COLUMNS if c in df.columns), None)


def _is_numeric(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.NumericType)


def profile(df: DataFrame, null_checked: Sequence[str] = (), date_range: tuple[str, str] | None = None) -> DataFrame:
    """One row per checked column, from a single aggregate over the table.

    Columns: ``column, rows, null_share, spread`` (sample standard deviation), ``constant``,
    ``first_time, last_time, out_of_range`` (the last three for the date column only).
    """
    metrics = [c for c in df.columns if c in METRIC_COLUMNS or c in null_checked]
    date = _date_column(df)
    rows = F.count(F.lit(1))

    def entry(name: str, **parts: Column) -> Column:
        blank = {
            "rows": rows,
            "null_share": F.avg(F.col(name).isNull().cast("double")),
            "spread": F.lit(None).cast("double"),
            "constant": F.lit(None).cast("boolean"),
            "first_time": F.lit(None).cast("timestamp"),
            "last_time": F.lit(None).cast("timestamp"),
            "out_of_range": F.lit(None).cast("long"),
        }
        return F.struct(F.lit(name).alias("column"), *((blank | parts)[key].alias(key) for key in blank))

    entries = []
    for name in metrics:
        if _is_numeric(df, name):
            value = F.col(name).cast("double")
            one_value = (F.min(value) == F.max(value)) & (F.count(value) > 1)
            entries.append(
                entry(name, spread=F.stddev_samp(value), constant=F.coalesce(one_value, F.lit(False)))
            )
        else:
            entries.append(entry(name))
    if date is not None:
        time = parse_time(df, date).cast("timestamp")
        parts = {"first_time": F.min(time), "last_time": F.max(time)}
        if date_range is not None:
            low, high = (F.lit(bound).cast("timestamp") for bound in date_range)
            parts["out_of_range"] = F.count_if((time < low) | (time > high))
        entries.append(entry(date, **parts))
    if not entries:
        return df.agg(F.struct(F.lit(None).cast("string").alias("column"), rows.alias("rows")).alias("e")).select("e.*")
    return df.agg(F.array(*entries).alias("entries")).select(F.inline("entries"))


def quality_issues(
    df: DataFrame,
    as_of: dt.datetime,
    max_null_share: float = MAX_NULL_SHARE,
    null_checked: Sequence[str] = (),
    date_range: tuple[str, str] | None = None,
) -> DataFrame:
    """D4-D7, D9 as rows (check, column, value, message): only what is wrong.

    ``as_of`` stands for "now" so that a report can be repeated.
    """
    facts = profile(df, null_checked, date_range)
    latest = F.lit((as_of + dt.timedelta(days=1)).isoformat(sep=" ")).cast("timestamp")
    columns = set(facts.columns)

    def issue(condition: Column, check: str, value: Column, message: Column | str) -> Column:
        text = F.lit(message) if isinstance(message, str) else message
        return F.when(
            condition,
            F.struct(
                F.lit(check).alias("check"),
                F.col("column"),
                value.cast("double").alias("value"),
                text.alias("message"),
            ),
        )

    checks = [issue(F.col("rows") == 0, "empty", F.col("rows"), "table is empty")]
    if "null_share" in columns:
        is_metric = F.col("column").isin(*METRIC_COLUMNS, *null_checked)
        checks += [
            issue(
                is_metric & (F.col("null_share") > max_null_share),
                "nulls",
                F.col("null_share"),
                F.format_string("%.1f%% missing", F.col("null_share") * 100),
            ),
            issue(F.col("constant"), "variance", F.col("spread"), "all values are identical"),
            issue(
                F.year("first_time") < OLDEST_YEAR,
                "old_dates",
                F.year("first_time"),
                F.format_string("earliest %s", F.col("first_time").cast("string")),
            ),
            issue(
                F.col("last_time") > latest,
                "future_dates",
                F.year("last_time"),
                F.format_string("latest %s", F.col("last_time").cast("string")),
            ),
            issue(
                F.col("out_of_range") > 0, "date_range", F.col("out_of_range"), "rows outside the allowed date range"
            ),
        ]
    found = facts.select(F.explode(F.array_compact(F.array(*checks))).alias("issue")).select("issue.*")
    # An empty table has one "empty" row, however many columns were checked.
    first = F.when(F.col("check") == "empty", F.lit(None).cast("string")).otherwise(F.col("column"))
    return found.withColumn("column", first).distinct()


def validation_report(
    spark: SparkSession,
    datasets: Mapping[str, DataFrame],
    as_of: dt.datetime,
    required: Mapping[str, Sequence[str]] = REQUIRED_COLUMNS,
    **limits,
) -> DataFrame:
    """Per dataset its source, status, missing columns and issues. Status depends on the schema only."""
    parts = []
    for name, df in datasets.items():
        source = detect_source(df, name)
        missing = missing_columns(df, source, required)
        issues = quality_issues(df, as_of, **limits).agg(
            F.array_sort(F.collect_list(F.struct("check", "column", "value", "message"))).alias("issues")
        )
        parts.append(
            issues.select(
                F.lit(name).alias("dataset"),
                F.lit(source).alias("source"),
                F.lit("FAILED" if missing else "PASSED").alias("status"),
                F.array(*(F.lit(c) for c in missing)).cast("array<string>").alias("missing"),
                "issues",
            )
        )
    if not parts:
        return spark.createDataFrame([], REPORT_SCHEMA)
    return reduce(DataFrame.unionByName, parts)


def overall_status(report: DataFrame | None, enabled: bool = True) -> str:
    """PASSED, FAILED (also when there is nothing to check) or SKIPPED. Never blocks a job."""
    if not enabled:
        return "SKIPPED"
    if report is None:
        return "FAILED"
    passed = report.agg(F.bool_and(F.col("status") == "PASSED")).first()[0]
    return "PASSED" if passed else "FAILED"
