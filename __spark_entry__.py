"""

Only wiring lives here; the operators are in ``townsquare``. Survey ids are given per query.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from townsquare.functions import features, filters, lemmas, sentiment, text
from townsquare.operators import (
    correlation,
    graph,
    group_tests,
    normality,
    quality,
    rollups,
    run_states,
    timeseries,
    topics,
)
from townsquare.plans import jobs, monitor
from townsquare.runtime import freeze, own_path, scratch_scope, shared_folder
from townsquare.sources import readers, shaping, writers
from townsquare.sources.tables import posts_from_tables, spread
from townsquare.streaming import alerts as live_alerts
from townsquare.streaming import daily as stream

try:
    from townsquare.llm import queries as text_queries
except ModuleNotFoundError as missing:
    # The text operators are one removable package with their pipeline; anything else is an error.
    if not (missing.name or "").startswith(("townsquare.llm", "corpus_pipeline")):
        raise
    text_queries = None

# Domains and words that occur in the generated texts.
DOMAINS = ("Data", "License", "Worthless", "Threat", "Best")
RULE_LEXICON = {"with": 1.5, "there": -2.0, "this": 0.8, "license": 2.5, "worthless": -1.9, "les": 0.5, "und": -0.7}
RULE_BOOSTERS = {"the": 0.293, "of": -0.293, "der": 0.293}
RULE_NEGATORS = ("and", "not", "que")
DATE_RANGE = (dt.date(2024, 1, 2), dt.date(2024, 1, 3))
AS_OF = dt.datetime(2024, 1, 15)
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def r(value: Column | str, digits: int = 6) -> Column:
    """Rounded double, without a negative zero."""
    return F.round(F.col(value) if isinstance(value, str) else value, digits).cast("double") + F.lit(0.0)


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: r(c, digits) for c in columns})


# --- inputs -------------------------------------------------------------------------------------


def posts(spark: SparkSession, folder: str, **parts: bool) -> DataFrame:
    return features.with_engagement(posts_from_tables(spark, folder, **parts))


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(spark.read.parquet(f"{folder}/documents.parquet"), "doc_id")


def events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """Posts with cleaned text, word count and sentiment."""
    df = posts(spark, folder, text=True)
    df = df.withColumn("text_cleaned", text.clean_text(F.col("text")))
    df = df.withColumn("word_count", text.word_count(F.col("text_cleaned")))
    return sentiment.with_sentiment(df)


SCORED = (
    "id", "created_at", "data_source", "subreddit", "user_id", "user_followers_count", "twitter_engagement",
    "reddit_engagement", "total_engagement", "word_count", "sentiment_compound", "sentiment_polarity", "sentiment_label",
)


def scored(spark: SparkSession, folder: str, *more: str, only: tuple[str, ...] = SCORED) -> DataFrame:
    """Posts with the sentiment and the word count of their texts, as one narrow stored table."""
    return freeze(texts(spark, folder).select(*only, *more))


def daily_table(spark: SparkSession, folder: str) -> DataFrame:
    """The daily metrics as a stored table of one row a day, from the scored posts."""
    return freeze(rollups.daily_metrics(scored(spark, folder)))


def measured(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """The named columns of posts, among them the word count but no sentiment, as a stored table."""
    df = posts(spark, folder, text=True)
    return freeze(df.withColumn("word_count", text.word_count(text.clean_text(F.col("text")))).select(*columns))


def raw_frames(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The post view split back into raw tables with each platform's own column names."""
    df = posts_from_tables(spark, folder, text=True, replies=True)
    twitter = df.filter(filters.source_is("twitter")).select(
        "id",
        F.col("created_at").cast("string").alias(" Created_At"),
        "text",
        "user_id",
        F.col("user_followers_count"),
        F.col("retweet_count").cast("long").alias("retweet_count"),
        F.col("favorite_count").cast("long").alias("favorite_count"),
        "in_reply_to_user_id",
    )
    reddit = df.filter(filters.source_contains("reddit")).select(
        F.col("id").alias("post_id"),
        F.col("created_at").cast("string").alias("datetime"),
        F.col("text").alias("title"),
        F.when(F.col("subreddit") != "view", F.col("text")).alias("text"),
        F.col("score").cast("long").alias("score"),
        F.col("comments").cast("long").alias("comments"),
        F.when(F.col("subreddit") != "error", F.col("subreddit")).alias("tag"),
        "author",
    )
    return {"twitter": twitter, "reddit_kaggle": reddit}


def scratch(spark: SparkSession) -> str:
    return own_path(spark, f"{shared_folder(spark)}/townsquare/{uuid.uuid4().hex}")


# --- sources and sinks (A) ----------------------------------------------------------------------


def csv_roundtrip(spark, folder):  # A1, A7
    df = documents(spark, folder).select("doc_id", "text", "lang", "n_chars")
    path, schema = writers.write_csv(df, scratch(spark)), df.schema
    # The texts hold line breaks, so their quoted fields span lines.
    return readers.read_csv(spark, path, schema, multi_line=True).withColumn("chars", F.length("text")).drop("text")


def raw_folder(spark, folder):  # A3, A4: rows per dataset of a raw folder; the missing location is skipped
    base = scratch(spark)
    frames = raw_frames(spark, folder)
    writers.write_csv(frames["twitter"], f"{base}/twitter.csv")
    writers.write_parquet(frames["reddit_kaggle"], f"{base}/reddit.parquet")
    found, path = readers.first_available(spark, [f"{base}/missing.csv", f"{base}/reddit.parquet"])
    out = found.agg(F.count(F.lit(1)).alias("count")).select(F.lit("first:reddit.parquet").alias("dataset"), "count")
    for name, df in readers.read_raw_folder(spark, base, multi_line=True).items():
        out = out.union(df.agg(F.count(F.lit(1)).alias("count")).select(F.lit(name), "count"))
    return out


def run_folders(spark, folder):  # A8, A9, A10: two runs stored, the newest one loaded again
    base = scratch(spark)
    df = posts(spark, folder)
    older = df.filter(filters.source_is("twitter"))
    for run_id, table in (("20240101_000000", older), ("20240201_000000", df)):
        writers.save_run(base, run_id, table, {"kpis": rollups.kpis(table), "empty": table.limit(0)})
    newest = readers.list_runs(spark, base)[0]
    loaded = rollups.kpis(readers.load_run(spark, base, newest))
    report = readers.load_report(spark, base, "kpis", newest)
    return loaded.select(F.lit(newest).alias("run_id"), "*").join(
        report.select("total_posts", F.col("total_engagement").alias("reported_engagement")), "total_posts"
    )


def seeded_sample(spark, folder):  # A5
    return readers.seeded_sample(posts(spark, folder).select("id", "data_source"), n=3000, key="id")


def combined_sources(spark, folder):  # A6, A11-A14, C7
    combined = shaping.combine_sources(raw_frames(spark, folder))
    return combined.select(
        "id",
        F.col("created_at").cast("date").alias("day"),
        "data_source",
        "subreddit",
        "user_id",
        "author",
        "retweet_count",
        "score",
    )


# --- filters and null handling (B) --------------------------------------------------------------


def imputed(spark, folder):  # B1-B4
    combined = shaping.combine_sources(raw_frames(spark, folder))
    df = filters.fill_unknown(combined.withColumn("text", filters.text_or_title(combined)))
    df = df.withColumn("total_engagement", F.col("retweet_count")).withColumn("audience", filters.audience(df))
    return filters.fill_metrics(df).select(
        "id", F.length("text").alias("chars"), "user_id", "author", "subreddit", "total_engagement", "audience"
    )


def filtered_posts(spark, folder):  # B5-B9, B11, B12
    df = filters.with_time(posts_from_tables(spark, folder, text=True))
    kept = df.filter(
        filters.in_sources(["twitter", "reddit_kaggle"])
        & filters.in_date_range(*DATE_RANGE)
        & (filters.source_contains("REDDIT") | filters.source_is("twitter"))
        & filters.longer_than("text")
    )
    return filters.available(kept, ["id", "data_source", "not_there", "subreddit"])


def complete_pairs(spark, folder):  # B10
    return filters.complete_pairs(posts(spark, folder), "score", "comments")


# --- scalar functions (C) -----------------------------------------------------------------------


def clean_text(spark, folder):  # C1
    return documents(spark, folder).select("doc_id", text.clean_text(F.col("text")).alias("text_cleaned"))


def clean_pages(spark, folder):  # C1 on markup
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    return pages.select("page_id", text.clean_text(F.col("html")).alias("text_cleaned"))


def word_count(spark, folder):  # C2
    cleaned = text.clean_text(F.col("text"))
    return documents(spark, folder).select("doc_id", text.word_count(cleaned).alias("word_count"))


def nlp_normalise(spark, folder):  # C3, C4
    return documents(spark, folder).select("doc_id", text.token_text(F.col("text")).alias("text_tokens_clean"))


def nlp_pages(spark, folder):  # C3, C4 on markup with site names
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    return pages.select("page_id", text.token_text(F.col("html")).alias("text_tokens_clean"))


def _plural_lemmas(tokenised: DataFrame) -> DataFrame:
    """Lemma table taken from the texts: a word ending in s whose stem is a word too."""
    words = tokenised.select(F.explode("tokens").alias("token")).distinct()
    stems = words.select(F.col("token").alias("lemma"))
    plural = words.filter(F.col("token").endswith("s")).withColumn("lemma", F.expr("left(token, length(token) - 1)"))
    return plural.join(stems, "lemma", "left_semi")


def _lemmatised(spark, folder, **limits):
    df = freeze(documents(spark, folder).select("doc_id", text.tokens(text.normalise(F.col("text"))).alias("tokens")))
    return text.lemmatise(df, "tokens", _plural_lemmas(df), **limits).select("doc_id", "text_tokens_clean")


def lemmatised(spark, folder):  # C5, table in the plan
    return _lemmatised(spark, folder)


def lemmatised_join(spark, folder):  # C5, table too large for the plan
    return _lemmatised(spark, folder, max_rows_in_plan=0)


def noun_lemmas(spark, folder):  # C5, words and the lemmas that rules and the vocabulary give
    df = documents(spark, folder).select(text.tokens(text.normalise(F.col("text"))).alias("tokens"))
    return lemmas.noun_lemmas(df, "tokens")


def lemmatised_nouns(spark, folder):  # C5 without a table
    df = freeze(documents(spark, folder).select("doc_id", text.tokens(text.normalise(F.col("text"))).alias("tokens")))
    return lemmas.lemmatise_nouns(df, "tokens").select("doc_id", "text_tokens_clean")


def domain_tags(spark, folder):  # C6
    cleaned = text.clean_text(F.col("text"))
    tags = text.domain_tags(cleaned, DOMAINS)
    return documents(spark, folder).select("doc_id", F.array_join(tags, "|").alias("tech_keywords"))


def parsed_times(spark, folder):  # C7
    raw = events(spark, folder).select(
        "event_id",
        F.when(F.col("event_id") % 3 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        .when(F.col("event_id") % 3 == 1, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .otherwise("not a date")
        .alias("iso"),
        (F.col("event_id") * 86_400).alias("unix"),
    )
    return raw.select(
        "event_id",
        F.date_format(features.parse_time(raw, "iso"), "yyyy-MM-dd HH:mm:ss").alias("iso"),
        F.date_diff(features.parse_time(raw, "unix").cast("date"), F.lit("1970-01-01").cast("date")).alias("unix_days"),
    )


def engagement_features(spark, folder):  # B4, C8-C12
    df = texts(spark, folder).withColumn("user_followers_count", F.coalesce("user_followers_count", F.lit(0.0)))
    df = freeze(df.drop("text", "text_cleaned", "sentiment_compound", "sentiment_polarity", "sentiment_label"))
    scaled = features.with_z_scores(features.with_engagement_rate(df))
    return rounded(
        scaled.select(
            "id",
            "user_followers_count",
            "twitter_engagement",
            "reddit_engagement",
            "total_engagement",
            "engagement_rate",
            "total_engagement_normalized",
            "word_count_normalized",
        ),
        "engagement_rate",
        "total_engagement_normalized",
        "word_count_normalized",
    )


def sentiment_score(spark, folder):  # C13-C16
    scored = sentiment.sentiment_compound(text.clean_text(F.col("text")))
    df = documents(spark, folder).select("doc_id", scored.alias("sentiment_compound"))
    score = F.col("sentiment_compound")
    return df.select(
        "doc_id",
        r("sentiment_compound", 4).alias("sentiment_compound"),
        sentiment.label_strict(score).alias("label_strict"),
        sentiment.label_inclusive(score).alias("sentiment_label"),
        r("sentiment_compound", 4).alias("sentiment_polarity"),
    )


def sentiment_rules(spark, folder):  # C13 with words frequent enough to exercise every rule
    scored = sentiment.sentiment_compound(
        text.clean_text(F.col("text")), RULE_LEXICON, RULE_BOOSTERS, RULE_NEGATORS
    )
    return documents(spark, folder).select("doc_id", r(scored, 4).alias("sentiment_compound"))


# --- data quality (D) ---------------------------------------------------------------------------


def sentiment_table(spark, folder):  # C13 with a lexicon table: every word of the texts from four letters on has a value
    df = documents(spark, folder).select("doc_id", text.clean_text(F.col("text")).alias("text_cleaned"))
    entry = F.explode(F.array_distinct(F.split("text_cleaned", sentiment.WORD_BREAK))).alias("entry")
    number = F.conv(F.substring(F.md5("entry"), 1, 4), 16, 10).cast("int") % 81 - 40
    # Stored, so that values are made of distinct words only: Spark would move the filter on them below the grouping.
    words = freeze(df.select(entry).distinct())
    lexicon = words.filter("length(entry) > 3").select("entry", (number / 10).alias("value")).filter("value != 0")
    return sentiment.with_table_sentiment(df, lexicon).select("doc_id", r("sentiment_compound", 4).alias("sentiment_compound"), "sentiment_label")


def source_detection(spark, folder):  # D1-D3
    rows = []
    for name, df in {**raw_frames(spark, folder), "events": posts(spark, folder)}.items():
        source = quality.detect_source(df, "part-0000.csv")
        for table in (quality.REQUIRED_COLUMNS, {"reddit": quality.STRICT_REDDIT_COLUMNS}):
            rows.append((name, source, len(table), ",".join(quality.missing_columns(df, source, table))))
    return spark.createDataFrame(rows, "dataset string, source string, rules int, missing string")


def quality_profile(spark, folder):  # D4-D7, D9
    facts = quality.profile(posts(spark, folder), date_range=("2024-01-05", "2024-01-20"))
    return facts.select(
        "column",
        "rows",
        r("null_share").alias("null_share"),
        r("spread").alias("spread"),
        "constant",
        F.to_date("first_time").alias("first_day"),
        F.to_date("last_time").alias("last_day"),
        "out_of_range",
    )


def quality_issues(spark, folder):  # D4-D7, D9
    df = posts(spark, folder).withColumn("author_post_karma", F.lit(7.0))
    found = quality.quality_issues(df, AS_OF, max_null_share=0.4, date_range=("2024-01-05", "2024-01-20"))
    return found.select("check", "column", r("value").alias("value"))


def validation_report(spark, folder):  # D8, with every issue and the overall status
    limits = {"max_null_share": 0.1, "null_checked": ("text",), "date_range": ("2024-01-05", "2024-01-20")}
    dated = posts(spark, folder, text=True).filter(filters.source_is("twitter")).select("id", "created_at", "text", "user_followers_count", "retweet_count")
    frames = raw_frames(spark, folder) | {"twitter_feed": dated}
    report = freeze(quality.validation_report(spark, frames, AS_OF - dt.timedelta(days=5), **limits))
    issue = F.transform("issues", lambda i: F.concat_ws(":", i["check"], i["column"], F.round(i["value"], 4).cast("decimal(20,4)"), i["message"]))
    return report.select(
        "dataset", "source", "status", F.array_join("missing", ",").alias("missing"), F.array_join(issue, "; ").alias("issues"),
        F.lit(quality.overall_status(report)).alias("overall_status"),
    )


# --- roll-ups (E) -------------------------------------------------------------------------------


def sentiment_distribution(spark, folder):  # E1
    return rollups.label_frequency(texts(spark, folder))


def platform_summary(spark, folder):  # E2
    return rollups.platform_summary(scored(spark, folder))


def domain_engagement(spark, folder):  # E3
    df = rollups.domain_engagement(texts(spark, folder), DOMAINS)
    return rounded(df, "mean_engagement", "mean_sentiment", digits=4)


def daily_metrics(spark, folder):  # E4
    return rounded(rollups.daily_metrics(texts(spark, folder)), "sentiment_polarity")


def daily_gaps(spark, folder):  # E4, E8: every fourth day moved 90 days on, so that days are missing
    moved = F.when(F.dayofmonth("created_at") % 4 == 2, F.col("created_at") + F.expr("interval 90 days"))
    return rollups.daily_volume(posts(spark, folder).withColumn("created_at", F.coalesce(moved, "created_at")))


def daily_describe(spark, folder):  # E5
    df = rollups.daily_describe(daily_table(spark, folder))
    return rounded(df, "mean", "std", "min", "q25", "q50", "q75", "max", digits=4)


def daily_volume_by_source(spark, folder):  # E6
    return rollups.daily_volume_by_source(posts(spark, folder))


def daily_sentiment(spark, folder):  # E7
    return rounded(rollups.daily_sentiment(texts(spark, folder)), "mean_sentiment")


def daily_volume(spark, folder):  # E8
    return rollups.daily_volume(posts(spark, folder))


def kpis(spark, folder):  # E9
    return rollups.kpis(posts(spark, folder))


def top_categories(spark, folder):  # E10
    return rollups.top_categories(posts(spark, folder))


def top_posts(spark, folder):  # E11
    # The fifty posts are found by their figures; only their texts are cleaned and scored.
    best = rollups.top_posts(posts(spark, folder, text=True), columns=("id", "created_at", "subreddit", "text", "total_engagement"))
    cleaned = freeze(best).withColumn("text_cleaned", text.clean_text(F.col("text")))
    return sentiment.with_sentiment(cleaned).select(*rollups.POST_COLUMNS)


def histogram(spark, folder):  # E12
    return rollups.histogram(posts(spark, folder))


def top_users(spark, folder):  # E13
    return rollups.top_users(posts(spark, folder))


def platform_pivot(spark, folder):  # E14
    df = posts(spark, folder)
    return rounded(rollups.platform_pivot(df, rollups.platforms(df)), "twitter", "reddit_kaggle")


def platform_pivot_exact(spark, folder):  # E14 on raw timestamps, here whole minutes so that some coincide
    df = posts(spark, folder).withColumn("created_at", F.date_trunc("minute", "created_at"))
    pivoted = rollups.platform_pivot(df, ["reddit_kaggle", "twitter"], grain="exact")
    minute = F.date_format("time", "yyyy-MM-dd HH:mm").alias("time")
    return pivoted.select(minute, r("reddit_kaggle").alias("reddit_kaggle"), r("twitter").alias("twitter"))


def distinct_users(spark, folder):  # E15
    return rollups.distinct_users(posts(spark, folder))


def date_extent(spark, folder):  # E15
    return rollups.date_extent(posts(spark, folder))


def sentiment_points(spark, folder):  # E16
    return rounded(rollups.sentiment_points(scored(spark, folder)), "sentiment_compound")


def sentiment_grid(spark, folder):  # E16 as cells
    return rollups.sentiment_grid(texts(spark, folder))


def length_points(spark, folder):  # E16
    return rounded(rollups.length_points(scored(spark, folder), key="id"), "sentiment_compound")


# --- statistics (F) -----------------------------------------------------------------------------


def normality_moments(spark, folder):  # F2
    row = normality.moments(posts(spark, folder), "total_engagement").first()
    k2, p = normality.omnibus_from_moments(row["n"], row["skewness"], row["kurtosis"])
    out = spark.createDataFrame(
        [(row["n"], row["skewness"], row["kurtosis"], k2, p)],
        "n long, skewness double, kurtosis double, k2 double, p_value double",
    )
    return rounded(rounded(out, "skewness", "kurtosis", "p_value"), "k2", digits=3)


def shapiro(spark, folder):  # the daily series is short enough for Shapiro-Wilk
    daily = daily_table(spark, folder)
    names = ["sentiment_polarity", "total_engagement", "reddit_engagement", "word_count"]
    report = normality.normality_report(daily, names)
    return rounded(report.select("name", "n", "test", "statistic"), "statistic")


def normality_gate(spark, folder):  # F3
    report = normality.normality_report(posts(spark, folder), ["total_engagement", "comments"])
    return report.select("name", "n", "test", "is_normal")


def pearson(spark, folder):  # F4
    return rounded(correlation.pearson(posts(spark, folder), "total_engagement", "user_followers_count"), "correlation")


def spearman(spark, folder):  # F5
    return rounded(correlation.spearman(posts(spark, folder), "score", "comments"), "correlation")


def kendall(spark, folder):  # F6
    df = correlation.kendall(posts(spark, folder), "score", "comments")
    counts = [F.col(c).cast("double").alias(c) for c in ("concordant", "discordant", "x_tied_pairs", "y_tied_pairs")]
    return df.select("n", *counts, r("correlation").alias("correlation"))


def adaptive_correlation(spark, folder):  # F7, F8
    report = correlation.compute_correlations(_correlated(spark, folder))
    return rounded(report, "correlation", "p_value")


def _correlated(spark, folder):
    columns = ("data_source", "user_followers_count", "word_count", "twitter_engagement", "reddit_engagement", "total_engagement")
    return measured(spark, folder, *columns).fillna(0.0, ["user_followers_count"])


def sentiment_correlations(spark, folder):  # F8, third family
    report = correlation.compute_correlations(
        scored(spark, folder),
        volume_vs_engagement=False,
        influencer_activity_vs_virality=False,
        sentiment_vs_commercial_metrics=True,
    )
    return rounded(report, "correlation", "p_value")


def levene(spark, folder):  # F9
    df = group_tests.levene(posts(spark, folder), "subreddit", "total_engagement", EVENT_TYPES)
    return rounded(df, "statistic")


def anova(spark, folder):  # F10
    return rounded(group_tests.anova(posts(spark, folder), "subreddit", "total_engagement", EVENT_TYPES), "statistic")


def kruskal(spark, folder):  # F11
    return rounded(group_tests.kruskal(posts(spark, folder), "subreddit", "total_engagement", EVENT_TYPES), "statistic")


def sentiment_comparison(spark, folder):  # F12
    rows = [group_tests.compare_sentiments(scored(spark, folder))]
    report = spark.createDataFrame(rows, group_tests.REPORT_SCHEMA)
    return rounded(report.select("name", "statistic", "p_value", "test_used", "significant"), "statistic", "p_value", digits=4)


def welch(spark, folder):  # F13
    df = group_tests.welch(posts(spark, folder), "data_source", "total_engagement", ("twitter", "reddit_kaggle"))
    return rounded(df, "statistic", "df", digits=4)


def mann_whitney(spark, folder):  # F14
    names = ("twitter", "reddit_kaggle")
    df = group_tests.mann_whitney(posts(spark, folder), "data_source", "total_engagement", names)
    return rounded(df, "statistic", "ties", digits=1)


def platform_comparison(spark, folder):  # F15
    df = features.with_engagement_rate(posts(spark, folder))
    report = spark.createDataFrame([group_tests.compare_platforms(df)], group_tests.REPORT_SCHEMA)
    return rounded(rounded(report.select("name", "statistic", "p_value", "test_used", "significant"), "p_value"), "statistic", digits=1)


def adf(spark, folder):  # F16
    df = timeseries.stationarity(daily_table(spark, folder))
    return rounded(df, "test_statistic", "p_value")


def adf_lag0(spark, folder):  # F16
    return rounded(
        timeseries.stationarity(daily_table(spark, folder), max_lag=0).select("column", "test_statistic", "lags", "n"),
        "test_statistic",
    )


def seasonal(spark, folder):  # F17
    daily = daily_table(spark, folder).select("day", "total_engagement")
    parts = timeseries.decompose(daily, "total_engagement")
    return rounded(parts, "trend", "seasonal", "resid", digits=4)


def seasonal_multiplicative(spark, folder):  # F17
    daily = daily_table(spark, folder).select("day", "total_engagement")
    parts = timeseries.decompose(daily, "total_engagement", "multiplicative")
    return rounded(parts, "trend", "seasonal", "resid")


def reddit_volume(spark, folder):  # F18
    report = correlation.reddit_volume_correlation(measured(spark, folder, "data_source", "word_count", "reddit_engagement"))
    return rounded(report, "correlation", "p_value")


def cross_platform(spark, folder):  # F19
    df = posts(spark, folder)
    names = rollups.platforms(df)
    report = correlation.cross_platform_correlation(rollups.platform_pivot(df, names), names)
    return rounded(report, "correlation", "p_value")


def findings(spark, folder):  # F20
    df = scored(spark, folder, "text_cleaned")
    summary = jobs.analysis_summary(
        correlation.compute_correlations(df),
        group_tests.statistical_tests(features.with_engagement_rate(df)),
        rollups.domain_engagement(df, DOMAINS),
    )
    return summary.withColumn("significant_findings", F.array_join("significant_findings", "; "))


# --- topics (G) ---------------------------------------------------------------------------------


def _topic_input(spark, folder):
    return documents(spark, folder).select("doc_id", text.token_text(F.col("text")).alias("text_tokens_clean"))


def vocabulary(spark, folder):  # G1
    return topics.vocabulary(_topic_input(spark, folder), "text_tokens_clean")


def topic_terms(spark, folder):  # G1-G3
    return topics.describe_topics(topics.fit_topics(_topic_input(spark, folder), k=3)).select("topic", "label")


def dominant_topics(spark, folder):  # G4
    df = _topic_input(spark, folder)
    return topics.dominant_topic(df, topics.fit_topics(df, k=3)).select("doc_id", "dominant_topic")


# --- graphs (H) ---------------------------------------------------------------------------------


def _community(spark, folder) -> graph.Graph:
    return graph.community_graph(posts_from_tables(spark, folder))


def _replies(spark, folder) -> graph.Graph:
    return graph.reply_graph(posts_from_tables(spark, folder, replies=True))


def community_edges(spark, folder):  # H1
    return _community(spark, folder).edges


def community_nodes(spark, folder):  # H1
    return _community(spark, folder).nodes.select("id", "type", "source", "followers")


def reply_edges(spark, folder):  # H2
    return _replies(spark, folder).edges


def graph_metrics(spark, folder):  # H3, H4
    named = [("community", _community(spark, folder)), ("replies", _replies(spark, folder))]
    parts = [graph.graph_metrics(g).select(F.lit(name).alias("graph"), "*") for name, g in named]
    return rounded(parts[0].union(parts[1]), "average_degree", "density")


def degree_centrality(spark, folder):  # H5
    return rounded(graph.degree_centrality(_replies(spark, folder)), "centrality")


def top_central(spark, folder):  # H5
    return rounded(graph.top_central(_replies(spark, folder)), "centrality")


def pagerank_10(spark, folder):  # H6
    ranks = graph.pagerank(_community(spark, folder), max_rounds=10, tolerance=None)
    return ranks.select("id", r("rank", 8).alias("rank"))


def pagerank(spark, folder):  # H6 until settled
    return rounded(graph.pagerank(graph.interaction_graph(posts_from_tables(spark, folder, replies=True))), "rank")


def influencers(spark, folder):  # H7
    return rounded(graph.influencers(_community(spark, folder)), "rank_score")


def influencers_20(spark, folder):  # H7 after exactly twenty rounds
    return rounded(graph.influencers(_community(spark, folder), max_rounds=20, tolerance=None), "rank_score", digits=8)


# --- monitoring (K) and whole jobs (L) ----------------------------------------------------------


def sentiment_alerts(spark, folder):  # K1
    # Days whose texts score 0 lie below this threshold.
    return rounded(monitor.sentiment_alerts(texts(spark, folder), threshold=0.01), "mean_sentiment")


def volume_alerts(spark, folder):  # K2, at one sigma
    return rounded(monitor.volume_alerts(posts(spark, folder), sigma=1.0), "limit")


def weak_correlations(spark, folder):  # K3
    report = correlation.compute_correlations(_correlated(spark, folder))
    return rounded(monitor.weak_correlations(report), "correlation")


def control_limits(spark, folder):  # K4
    return rounded(monitor.control_limits(posts(spark, folder)), "centre_line", "upper_limit")


def _live(spark, folder) -> DataFrame:
    """The posts of ``posts_from_tables`` as a stream of the event table, with the sentiment of their texts."""
    source = spark.readStream.schema(events(spark, folder).schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    live = source.select(
        F.col("ts").alias("created_at"),
        F.when(F.col("event_id") % 2 == 0, "twitter").otherwise("reddit_kaggle").alias("data_source"),
        F.col("value").alias("total_engagement"),
        F.col("event_id").alias("doc_id"),
    )
    known = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    cleaned = live.join(known, "doc_id", "left").withColumn("text_cleaned", text.clean_text(F.col("text")))
    return sentiment.with_sentiment(cleaned)


def daily_stream(spark, folder):  # K5: all input taken as a stream; only closed days come out
    out, checkpoint = scratch(spark), scratch(spark)
    stream.start_daily(stream.daily_stream(_live(spark, folder)), out, checkpoint).awaitTermination()
    closed = spark.read.schema("data_source string, count long, total_engagement double, mean_sentiment double, day date").parquet(out)
    return rounded(rounded(closed, "total_engagement", digits=4), "mean_sentiment")


def sentiment_drop_stream(spark, folder):  # K5: closed days below the threshold
    out, checkpoint = scratch(spark), scratch(spark)
    low = stream.sentiment_drop_stream(_live(spark, folder), threshold=0.01).select("day", "data_source", "mean_sentiment")
    stream.start_daily(low, out, checkpoint).awaitTermination()
    return rounded(spark.read.schema("day date, data_source string, mean_sentiment double").parquet(out), "mean_sentiment")


def watch_stream(spark, folder):  # K5 with K1, K2, E7: running figures and alerts of the closed days, from keyed state
    out, checkpoint = scratch(spark), scratch(spark)
    live_alerts.start_watch(live_alerts.watch_stream(_live(spark, folder), drop=0.01, sigma=1.0), out, checkpoint).awaitTermination()
    closed = spark.read.schema(monitor.WATCH_SCHEMA).parquet(out)
    return rounded(closed, "mean_sentiment", "recent_sentiment", "limit")


def daily_watch(spark, folder):  # the same over a finished table, all days
    watched = monitor.daily_watch(texts(spark, folder), drop=0.01, sigma=1.0)
    return rounded(watched, "mean_sentiment", "recent_sentiment", "limit")


def monitoring_read(spark, folder):  # A10, E6, E9, E10, E12, K1, K2: a committed run read again; a run that broke off is not seen
    base = scratch(spark)
    table = scored(spark, folder, "text_cleaned")
    writers.save_run(base, "20240101_000000", table, {"kpis": rollups.kpis(table)})
    broken = table.withColumn("word_count", F.assert_true(F.lit(False), "this run breaks off").cast("int"))
    with contextlib.suppress(Exception):
        writers.save_run(base, "20240201_000000", table, {"kpis": broken})
    newest = readers.list_runs(spark, base)[0]
    read = monitor.monitoring(spark, base, newest, sources=["twitter", "reddit_kaggle"], dates=DATE_RANGE, sentiment_drop=0.01, volume_sigma=1.0)
    figure = F.col("value").cast("double")
    kpi = read["kpis"].select(F.explode(F.array(*(
        F.struct(F.lit(c).alias("item"), F.col(c).cast("double").alias("value"))
        for c in ("total_posts", "reddit_posts", "twitter_posts", "total_engagement")
    ))).alias("e")).select(F.lit("kpis").alias("part"), "e.*")
    parts = [
        kpi,
        read["daily_volume"].select(F.lit("daily_volume"), F.concat_ws(" ", F.col("day").cast("string"), "data_source"), F.col("count")),
        read["top_categories"].select(F.lit("top_categories"), "subreddit", F.col("posts")),
        read["histogram"].select(F.lit("histogram"), F.col("bin").cast("string"), F.col("count")),
        read["top_posts"].select(F.lit("top_posts"), "id", F.col("total_engagement")),
        read["alerts"].select(F.lit("alerts"), F.concat_ws(": ", "level", "title", "detail"), F.lit(1.0)),
    ]
    whole = reduce(DataFrame.union, parts).select(F.lit(newest).alias("run_id"), "part", "item", r(figure, 4).alias("value"))
    return whole


def rollups_over_runs(spark, folder):  # E2, E4, E6, E9 from the states of three runs; posts are not read again, a broken run not at all
    base = scratch(spark)
    table = scored(spark, folder)
    for number in range(3):
        part = table.where(F.pmod(F.crc32("id"), F.lit(3)) == number)
        writers.save_run(base, f"2024010{number + 1}_000000", None, {}, states=run_states.post_states(part))
    broken = {"daily": run_states.post_states(table)["daily"].withColumn("posts", F.raise_error(F.lit("this run breaks off")).cast("long"))}
    with contextlib.suppress(Exception):
        writers.save_run(base, "20240201_000000", None, {}, states=broken)
    daily, engagement = (readers.load_states(spark, base, name) for name in ("daily", "engagement"))

    def figures(part: str, df: DataFrame, *keys: str) -> DataFrame:
        names = [c for c in df.columns if c not in keys]
        entries = F.array(*(F.struct(F.lit(c).alias("figure"), F.col(c).cast("double").alias("value")) for c in names))
        item = F.concat_ws(" ", *(F.col(k).cast("string") for k in keys)).alias("item")
        return df.select(F.lit(part).alias("part"), item, F.explode(entries).alias("e")).select("part", "item", "e.figure", r("e.value").alias("value"))

    return reduce(DataFrame.union, [
        figures("platform_summary", run_states.platform_summary(daily, engagement), "data_source"),
        figures("daily_metrics", run_states.daily_metrics(daily), "day"),
        figures("daily_volume_by_source", run_states.daily_volume_by_source(daily), "day", "data_source"),
        figures("kpis", run_states.kpis(daily)),
    ])


def analysis_job(spark, folder):  # L3: the figures of the analysis sections over one post table, in long form
    params = jobs.Params(domains=DOMAINS, network_metrics=("community_metrics", "top_users"))
    table = scored(spark, folder, "text_cleaned", "author")
    found = jobs.analyse(table, params)

    def figures(section: str, key: str, *columns: str) -> DataFrame:
        entries = F.array(*(F.struct(F.lit(c).alias("figure"), F.col(c).cast("double").alias("value")) for c in columns))
        return found[section].select(F.lit(section).alias("section"), F.col(key).alias("item"), F.explode(entries).alias("e")).select("section", "item", "e.*")

    found["community_metrics"] = found["community_metrics"].withColumn("graph", F.lit("community"))
    parts = [
        figures("correlations", "name", "n", "correlation", "p_value"),
        figures("cross_platform", "data_source", "total_engagement_mean", "total_engagement_sum", "total_engagement_median"),
        figures("technology_domains", "domain", "count", "mean_engagement", "mean_sentiment"),
        figures("daily_summary", "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max"),
        figures("top_users", "user_id", "total_engagement"),
        figures("community_metrics", "graph", "number_of_nodes", "number_of_edges", "average_degree", "density"),
        figures("summary", "status", "correlations", "statistical_tests", "domains_analyzed"),
    ]
    return reduce(DataFrame.unionByName, parts).withColumn("value", r("value", 4))


def stored_job(spark, folder):  # L4, A9, A10: the whole job stored as a run; its posts and reports read again
    base = scratch(spark)
    params = jobs.Params(domains=DOMAINS, as_of=AS_OF, topics=False, enabled={"network": False})
    jobs.run_job(spark, raw_frames(spark, folder), params, out=(base, "20240301_000000"))
    run_id = readers.list_runs(spark, base)[0]
    stored = readers.load_run(spark, base, run_id)
    count = F.count(F.lit(1)).cast("double")
    by_source = stored.groupBy("data_source").agg(count.alias("posts"), F.sum("total_engagement").alias("total_engagement"),
                                                  F.sum("word_count").cast("double").alias("word_count"))
    long = by_source.select("data_source", F.explode(F.array(*(
        F.struct(F.lit(c).alias("figure"), F.col(c).alias("value")) for c in ("posts", "total_engagement", "word_count")
    ))).alias("e")).select(F.lit("posts").alias("part"), F.col("data_source").alias("item"), "e.*")
    labels = readers.load_report(spark, base, "sentiment_distribution", run_id)
    status = readers.load_report(spark, base, "validation_status", run_id)
    return long.union(
        labels.select(F.lit("sentiment_distribution"), "sentiment_label", F.lit("count"), F.col("count").cast("double"))
    ).union(status.select(F.lit("validation_status"), "overall_status", F.lit("datasets"), F.lit(2.0)))


def transform_job(spark, folder):  # L1
    df = jobs.transform_posts(raw_frames(spark, folder))
    return rounded(
        df.select(
            "id",
            "data_source",
            "subreddit",
            "author",
            "word_count",
            "user_followers_count",
            "total_engagement",
            "engagement_rate",
            "total_engagement_normalized",
            "word_count_normalized",
            "sentiment_label",
        ),
        "engagement_rate",
        "total_engagement_normalized",
        "word_count_normalized",
    )


def nlp_job(spark, folder):  # L2
    df = documents(spark, folder).select(F.col("doc_id").alias("id"), "text")
    result = jobs.enrich_text(df, DOMAINS)
    return result.posts.select(
        "id", "text_tokens_clean", "sentiment_label", F.array_join("tech_keywords", "|").alias("tech_keywords")
    )


def full_job(spark, folder):  # L3, L4: every section's row count
    params = jobs.Params(domains=DOMAINS, decomposition="additive", as_of=AS_OF)
    with scratch_scope():
        sections = jobs.run_job(spark, raw_frames(spark, folder), params)
        rows = [(name, df.count()) for name, df in sections.items()]
    return spark.createDataFrame(rows, "section string, rows long")


QUERIES: tuple[Callable[[SparkSession, str], DataFrame], ...] = (
    platform_summary,
    csv_roundtrip,
    raw_folder,
    run_folders,
    seeded_sample,
    combined_sources,
    imputed,
    filtered_posts,
    complete_pairs,
    clean_text,
    clean_pages,
    word_count,
    nlp_normalise,
    nlp_pages,
    lemmatised,
    lemmatised_join,
    noun_lemmas,
    lemmatised_nouns,
    domain_tags,
    parsed_times,
    engagement_features,
    sentiment_score,
    sentiment_rules,
    sentiment_table,
    source_detection,
    quality_profile,
    quality_issues,
    validation_report,
    sentiment_distribution,
    domain_engagement,
    daily_metrics,
    daily_gaps,
    daily_describe,
    daily_volume_by_source,
    daily_sentiment,
    daily_volume,
    kpis,
    top_categories,
    top_posts,
    histogram,
    top_users,
    platform_pivot,
    platform_pivot_exact,
    distinct_users,
    date_extent,
    sentiment_points,
    sentiment_grid,
    length_points,
    normality_moments,
    shapiro,
    normality_gate,
    pearson,
    spearman,
    kendall,
    adaptive_correlation,
    sentiment_correlations,
    levene,
    anova,
    kruskal,
    sentiment_comparison,
    welch,
    mann_whitney,
    platform_comparison,
    adf,
    adf_lag0,
    seasonal,
    seasonal_multiplicative,
    reddit_volume,
    cross_platform,
    findings,
    vocabulary,
    topic_terms,
    dominant_topics,
    community_edges,
    community_nodes,
    reply_edges,
    graph_metrics,
    degree_centrality,
    top_central,
    pagerank_10,
    pagerank,
    influencers,
    influencers_20,
    sentiment_alerts,
    volume_alerts,
    weak_correlations,
    control_limits,
    daily_stream,
    sentiment_drop_stream,
    watch_stream,
    daily_watch,
    monitoring_read,
    rollups_over_runs,
    transform_job,
    nlp_job,
    analysis_job,
    stored_job,
    full_job,
)


def entry(spark: SparkSession) -> DataFrame:
    return platform_summary(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every registered query by name."""
    return {query.__name__: query for query in QUERIES} | (text_queries.QUERIES if text_queries else {})


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for every query that SQL can express on whole tables."""
    from oracles import ORACLES

    return ORACLES | (text_queries.ORACLES if text_queries else {})
