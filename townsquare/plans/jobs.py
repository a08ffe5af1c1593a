"""The post table and the reports as whole jobs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from functools import partial, reduce
from typing import Literal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from townsquare.functions.features import with_engagement, with_engagement_rate, with_z_scores
from townsquare.functions.filters import audience, fill_metrics, fill_unknown, text_or_title
from townsquare.functions.lemmas import lemmatise_nouns
from townsquare.functions.sentiment import with_sentiment
from townsquare.functions.text import clean_text, domain_tags, lemmatise, normalise, tokens, word_count
from townsquare.operators import graph as graphs
from townsquare.operators import topics as topic_models
from townsquare.operators.correlation import (
    compute_correlations,
    cross_platform_correlation,
    reddit_volume_correlation,
)
from townsquare.operators.group_tests import statistical_tests
from townsquare.operators.quality import REQUIRED_COLUMNS, overall_status, validation_report
from townsquare.operators.rollups import (
    daily_describe,
    daily_metrics,
    domain_engagement,
    label_frequency,
    platform_pivot,
    platform_summary,
    platforms,
    top_users,
)
from townsquare.operators.run_states import post_states
from townsquare.operators.timeseries import decompose, stationarity
from townsquare.plans.monitor import alerts
from townsquare.runtime import freeze
from townsquare.schema import TECHNOLOGY_DOMAINS
from townsquare.sources.shaping import combine_sources
from townsquare.sources.writers import save_run

STAGES = ("validation", "transformation", "nlp", "network", "analysis")
NETWORK_SECTIONS = ("community_metrics", "community_influencers", "reply_metrics", "reply_centrality", "top_users")


@dataclass(frozen=True)
class Params:
    """Switches and settings of a run."""

    enabled: Mapping[str, bool] = field(default_factory=dict)
    domains: tuple[str, ...] = TECHNOLOGY_DOMAINS
    karma_as_audience: bool = False
    topics: bool = True
    num_topics: int = 5
    seed: int = 42
    correlations: Mapping[str, bool] = field(default_factory=dict)
    tests: Mapping[str, bool] = field(default_factory=dict)
    decomposition: str | None = None
    pivot_grain: str = "day"
    required_columns: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: REQUIRED_COLUMNS)
    #: Posts after this time are reported as of the future; unset, the time of the run.
    as_of: dt.datetime | None = None
    max_null_share: float | None = None
    null_checked: tuple[str, ...] | None = None
    date_range: tuple[str, str] | None = None
    min_df: float = 2
    max_df: float | int = 0.95
    alert_limits: Mapping[str, float] = field(default_factory=dict)
    network_metrics: tuple[str, ...] = NETWORK_SECTIONS

    def quality_limits(self) -> dict:
        limits = {"max_null_share": self.max_null_share, "null_checked": self.null_checked, "date_range": self.date_range}
        return {name: value for name, value in limits.items() if value is not None}

    def on(self, stage: str) -> bool:
        return self.enabled.get(stage, True)


def add_features(posts: DataFrame, karma_as_audience: bool = False) -> DataFrame:
    """Everything that needs only the row itself."""
    df = posts
    if "text" in df.columns:
        df = df.withColumn("text", text_or_title(df)).withColumn("text_cleaned", clean_text(F.col("text")))
        df = df.withColumn("word_count", word_count(F.col("text_cleaned")))
    return with_engagement(df.withColumn("user_followers_count", audience(df, karma_as_audience)))


def transform_posts(
    frames: Mapping[str, DataFrame],
    enabled: bool = True,
    karma_as_audience: bool = False,
    enrich: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame | None:
    """L1: union of sources → features → sentiment → imputation → rate and z-scores.

    Text is cleaned and scored once, into a written table; the rate's maximum and the z-scores'
    means then come from two narrow columns of it. ``enrich`` (see ``enrich_columns``) runs before
    that table is written, so that a job with both steps reads and writes the texts once.
    """
    if not enabled:
        return None
    posts = combine_sources(frames)
    if posts is None:
        return None
    df = add_features(posts, karma_as_audience)
    if enrich is None:
        df = with_sentiment(df, inclusive=False)
    df = fill_metrics(fill_unknown(df))
    table = freeze(df if enrich is None else enrich(df))
    return with_z_scores(with_engagement_rate(table), drop_constant=True)


def enrich_columns(
    posts: DataFrame, domains: Iterable[str] = TECHNOLOGY_DOMAINS, lemmas: DataFrame | Literal["rules"] | None = None
) -> DataFrame:
    """L2, row by row: tokens (lemmas if a table, or ``"rules"`` for nouns, is given), final sentiment label and domain tags.

    Tokens come from the post's text, else its title; a table with neither is returned as it is.
    Sentiment and tags read the cleaned text, in which digits and marks survive.
    """
    if not {"text", "title"} & set(posts.columns):
        return posts
    text = F.col("text") if "text" in posts.columns else F.col("title")
    df = posts if "text_cleaned" in posts.columns else posts.withColumn("text_cleaned", clean_text(text))
    df = df.withColumn("__tokens", tokens(normalise(text)))
    if lemmas is None:
        df = df.withColumn("text_tokens_clean", F.array_join("__tokens", " "))
    elif isinstance(lemmas, DataFrame):
        df = lemmatise(df, "__tokens", lemmas)
    elif lemmas == "rules":
        df = lemmatise_nouns(df, "__tokens")
    else:
        raise ValueError(f"lemmas are a table or 'rules', not {lemmas!r}")
    return with_sentiment(df.drop("__tokens")).withColumn("tech_keywords", domain_tags(F.col("text_cleaned"), domains))


@dataclass(frozen=True)
class NlpResult:
    posts: DataFrame
    topics: DataFrame | None
    sentiment_distribution: DataFrame


def text_reports(posts: DataFrame, topics: bool = True, num_topics: int = 5, seed: int = 42, **limits) -> NlpResult:
    """L2, over the whole table: topics and the label frequency of enriched (stored) posts."""
    model = topic_models.fit_topics(posts, k=num_topics, seed=seed, **limits) if topics else None
    return NlpResult(posts, topic_models.describe_topics(model) if model else None, label_frequency(posts))


def enrich_text(
    posts: DataFrame, domains: Iterable[str] = TECHNOLOGY_DOMAINS, lemmas: DataFrame | Literal["rules"] | None = None, **topic_settings
) -> NlpResult | None:
    """L2 as a job of its own; ``None`` if the table has neither text nor title."""
    if not {"text", "title"} & set(posts.columns):
        return None
    return text_reports(freeze(enrich_columns(posts, domains, lemmas)), **topic_settings)


def network_sections(posts: DataFrame, wanted: Iterable[str] = NETWORK_SECTIONS) -> dict[str, DataFrame]:
    """H1-H7 for the community graph and the reply graph, named apart.

    Ranks that do not settle leave the influencers out; any other error is raised.
    """
    wanted = set(wanted)
    graph = graphs.community_graph(posts)
    frozen = graphs.Graph(freeze(graph.nodes), freeze(graph.edges))
    replies = graphs.reply_graph(posts)
    frozen_replies = graphs.Graph(freeze(replies.nodes), freeze(replies.edges))
    sections = {
        "community_metrics": lambda: graphs.graph_metrics(frozen),
        "community_influencers": lambda: graphs.influencers(frozen),
        "reply_metrics": lambda: graphs.graph_metrics(frozen_replies),
        "reply_centrality": lambda: graphs.top_central(frozen_replies),
        "top_users": lambda: top_users(posts),
    }
    found = {}
    for name, section in sections.items():
        if name in wanted:
            try:
                found[name] = section()
            except graphs.NotSettled:
                continue
    return found


def analysis_summary(
    correlations: DataFrame, tests: DataFrame, domains: DataFrame | None
) -> DataFrame:
    """one row with counts and a sentence per significant correlation."""
    sentence = F.format_string(
        "Correlation %s is significant (p=%.4f) using %s", "name", "p_value", "method_used"
    )
    found = correlations.agg(
        F.count(F.lit(1)).alias("correlations"),
        F.array_sort(F.collect_list(F.when(F.col("significant"), sentence))).alias("significant_findings"),
    )
    return found.select(
        F.lit("completed").alias("status"),
        "correlations",
        tests.agg(F.count(F.lit(1))).scalar().alias("statistical_tests"),
        (domains.agg(F.count(F.lit(1))).scalar() if domains is not None else F.lit(0)).alias("domains_analyzed"),
        "significant_findings",
    )


def analyse(posts: DataFrame, params: Params = Params()) -> dict[str, DataFrame]:
    """L3: every analysis section, by name, over one written post table."""
    if not params.on("analysis"):
        return {}
    columns = set(posts.columns)
    sections = {
        "correlations": compute_correlations(posts, **params.correlations),
        "statistical_tests": statistical_tests(posts, **params.tests),
    }
    if params.on("network") and {"user_id", "data_source"} <= columns:
        sections |= network_sections(posts, params.network_metrics)
    if "created_at" in columns:
        daily = freeze(daily_metrics(posts))
        if len(daily.columns) > 1 and daily.count() >= 7:
            sections["stationarity"] = stationarity(daily)
            if params.decomposition:
                parts = [
                    decompose(daily, c, params.decomposition).withColumn("column", F.lit(c))
                    for c in ("sentiment_polarity", "total_engagement")
                    if c in daily.columns
                ]
                sections["decomposition"] = reduce(DataFrame.unionByName, parts)
            sections["daily_summary"] = daily_describe(daily)
    if "text_cleaned" in columns:
        sections["technology_domains"] = domain_engagement(posts, params.domains)
    if "data_source" in columns:
        sections["cross_platform"] = platform_summary(posts)
        specific = []
        if {"word_count", "reddit_engagement"} <= columns:
            specific.append(reddit_volume_correlation(posts))
        if {"created_at", "total_engagement"} <= columns:
            names = platforms(posts)
            pivoted = platform_pivot(posts, names, grain=params.pivot_grain)
            specific.append(cross_platform_correlation(pivoted, names))
        if specific:
            sections["project_specific_metrics"] = reduce(DataFrame.unionByName, specific)
        sections["alerts"] = alerts(posts, sections["correlations"], **params.alert_limits)
    sections["summary"] = analysis_summary(
        sections["correlations"], sections["statistical_tests"], sections.get("technology_domains")
    )
    return sections


def run_job(
    spark: SparkSession,
    frames: Mapping[str, DataFrame],
    params: Params = Params(),
    lemmas: DataFrame | Literal["rules"] | None = None,
    out: tuple[str, str] | None = None,
) -> dict[str, DataFrame]:
    """L4: the whole job over one DataFrame per source; ``out`` = (base folder, run id) also stores it.

    Each stage can be switched off; later stages then work with what there is.
    """
    results: dict[str, DataFrame] = {}
    validated = params.on("validation")
    if validated:
        results["validation"] = validation_report(
            spark, frames, params.as_of or dt.datetime.now(dt.UTC).replace(tzinfo=None), params.required_columns,
            **params.quality_limits(),
        )
    status = overall_status(results["validation"] if validated and frames else None, validated)
    results["validation_status"] = spark.createDataFrame([(status,)], "overall_status string")
    enrich = partial(enrich_columns, domains=params.domains, lemmas=lemmas) if params.on("nlp") else None
    posts = transform_posts(frames, params.on("transformation"), params.karma_as_audience, enrich)
    if posts is None:
        return results
    if "text_tokens_clean" in posts.columns:
        nlp = text_reports(
            posts, params.topics, params.num_topics, params.seed, min_df=params.min_df, max_df=params.max_df
        )
        results["sentiment_distribution"] = nlp.sentiment_distribution
        if nlp.topics is not None:
            results["topics"] = nlp.topics
    results |= analyse(posts, params)
    results["posts"] = posts
    if out is not None:
        reports = {name: df for name, df in results.items() if name != "posts"}
        save_run(out[0], out[1], posts, reports, states=post_states(posts))
    return results
