"""L: whole jobs, and properties of the physical plans."""

import datetime as dt
import importlib

import pytest
from pyspark.sql import functions as F

from tests.conftest import column
from townsquare.operators import rollups
from townsquare.plans import jobs
from townsquare.schema import ENRICHED_POST
from townsquare.sources import readers

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def driver():
    return importlib.import_module("__spark_entry__")


def test_l1_transform(spark, twitter, reddit):
    df = jobs.transform_posts({"twitter": twitter, "reddit_kaggle": reddit})
    rows = {r["id"]: r for r in df.collect()}
    assert "solar roof is great" in rows["tw1"]["text_cleaned"]
    assert rows["tw1"]["sentiment_label"] == "positive"
    assert rows["rd2"]["text"] == "Draughty doors" and rows["rd2"]["user_id"] == "unknown"
    assert rows["rd2"]["total_engagement"] == 54.0 and rows["tw2"]["total_engagement"] == 137.0
    assert max(r["engagement_rate"] for r in rows.values()) == 1.0
    assert {"total_engagement_normalized", "word_count_normalized"} <= set(df.columns)
    assert jobs.transform_posts({"twitter": twitter}, enabled=False) is None
    assert jobs.transform_posts({}) is None


def test_l2_nlp(spark):
    df = spark.createDataFrame([("Two sheds with solar tiles", "Sheds")], "text string, title string")
    result = jobs.enrich_text(df, ["Solar"])
    row = result.posts.first()
    assert row["text_tokens_clean"] == "two sheds solar tiles" and row["tech_keywords"] == ["Solar"]
    assert result.topics is None and result.sentiment_distribution.first()["count"] == 1
    assert column(jobs.enrich_text(df.select("title")).posts, "text_cleaned") == ["sheds"]
    assert jobs.enrich_text(df.select(F.lit(1).alias("x"))) is None


def test_l2_nouns_by_rules(spark):
    df = spark.createDataFrame([("Two sheds with solar tiles",), ("One shed",), ("That shed",), (None,)], "text string")
    assert column(jobs.enrich_columns(df, lemmas="rules"), "text_tokens_clean") == ["two shed solar tiles", "one shed", "shed", ""]
    with pytest.raises(ValueError, match="'rules'"):
        jobs.enrich_columns(df, lemmas="all")


def test_f20_summary(spark):
    found = spark.createDataFrame(
        [("length_and_replies", 0.44, 0.0312, "kendall", True), ("faint", 0.07, 0.61, "spearman", False)],
        "name string, correlation double, p_value double, method_used string, significant boolean",
    )
    other = spark.range(1)
    row = jobs.analysis_summary(found, other, other).first()
    assert (row["status"], row["correlations"], row["statistical_tests"], row["domains_analyzed"]) == ("completed", 2, 1, 1)
    assert row["significant_findings"] == ["Correlation length_and_replies is significant (p=0.0312) using kendall"]


def test_l3_l4_whole_job(spark, driver, tmp_path):
    frames = driver.raw_frames(spark, SMALL)
    params = jobs.Params(domains=driver.DOMAINS, num_topics=2, decomposition="additive", enabled={"network": False})
    base = str(tmp_path / "outputs")
    results = jobs.run_job(spark, frames, params, out=(base, "run1"))
    wanted = {
        "validation", "validation_status", "sentiment_distribution", "topics", "correlations", "statistical_tests",
        "stationarity", "decomposition", "daily_summary", "technology_domains", "cross_platform",
        "project_specific_metrics", "alerts", "summary", "posts",
    }
    assert wanted <= set(results) and "community_metrics" not in results
    assert readers.list_runs(spark, base) == ["run1"]
    stored = readers.load_run(spark, base, "run1")
    assert stored.count() == 1000
    known = {f.name: f.dataType for f in ENRICHED_POST}
    for field in stored.schema:
        if field.name in known and field.name != "created_at":
            assert field.dataType == known[field.name], field
    report = readers.load_report(spark, base, "cross_platform", "run1")
    assert report.count() == 2


def test_l3_network_and_switches(spark, driver):
    assert jobs.analyse(spark.range(1), jobs.Params(enabled={"analysis": False})) == {}
    posts = jobs.transform_posts(driver.raw_frames(spark, SMALL))
    sections = jobs.network_sections(posts)
    assert sections["community_metrics"].first()["number_of_nodes"] > 0
    assert sections["reply_centrality"].count() == 10
    off = jobs.run_job(spark, {"a": posts}, jobs.Params(enabled={"validation": False, "transformation": False}))
    assert column(off["validation_status"], "overall_status") == ["SKIPPED"] and set(off) == {"validation_status"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_stay_in_the_jvm_and_prune(spark, driver):
    for name in ("clean_text", "nlp_normalise", "sentiment_score", "domain_tags", "kpis", "top_posts", "daily_metrics"):
        plan = plan_of(driver.queries()[name](spark, SMALL))
        assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan, name
    kpis = plan_of(driver.queries()["kpis"](spark, SMALL))
    assert "text" not in kpis.split("ReadSchema: ")[1].splitlines()[0]


def test_plans_have_no_global_window_over_posts(spark, driver):
    posts = driver.posts(spark, SMALL)
    plan = plan_of(rollups.histogram(posts))
    assert "Window" not in plan and "SinglePartition" in plan
    summary = plan_of(rollups.platform_summary(driver.scored(spark, SMALL)))
    assert "Window" in summary and "percentile" not in summary


def test_date_filter_reaches_the_scan(spark, driver):
    import datetime as dt

    from townsquare.functions import filters
    from townsquare.sources.tables import posts_from_tables

    df = posts_from_tables(spark, SMALL).filter(filters.in_date_range(dt.date(2024, 1, 2), dt.date(2024, 1, 3)))
    pushed = plan_of(df).split("PushedFilters: ")[1].splitlines()[0]
    assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed


def test_same_result_under_other_partitioning(spark, driver):
    posts = driver.scored(spark, SMALL)
    base = rollups.platform_summary(posts).orderBy("data_source").collect()
    for n in (1, 7):
        assert rollups.platform_summary(posts.repartition(n)).orderBy("data_source").collect() == base


def test_every_oracle_belongs_to_a_query(driver):
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert set(driver.queries()) >= {query.__name__ for query in driver.QUERIES}


def test_entry(spark, driver):
    assert driver.entry(spark).count() == 2


def test_pagerank_rounds_do_not_shuffle_arcs(spark, driver, monkeypatch):
    from townsquare.operators import graph

    plans, write = [], graph.write_intermediate

    def record(df):
        plans.append(plan_of(df))
        return write(df)

    monkeypatch.setattr(graph, "write_intermediate", record)
    monkeypatch.setattr(graph, "ARCS_PER_BUCKET", 1)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        graph.pagerank(driver._community(spark, SMALL), max_rounds=3, tolerance=None, rounds_per_write=3)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    (plan,) = plans
    assert plan.count("SortMergeJoin") == 3 and plan.count("FileScan parquet spark_catalog.default.townsquare_arcs_") == 3
    # One shuffle for the starting ranks, then one per round: none of them moves arcs.
    assert plan.count("Exchange hashpartitioning") == 4


def test_scratch_scope_deletes_what_it_wrote(spark):
    import os

    from townsquare import runtime

    folder = f"{runtime.shared_folder(spark)}/townsquare"
    outer = runtime.freeze(spark.range(3))
    before = set(os.listdir(folder))
    with pytest.raises(KeyError), runtime.scratch_scope():
        assert runtime.freeze(spark.range(4)).count() == 4
        assert set(os.listdir(folder)) != before
        raise KeyError
    assert set(os.listdir(folder)) == before and outer.count() == 3


def test_monitoring_read(spark, driver, tmp_path):
    from townsquare.plans import monitor
    from townsquare.sources import writers

    base = str(tmp_path / "runs")
    df = driver.scored(spark, SMALL, "text_cleaned")
    writers.save_run(base, "r1", df, {})
    read = monitor.monitoring(spark, base, "r1", sources=["reddit_kaggle", "twitter"], volume_sigma=1.0, sentiment_drop=1.0)
    assert read["kpis"].first()["total_posts"] == df.count()
    reddit = df.filter("data_source = 'reddit_kaggle'")
    assert read["top_posts"].count() == 50 and read["histogram"].agg(F.sum("count")).first()[0] == reddit.count()
    assert {"sentiment drop"} <= {r["title"] for r in read["alerts"].collect()}
    only = monitor.monitoring(spark, base, "r1", sources=["twitter"])
    assert only["top_categories"].count() == 0 and only["kpis"].first()["reddit_posts"] == 0


def test_as_of_defaults_to_now(spark, twitter, reddit):
    late = twitter.withColumn("created_at", F.lit("2026-03-01"))
    report = jobs.run_job(spark, {"twitter": late}, jobs.Params(topics=False, enabled={"transformation": False}))["validation"]
    issues = [i["check"] for r in report.collect() for i in r["issues"]]
    assert "future_dates" not in issues
    old = jobs.Params(topics=False, enabled={"transformation": False}, as_of=dt.datetime(2020, 1, 1))
    issues = [i["check"] for r in jobs.run_job(spark, {"twitter": late}, old)["validation"].collect() for i in r["issues"]]
    assert "future_dates" in issues


def test_shared_folder_rules():
    from types import SimpleNamespace

    from townsquare.runtime import shared_folder

    class Conf(dict):
        set = dict.__setitem__

    def session(master, **conf):
        return SimpleNamespace(conf=Conf(conf), sparkContext=SimpleNamespace(master=master))

    assert shared_folder(session("yarn", **{"spark.checkpoint.dir": "hdfs://x/cp/"})) == "hdfs://x/cp"
    with pytest.raises(RuntimeError):
        shared_folder(session("yarn"))
    local = session("local[2]")
    assert shared_folder(local) == shared_folder(local)
