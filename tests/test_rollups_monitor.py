"""E and K: roll-ups, top lists, alerts and the daily stream."""

import datetime as dt
import math
import tempfile

import pytest
from pyspark.sql import functions as F

from tests.conftest import column
from townsquare.operators import rollups, run_states
from townsquare.plans import monitor
from townsquare.sources import readers, runs, writers
from townsquare.streaming import alerts, daily

SCHEMA = (
    "id string, created_at timestamp, data_source string, user_id string, subreddit string, "
    "total_engagement double, reddit_engagement double, word_count int, sentiment_polarity double, text_cleaned string"
)


def posts(spark, *rows):
    filled = [
        (str(i), dt.datetime(2024, 1, d, 12), s, u, sub, e, e, 2, p, t)
        for i, (d, s, u, sub, e, p, t) in enumerate(rows)
    ]
    return spark.createDataFrame(filled, SCHEMA).withColumn("sentiment_compound", F.col("sentiment_polarity"))


@pytest.fixture
def few(spark):
    return posts(
        spark,
        (1, "twitter", "a", "x", 1.0, 0.5, "ai and python"),
        (1, "twitter", "b", "x", 3.0, -0.5, "ai"),
        (1, "reddit", "unknown", "y", 100.0, 0.1, "none"),
        (4, "twitter", "a", "y", 8.0, -0.4, "big data"),
        (4, "reddit", None, "z", 2.0, -0.2, None),
    )


def test_e1_e2_e3(spark, few):
    labels = few.withColumn("sentiment_label", F.lit("neutral"))
    assert rollups.label_frequency(labels).first()["count"] == 5
    rows = {r["data_source"]: r for r in rollups.platform_summary(few).collect()}
    assert rows["twitter"]["total_engagement_median"] == 3.0
    assert rows["reddit"]["total_engagement_median"] == 51.0
    assert rows["twitter"]["total_engagement_sum"] == 12.0 and rows["twitter"]["sentiment_polarity_count"] == 3
    assert rows["twitter"]["sentiment_polarity_std"] == pytest.approx(0.5508)
    domains = {r["domain"]: r for r in rollups.domain_engagement(few, ["AI", "Python", "Cloud"]).collect()}
    assert set(domains) == {"AI", "Python"}
    assert domains["AI"]["count"] == 2 and domains["AI"]["mean_engagement"] == 2.0


def test_e4_e5_e7_e8(spark, few):
    metrics = rollups.daily_metrics(few).orderBy("day").collect()
    assert [r["day"].day for r in metrics] == [1, 4]
    assert metrics[0]["total_engagement"] == 104.0
    sentiment = rollups.daily_sentiment(few).orderBy("day").collect()
    assert [r["day"].day for r in sentiment] == [1, 2, 3, 4]
    assert sentiment[1]["mean_sentiment"] is None
    assert column(rollups.daily_volume(few).orderBy("day"), "count") == [3, 0, 0, 2]
    facts = {r["column"]: r for r in rollups.daily_describe(rollups.daily_metrics(few)).collect()}
    assert facts["total_engagement"]["q50"] == 57.0 and facts["total_engagement"]["count"] == 2
    by_source = {(r["day"].day, r["data_source"]): r["count"] for r in rollups.daily_volume_by_source(few).collect()}
    assert by_source == {(1, "twitter"): 2, (1, "reddit"): 1, (4, "twitter"): 1, (4, "reddit"): 1}


def test_e9_e13(spark, few):
    assert tuple(rollups.kpis(few).first()) == (5, 2, 3, 114.0)
    assert tuple(rollups.kpis(few.limit(0)).first()) == (0, 0, 0, 0.0)
    assert column(rollups.top_categories(few, n=2), "subreddit") == ["x", "y"]
    assert column(rollups.top_posts(few, n=2), "id") == ["2", "3"]
    assert [tuple(r) for r in rollups.top_users(few).collect()] == [("a", 9.0), ("b", 3.0)]


def test_e12_histogram(spark, few):
    bins = {r["bin"]: r["count"] for r in rollups.histogram(few, bins=4).collect()}
    assert bins == {1: 4, 4: 1}
    constant = few.withColumn("total_engagement", F.lit(5.0))
    assert [tuple(r) for r in rollups.histogram(constant).collect()] == [(1, 5)]


def test_e14_e15_e16(spark, few):
    names = rollups.platforms(few)
    assert names == ["reddit", "twitter"]
    rows = rollups.platform_pivot(few, names).orderBy("time").collect()
    assert [(r["reddit"], r["twitter"]) for r in rows] == [(100.0, 2.0), (2.0, 8.0)]
    assert rollups.platform_pivot(few, names, grain="exact").count() == 2
    assert rollups.distinct_users(few).count() == 3
    assert tuple(rollups.date_extent(few).first()) == (dt.date(2024, 1, 1), dt.date(2024, 1, 4))
    assert rollups.sentiment_points(few).count() == 5
    assert rollups.length_points(few, n=3).count() == 3


def test_k1_sentiment_alerts(spark, few):
    # The last three calendar days are 2 (empty), 3 (empty) and 4.
    assert [r["day"].day for r in monitor.sentiment_alerts(few).collect()] == [4]
    assert monitor.sentiment_alerts(few, threshold=-0.5).count() == 0


def test_k2_k4_volume(spark):
    rows = [(d, "twitter", "a", "x", 1.0, 0.0, "t") for d in range(1, 11) for _ in range(30 if d == 7 else 2)]
    df = posts(spark, *rows)
    assert [r["day"].day for r in monitor.volume_alerts(df).collect()] == [7]
    assert monitor.volume_alerts(df.filter(F.dayofmonth("created_at").between(5, 9))).count() == 0
    limits = monitor.control_limits(df).first()
    assert limits["centre_line"] == 4.8 and limits["upper_limit"] == pytest.approx(4.8 + 2 * 8.8544, abs=1e-3)


def test_k3_and_alert_list(spark, few):
    found = spark.createDataFrame([("weak", 0.1), ("strong", -0.9), ("undefined", None)], "name string, correlation double")
    assert sorted(column(monitor.weak_correlations(found), "name")) == ["undefined", "weak"]
    listed = {(r["level"], r["detail"]) for r in monitor.alerts(few, found).collect()}
    assert listed == {("critical", "2024-01-04"), ("info", "weak"), ("info", "undefined")}


def test_k5_stream_drops_late_rows(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "created_at timestamp, data_source string, total_engagement double, sentiment_compound double"
    checkpoint = str(tmp_path / "checkpoint")

    def feed(*rows):
        spark.createDataFrame(
            [(dt.datetime(2024, 1, d, h), s, e, c) for d, h, s, e, c in rows], schema
        ).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        daily.start_daily(daily.daily_stream(stream), out, checkpoint).awaitTermination()

    feed((1, 10, "twitter", 2.0, 0.5), (1, 11, "twitter", 4.0, -0.9), (1, 12, "reddit", 1.0, 0.0))
    feed((5, 0, "twitter", 1.0, 0.0))  # watermark: day 3
    feed((1, 13, "twitter", 100.0, 1.0), (9, 0, "twitter", 1.0, 0.0))  # the first row is too late
    rows = {(r["day"].day, r["data_source"]): r for r in spark.read.parquet(out).collect()}
    assert set(rows) == {(1, "twitter"), (1, "reddit"), (5, "twitter")}
    assert rows[1, "twitter"]["count"] == 2 and rows[1, "twitter"]["total_engagement"] == 6.0
    assert rows[1, "twitter"]["mean_sentiment"] == pytest.approx(-0.2)


def test_k5_sentiment_drop(spark):
    folder = tempfile.mkdtemp(prefix="townsquare-stream-")
    schema = "created_at timestamp, data_source string, sentiment_compound double"
    rows = [(dt.datetime(2024, 1, d, 1), "twitter", s) for d, s in ((1, -0.5), (2, 0.5), (9, 0.0))]
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/in")
    stream = daily.sentiment_drop_stream(spark.readStream.schema(schema).parquet(f"{folder}/in"))
    daily.start_daily(stream, f"{folder}/out", f"{folder}/cp").awaitTermination()
    assert [r["day"].day for r in spark.read.parquet(f"{folder}/out").collect()] == [1]


def test_e16_grid_counts_every_post_once(spark, few):
    cells = rollups.sentiment_grid(few.withColumn("sentiment_compound", F.col("sentiment_polarity"))).collect()
    assert sum(r["count"] for r in cells) == few.count()
    by_id = {r["id"]: r for r in few.collect()}
    for r in cells:
        post = by_id[r["id"]]
        assert (post["data_source"], post["total_engagement"]) == (r["data_source"], r["total_engagement"])
        assert r["engagement_bin"] == int(math.log2(post["total_engagement"] + 1))
        assert (r["sentiment_bin"] - 1) / 20 - 1 <= post["sentiment_compound"] + 1e-9 <= r["sentiment_bin"] / 20 - 1 + 1e-6
    same = few.unionByName(few.withColumn("id", F.concat("id", F.lit("x"))))
    assert rollups.sentiment_grid(same).count() == len(cells)


WATCHED = "created_at timestamp, data_source string, sentiment_compound double"


def watched_rows(df):
    return sorted(
        (r["data_source"], r["day"], r["count"], *(None if v is None else round(v, 9) for v in (r["mean_sentiment"], r["recent_sentiment"], r["limit"])),
         r["volume_alert"], r["sentiment_alert"])
        for r in df.collect()
    )


def test_live_watch_equals_batch_with_late_rows(spark):
    folder = tempfile.mkdtemp(prefix="townsquare-watch-")
    source, out, checkpoint = (f"{folder}/{name}" for name in ("in", "out", "cp"))

    def at(d, source, sentiment=0.1, hour=9):
        return (dt.datetime(2024, 3, 1, hour) + dt.timedelta(days=d), source, sentiment)

    kept = [at(0, "quiet"), at(1, "quiet", -0.9), at(3, "gappy", 0.2)]
    kept += [at(d, "busy", 0.3 - 0.1 * d) for d in range(12) for _ in range(2 + d % 3)]
    surge = [at(9, "busy", -0.5, 11)] * 30 + [at(9, "gappy", None), at(7, "gappy", -0.2)]
    late_but_kept = [at(10, "busy", 0.9, 1), at(10, "gappy", 0.9, 1)]
    too_late = [at(1, "busy", 0.9, 3), at(0, "gappy", 0.9, 3)]
    nobody = [(None, "busy", 0.1), (dt.datetime(2024, 3, 5), None, 0.1)]
    steps = [kept[:20], kept[20:] + surge, late_but_kept + too_late + nobody, [at(15, "other"), at(14, "busy")], [at(16, "busy")]]
    for rows in steps:
        spark.createDataFrame(rows, WATCHED).coalesce(1).write.mode("append").parquet(source)
        stream = alerts.watch_stream(spark.readStream.schema(WATCHED).parquet(source), min_days=3, sigma=1.0)
        alerts.start_watch(stream, out, checkpoint).awaitTermination()
    counted = [r for r in [*kept, *surge, *late_but_kept, at(14, "busy"), at(15, "other"), at(16, "busy")]]
    # The last watermark is day 14, 9 o'clock: day 13 is the last one closed.
    expected = monitor.daily_watch(spark.createDataFrame(counted, WATCHED), sigma=1.0, min_days=3, through=F.lit(dt.date(2024, 3, 14)))
    got = watched_rows(spark.read.schema(monitor.WATCH_SCHEMA).parquet(out))
    assert got == watched_rows(expected)
    assert {r[0] for r in got} == {"busy", "quiet", "gappy"} and len(got) == 14 + 14 + 11
    assert any(r[-2] for r in got) and any(r[-1] for r in got)
    assert "HDFSBacked" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")


def test_daily_watch_is_k1_and_k2_on_each_day(spark):
    rows = [(dt.datetime(2024, 5, d, 8), "one", s) for d, s in ((1, 0.1), (2, -0.4), (2, -0.6), (5, 0.2)) for _ in range(d)]
    df = spark.createDataFrame(rows, WATCHED)
    watched = monitor.daily_watch(df, sigma=1.0, min_days=2).orderBy("day").collect()
    for r in watched:
        upto = df.filter(F.to_date("created_at") <= F.lit(r["day"]))
        if r["count"]:
            assert (r["day"] in column(monitor.volume_alerts(upto, 1.0, 2), "day")) == r["volume_alert"]
            assert (r["day"] in column(monitor.sentiment_alerts(upto), "day")) == r["sentiment_alert"]
    assert [r["count"] for r in watched] == [1, 4, 0, 0, 5]


def test_rollups_from_run_states_equal_those_of_all_posts(spark, tmp_path):
    rows = [
        (dt.datetime(2024, 1, 1 + i % 7, i % 24) if i % 11 else None, ("twitter", "reddit_kaggle", "reddit_kaggle", None)[i % 4],
         float(i * i % 37) if i % 5 else None, float(i % 13), i % 17, 1e6 + (i % 19) / 7 if i % 3 else None)
        for i in range(300)
    ]
    schema = "created_at timestamp, data_source string, total_engagement double, reddit_engagement double, word_count int, sentiment_polarity double"
    posts = spark.createDataFrame(rows, schema).withColumn("number", F.monotonically_increasing_id())
    base = str(tmp_path)
    # Runs of unlike size, an empty one, and one without the sentiment column; each saved on its own.
    for run_id, condition in (("r1", "number % 10 < 7"), ("r2", "number % 10 >= 7"), ("r3", "false")):
        part = posts.where(condition)
        writers.save_run(base, run_id, None, {}, states=run_states.post_states(part if run_id != "r3" else part.drop("sentiment_polarity")))
    daily, engagement = (readers.load_states(spark, base, name) for name in ("daily", "engagement"))
    assert all("/states/" in name for name in daily.inputFiles() + engagement.inputFiles())

    def same(left, right):
        assert left.columns == right.columns
        a, b = (sorted((tuple(r) for r in df.collect()), key=repr) for df in (left, right))
        assert len(a) == len(b)
        for x, y in ((u, v) for r, s in zip(a, b, strict=True) for u, v in zip(r, s, strict=True)):
            assert x == (pytest.approx(y, rel=1e-9) if isinstance(y, float) else y)

    same(run_states.platform_summary(daily, engagement), rollups.platform_summary(posts))
    same(run_states.daily_metrics(daily), rollups.daily_metrics(posts))
    same(run_states.daily_volume_by_source(daily), rollups.daily_volume_by_source(posts))
    same(run_states.kpis(daily), rollups.kpis(posts))
    one = readers.load_states(spark, base, "daily", ["r2"])
    same(run_states.kpis(one), rollups.kpis(posts.where("number % 10 >= 7")))
    with pytest.raises(runs.NotCommitted):
        readers.load_states(spark, base, "daily", ["r2", "r9"])


def test_run_states_of_posts_without_the_columns(spark):
    bare = spark.createDataFrame([("twitter", dt.datetime(2024, 1, 1))], "data_source string, created_at timestamp")
    states = run_states.post_states(bare)
    assert list(states) == ["daily"] and run_states.post_states(bare.drop("created_at")) == {}
    assert [tuple(r) for r in run_states.platform_summary(states["daily"]).collect()] == [("twitter", 1)]
    assert run_states.kpis(states["daily"].limit(0)).first()["total_posts"] == 0
