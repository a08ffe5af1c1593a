"""A and D: reading, writing, shaping and checking raw data."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import column
from townsquare.operators import quality
from townsquare.schema import REDDIT_RAW, TWITTER_RAW
from townsquare.sources import readers, runs, shaping, writers

NOW = dt.datetime(2024, 1, 1)


def test_a1_a7_csv(spark, tmp_path):
    rows = [("1", 'He said "hi", then\nleft', 5), ("2", "  padded  ", None), ("3", None, -1)]
    path = str(tmp_path / "out.csv")
    writers.write_csv(spark.createDataFrame(rows, "id string, text string, score long"), path)
    schema = spark.createDataFrame([], "text string, id string, score long, extra double").schema
    got = readers.read_csv(spark, path, schema, multi_line=True).orderBy("id").collect()
    assert [(r["id"], r["text"], r["score"]) for r in got] == rows
    assert got[0]["extra"] is None and got[0].asDict().keys() == {"text", "id", "score", "extra"}
    assert dict(readers.read_csv(spark, path).dtypes)["score"] == "int"


def test_a1_bad_numbers_become_null(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,retweet_count\na,12\nb,many\n")
    got = readers.read_csv(spark, str(tmp_path / "t.csv"), TWITTER_RAW).orderBy("id")
    assert column(got, "retweet_count") == [12, None]


def test_a1_large_files_are_split(spark, tmp_path):
    path = tmp_path / "large.csv"
    path.write_text("id,retweet_count\n" + "abcdefgh,12\n" * 40_000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        df = readers.read_csv(spark, str(path), TWITTER_RAW)
        assert df.rdd.getNumPartitions() > 3 and df.filter("retweet_count = 12").count() == 40_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a2_a8_parquet(spark, twitter, tmp_path):
    path = writers.write_parquet(twitter, str(tmp_path / "t.parquet"))
    assert readers.read_parquet(spark, path).count() == 3
    assert any(p.name.endswith(".snappy.parquet") for p in (tmp_path / "t.parquet").iterdir())


def test_a3_raw_folder(spark, twitter, reddit, tmp_path):
    folder = str(tmp_path / "raw")
    writers.write_csv(reddit, f"{folder}/forum_dump.csv")
    writers.write_parquet(twitter, f"{folder}/tw.parquet")
    (tmp_path / "raw" / "one.csv").write_text("id,text\n1,low tide\n")
    (tmp_path / "raw" / ".hidden.csv").write_text("id\n1\n")
    (tmp_path / "raw" / "notes.txt").write_text("x")
    found = readers.read_raw_folder(spark, folder)
    assert {name: df.count() for name, df in found.items()} == {"forum_dump.csv": 3, "tw.parquet": 3, "one.csv": 1}


def test_a4_fallback(spark, twitter, tmp_path):
    good = writers.write_parquet(twitter, str(tmp_path / "b.parquet"))
    df, path = readers.first_available(spark, [str(tmp_path / "a.csv"), str(tmp_path / "x.txt"), good])
    assert path == good and df.count() == 3
    assert readers.first_available(spark, [str(tmp_path / "a.csv")]) is None


def test_a5_sample(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("id"), (F.col("id") % 3).alias("v"))
    first = {r["id"] for r in readers.seeded_sample(df, 500).collect()}
    again = {r["id"] for r in readers.seeded_sample(df.repartition(7), 500).collect()}
    other = {r["id"] for r in readers.seeded_sample(df, 500, seed=7).collect()}
    assert len(first) == 500 and first == again and first != other
    assert readers.seeded_sample(df, 6000).count() == 5000
    copies = spark.range(3000).select(F.lit("same").alias("id"))
    assert readers.seeded_sample(copies, 1000).count() == 1000


def test_a4_a7_ingest(spark, twitter, reddit, tmp_path):
    raw = str(tmp_path)
    local = writers.write_csv(reddit, f"{raw}/forum_dump.csv")
    feed = writers.write_csv(twitter, f"{raw}/short_posts.csv")
    places = {"reddit_kaggle": [f"{raw}/download.csv", local], "twitter": [feed], "gone": [f"{raw}/none.csv"]}
    assert writers.ingest(spark, places, raw) == {"reddit_kaggle": local, "twitter": feed}
    paths = writers.ingest(spark, places, raw, sampled=("reddit_kaggle",), n=2)
    assert paths == {"reddit_kaggle": f"{raw}/reddit_kaggle_sampled.csv", "twitter": feed}
    sampled = readers.read_csv(spark, paths["reddit_kaggle"], REDDIT_RAW)
    assert column(sampled, "data_source") == ["reddit_kaggle"] * 2
    assert writers.ingest(spark, places, raw, enabled=False) == {}


def test_a9_a10_runs(spark, twitter, tmp_path):
    base = str(tmp_path / "outputs")
    assert readers.list_runs(spark, base) == []
    counts = twitter.groupBy("data_source").count()
    writers.save_run(base, "20230101_120000", twitter.limit(1), {"volume": counts})
    writers.save_run(base, "20240101_120000", twitter, {"volume": counts, "none": counts.limit(0), "off": None})
    writers.save_run(base, "20250101_120000", None, {"volume": counts})
    assert readers.list_runs(spark, base) == ["20240101_120000", "20230101_120000"]
    assert readers.load_run(spark, base, "20230101_120000").count() == 1
    assert readers.load_run(spark, base, "20240101_120000").columns == twitter.columns
    assert readers.load_report(spark, base, "volume", "20240101_120000").first()["count"] == 3
    assert not (tmp_path / "outputs" / "reports" / "none").exists()


def test_quoted_lines_over_many_splits(spark, tmp_path):
    """A file cut into splits of a few hundred bytes gives the same rows as one read whole."""
    import random

    rng = random.Random(6)
    parts = ["plain", 'a "quoted" word', "two\nlines", "", "\n\n", "x" * 700, 'end"', "comma, here", "é\r\nü", '"']
    rows = [(k, rng.choice(parts) + rng.choice(parts), rng.choice([None, 1.5])) for k in range(400)]
    rows[100] = (100, "\n".join(f'line {i} of "many"' for i in range(200)), 2.0)  # spans several splits
    folder = str(tmp_path / "long.csv")
    writers.write_csv(spark.createDataFrame(rows, "id int, text string, score double").coalesce(1), folder)
    schema = "score double, id int, text string, none string"
    schema = spark.createDataFrame([], schema).schema
    whole = readers.read_csv(spark, folder, schema, multi_line=True, balanced_quotes=False).collect()
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in ("300", "2000", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "0")
            records = readers.quoted_records(spark, folder)
            assert records.count() == 401 and records.where("first").count() == 1
            split = readers.read_csv(spark, folder, schema, multi_line=True)
            assert sorted(map(repr, split.collect())) == sorted(map(repr, whole))
            if size != "128m":
                assert spark.read.text(folder).rdd.getNumPartitions() > 20
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert {r["id"]: r["text"] for r in whole}[100] == rows[100][1]
    assert dict(readers.read_csv(spark, folder, multi_line=True).dtypes) == {"id": "int", "text": "string", "score": "double"}


def test_a_failed_run_is_no_run(spark, twitter, tmp_path):
    base = str(tmp_path / "outputs")
    counts = twitter.groupBy("data_source").count()
    broken = twitter.select(F.raise_error(F.lit("broken on purpose")).cast("string").alias("x"))
    writers.save_run(base, "20240101", twitter, {"volume": counts})
    for posts, reports in ((broken, {"volume": counts}), (twitter, {"volume": counts, "worse": broken})):
        with pytest.raises(Exception, match="broken on purpose"):
            writers.save_run(base, "20250101", posts, reports)
    assert (tmp_path / "outputs" / "posts" / "run_id=20250101").exists()
    assert readers.list_runs(spark, base) == ["20240101"]
    for load in (lambda: readers.load_run(spark, base, "20250101"), lambda: readers.load_report(spark, base, "volume", "20250101"),
                 lambda: readers.load_report(spark, base, "worse", "20240101")):
        with pytest.raises(runs.NotCommitted):
            load()
    writers.save_run(base, "20250101", twitter, {"volume": counts})
    assert readers.list_runs(spark, base) == ["20250101", "20240101"]
    # A failed second attempt takes the first one's place away: its folders are no longer what was committed.
    with pytest.raises(Exception, match="broken on purpose"):
        writers.save_run(base, "20250101", twitter, {"worse": broken})
    assert readers.list_runs(spark, base) == ["20240101"]
    assert [entry["sections"] for entry in runs.committed(spark, base)] == [["volume"]]


def test_a6_a11_a14_shaping(spark, twitter, reddit):
    untagged = reddit.drop("tag").withColumnRenamed("title", " Title ")
    combined = shaping.combine_sources({"twitter": twitter, "reddit_kaggle": reddit, "reddit_b": untagged, "off": None})
    rows = {(r["data_source"], r["id"]): r for r in combined.collect()}
    assert len(rows) == 9 and {k[0] for k in rows} == {"twitter", "reddit_kaggle", "reddit_b"}
    assert rows["reddit_kaggle", "rd2"]["subreddit"] == "technology"
    assert rows["reddit_b", "rd1"]["subreddit"] == "technology"
    assert rows["reddit_b", "rd1"]["title"] == "Heat pumps"
    assert rows["twitter", "tw1"]["subreddit"] is None and rows["twitter", "tw1"]["score"] is None
    assert rows["reddit_kaggle", "rd1"]["created_at"] == dt.datetime(2022, 5, 1, 10)
    assert rows["twitter", "tw2"]["created_at"] == dt.datetime(2022, 5, 2)
    assert shaping.combine_sources({}) is None


def test_d1_source_detection(spark, twitter, reddit):
    assert quality.detect_source(twitter, "x.csv") == "twitter"
    assert quality.detect_source(reddit, "twitter.csv") == "reddit"
    plain = spark.createDataFrame([(1,)], "score int")
    assert quality.detect_source(plain, "reddit-2019.csv") == "reddit"
    assert quality.detect_source(plain, "x.csv") == "unknown"
    assert quality.detect_source(plain.withColumnRenamed("score", "retweet_count"), "random_name.csv") == "twitter"
    assert quality.detect_source(plain.withColumnRenamed("score", "subreddit"), "x.csv") == "reddit"


def test_d2_d3_schema(spark, twitter, reddit):
    assert quality.missing_columns(twitter, "twitter") == []
    assert quality.missing_columns(twitter.drop("user_followers_count"), "twitter") == ["user_followers_count"]
    assert quality.missing_columns(reddit, "reddit") == []
    bare = reddit.select("post_id", "score", "datetime")
    assert quality.missing_columns(bare, "reddit") == ["text", "content_text"]
    assert "content_text" not in quality.missing_columns(bare.withColumn("body", F.lit("b")), "reddit")
    assert column(quality.schema_report(bare, "reddit"), "column") == ["text", "content_text"]
    assert quality.missing_columns(bare, "commercial") == ["amazon_tech_sales_velocity", "created_at"]


def issues(df, **limits):
    return {(r["check"], r["column"]) for r in quality.quality_issues(df, NOW, **limits).collect()}


def test_d4_d7_quality(spark, twitter):
    assert issues(twitter) == set()
    assert issues(twitter.withColumn("user_followers_count", F.lit(None).cast("double"))) == {
        ("nulls", "user_followers_count")
    }
    assert issues(twitter.withColumn("retweet_count", F.lit(3))) == {("variance", "retweet_count")}
    assert issues(twitter.limit(1)) == set()
    assert issues(twitter.limit(0)) == {("empty", None)}
    assert issues(twitter.withColumn("created_at", F.lit("1999-01-01"))) == {("old_dates", "created_at")}
    assert issues(twitter.withColumn("created_at", F.lit("2030-01-01"))) == {("future_dates", "created_at")}
    unix = spark.createDataFrame([(1, 946684800)], "id int, created_utc long")
    assert issues(unix) == {("old_dates", "created_utc")}
    assert issues(spark.createDataFrame([], "other int")) == {("empty", None)}


def test_d9_configured_limits(spark, twitter):
    half = twitter.withColumn("text", F.when(F.col("id") == "tw1", F.col("text")))
    assert issues(half, max_null_share=0.4, null_checked=["text"]) == {("nulls", "text")}
    assert issues(twitter, date_range=("2022-05-02", "2026-01-01")) == {("date_range", "created_at")}


def test_d8_report(spark, twitter, reddit):
    report = quality.validation_report(spark, {"tw.csv": twitter, "rd.csv": reddit.drop("score")}, NOW)
    rows = {r["dataset"]: r for r in report.collect()}
    assert rows["tw.csv"]["status"] == "PASSED" and rows["tw.csv"]["issues"] == []
    assert rows["rd.csv"]["status"] == "FAILED" and rows["rd.csv"]["missing"] == ["score"]
    assert quality.overall_status(report) == "FAILED"
    assert quality.overall_status(report.filter("source = 'twitter'")) == "PASSED"
    assert quality.overall_status(report, enabled=False) == "SKIPPED"
    assert quality.overall_status(None) == "FAILED"
    assert quality.validation_report(spark, {}, NOW).count() == 0


def test_intermediate_folder_is_the_clusters(spark):
    from townsquare.runtime import freeze, shared_folder

    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    frozen = freeze(spark.range(3))
    assert frozen.count() == 3
    assert all(shared_folder(spark) in f for f in frozen.inputFiles())
    with pytest.raises(Exception):
        readers.read_any(spark, "x.txt")
