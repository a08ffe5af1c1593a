"""B and C: filters, null handling, text, time, engagement and sentiment."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import column
from townsquare.functions import features, filters, lemmas, sentiment, text


def texts(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, text string")


def one(spark, value, expression):
    return texts(spark, value).select(expression(F.col("text")).alias("x")).first()["x"]


def reference_clean(value):
    if value is None:
        return ""
    value = value.lower()
    for pattern, new in ((r"http\S+|www\S+", ""), (r"<.*?>", ""), (r"[^a-zA-Z0-9áéíóúñü¿?¡!.,;:\s]", "")):
        value = re.sub(pattern, new, value)
    return re.sub(r"\s+", " ", value).strip()


def reference_tokens(value):
    value = (value or "").lower()
    value = re.sub(r"http\S+|www\S+|https\S+", "", value)
    value = re.sub(r"\S*\.com\S*|\S*\.org\S*", "", value)
    value = re.sub(r"[^a-zA-Z\s]", "", value)
    for first, second in text.FUSED_WORDS:
        value = re.sub(rf"\b{first}{second}\b", f"{first} {second}", value)
    return [w for w in value.split() if w not in text.STOP_WORDS and len(w) > 2]


SAMPLES = [
    None,
    "",
    "   ",
    "Tide TABLES? Look here: http://harbour.test",
    "<a href=http://x.org>link</a> and <b>bold</b> text",
    "tabs\tand\nnew\r\nlines\x0bhere\x85x\xa0y\u2003z\u2028w\u3000v\x1cu",
    "wwwwhat www.site.com/x?y=1 http: httpx whttp://a b",
    "Ñandú áéíóú çâê — “quotes” ¿qué? ¡sí! a.b,c;d:e",
    "< not a tag\n> end <tag\nbroken> <>",
    "mail me@site.com or visit data.org/path.com now .com .org x.comx",
    "I cannot gonna wanna gimme it; cannots lemmexx gotta",
    "emoji 😀 and ünïcode ÀÉ ẞ",
    "a  b   c    d",
    "single",
]


def test_c1_clean_text_equals_plain_regexes(spark):
    got = column(texts(spark, *SAMPLES).orderBy("id").select(text.clean_text(F.col("text")).alias("t")), "t")
    assert got == [reference_clean(s) for s in SAMPLES]


def test_c1_c4_random_texts(spark):
    rng = random.Random(5)
    alphabet = list("abcwhtpAZ09 .,<>\n\t:/éñ\u2003\xa0\x1c@") + ["http", "www", ".com", ".org", "cannot", "gonna", " "]
    values = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    rows = (
        texts(spark, *values)
        .orderBy("id")
        .select(
            text.clean_text(F.col("text")).alias("clean"),
            text.tokens(text.normalise(F.col("text"))).alias("tokens"),
            text.word_count(text.clean_text(F.col("text"))).alias("words"),
        )
        .collect()
    )
    for value, row in zip(values, rows):
        assert row["clean"] == reference_clean(value), repr(value)
        assert row["words"] == len(reference_clean(value).split()), repr(value)
        assert row["tokens"] == reference_tokens(value), repr(value)


def test_c2_word_count(spark):
    count = lambda v: one(spark, v, text.word_count)
    assert (count(""), count(None), count("one"), count("two words")) == (0, 0, 1, 2)


def test_c3_c4_normalise_and_tokens(spark):
    value = "The ferry leaves at NINE, see http://harbour.test and bring Warm coats!"
    assert one(spark, value, text.token_text) == "ferry leaves nine see bring warm coats"


@pytest.mark.parametrize("limit", [20_000, 0])
def test_c5_lemmas_in_plan_and_by_join(spark, limit):
    df = spark.createDataFrame(
        [(1, ["cats", "run", "cats"]), (2, []), (3, ["dogs"]), (4, None), (5, ["cats", "run", "cats"])],
        "id int, tokens array<string>",
    )
    table = spark.createDataFrame([("cats", "cat"), ("dogs", "dog")], "token string, lemma string")
    got = text.lemmatise(df, "tokens", table, max_rows_in_plan=limit).orderBy("id")
    assert column(got, "text_tokens_clean") == ["cat run cat", "", "dog", None, "cat run cat"]


@pytest.mark.parametrize("limit", [20_000, 0])
def test_c5_both_paths_agree_on_odd_lists(spark, limit):
    rows = [(1, ["a b", "cats"]), (2, ["a", "b", "cats"]), (3, [None, "cats"]), (4, ["cats"]), (5, [None]), (6, [""])]
    df = spark.createDataFrame(rows, "id int, tokens array<string>")
    table = spark.createDataFrame([("cats", "feline"), ("cats", "cat"), (None, "x")], "token string, lemma string")
    got = text.lemmatise(df, "tokens", table, max_rows_in_plan=limit).orderBy("id")
    assert column(got, "text_tokens_clean") == ["a b cat", "a b cat", "cat", "cat", "", ""]


NOUN_LISTS = [
    (1, ["boxes", "box", "box", "churches", "church", "church", "glass", "glas", "glas"]),
    (2, ["cities", "city", "city", "women", "woman", "woman", "wolves", "wolf", "wolf"]),
    (3, ["this", "mice", "news", "new", "new", "ferries", "ferry", None]),
    (4, ["buses", "buse", "buse", "bus", "bus"]),
    (5, None),
    (6, []),
]


def test_c5_nouns_by_rules(spark):
    df = spark.createDataFrame(NOUN_LISTS, "id int, tokens array<string>")
    got = {row["token"]: row["lemma"] for row in lemmas.noun_lemmas(df, "tokens").collect()}
    # "ferry" occurs once only, "glass" ends in ss, "news" is an exception, of "buse" and "bus" the shorter one counts.
    assert got == {
        "boxes": "box", "churches": "church", "cities": "city", "women": "woman", "wolves": "wolf", "mice": "mouse",
        "buses": "bus",
    }
    assert lemmas.noun_lemmas(df.limit(0), "tokens").count() == 0
    texts = column(lemmas.lemmatise_nouns(df, "tokens").orderBy("id"), "text_tokens_clean")
    assert texts[2:] == ["this mouse news new new ferries ferry", "bus buse buse bus bus", None, ""]


def test_c5_nouns_with_own_exceptions_and_limit(spark):
    df = spark.createDataFrame(NOUN_LISTS, "id int, tokens array<string>")
    own = spark.createDataFrame([("mice", "rodent"), ("mice", "zoo"), ("boxes", "boxes"), ("this", None)], "token string, lemma string")
    for parts in (1, 5):
        got = lemmas.noun_lemmas(df.repartition(parts), "tokens", min_count=1, exceptions=own)
        pairs = {row["token"]: row["lemma"] for row in got.collect()}
        assert pairs["mice"] == "rodent" and pairs["ferries"] == "ferry" and pairs["news"] == "new"
        assert "boxes" not in pairs and "this" not in pairs and "glass" not in pairs


@pytest.mark.parametrize("value", ["see wttpfoo bar", "hww.x stays", "a http://x.y b", "www.z w", "http", "www x"])
def test_c1_c3_urls(spark, value):
    assert one(spark, value, text.clean_text) == reference_clean(value)
    assert one(spark, value, text.token_text) == " ".join(reference_tokens(value))


def test_c6_domain_tags(spark):
    df = texts(spark, "an ai that writes python by night", "gone fishing", None)
    got = column(df.orderBy("id").select(text.domain_tags(F.col("text"), ["AI", "Python"]).alias("t")), "t")
    assert got == [["AI", "Python"], [], []]


def test_c7_parse_time(spark):
    df = spark.createDataFrame(
        [("2024-01-02T03:04:05.123456", 86_400), ("2024-01-02 03:04:05", 0), ("2024-01-02", None), ("junk", None)],
        "iso string, unix long",
    )
    got = df.select(features.parse_time(df, "iso").alias("iso"), features.parse_time(df, "unix").alias("unix")).collect()
    assert got[0]["iso"] == dt.datetime(2024, 1, 2, 3, 4, 5, 123456)
    assert got[1]["iso"] == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert got[2]["iso"] == dt.datetime(2024, 1, 2)
    assert got[3]["iso"] is None
    assert [row["unix"] for row in got[:2]] == [dt.datetime(1970, 1, 2), dt.datetime(1970, 1, 1)]


def test_c8_c12_features(spark):
    df = spark.createDataFrame(
        [(10.0, -20.0, None, None), (None, None, -5.0, 3.0), (None, None, None, None)],
        "retweet_count double, favorite_count double, score double, comments double",
    )
    engaged = features.with_engagement_rate(features.with_engagement(df))
    rows = engaged.orderBy(F.desc("total_engagement")).collect()
    assert [r["total_engagement"] for r in rows] == [30.0, 11.0, 0.0]
    assert [r["engagement_rate"] for r in rows] == [1.0, 11 / 30, 0.0]
    z = features.with_z_scores(engaged, ["total_engagement"]).orderBy(F.desc("total_engagement")).collect()
    mean, std = 41 / 3, (((30 - 41 / 3) ** 2 + (11 - 41 / 3) ** 2 + (41 / 3) ** 2) / 2) ** 0.5
    assert z[0]["total_engagement_normalized"] == pytest.approx((30 - mean) / std)


def test_c11_c12_constant_columns(spark):
    df = spark.createDataFrame([(0.0,), (0.0,)], "total_engagement double")
    assert column(features.with_engagement_rate(df), "engagement_rate") == [0.0, 0.0]
    assert column(features.with_z_scores(df), "total_engagement_normalized") == [None, None]
    assert "total_engagement_normalized" not in features.with_z_scores(df, drop_constant=True).columns


def test_c8_missing_columns(spark):
    df = spark.createDataFrame([(1.0,)], "retweet_count double")
    row = features.with_engagement(df).first()
    assert (row["twitter_engagement"], row["reddit_engagement"]) == (1.0, 0.0)


def reference_sentiment(value):
    words = [w for w in re.split(sentiment.WORD_BREAK, value) if w]
    total = 0.0
    but = words.index("but") if "but" in words else None
    for i, word in enumerate(words):
        if word not in sentiment.LEXICON:
            continue
        score = sentiment.LEXICON[word]
        sign = 1 if score > 0 else -1
        flips = 0
        for distance, damping in enumerate(sentiment.DAMPING, start=1):
            if i - distance < 0:
                break
            before = words[i - distance]
            if before not in sentiment.LEXICON:
                score += sign * sentiment.BOOSTERS.get(before, 0.0) * damping
            flips += before in sentiment.NEGATORS
        score *= sentiment.NEGATION**flips
        if but is not None and i != but:
            score *= 0.5 if i < but else 1.5
        total += score
    marks, questions = min(4, value.count("!")) * 0.292, value.count("?")
    marks += 0.96 if questions > 3 else questions * 0.18 if questions > 1 else 0.0
    total += marks if total > 0 else -marks if total < 0 else 0.0
    return round(total / (total * total + 15) ** 0.5, 4)


def test_c13_signs_and_rules(spark):
    score = lambda v: one(spark, v, sentiment.sentiment_compound)
    assert score("we love the good garden") > 0.05
    assert score("an awful trip and bad food") < -0.05
    assert score("the train leaves at nine") == 0.0
    assert score("") == 0.0 and score(None) == 0.0
    assert score("not good") < 0 < score("good") < score("very good") < score("very good!!!")
    assert score("good but bad") < 0


def test_c13_random_against_loop(spark):
    rng = random.Random(3)
    pool = [*sentiment.LEXICON][::9] + [*sentiment.BOOSTERS][::4] + ["not", "never", "but", "book", "a", "!", "?", "."]
    values = [" ".join(rng.choice(pool) for _ in range(rng.randint(0, 14))) for _ in range(200)]
    got = column(
        texts(spark, *values).orderBy("id").select(sentiment.sentiment_compound(F.col("text")).alias("s")), "s"
    )
    assert got == pytest.approx([reference_sentiment(v) for v in values], abs=1.01e-4)


def test_c14_c15_c16_labels(spark):
    df = spark.createDataFrame([(0.05,), (-0.05,), (0.06,), (0.0,)], "s double")
    assert column(df.select(sentiment.label_strict(F.col("s")).alias("l")), "l") == [
        "neutral", "neutral", "positive", "neutral",
    ]
    assert column(df.select(sentiment.label_inclusive(F.col("s")).alias("l")), "l") == [
        "positive", "negative", "positive", "neutral",
    ]
    scored = sentiment.with_sentiment(spark.createDataFrame([("good",)], "text_cleaned string")).first()
    assert scored["sentiment_polarity"] == scored["sentiment_compound"]


def test_b1_b4_nulls(spark):
    schema = "text string, title string, user_followers_count double, author_post_karma double"
    df = spark.createDataFrame([(None, "t", None, 7.0), ("x", "t", 3.0, 7.0)], schema)
    assert column(df.select(filters.text_or_title(df).alias("t")), "t") == ["t", "x"]
    assert column(df.select(filters.audience(df).alias("a")), "a") == [0.0, 3.0]
    assert column(df.select(filters.audience(df, karma_as_audience=True).alias("a")), "a") == [7.0, 3.0]
    karma = df.drop("user_followers_count")
    assert column(karma.select(filters.audience(karma).alias("a")), "a") == [7.0, 7.0]
    assert column(df.select("text").select(filters.audience(df.select("text")).alias("a")), "a") == [0.0, 0.0]


def test_b2_b3_imputation(spark):
    df = spark.createDataFrame(
        [("oak", 7.5, 3.0, 4.0), (None, 1.0, None, 6.0), ("elm", None, 8.0, None)],
        "text_col string, total_engagement double, word_count double, other_num double",
    )
    rows = filters.fill_metrics(filters.fill_unknown(df)).collect()
    assert [r["text_col"] for r in rows] == ["oak", "unknown", "elm"]
    assert rows[2]["total_engagement"] == 0 and rows[1]["word_count"] == 0
    assert rows[2]["other_num"] is None


def test_b5_b12_filters(spark, twitter):
    df = twitter.withColumn("created_at", F.to_timestamp("created_at"))
    odd = spark.createDataFrame([(None,), ("my_REDDIT",), ("twitter",)], "data_source string")
    assert df.filter(filters.in_sources(["twitter"])).count() == 3
    assert df.filter(filters.in_date_range(dt.date(2022, 5, 1), dt.date(2022, 5, 2))).count() == 2
    assert odd.filter(filters.source_contains("reddit")).count() == 1
    assert odd.filter(filters.source_contains("reddit", ignore_case=False)).count() == 0
    assert odd.filter(filters.source_is("twitter")).count() == 1
    assert df.filter(filters.longer_than("text", 15)).count() == 2
    pairs = spark.createDataFrame([(1.0, 2.0), (None, 1.0), (float("nan"), 1.0)], "a double, b double")
    assert filters.complete_pairs(pairs, "a", "b").count() == 1
    assert filters.with_time(df.withColumn("created_at", F.lit(None).cast("timestamp"))).count() == 0
    assert filters.available(df, ["text", "nope", "id"]).columns == ["text", "id"]


def test_c13_lexicon_table_equals_the_map(spark):
    words = ["good", "bad", "very", "not", "but", "plain", "slightly", "awful", "fine!", "why?", "hot dog", "hot"]
    rng = random.Random(9)
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(14))) + "!" * (k % 6) + "?" * (k % 5) for k in range(200)] + [None, ""]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text_cleaned string")
    values = {"good": 1.9, "bad": -2.5, "awful": -2.0, "fine": 0.8, "hot": 0.5}
    table = spark.createDataFrame(list(values.items()), "entry string, value double")
    got = {r["k"]: r["sentiment_compound"] for r in sentiment.with_table_sentiment(df, table).collect()}
    want = {r["k"]: r["sentiment_compound"] for r in sentiment.with_sentiment(df, lexicon=values).collect()}
    assert got == want and len(got) == 202


def test_c13_entries_of_several_words(spark):
    table = [("hot dog", 2.0), ("dog", -1.0), ("hot dog stand", -3.0), ("Hot  Dog", 4.0), ("", 9.0), ("bad", None), ("very good", 1.0)]
    lexicon = spark.createDataFrame(table, "entry string, value double")
    texts = ["a hot dog", "dog hot dog", "hot dog stand", "not a hot dog", "very good", "hot", "very dog"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text_cleaned string")
    got = {r["k"]: r["sentiment_compound"] for r in sentiment.with_table_sentiment(df, lexicon).collect()}

    def squashed(s):
        return round(s / (s * s + 15) ** 0.5, 4)

    # "hot dog" is listed twice, with a mean of 3; a booster inside an entry is no booster.
    assert got == {0: squashed(3), 1: squashed(2), 2: squashed(-3), 3: squashed(3 * -0.74), 4: squashed(1), 5: 0.0, 6: squashed(-1.293)}
    none = sentiment.with_table_sentiment(df, lexicon.limit(0))
    assert {r["sentiment_compound"] for r in none.collect()} == {0.0}


def test_f5_words_of_a_text_are_not_copied_into_its_runs(spark):
    df = spark.createDataFrame([(1, "the tiger is very bold"), (2, "bold but not so bold")], "k int, text_cleaned string")
    for entries in (["bold"], ["bold", "very bold"]):
        table = spark.createDataFrame([(e, 1.5) for e in entries], "entry string, value double")
        scored = sentiment.with_table_sentiment(df, table)
        made = re.findall(r"Generate \w+\(.*?\), \[([^\]]*)\]", scored._jdf.queryExecution().executedPlan().toString())
        assert made and not any("__words" in kept for kept in made)


def test_f5_but_is_searched_once_a_text(spark):
    plain = spark.range(1).select(F.lit("bold " * 3).alias("text_cleaned"))
    lexicon = spark.createDataFrame([("bold", 1.5)], "entry string, value double")
    for scored in (sentiment.with_table_sentiment(plain, lexicon), sentiment.with_sentiment(plain, lexicon={"bold": 1.5})):
        plan = scored._jdf.queryExecution().analyzed().toString()
        assert "array_position" in plan
        # Bound by a lambda: the search is not part of what is computed for each word or hit.
        assert all(re.search(r"array\(array_position\([^()]*, but\)\)", line) for line in plan.splitlines() if "array_position" in line)
