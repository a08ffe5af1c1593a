"""G and H: topics and graphs."""

import datetime as dt
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import column
from townsquare.operators import graph, topics

POSTS = (
    "id string, created_at timestamp, data_source string, user_id string, author string, subreddit string, "
    "score double, user_followers_count double, sentiment_polarity double, in_reply_to_user_id string"
)


def posts(spark):
    t = [dt.datetime(2024, 1, d) for d in range(1, 10)]
    rows = [
        ("1", t[0], "reddit_kaggle", "unknown", "ann", "tech", 5.0, None, 0.1, None),
        ("2", t[1], "reddit_kaggle", "unknown", "ann", "tech", 9.0, None, 0.3, None),
        ("3", t[2], "reddit_kaggle", None, "bob", "tech", 2.0, None, 0.2, None),
        ("4", t[3], "reddit_kaggle", None, "bob", "news", 0.0, None, 0.2, None),
        ("5", t[4], "reddit_kaggle", None, "unknown", "news", 3.0, None, 0.0, None),
        ("6", t[5], "twitter", "cat", None, None, None, 10.0, 0.5, "dan"),
        ("7", t[6], "twitter", "cat", None, None, None, 20.0, 0.6, "dan"),
        ("8", t[7], "twitter", "dan", None, None, None, 7.0, 0.0, "cat"),
        ("9", t[8], "twitter", "eve", None, None, None, 1.0, 0.0, "eve"),
    ]
    return spark.createDataFrame(rows, POSTS)


def test_h1_community_graph(spark):
    g = graph.community_graph(posts(spark))
    edges = {(r["src"], r["dst"]): r["weight"] for r in g.edges.collect()}
    assert edges == {("ann", "tech"): 9.0, ("bob", "tech"): 2.0, ("bob", "news"): 0.0}
    nodes = {r["id"]: r for r in g.nodes.collect()}
    assert set(nodes) == {"ann", "bob", "tech", "news", "cat", "dan", "eve"}
    assert nodes["tech"]["type"] == "community" and nodes["ann"]["type"] == "user"
    assert nodes["ann"]["sentiment"] == 0.3 and nodes["cat"]["followers"] == 20.0
    assert nodes["cat"]["source"] == "twitter"


def test_h2_h5_reply_graph(spark):
    g = graph.reply_graph(posts(spark))
    assert {(r["src"], r["dst"]) for r in g.edges.collect()} == {("cat", "dan"), ("eve", "eve")}
    metrics = graph.graph_metrics(g).first()
    assert (metrics["number_of_nodes"], metrics["number_of_edges"]) == (3, 2)
    assert metrics["average_degree"] == pytest.approx(4 / 3) and metrics["density"] == pytest.approx(2 / 3)
    central = {r["id"]: r["centrality"] for r in graph.degree_centrality(g).collect()}
    assert central == {"cat": 0.5, "dan": 0.5, "eve": 1.0}
    assert column(graph.top_central(g, 2), "id") == ["eve", "cat"]
    without = graph.reply_graph(posts(spark).drop("in_reply_to_user_id"))
    assert graph.graph_metrics(without).first()["number_of_edges"] == 0
    alone = graph.Graph(without.nodes.limit(1), without.edges)
    assert graph.degree_centrality(alone).first()["centrality"] == 1.0
    assert graph.graph_metrics(alone).first()["density"] == 0.0


def ranks_by_hand(nodes, edges, alpha=0.85, rounds=None):
    index = {n: i for i, n in enumerate(nodes)}
    n = len(nodes)
    m = np.zeros((n, n))
    for s, d, w in edges:
        w = max(w, 0)
        m[index[s], index[d]] += w
        if s != d:
            m[index[d], index[s]] += w
    out = m.sum(axis=1)
    p = np.full(n, 1 / n)
    for _ in range(rounds or 100):
        spread = np.divide(m, out[:, None], out=np.zeros_like(m), where=out[:, None] > 0)
        new = alpha * (p @ spread + p[out == 0].sum() / n) + (1 - alpha) / n
        change, p = np.abs(new - p).sum(), new
        if rounds is None and change < n * 1e-6:
            break
    return dict(zip(nodes, p))


def star(spark, leaves=40):
    names = [f"n{i}" for i in range(leaves)] + ["hub", "lone", "minus"]
    edges = [("hub", f"n{i}", float(i % 3 + 1)) for i in range(leaves)]
    edges += [("n0", "n1", 2.0), ("n2", "n2", 1.0), ("hub", "minus", -4.0)]
    nodes = spark.createDataFrame(
        [(n, "user", "twitter", None, float(i)) for i, n in enumerate(names)],
        "id string, type string, source string, sentiment double, followers double",
    )
    return names, edges, graph.Graph(nodes, spark.createDataFrame(edges, "src string, dst string, weight double"))


@pytest.mark.parametrize("settings", [{}, {"hub_arcs": 5}, {"rounds_per_write": 1}])
def test_h6_pagerank(spark, settings):
    names, edges, g = star(spark)
    got = {r["id"]: r["rank"] for r in graph.pagerank(g, max_rounds=7, tolerance=None, **settings).collect()}
    want = ranks_by_hand(names, edges, rounds=7)
    assert got == pytest.approx(want)
    assert sum(got.values()) == pytest.approx(1.0)


def test_h6_tolerance(spark):
    names, edges, g = star(spark)
    got = {r["id"]: r["rank"] for r in graph.pagerank(g).collect()}
    assert got == pytest.approx(ranks_by_hand(names, edges), abs=2e-5)
    with pytest.raises(RuntimeError):
        graph.pagerank(g, max_rounds=2)
    empty = graph.Graph(g.nodes.limit(0), g.edges.limit(0))
    assert graph.pagerank(empty).count() == 0
    lonely = graph.Graph(g.nodes.limit(3), g.edges.limit(0))
    assert column(graph.pagerank(lonely), "rank") == pytest.approx([1 / 3] * 3)


def test_h7_influencers(spark):
    names, edges, g = star(spark)
    loose = {"tolerance": 1e-3}
    best = graph.influencers(g, **loose).collect()
    assert len(best) == 10 and max(best, key=lambda r: r["rank_score"])["id"] == "hub"
    communities = graph.Graph(
        g.nodes.withColumn("type", F.when(F.col("id") == "hub", "community").otherwise(F.col("type"))), g.edges
    )
    assert graph.influencers(communities, **loose).count() == 9
    assert graph.influencers(graph.Graph(g.nodes.limit(4), g.edges.limit(0))).count() == 0
    with pytest.raises(graph.NotSettled):
        graph.influencers(g, max_rounds=2)


def test_h6_hubs_and_stop_rule_agree(spark):
    _, _, g = star(spark)
    whole = {r["id"]: r["rank"] for r in graph.pagerank(g).collect()}
    split = {r["id"]: r["rank"] for r in graph.pagerank(g, hub_arcs=1).collect()}
    assert split == pytest.approx(whole, abs=1e-12)


def test_h6_cleans_up_and_raises_on_failure(spark, monkeypatch):
    _, _, g = star(spark)
    before = {t.name for t in spark.catalog.listTables()}

    def broken(*_):
        raise RuntimeError("no folder")

    monkeypatch.setattr(graph, "read_intermediate", broken)
    with pytest.raises(RuntimeError, match="no folder"):
        graph.influencers(g)
    assert {t.name for t in spark.catalog.listTables()} == before


def test_g1_vocabulary(spark):
    df = spark.createDataFrame([("oak elm elm",), ("oak ash",), ("oak fir yew",), ("elm a",)], "t string")
    got = {r["term"]: r["documents"] for r in topics.vocabulary(df, "t", 2, 0.7).collect()}
    assert got == {"elm": 2}
    assert {r["term"] for r in topics.vocabulary(df, "t", 0.5, 1.0).collect()} == {"oak", "elm"}


def test_interaction_graph(spark):
    g = graph.interaction_graph(posts(spark))
    assert g.nodes.count() == 7 and g.edges.count() == 5


def documents(spark):
    themes = ["spark cluster shuffle partition executor", "garden flower water sunlight soil"]
    rows = [(i, f"{themes[i % 2]} {themes[i % 2]} common{i % 3}") for i in range(30)]
    return spark.createDataFrame(rows + [(99, "short")], "id int, text_tokens_clean string")


def test_g1_g4_topics(spark):
    df = documents(spark)
    model = topics.fit_topics(df, k=2, rounds=4)
    described = topics.describe_topics(model).orderBy("topic").collect()
    assert [r["topic"] for r in described] == [0, 1]
    assert all(r["label"].startswith(f"Topic {r['topic']}: ") and len(r["terms"]) == 5 for r in described)
    again = topics.describe_topics(topics.fit_topics(df, k=2, rounds=4)).orderBy("topic").collect()
    assert [r["label"] for r in again] == [r["label"] for r in described]
    found = topics.dominant_topic(df, model)
    assert found.columns == ["id", "text_tokens_clean", "dominant_topic"]
    by_id = {r["id"]: r["dominant_topic"] for r in found.collect()}
    assert by_id[99] is None and {by_id[i] for i in range(0, 30, 2)} != {by_id[i] for i in range(1, 30, 2)}


def test_g2_finds_the_themes(spark):
    model = topics.fit_topics(documents(spark), k=2)
    assert model.terms.columns == ["term", "w0", "w1"] and model.terms.count() == model.size == 13
    assert sum(model.totals) == pytest.approx(30 * 11)
    found = {frozenset(r["terms"]) for r in topics.describe_topics(model).collect()}
    assert found == {frozenset("spark cluster shuffle partition executor".split()), frozenset("garden flower water sunlight soil".split())}


def test_g2_equals_plain_expectation_and_maximisation(spark):
    texts = ["oak elm fir", "oak elm elm yew", "ash fir fir", "yew oak oak", "elm ash ash ash", "fir yew yew"] * 3
    df = spark.createDataFrame([(t,) for t in texts], "text_tokens_clean string").repartition(4)
    model = topics.fit_topics(df, k=2, max_df=1.0, rounds=4, seed=5)
    vocabulary = sorted({w for t in texts for w in t.split()})
    start = [[int(hashlib.md5(f"5|{i}|{w}".encode()).hexdigest()[:8], 16) / 16**8 for w in vocabulary] for i in range(2)]
    weights, shares = start, [[0.5, 0.5]] * len(texts)  # the first round knows no text yet
    for _ in range(4):
        totals = [sum(w) + 0.5 * len(vocabulary) for w in weights]
        new, new_shares = [[0.0] * len(vocabulary) for _ in range(2)], []
        for text, share in zip(texts, shares, strict=True):
            own = [0.0, 0.0]
            for word in text.split():
                v = vocabulary.index(word)
                parts = [(weights[i][v] + 0.5) / totals[i] * (share[i] + 0.5) for i in range(2)]
                for i in range(2):
                    own[i] += parts[i] / sum(parts)
                    new[i][v] += parts[i] / sum(parts)
            new_shares.append(own)
        weights, shares = new, new_shares
    got = {r["term"]: (r["w0"], r["w1"]) for r in model.terms.collect()}
    assert got == {w: pytest.approx((weights[0][v], weights[1][v])) for v, w in enumerate(vocabulary)}


def test_g4_unknown_words_and_no_texts(spark):
    model = topics.fit_topics(documents(spark), k=2, rounds=2)
    other = spark.createDataFrame([(1, "nothing known here"), (2, None), (3, "garden flower water")], "id int, text_tokens_clean string")
    by_id = {r["id"]: r["dominant_topic"] for r in topics.dominant_topic(other, model).collect()}
    assert by_id[1] == 0 and by_id[2] is None and by_id[3] in (0, 1)
    assert topics.dominant_topic(other.limit(0), model).count() == 0


def test_g2_too_few_documents(spark):
    assert topics.fit_topics(documents(spark).limit(5)) is None
    same = spark.createDataFrame([("tall oak near water",)] * 14, "text_tokens_clean string")
    assert topics.fit_topics(same) is None  # every term is in more than 95 % of the texts
    assert topics.fit_topics(same, max_df=1.0, k=2, rounds=1) is not None


def plain_topics(texts, k, rounds, seed):
    vocabulary = sorted({w for t in texts for w in t.split()})
    weights = [[int(hashlib.md5(f"{seed}|{i}|{w}".encode()).hexdigest()[:8], 16) / 16**8 for w in vocabulary] for i in range(k)]
    shares = [[1 - 1 / k] * k for _ in texts]  # the first round knows no text yet
    for _ in range(rounds):
        totals = [sum(w) + len(vocabulary) / k for w in weights]
        new, new_shares = [[0.0] * len(vocabulary) for _ in range(k)], []
        for text, share in zip(texts, shares, strict=True):
            own = [0.0] * k
            for word in text.split():
                v = vocabulary.index(word)
                parts = [(weights[i][v] + 1 / k) / totals[i] * (share[i] + 1 / k) for i in range(k)]
                for i in range(k):
                    own[i] += parts[i] / sum(parts)
                    new[i][v] += parts[i] / sum(parts)
            new_shares.append(own)
        weights, shares = new, new_shares
    return {w: tuple(weights[i][v] for i in range(k)) for v, w in enumerate(vocabulary)}


def test_f3_rounds_write_a_row_a_term_and_part_not_a_row_a_word(spark, monkeypatch):
    written, write = [], topics.write_intermediate

    def counted(df):
        path = write(df)
        written.append(spark.read.parquet(path).count())
        return path

    monkeypatch.setattr(topics, "write_intermediate", counted)
    monkeypatch.setattr(topics, "freeze", lambda df: topics.read_intermediate(spark, counted(df), df.schema))
    words = [f"word{chr(97 + i)}{chr(97 + j)}" for i in range(10) for j in range(5)]
    df = spark.range(400).select(F.lit(" ".join(words)).alias("text_tokens_clean"))
    model = topics.fit_topics(df, k=2, max_df=1.0, rounds=3)
    assert model.size == 50 and sum(model.totals) == pytest.approx(400 * 50)
    assert topics.dominant_topic(df, model).filter("dominant_topic in (0, 1)").count() == 400
    assert max(written) <= 400 + 50  # a row a text and a term; 20,000 counts


@pytest.mark.parametrize("held", [1, 7, 4_000_000])
def test_f3_blocks_of_any_size_and_long_repeats_give_one_model(spark, monkeypatch, held):
    monkeypatch.setattr(topics, "BLOCK_WORDS", held)
    texts = ["oak elm fir", "oak elm elm yew", " ".join(["fir"] * 700 + ["oak"] * 255), "yew oak oak"] * 3
    rows = [(t,) for t in texts] + [("short",), (None,), ("? ! . , ; : - +",)]
    df = spark.createDataFrame(rows, "text_tokens_clean string").repartition(3)
    model = topics.fit_topics(df, k=3, min_df=1, max_df=1.0, rounds=3, seed=5)
    got = {r["term"]: tuple(r)[1:] for r in model.terms.collect()}
    assert got == {w: pytest.approx(weights) for w, weights in plain_topics(texts, 3, 3, 5).items()}
    found = [r["dominant_topic"] for r in topics.dominant_topic(df, model).orderBy("text_tokens_clean").collect()]
    assert found.count(None) == 2 and len(found) == len(rows)


def test_f3_words_with_one_hash_are_kept_apart(spark, monkeypatch):
    exprs = F.expr
    # The first salt gives all words one node.
    monkeypatch.setattr(topics.F, "expr", lambda text: exprs(text.replace("xxhash64(0, term)", "7L")))
    texts = ["oak elm fir yew", "oak elm elm yew", "fir fir yew oak"] * 4
    df = spark.createDataFrame([(t,) for t in texts], "text_tokens_clean string")
    model = topics.fit_topics(df, k=2, max_df=1.0, rounds=2, seed=5)
    assert {r["term"]: tuple(r)[1:] for r in model.terms.collect()} == {w: pytest.approx(v) for w, v in plain_topics(texts, 2, 2, 5).items()}
