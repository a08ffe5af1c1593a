"""Interaction graphs: building, size and density, degree centrality, PageRank (H1-H7).

A graph is two tables: ``nodes(id, type, source, sentiment, followers)`` with one row per node and
undirected ``edges(src, dst, weight)`` with src <= dst and one row per pair.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from townsquare.functions.filters import source_contains, source_is
from townsquare.runtime import drop_intermediate, freeze, read_intermediate, shared_folder, write_intermediate
from townsquare.schema import UNKNOWN

HUB_ARCS = 1_000_000
MAX_HUBS = 100_000
ARCS_PER_BUCKET = 100_000
MIN_INFLUENCER_NODES = 5


class NotSettled(RuntimeError):
    """The rounds did not suffice for the ranks to settle."""


@dataclass(frozen=True)
class Graph:
    nodes: DataFrame
    edges: DataFrame


def _optional(df: DataFrame, column: str, data_type: str) -> Column:
    return F.col(column).cast(data_type) if column in df.columns else F.lit(None).cast(data_type)


def _known(column: str) -> Column:
    return F.col(column).isNotNull() & (F.col(column) != UNKNOWN)


def _latest(nodes: DataFrame) -> DataFrame:
    """One row per node: every attribute keeps its last written value."""
    return nodes.groupBy("id").agg(
        F.max_by("type", "at").alias("type"),
        F.max_by("source", "at").alias("source"),
        *(F.max_by(c, F.when(F.col(c).isNotNull(), F.col("at"))).alias(c) for c in ("sentiment", "followers")),
    )


def _undirected(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("src"), F.greatest(a, b).alias("dst")]


def community_graph(posts: DataFrame) -> Graph:
    """H1: authors and communities of the Reddit-like posts, joined by the last post's score.

    Also holds the Twitter-like users as nodes. "Last" is by (created_at, id). Posts without a
    known author make no edge.
    """
    rows = posts.select(
        F.col("id").cast("string").alias("post"),
        "created_at",
        "data_source",
        _optional(posts, "author", "string").alias("author"),
        _optional(posts, "subreddit", "string").alias("subreddit"),
        _optional(posts, "user_id", "string").alias("user_id"),
        _optional(posts, "score", "double").alias("score"),
        _optional(posts, "sentiment_polarity", "double").alias("sentiment"),
        _optional(posts, "user_followers_count", "double").alias("followers"),
    )
    reddit = rows.filter(source_contains("reddit") & _known("author") & F.col("subreddit").isNotNull())
    twitter = rows.filter(source_is("twitter") & _known("user_id"))

    def at(place: int) -> Column:
        # Nodes of one post are written in a fixed order; Twitter-like posts come last.
        return F.struct(F.lit(place // 2).alias("phase"), "created_at", "post", F.lit(place).alias("place")).alias("at")

    none = F.lit(None).cast("double")
    nodes = (
        reddit.select(
            F.inline(
                F.array(
                    F.struct(
                        F.col("author").alias("id"),
                        F.lit("user").alias("type"),
                        F.lit("reddit").alias("source"),
                        "sentiment",
                        none.alias("followers"),
                        at(0),
                    ),
                    F.struct(
                        F.col("subreddit").alias("id"),
                        F.lit("community").alias("type"),
                        F.lit("reddit").alias("source"),
                        none.alias("sentiment"),
                        none.alias("followers"),
                        at(1),
                    ),
                )
            )
        )
    ).unionByName(
        twitter.select(
            F.col("user_id").alias("id"),
            F.lit("user").alias("type"),
            F.lit("twitter").alias("source"),
            "sentiment",
            "followers",
            at(2),
        )
    )
    edges = (
        reddit.select(*_undirected("author", "subreddit"), F.coalesce("score", F.lit(1.0)).alias("w"), "created_at", "post")
        .groupBy("src", "dst")
        .agg(F.max_by("w", F.struct("created_at", "post")).alias("weight"))
    )
    return Graph(_latest(nodes), edges)


def reply_graph(posts: DataFrame) -> Graph:
    """H2: every known user as a node; one undirected edge per pair that replied to each other."""
    users = posts.filter(_known("user_id")).select(F.col("user_id").cast("string").alias("id"))
    pairs = posts.sparkSession.createDataFrame([], "src string, dst string")
    ends = users
    if "in_reply_to_user_id" in posts.columns:
        replies = posts.filter(_known("user_id") & _known("in_reply_to_user_id")).select(
            F.col("user_id").cast("string").alias("a"), F.col("in_reply_to_user_id").cast("string").alias("b")
        )
        pairs = replies.select(*_undirected("a", "b")).distinct()
        ends = users.union(replies.select("b"))
    nodes = ends.distinct().select(
        "id",
        F.lit("user").alias("type"),
        F.lit("twitter").alias("source"),
        F.lit(None).cast("double").alias("sentiment"),
        F.lit(None).cast("double").alias("followers"),
    )
    return Graph(nodes, pairs.withColumn("weight", F.lit(1.0)))


def graph_metrics(graph: Graph) -> DataFrame:
    """H3, H4: one row with nodes, edges, average degree 2E/N and density 2E/(N(N-1))."""
    edges = graph.edges.agg(F.count(F.lit(1))).scalar()
    counted = graph.nodes.agg(F.count(F.lit(1)).alias("number_of_nodes")).withColumn("number_of_edges", edges)
    n, e = F.col("number_of_nodes").cast("double"), F.col("number_of_edges").cast("double")
    return counted.withColumns(
        {
            "average_degree": F.when(n > 0, F.try_divide(2 * e, n)).otherwise(0.0),
            "density": F.when(n > 1, F.try_divide(2 * e, n * (n - 1))).otherwise(0.0),
        }
    )


def degree_centrality(graph: Graph) -> DataFrame:
    """H5: (id, degree, centrality) of every node; a self-loop counts twice, isolated nodes 0."""
    ends = graph.edges.select(F.explode(F.array("src", "dst")).alias("id"))
    degrees = ends.groupBy("id").agg(F.count(F.lit(1)).alias("degree"))
    others = graph.nodes.agg(F.count(F.lit(1)) - 1).scalar()
    return (
        graph.nodes.select("id")
        .join(degrees, "id", "left")
        .select("id", F.coalesce("degree", F.lit(0)).alias("degree"))
        .withColumn("centrality", F.when(others < 1, 1.0).otherwise(F.try_divide(F.col("degree").cast("double"), others)))
    )


def top_central(graph: Graph, n: int = 10) -> DataFrame:
    """H5: the ``n`` most central nodes, ties by id."""
    return degree_centrality(graph).orderBy(F.desc("centrality"), "id").limit(n)


def pagerank(
    graph: Graph,
    alpha: float = 0.85,
    max_rounds: int = 100,
    tolerance: float | None = 1e-6,
    hub_arcs: int = HUB_ARCS,
    rounds_per_write: int = 5,
) -> DataFrame:
    """H6: (id, rank) by weighted PageRank over both directions of each edge.

    ``tolerance`` stops after the first round whose summed change is below tolerance · nodes;
    ``None`` runs exactly ``max_rounds``. Raises ``NotSettled`` if the rounds do not suffice.
    Negative weights count as 0.

    * Nodes without a positive edge all keep one common rank, so it is tracked as a number and
      only connected nodes are iterated; the mass they hold needs no extra aggregate.
    * Arcs are written once, bucketed by their source, and never shuffled again. A node with more
      than ``hub_arcs`` arcs is a hub: its arcs are written evenly spread instead and meet the hubs'
      ranks by broadcast, or by a shuffle join where there are more than ``MAX_HUBS`` hubs.
    * Rounds end in a written table, so plans stay flat and a lost executor costs no more than one;
      a fixed number of rounds without hubs is written every ``rounds_per_write``.
    """
    graph = Graph(freeze(graph.nodes), freeze(graph.edges))
    spark = graph.nodes.sparkSession
    forth = F.struct("src", "dst", "weight")
    back = F.struct(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    directions = F.when(F.col("src") == F.col("dst"), F.array(forth)).otherwise(F.array(forth, back))
    arcs = graph.edges.filter(F.col("weight") > 0).select(F.inline(directions))
    degrees = freeze(
        arcs.groupBy("src").agg(F.sum("weight").alias("out_weight"), F.count(F.lit(1)).alias("out_degree"))
    )
    total = graph.nodes.count()
    if total == 0:
        return spark.createDataFrame([], "id string, rank double")
    size = degrees.agg(
        F.count(F.lit(1)).alias("nodes"),
        F.coalesce(F.sum("out_degree"), F.lit(0)).alias("arcs"),
        F.count(F.when(F.col("out_degree") > hub_arcs, 1)).alias("hubs"),
    ).first()
    isolated = total - size["nodes"]
    has_hubs = size["hubs"] > 0
    few = F.broadcast if size["hubs"] <= MAX_HUBS else lambda df: df
    if has_hubs or tolerance is not None:
        # With hubs each round reads the ranks twice and chained rounds would double the plan each
        # time; a stop rule is looked at after every round, whatever the graph's size.
        rounds_per_write = 1

    # A weightless arc from each node to itself carries the node's own values through the grouping.
    own = degrees.select("src", F.col("src").alias("dst"), F.lit(0.0).alias("weight"), F.lit(True).alias("own"))
    links = arcs.withColumn("own", F.lit(False)).unionByName(own)
    hubs = degrees.filter(F.col("out_degree") > hub_arcs).select("src")
    folder, name = f"{shared_folder(spark)}/townsquare", f"townsquare_arcs_{uuid.uuid4().hex}"
    buckets = min(int(spark.conf.get("spark.sql.shuffle.partitions")), size["arcs"] // ARCS_PER_BUCKET + 1)
    plain = links.join(few(hubs), "src", "left_anti") if has_hubs else links
    hub_path = None
    try:
        writer = plain.repartition(buckets, "src").write.bucketBy(buckets, "src").option("path", f"{folder}/{name}")
        writer.saveAsTable(name)
        plain = spark.table(name)
        if has_hubs:
            spread = links.join(few(hubs), "src", "left_semi").repartition(buckets, "src", "dst")
            hub_path = write_intermediate(spread)
            spread = read_intermediate(spark, hub_path, links.schema)

        def next_round(current: DataFrame, base: float) -> DataFrame:
            rates = current.withColumnRenamed("id", "src")
            meetings = [plain.join(rates, "src")]
            if has_hubs:
                meetings.append(spread.join(few(rates.filter("is_hub")), "src"))
            flows = [
                met.select(
                    F.col("dst").alias("id"),
                    (F.col("rank") * F.col("weight") / F.col("out_weight")).alias("flow"),
                    *(F.when(F.col("own"), F.col(c)).alias(c) for c in ("rank", "out_weight", "is_hub")),
                )
                for met in meetings
            ]
            return (
                reduce(DataFrame.unionByName, flows)
                .groupBy("id")
                .agg(
                    (F.lit(alpha) * F.sum("flow") + F.lit(base)).alias("rank"),
                    F.max("out_weight").alias("out_weight"),
                    F.max("is_hub").alias("is_hub"),
                    F.max("rank").alias("old"),
                )
            )

        lone_rank = 1.0 / total
        current = degrees.select(
            F.col("src").alias("id"),
            F.lit(lone_rank).alias("rank"),
            "out_weight",
            (F.col("out_degree") > hub_arcs).alias("is_hub"),
        )
        columns, path, done, converged = current.columns, None, 0, tolerance is None
        while done < max_rounds:
            step = current
            for _ in range(min(rounds_per_write, max_rounds - done)):
                # Isolated nodes spread their mass evenly over all nodes.
                base = (alpha * isolated * lone_rank + (1.0 - alpha)) / total
                step = next_round(step.select(*columns), base)
                lone_change, lone_rank, done = abs(base - lone_rank), base, done + 1
            next_path = write_intermediate(step)
            table = read_intermediate(spark, next_path, step.schema)
            current = table.select(*columns)
            if path is not None:
                drop_intermediate(spark, path)
            path = next_path
            if tolerance is not None:
                change = table.agg(F.coalesce(F.sum(F.abs(F.col("rank") - F.col("old"))), F.lit(0.0))).first()[0]
                converged = change + isolated * lone_change < total * tolerance
                if converged:
                    break
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        for finished in filter(None, (f"{folder}/{name}", hub_path)):
            drop_intermediate(spark, finished)
    if not converged:
        raise NotSettled(f"PageRank did not settle within {max_rounds} rounds")
    lone = graph.nodes.select("id").join(current.select("id"), "id", "left_anti")
    return current.select("id", "rank").union(lone.select("id", F.lit(lone_rank).alias("rank")))


def influencers(graph: Graph, n: int = 10, **settings) -> DataFrame:
    """H7: the users among the ``n`` best-ranked nodes (so maybe fewer), with source and followers.

    Graphs of fewer than five nodes have none. Raises ``NotSettled`` as ``pagerank`` does.
    """
    graph = Graph(freeze(graph.nodes), graph.edges)
    spark = graph.nodes.sparkSession
    empty = spark.createDataFrame([], "id string, rank_score double, source string, followers double")
    if len(graph.nodes.limit(MIN_INFLUENCER_NODES).collect()) < MIN_INFLUENCER_NODES:
        return empty
    ranks = pagerank(graph, **settings)
    best = ranks.orderBy(F.desc("rank"), "id").limit(n)
    # ``n`` rows.
    found = graph.nodes.join(F.broadcast(best), "id").filter(F.col("type") == "user")
    return found.select(
        "id",
        F.col("rank").alias("rank_score"),
        F.coalesce("source", F.lit(UNKNOWN)).alias("source"),
        F.coalesce("followers", F.lit(0.0)).alias("followers"),
    )


def interaction_graph(posts: DataFrame) -> Graph:
    """The union of H1 and H2: communities joined by score, replies with weight 1."""
    community, reply = community_graph(posts), reply_graph(posts)
    nodes = community.nodes.unionByName(reply.nodes.join(community.nodes.select("id"), "id", "left_anti"))
    edges = (
        community.edges.withColumn("first", F.lit(0))
        .unionByName(reply.edges.withColumn("first", F.lit(1)))
        .groupBy("src", "dst")
        .agg(F.max_by("weight", "first").alias("weight"))
    )
    return Graph(nodes, edges)
