"""Topics: bag of words, topic weights, top terms and dominant topic.

Texts are counted once, into blocks: the distinct terms of some thousand texts and how often each text has them. Blocks are
bucketed by part and never shuffled again. In every round a part is sent one row per distinct term and per text of it, with that one's
topic weights, and returns one row per term and text, which are summed by key; so what is shuffled grows with the distinct terms of
the parts and not with the words. Neither the vocabulary nor a weight per term ever comes to the driver; it sees one total per topic.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from townsquare.functions.filters import longer_than
from townsquare.runtime import drop_intermediate, freeze, own_path, read_intermediate, shared_folder, write_intermediate

MIN_DOCUMENTS = 10
TERMS_PER_TOPIC = 5
ROUNDS = 10
#: Rounds in which a text's shares are fitted to a finished model.
FOLD_IN_ROUNDS = 3
#: Words of a block, which one task builds at once; a longer text is a block of its own.
BLOCK_WORDS = 4_000_000
#: Counts of a part, whose blocks one task reads in a round.
PART_COUNTS = 32_000_000
#: Counts that are shared out at once.
SLICE_COUNTS = 1 << 20
_DIGITS = 9
_BLOCK = (
    "number long, size long, counted long, texts array<long>, starts binary, terms array<string>, documents array<long>, "
    "places binary, counts binary"
)


@dataclass(frozen=True)
class TopicModel:
    """``terms`` holds each term's weight per topic (term, w0, w1, …); ``totals`` their sums."""

    terms: DataFrame
    totals: tuple[float, ...]
    size: int
    text_column: str

    @property
    def k(self) -> int:
        return len(self.totals)


def bag_of_words(df: DataFrame, text_column: str) -> DataFrame:
    """G1, before counting: ``words`` of at least two letters or digits, without stop words."""
    raw = F.filter(F.split(F.lower(F.coalesce(text_column, F.lit(""))), r"[^\p{L}\p{N}_]+"), lambda w: F.length(w) > 1)
    remover = StopWordsRemover(inputCol="__raw", outputCol="words", locale="en_US")
    return remover.transform(df.withColumn("__raw", raw)).drop("__raw")


def vocabulary(df: DataFrame, text_column: str, min_df: float = 2, max_df: float | int = 0.95) -> DataFrame:
    """G1: (term, documents), every term whose document frequency lies within the limits.

    Fractional limits are shares of all texts, whole ones counts of texts.
    """
    return _terms_within(bag_of_words(df, text_column), min_df, max_df)


def _terms_within(words: DataFrame, min_df: float, max_df: float | int) -> DataFrame:
    total = words.agg(F.count(F.lit(1))).scalar()
    counted = words.select(F.explode(F.array_distinct("words")).alias("term")).groupBy("term").agg(
        F.count(F.lit(1)).alias("documents")
    )

    return _within(counted, total, min_df, max_df)


def _within(counted: DataFrame, total: Column, min_df: float, max_df: float | int) -> DataFrame:
    def bound(limit: float) -> Column:
        return total * limit if isinstance(limit, float) and limit <= 1 else F.lit(limit)

    return counted.filter((F.col("documents") >= bound(min_df)) & (F.col("documents") <= bound(max_df)))


def _block(number: int, texts: list[pa.Array], words: list[pa.Array]) -> pa.RecordBatch:
    """One row: the distinct terms of some texts, and the place and number of each text's terms, text by text.

    A count above 255 stands as several.
    """
    ids = np.concatenate([part.to_numpy(zero_copy_only=False) for part in texts])
    lengths = np.concatenate([part.value_lengths().fill_null(0).to_numpy(zero_copy_only=False) for part in words]).astype(np.int64)
    coded = pa.concat_arrays([part.flatten() for part in words]).dictionary_encode()
    width = max(len(coded.dictionary), 1)
    places = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    pairs, counts = np.unique(np.repeat(np.arange(len(ids)), lengths) * width + places, return_counts=True)
    documents = np.bincount(pairs % width, minlength=len(coded.dictionary))
    times = -(-counts // 255)
    if (times > 1).any():
        last = np.cumsum(times) - 1
        rest = counts - (times - 1) * 255
        pairs, counts = np.repeat(pairs, times), np.full(times.sum(), 255)
        counts[last] = rest
    text, place = pairs // width, pairs % width
    filled = np.flatnonzero(lengths)
    row = {
        "number": number, "size": len(ids), "counted": len(pairs), "texts": ids[filled],
        "starts": np.searchsorted(text, filled).astype(np.int32).tobytes(), "terms": coded.dictionary, "documents": documents,
        "places": place.astype(np.int32).tobytes(), "counts": counts.astype(np.uint8).tobytes(),
    }
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [
            pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v, kind.value_type)) if pa.types.is_list(kind) else pa.array([v], kind)
            for v, kind in zip(row.values(), kinds, strict=True)
        ],
        names=list(row),
    )


def _blocks(df: DataFrame, text_column: str, key: Column) -> DataFrame:
    """Stored blocks of the texts of more than ten characters; see ``_block``. Texts without a word only count towards ``size``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        texts: list[pa.Array] = []
        lists: list[pa.Array] = []
        held = 0
        for batch in batches:
            batch = batch.filter(batch.column(1))
            joined = batch.column(2)
            # Words hold no blank.
            words = pc.split_pattern(pc.if_else(pc.equal(joined, ""), pa.scalar(None, pa.string()), joined), " ")
            ends = np.cumsum(words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
            start = 0
            while start < batch.num_rows:
                taken = int(ends[start - 1]) if start else 0
                stop = max(int(np.searchsorted(ends, taken + BLOCK_WORDS - held, side="right")), start + (not held))
                if stop > start:
                    texts.append(batch.column(0).slice(start, stop - start))
                    lists.append(words.slice(start, stop - start))
                    held += int(ends[stop - 1]) - taken
                    start = stop
                if start < batch.num_rows:
                    yield _block(number, texts, lists)
                    texts, lists, held, number = [], [], 0, number + 1
        if texts:
            yield _block(number, texts, lists)

    # Short texts are left out by the task: a filter here would have Spark compute a text that is an expression twice.
    words = bag_of_words(df.select(key.alias("text"), text_column), text_column)
    counts = F.coalesce(longer_than(text_column), F.lit(False)).alias("counts")
    return freeze(words.select("text", counts, F.array_join("words", " ").alias("words")).mapInArrow(run, _BLOCK))


def _keyed(blocks: DataFrame, known: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The blocks with the terms' ``nodes`` and all words (node, term, documents) as a stored table.

    A node is a hash of 64 bits; should two words (``known`` ones included) share one, another salt is taken.
    """
    salt = 0
    while True:
        keyed = blocks.withColumn("nodes", F.expr(f"transform(terms, term -> xxhash64({salt}, term))"))
        listed = keyed.select(F.inline(F.arrays_zip("nodes", "terms", "documents"))).toDF("node", "term", "documents")
        words = freeze(listed.groupBy("node", "term").agg(F.sum("documents").alias("documents")))
        apart = words.select("node", "term")
        if known is not None:
            apart = apart.union(known.select(F.expr(f"xxhash64({salt}, term)"), "term")).distinct()
        if not apart.groupBy("node").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).collect():
            return keyed, words
        salt += 1


def _in_parts(blocks: DataFrame) -> tuple[DataFrame, int]:
    """``part`` of each block: a multiple of the number of cores, if the blocks suffice, so that a part has about ``PART_COUNTS`` counts.

    Parts are named so that hash partitioning by name puts each into a partition of its own.
    """
    spark = blocks.sparkSession
    rows, counted = blocks.agg(F.count(F.lit(1)), F.coalesce(F.sum("counted"), F.lit(0))).first()
    cores = spark.sparkContext.defaultParallelism
    parts = max(1, min(rows, cores * max(1, round(counted / PART_COUNTS / cores))))
    place = F.pmod(F.hash(F.col("id").cast("int")), F.lit(parts)).alias("place")
    found = spark.range(parts * 64).groupBy(place).agg(F.min("id").cast("int").alias("name")).collect()  # a row a part
    names = {row["place"]: row["name"] for row in found}
    listed = F.array(*(F.lit(names.get(k, k)).cast("int") for k in range(parts)))
    return blocks.withColumn("part", F.get(listed, F.pmod("number", F.lit(parts)).cast("int"))), parts


@dataclass
class _Part:
    """The weights sent to a part, a row a topic, with a column of ones behind them for all terms without a weight."""

    nodes: np.ndarray
    weights: np.ndarray
    texts: np.ndarray
    shares: np.ndarray

    @staticmethod
    def of(sent: pa.Table, k: int, totals: Sequence[float], size: int) -> _Part:
        prior = 1.0 / k
        is_text = sent.column("is_text").to_numpy()
        nodes, values = sent.column("node").to_numpy(), [sent.column(f"w{i}").to_numpy() for i in range(k)]

        def chosen(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            rows = rows[np.argsort(nodes[rows])]
            return nodes[rows], np.array([value[rows] + prior for value in values])

        terms, weights = chosen(np.flatnonzero(~is_text))
        weights /= np.array(totals)[:, None] + prior * size
        return _Part(terms, np.hstack([weights, np.ones((k, 1))]), *chosen(np.flatnonzero(is_text)))

    def share_out(self, block: dict, shares: np.ndarray | None, sums: np.ndarray | None = None) -> np.ndarray:
        """The new shares of a block's texts, a row a topic; adds the terms' parts to ``sums``.

        Each topic's part of a count: the term's weight in the topic times the text's share of it. Terms without a weight do not count.
        """
        unknown = len(self.nodes)
        at = np.searchsorted(self.nodes, block["nodes"])
        local = np.where(np.append(self.nodes, 0)[at] == block["nodes"], at, unknown)
        starts = block["starts"].astype(np.int64)
        ends = np.append(starts[1:], len(block["places"]))
        found = np.empty((len(self.weights), len(starts)))
        first = 0
        while first < len(starts):
            last = max(int(np.searchsorted(ends, starts[first] + SLICE_COUNTS, side="right")), first + 1)
            here, lengths = slice(starts[first], ends[last - 1]), ends[first:last] - starts[first:last]
            places = local.take(block["places"][here])
            parts = [weight.take(places) for weight in self.weights]
            if shares is not None:
                for part, share in zip(parts, shares, strict=True):
                    part *= np.repeat(share[first:last], lengths)
            counts = np.where(places < unknown, block["counts"][here], 0) / reduce(np.add, parts)
            for i, part in enumerate(parts):
                part *= counts
                if sums is not None:
                    sums[i] += np.bincount(places, weights=part, minlength=unknown + 1)
                found[i, first:last] = np.add.reduceat(part, starts[first:last] - starts[first])
            first = last
        return found

    def own_shares(self, block: dict) -> np.ndarray | None:
        return self.shares[:, np.searchsorted(self.texts, block["texts"])] if len(self.texts) else None


_READ = ("part", "texts", "starts", "nodes", "places", "counts")


def _each_block(blocks: pa.Table) -> Iterator[dict]:
    for row in range(blocks.num_rows):
        value = {name: blocks.column(name)[row] for name in _READ[1:]}
        yield {
            "texts": value["texts"].values.to_numpy(), "nodes": value["nodes"].values.to_numpy(),
            **{name: np.frombuffer(value[name].as_buffer(), dtype=kind) for name, kind in (("starts", np.int32), ("places", np.int32), ("counts", np.uint8))},
        }


def _result(found: list[tuple[bool, np.ndarray, np.ndarray]], k: int) -> pa.Table:
    """Rows of sums: whether of texts, the nodes, and their values, a row a topic."""
    flags = [np.full(len(nodes), is_text) for is_text, nodes, _ in found]
    values = [np.concatenate([value[i] for _, _, value in found]) for i in range(k)]
    return pa.table({"node": np.concatenate([nodes for _, nodes, _ in found]), "is_text": np.concatenate(flags)} | {f"w{i}": v for i, v in enumerate(values)})


def _weights(k: int) -> str:
    return "node long, is_text boolean, " + ", ".join(f"w{i} double" for i in range(k))


def _totals(terms: DataFrame, k: int) -> tuple[float, ...]:
    return tuple(terms.agg(*(F.sum(f"w{i}") for i in range(k))).first())  # k numbers


def first_weight(topic: int, seed: int) -> Column:
    """Where a term's weight starts: between 0 and 1, from the MD5 of seed, topic and term."""
    digest = F.md5(F.concat(F.lit(f"{seed}|{topic}|"), F.col("term")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(16**8))


def fit_topics(
    df: DataFrame,
    text_column: str = "text_tokens_clean",
    k: int = 3,
    seed: int = 42,
    min_df: float = 2,
    max_df: float | int = 0.95,
    rounds: int = ROUNDS,
) -> TopicModel | None:
    """G1 + G2: vocabulary and topic weights over texts of more than ten characters; ``None`` below ten texts.

    Latent Dirichlet allocation by expectation and maximisation: a term's occurrences in a text are shared among the topics
    by its weights and the text's, and summed again by term and by text. Both priors are 1 / k, and the first round knows no text's
    weights yet. Every round uses all texts and all terms within the limits. No key is hot: a term has one row a part.
    """
    spark = df.sparkSession
    texts = df.select(text_column).filter(longer_than(text_column))
    if len(texts.limit(MIN_DOCUMENTS).collect()) < MIN_DOCUMENTS:
        return None
    blocks, counted = _keyed(_blocks(df, text_column, F.monotonically_increasing_id()))
    total = blocks.agg(F.sum("size")).first()[0]  # one number
    terms = freeze(
        _within(counted, F.lit(total), min_df, max_df).select("node", "term", *(first_weight(i, seed).alias(f"w{i}") for i in range(k)))
    )
    size = terms.count()
    if not size:
        return None
    placed, parts = _in_parts(blocks)
    of_terms = placed.select("part", F.explode("nodes").alias("node")).join(terms.select("node"), "node", "left_semi").distinct()
    of_texts = placed.select("part", F.explode("texts").alias("node"))
    links = of_terms.select("node", F.lit(False).alias("is_text"), "part").union(of_texts.select("node", F.lit(True), "part"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    written: list[str] = []
    path = None

    def bucketed(table: DataFrame, number: int, *keys: str) -> DataFrame:
        name = f"townsquare_topics_{uuid.uuid4().hex}"
        written.append(name)
        place = own_path(spark, f"{shared_folder(spark)}/townsquare/{name}")
        table.write.bucketBy(number, *keys).option("path", place).saveAsTable(name)
        return spark.table(name)

    try:
        stored = bucketed(placed.select(*_READ), parts, "part")
        links = bucketed(links.repartition(buckets, "node", "is_text"), buckets, "node", "is_text")
        current = terms.select("node", F.lit(False).alias("is_text"), *(f"w{i}" for i in range(k)))
        totals = _totals(current, k)
        for _ in range(rounds):
            sent = links.join(current.hint("shuffle_hash"), ["node", "is_text"])
            made = stored.groupBy("part").cogroup(sent.groupBy("part")).applyInArrow(_round(k, totals, size), _weights(k))
            summed = made.groupBy("node", "is_text").agg(*(F.sum(f"w{i}").alias(f"w{i}") for i in range(k)))
            before, path = path, write_intermediate(summed)
            if before:
                drop_intermediate(spark, before)
            current = read_intermediate(spark, path, summed.schema)
            totals = _totals(current.filter("not is_text"), k)
        found = current.filter("not is_text").join(terms.select("node", "term"), "node")
        model = freeze(found.select("term", *(f"w{i}" for i in range(k))))
    finally:
        for name in written:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
            drop_intermediate(spark, f"{shared_folder(spark)}/townsquare/{name}")
        if path:
            drop_intermediate(spark, path)
    return TopicModel(model, totals, size, text_column)


def _round(k: int, totals: Sequence[float], size: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """One round over a part: the new weights of its terms and texts, as far as this part goes."""

    def run(blocks: pa.Table, sent: pa.Table) -> pa.Table:
        part = _Part.of(sent, k, totals, size)
        sums = np.zeros_like(part.weights)
        found = [(True, block["texts"], part.share_out(block, part.own_shares(block), sums)) for block in _each_block(blocks)]
        return _result([(False, part.nodes, sums[:, :-1]), *found], k)

    return run


def _fold_in(k: int, totals: Sequence[float], size: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """All rounds that fit the texts of a part to a finished model."""

    def run(blocks: pa.Table, sent: pa.Table) -> pa.Table:
        part = _Part.of(sent, k, totals, size)
        found = []
        for block in _each_block(blocks):
            shares = part.share_out(block, None)
            for _ in range(FOLD_IN_ROUNDS - 1):
                shares = part.share_out(block, shares + 1.0 / k)
            found.append((True, block["texts"], shares))
        return _result([(False, part.nodes[:0], part.weights[:, :0]), *found], k)

    return run


def describe_topics(model: TopicModel, terms: int = TERMS_PER_TOPIC) -> DataFrame:
    """(topic, terms, label) with ``label`` as ``Topic i: a, b, …``; equal weights go by the term."""
    tops = []
    for i in range(model.k):
        weight = F.round(f"w{i}", _DIGITS).alias("weight")
        top = model.terms.select(F.lit(i).alias("topic"), weight, "term").orderBy(F.desc("weight"), "term").limit(terms)
        tops.append(top)
    ordered = F.sort_array(F.collect_list(F.struct((-F.col("weight")).alias("minus"), "term")))
    listed = reduce(DataFrame.unionByName, tops).groupBy("topic").agg(ordered.alias("found"))
    topics = listed.select("topic", F.transform("found", lambda t: t["term"]).alias("terms"))
    return topics.withColumn("label", F.format_string("Topic %d: %s", "topic", F.array_join("terms", ", ")))


def dominant_topic(df: DataFrame, model: TopicModel) -> DataFrame:
    """``dominant_topic``, the topic with the largest share; null for short texts.

    A text's shares are fitted to the model in a few rounds; a text without a known term has topic 0, the first of equals.
    """
    k = model.k
    rows = freeze(df.withColumn("__text", F.monotonically_increasing_id()))
    blocks, counted = _keyed(_blocks(rows, model.text_column, F.col("__text")), model.terms)
    names = [f"w{i}" for i in range(k)]
    known = freeze(counted.select("node", "term").join(model.terms, "term").select("node", F.lit(False).alias("is_text"), *names))
    placed, _ = _in_parts(blocks)
    links = placed.select(F.col("part").alias("to"), F.explode("nodes").alias("node")).distinct()
    sent = links.join(known, "node").select("to", "node", "is_text", *names)
    made = placed.select(*_READ).groupBy("part").cogroup(sent.groupBy("to")).applyInArrow(_fold_in(k, model.totals, model.size), _weights(k))
    weights = F.array(*(F.round(name, _DIGITS) for name in names))
    best = freeze(made.select(F.col("node").alias("__text"), (F.array_position(weights, F.array_max(weights)).cast("int") - 1).alias("__best")))
    # Whether a text is long enough is known before the join, so that only texts asked for travel.
    found = rows.withColumn("__long", longer_than(model.text_column)).join(best, "__text", "left")
    topic = F.when(F.col("__long"), F.coalesce("__best", F.lit(0)))
    return found.withColumn("dominant_topic", topic).drop("__text", "__best", "__long")
