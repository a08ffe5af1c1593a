"""Log-bilinear language model, trained in numpy with noise-contrastive estimation.

Word counts come from the whole training corpus. The softmax is factored: the most frequent words
are symbols of their own, and every other word, seen or not, belongs to one of ``CLASSES`` classes by its
ending, so each word of the corpus has a vector, its own or its class's. A context of two symbols predicts the
next one through a product of vectors; a word of a class then has its share of the class by its
counts, which come from all training texts. Matrix products give the scores of all pairs of symbols and the
normalising sums of all contexts, so a token's normalised log-probability is three look-ups.

Texts are dealt by a hash to parts of a fixed size; in each round every part trains a model from the last
average, and the models are averaged by their tokens. A model thus moves by ``ROUNDS`` times ``PART_TOKENS``
tokens at most, however large the corpus; more text means more models in each average.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from townsquare.llm.common import SPACED, U64, Stored, as_text, encoded, map_rows, mix, run_hashes, small_batches, word_runs

#: Symbols of the model: classes of words by their ending, then the most frequent words.
VOCABULARY = 2048
CLASSES = 512
#: Most frequent words whose counts travel to the scoring tasks; rarer words are joined.
FREQUENT = 1 << 17
WIDTH = 32
BATCH_TOKENS = 4096
NOISE = 64
RATE = 0.08
SEED = 7
#: Rounds of training and averaging, and tokens of a part that trains one model in a round.
ROUNDS = 3
PART_TOKENS = 1 << 20
GROUP_CHARS = 1 << 18
#: Distinct words a counting task holds before it hands them on.
HELD_WORDS = 1 << 20
_BLOCK = 128
END = run_hashes(np.frombuffer(b"\n", dtype=np.uint8), np.array([0]), np.array([1]))[0]


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))


def tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words with an end after each text, and where each text begins.

    The low bits of a word's hash are its class, which its last three bytes decide.
    """
    data = [encoded(t).lower() for t in texts]
    view = np.frombuffer(b"\n".join(data), dtype=np.uint8)
    starts, ends = word_runs(view, SPACED)
    edges = np.searchsorted(starts, np.cumsum([0] + [len(d) + 1 for d in data]))
    last = [np.where(ends - k >= starts, view[ends - k], 0).astype(U64) for k in (1, 2, 3)]
    ending = mix(mix(last[0], last[1]), last[2]) >> U64(40)
    hashes = (run_hashes(view, starts, ends) & ~U64(CLASSES - 1)) | (ending & U64(CLASSES - 1))
    out = np.insert(hashes, edges[1:], END)
    return out, edges[:-1] + np.arange(len(texts))


def groups(texts: list[str]) -> Iterator[list[int]]:
    rows, size = [], 0
    for row, text in enumerate(texts):
        if rows and size + len(text) > GROUP_CHARS:
            yield rows
            rows, size = [], 0
        rows.append(row)
        size += len(text)
    if rows:
        yield rows


def count_words(training: DataFrame) -> DataFrame:
    """Rows (word, c) over all training texts, summed in each task first."""
    small_batches(training.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            words, inverse = np.unique(np.concatenate([w for w, _ in held]), return_inverse=True)
            return words, np.bincount(inverse, weights=np.concatenate([c for _, c in held])).astype(np.int64)

        def handed() -> pa.RecordBatch:
            words, counts = merged()
            held.clear()
            return pa.RecordBatch.from_pydict({"word": words.view(np.int64), "c": counts})

        for batch in batches:
            texts = [as_text(t) for t in batch.column(0).to_pylist()]
            for rows in groups(texts):
                held.append(np.unique(tokens([texts[r] for r in rows])[0], return_counts=True))
            if sum(len(w) for w, _ in held) > HELD_WORDS:
                held[:] = [merged()]
                if len(held[0][0]) > HELD_WORDS // 2:
                    yield handed()
        if held:
            yield handed()

    return training.select("text").mapInArrow(run, "word bigint, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


def frequent_words(counts: DataFrame) -> DataFrame:
    """The most frequent words, about FREQUENT at most and the end: whole steps of a logarithmic
    scale of counts, found from a histogram of a few hundred rows, so nothing is sorted. Of the
    step that no longer fits, the words with the smallest mixed hashes come along."""
    step = F.floor(F.log2(F.col("c")) * 16)
    end = F.col("word") == F.lit(int(END.view(np.int64)))
    left, least = FREQUENT, None
    for row in counts.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        if row["count"] > left:
            share = F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < int((1 << 20) * 0.95 * left / row["count"])
            return counts.where(end | (step > row["step"]) | ((step == row["step"]) & share))
        left, least = left - row["count"], row["step"]
    return counts.where(end if least is None else end | (step >= least))


class Lexicon:
    """The frequent words: sorted hashes, counts and symbols; the first symbols are the classes of all other words.

    ``classes`` has the tokens and the distinct words of each class, frequent ones included.
    """

    def __init__(self, words: np.ndarray, counts: np.ndarray, classes: tuple[np.ndarray, np.ndarray]) -> None:
        order = np.lexsort((words, -counts))[: VOCABULARY - CLASSES]
        if len(words) and not (words[order] == END).any():
            order[-1] = np.flatnonzero(words == END)[0]
        own_class = (words & U64(CLASSES - 1)).astype(np.int32)
        index = own_class.copy()
        index[order] = np.arange(CLASSES, CLASSES + len(order))
        by_hash = np.argsort(words)
        self.words, self.counts, self.index = words[by_hash], counts[by_hash], index[by_hash]
        #: Where the words begin whose hashes share their upper bits; few words do.
        self.bits = max(1, (2 * len(words)).bit_length())
        self.first = np.searchsorted(self.words, np.arange(1 << self.bits, dtype=U64) << U64(64 - self.bits)).astype(np.int32)
        self.total, self.distinct, self.size = int(classes[0].sum()), int(classes[1].sum()), CLASSES + len(order)
        tokens, distinct = (x.astype(np.int64) for x in classes)
        np.subtract.at(tokens, own_class[order], counts[order])
        np.subtract.at(distinct, own_class[order], 1)
        #: log10 of what the shares of a class's words are counted against; one more for what was never seen.
        self.rest_log = np.concatenate([np.log10(tokens + distinct + 1.0), np.zeros(len(order))])
        known = np.concatenate([tokens + 1.0, counts[order]])
        self.share = known / known.sum()

    def look(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols and counts; a count of -1 marks words beyond the frequent ones."""
        last = len(self.words) - 1
        at = np.minimum(self.first.take((h >> U64(64 - self.bits)).view(np.int64)), last)
        less = np.flatnonzero((self.words.take(at) < h) & (at < last))
        while len(less):
            at[less] += 1
            further = at[less]
            less = less[(self.words.take(further) < h[less]) & (further < last)]
        beyond = np.flatnonzero(self.words.take(at) != h)
        index, counts = self.index.take(at), self.counts.take(at)
        index[beyond] = (h[beyond] & U64(CLASSES - 1)).astype(np.int32)
        counts[beyond] = -1
        return index, counts


class Model:
    """Vectors of context and target words, weights of the two places, and biases."""

    def __init__(self, size: int, share: np.ndarray) -> None:
        rng = np.random.default_rng(SEED)
        self.context = rng.normal(0, 0.1, (size, WIDTH)).astype(np.float32)
        self.target = rng.normal(0, 0.1, (size, WIDTH)).astype(np.float32)
        self.near = np.ones(WIDTH, dtype=np.float32)
        self.far = np.full(WIDTH, 0.5, dtype=np.float32)
        self.bias = np.log(share).astype(np.float32)

    def arrays(self) -> list[np.ndarray]:
        return [self.context, self.target, self.near, self.far, self.bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.arrays()])

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for x in self.arrays():
            x[...] = flat[at : at + x.size].reshape(x.shape)
            at += x.size


def _gathered(places: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sums of the rows of ``values`` in ``size`` rows; ``places`` are those of a row's pairs of floats, added as one complex number."""
    out = np.zeros((size, values.shape[1]), dtype=np.float32)
    np.add.at(out.view(np.complex64).reshape(-1), places.reshape(-1), values.view(np.complex64).reshape(-1))
    return out


def _sigmoid_of_negative(x: np.ndarray) -> np.ndarray:
    """The logistic function of ``-x``, in place; it is 0 where exp is infinite."""
    with np.errstate(over="ignore"):
        np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


#: Rows of one matrix product: small enough that the library does not spread it over threads, which cost more than they save.
_ROWS = 128


def _times(a: np.ndarray, b: np.ndarray, out: np.ndarray) -> np.ndarray:
    """``a @ b``, a stack of rows at a time."""
    whole = len(a) // _ROWS * _ROWS
    np.matmul(a[:whole].reshape(-1, _ROWS, a.shape[1]), b, out=out[:whole].reshape(-1, _ROWS, b.shape[1]))
    if whole < len(a):
        np.matmul(a[whole:], b, out=out[whole:])
    return out


def _crossed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a.T @ b``, summed over stacks of rows."""
    whole = len(a) // _ROWS * _ROWS
    stacks = a[:whole].reshape(-1, _ROWS, a.shape[1]).transpose(0, 2, 1)
    return np.matmul(stacks, b[:whole].reshape(-1, _ROWS, b.shape[1])).sum(axis=0) + a[whole:].T @ b[whole:]


def _add_to_rows(a: np.ndarray, row: np.ndarray) -> None:
    """``a += row``, a stack of rows at a time."""
    whole = len(a) // _ROWS * _ROWS
    stacks = a[:whole].reshape(-1, _ROWS * len(row))
    stacks += np.tile(row, _ROWS)
    a[whole:] += row


class Trainer:
    """Noise-contrastive estimation with noise shared by a batch, and Adagrad steps."""

    def __init__(self, share: np.ndarray, seed: int) -> None:
        self.model = Model(len(share), share)
        self.rng = np.random.default_rng((SEED, seed))
        self.cumulative = np.cumsum(share)
        self.log_noise = np.log(NOISE * share).astype(np.float32)
        self.squares = [np.full(x.shape, 1e-2, dtype=np.float32) for x in self.model.arrays()]
        self.seen = 0
        # Room for a batch, kept from step to step: fresh pages for every product would cost as much as the sums.
        self.rows = [np.empty((BATCH_TOKENS, WIDTH), dtype=np.float32) for _ in range(4)]
        self.against = np.empty((BATCH_TOKENS, NOISE), dtype=np.float32)
        self.ones = np.ones(BATCH_TOKENS, dtype=np.float32)
        self.number = np.zeros(len(share), dtype=np.intp)
        self.places = np.arange(len(share) * WIDTH // 2).reshape(len(share), WIDTH // 2)

    def step(self, far: np.ndarray, near: np.ndarray, word: np.ndarray) -> None:
        """One step of Adagrad, on the rows of the symbols in the batch and its noise: all others have no gradient.

        What is linear in a context's vector is done once a symbol and not once a token: the weighted vectors
        before they are taken, and the weights on the sums by symbol.
        """
        m = self.model
        size, n = len(m.bias), len(word)
        scale = np.float32(1 / math.sqrt(n))
        noise = np.minimum(np.searchsorted(self.cumulative, self.rng.random(NOISE)), size - 1)
        present = np.zeros(size, dtype=bool)
        for symbols in (far, near, word, noise):
            present[symbols] = True
        own = np.flatnonzero(present)
        size = len(own)
        self.number[own] = np.arange(size)
        far, near, word, noise = (self.number.take(x) for x in (far, near, word, noise))
        context, target = m.context.take(own, axis=0), m.target.take(own, axis=0)
        offset = (self.log_noise - m.bias).take(own)
        h, b, q, dh = (room[:n] for room in self.rows)
        down = self.against[:n]
        (context * m.near).take(near, axis=0, out=h, mode="clip")
        (context * m.far).take(far, axis=0, out=b, mode="clip")
        target.take(word, axis=0, out=q, mode="clip")
        h += b
        np.multiply(h, q, out=b)
        up = _sigmoid_of_negative(offset.take(word) - b @ self.ones[:WIDTH])
        up -= 1
        up *= scale
        drawn = target.take(noise, axis=0)
        _times(h, np.ascontiguousarray(-drawn.T), down)
        _add_to_rows(down, offset.take(noise))
        _sigmoid_of_negative(down)
        drawn *= scale
        _times(down, drawn, dh)
        d_noise, d_noise_bias = _crossed(down, h) * scale, self.ones[:n] @ down * scale
        b[...] = up[:, None]
        q *= b
        dh += q
        h *= b
        d_target = _gathered(self.places.take(word, axis=0), h, size)
        np.add.at(d_target, noise, d_noise)
        d_bias = np.bincount(word, weights=up, minlength=size).astype(np.float32)
        np.add.at(d_bias, noise, d_noise_bias)
        d_near_rows, d_far_rows = (_gathered(self.places.take(x, axis=0), dh, size) for x in (near, far))
        d_near, d_far = (np.einsum("ij,ij->j", context, rows) for rows in (d_near_rows, d_far_rows))
        d_near_rows *= m.near
        d_far_rows *= m.far
        d_near_rows += d_far_rows
        gradients = [d_near_rows, d_target, d_near, d_far, d_bias]
        every = slice(None)
        for x, g, s, rows in zip(m.arrays(), gradients, self.squares, (own, own, every, every, own), strict=True):
            root = s[rows] + g * g
            s[rows] = root
            np.sqrt(root, out=root)
            g /= root
            g *= np.float32(RATE)
            x[rows] -= g
        self.seen += n

    def learn(self, index: np.ndarray, starts: np.ndarray, end: int) -> None:
        far, near = contexts(index, starts, end)
        for k in range(0, len(index), BATCH_TOKENS):
            cut = slice(k, k + BATCH_TOKENS)
            self.step(far[cut], near[cut], index[cut])


def contexts(index: np.ndarray, starts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The last but one and the last word before each token; a text begins behind two ends."""
    near = np.concatenate([[end], index[:-1]])
    far = np.concatenate([[end, end], index[:-2]])[: len(index)]
    near[starts] = end
    far[starts] = end
    second = starts + 1
    far[second[second < len(index)]] = end
    return far, near


def deal(training: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Rows (part, key, words): texts as vocabulary numbers, dealt by a hash of id and text, so
    that parts and their order do not depend on the layout of the input."""
    small_batches(training.sparkSession)
    shared = training.sparkSession.sparkContext.broadcast(lexicon)
    parts = max(1, -(-lexicon.total // PART_TOKENS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = shared.value
        for batch in batches:
            numbers, keys = batch.column(0), batch.column(1)
            texts = [as_text(t) for t in batch.column(2).to_pylist()]
            for rows in groups(texts):
                h, starts = tokens([texts[r] for r in rows])
                index = lexicon.look(h)[0].astype(np.int32)
                words = pa.ListArray.from_arrays(pa.array(np.append(starts, len(h)), pa.int32()), pa.array(index))
                cut = slice(rows[0], rows[-1] + 1)
                yield pa.RecordBatch.from_arrays([numbers[cut], keys[cut], words], names=["part", "key", "words"])

    key = F.xxhash64("text", "doc_id")
    keyed = training.select(F.pmod(key, F.lit(parts)).cast("int").alias("part"), key.alias("key"), "text")
    dealt = keyed.mapInArrow(run, "part int, key bigint, words array<int>")
    # The number of tasks follows the cluster and not the tokens; parts are dealt to them evenly.
    n = min(parts, tasks(training.sparkSession))
    places = F.array(*map(F.lit, place_keys(training.sparkSession, n)))
    placed = dealt.withColumn("place", F.element_at(places, F.col("part") % n + 1))
    return placed.repartition(n, "place").sortWithinPartitions("part", "key").drop("place")


def place_keys(spark: SparkSession, n: int) -> list[int]:
    """For each of ``n`` partitions an integer that hash partitioning sends there, so that rows can be dealt out evenly."""
    drawn = spark.range(max(64, n * (8 + 2 * n.bit_length()))).select(F.col("id").cast("int").alias("key"))
    found = drawn.groupBy(F.pmod(F.hash("key"), F.lit(n)).alias("place")).agg(F.min("key").alias("key"))
    keys = {row["place"]: row["key"] for row in found.collect()}  # one row per partition
    # Rows without an own key would only share a task with others.
    return [keys.get(place, place) for place in range(n)]


def tasks(spark: SparkSession) -> int:
    """Tasks that a round is dealt to at most."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Part, word numbers and starts of texts: a part at a time, in pieces if texts are huge."""
    part, held, size = -1, [], 0

    def piece() -> tuple[int, np.ndarray, np.ndarray]:
        starts = np.cumsum([0] + [len(x) for x in held])[:-1]
        return part, np.concatenate(held).astype(np.int64), starts

    for batch in batches:
        words = batch.column(1)
        offsets, values = words.offsets.to_numpy(), words.values.to_numpy()
        for row, number in enumerate(batch.column(0).to_pylist()):
            if held and (number != part or size >= 2 * PART_TOKENS):
                yield piece()
                held, size = [], 0
            part = number
            held.append(values[offsets[row] : offsets[row + 1]])
            size += len(held[-1])
    if held:
        yield piece()


def train(training: DataFrame, lexicon: Lexicon, stored: Stored) -> Model:
    """Rounds of training in every part from the last average."""
    end = int(lexicon.look(np.array([END], dtype=U64))[0][0])
    model = Model(lexicon.size, lexicon.share)
    dealt = stored.put(deal(training, lexicon))
    for number in range(ROUNDS):
        _round(dealt, lexicon.share, model, number, end)
    stored.drop(dealt)
    return model


def _round(dealt: DataFrame, share: np.ndarray, model: Model, number: int, end: int) -> None:
    """Train every part from ``model`` and put the average by tokens in its place.

    A task sums the models of its parts; sums are built in two steps over salted groups, each of as
    many sums as the root of the number of tasks, one piece of the model at a time.
    """
    salts = math.isqrt(tasks(dealt.sparkSession)) + 1
    shared = dealt.sparkSession.sparkContext.broadcast((share, model.flat()))
    parts_schema = "part int, salt int, weight double, data binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        share, start = shared.value
        task = TaskContext.get().partitionId()
        flat, seen, trainer, last = np.zeros(len(start)), 0, None, -1
        for part, index, starts in _parts(batches):
            if part != last and trainer is not None:
                flat += trainer.model.flat().astype(np.float64) * trainer.seen
                seen += trainer.seen
            if part != last:
                trainer, last = Trainer(share, part * ROUNDS + number), part
                trainer.model.load(start)
            trainer.learn(index, starts, end)
        if trainer is not None:
            flat += trainer.model.flat().astype(np.float64) * trainer.seen
            seen += trainer.seen
            pieces = np.array_split(flat, max(1, len(flat) // (_BLOCK * WIDTH)))
            yield pa.RecordBatch.from_pydict({
                "part": pa.array(range(len(pieces)), pa.int32()), "salt": pa.array([task % salts] * len(pieces), pa.int32()),
                "weight": [float(seen)] * len(pieces), "data": [p.tobytes() for p in pieces],
            })

    def summed(frame: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x) for x in frame["data"])
        return pd.DataFrame({
            "part": frame["part"].iloc[:1].astype("int32"), "salt": frame["salt"].iloc[:1].astype("int32"),
            "weight": [frame["weight"].sum()], "data": [total.tobytes()],
        })

    parts = dealt.select("part", "words").mapInArrow(run, parts_schema)
    parts = parts.groupBy("part", "salt").applyInPandas(summed, parts_schema)
    rows = parts.groupBy("part").applyInPandas(summed, parts_schema).orderBy("part").collect()
    if rows:
        model.load(np.concatenate([np.frombuffer(r["data"]) / r["weight"] for r in rows]))
    shared.unpersist()


class Tables:
    """Scores of all word pairs and normalising sums of all contexts, by matrix products."""

    def __init__(self, model: Model) -> None:
        self.near = (model.context * model.near) @ model.target.T + model.bias
        self.far = (model.context * model.far) @ model.target.T
        tops = self.near.max(axis=1), self.far.max(axis=1)
        product = np.exp(self.far - tops[1][:, None]) @ np.exp(self.near - tops[0][:, None]).T
        self.log_sum = np.log(product) + tops[1][:, None] + tops[0][None, :]

    def log_probability(self, far: np.ndarray, near: np.ndarray, word: np.ndarray) -> np.ndarray:
        size = len(self.near)
        by_near, by_far, log_sum = self.near.take(near * size + word), self.far.take(far * size + word), self.log_sum.take(far * size + near)
        return (by_near + by_far - log_sum).astype(np.float64)


_TABLES: dict[str, Tables] = {}


def _counted_by_text(words: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct words of each of ``n`` texts, how often each occurs in it, and where each text's words begin and end."""
    order = np.lexsort((words, text))
    words, text = words[order], text[order]
    new = np.flatnonzero(np.concatenate([[True], (words[1:] != words[:-1]) | (text[1:] != text[:-1])])[: len(words)])
    return words[new], np.diff(np.append(new, len(words))), np.searchsorted(text[new], np.arange(n + 1))


def score(docs: DataFrame, stored: Stored) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from documents that are not held out. Null and empty texts are one end token; a
    null doc_id is not held out; repeated rows are counted and scored each. Where nothing
    can be learned, both scores are the base with N = V = 0. An empty table gives an empty
    result; other columns are ignored.
    """
    slim = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out().alias("held_out")
    )
    training = slim.where("not held_out").select("doc_id", "text")
    counts = stored.put(count_words(training))
    classes = np.zeros((2, CLASSES), dtype=np.int64)
    by_class = counts.groupBy(F.col("word").bitwiseAND(F.lit(CLASSES - 1)).alias("class")).agg(F.sum("c"), F.count("*"))
    for number, c, words in by_class.collect():
        classes[:, number] = c, words
    total, distinct = map(int, classes.sum(axis=1))
    top = frequent_words(counts).toPandas()
    lexicon = Lexicon(top["word"].to_numpy(dtype=np.int64).view(U64), top["c"].to_numpy(dtype=np.int64), tuple(classes))
    model = train(training, lexicon, stored) if total else None
    shared = docs.sparkSession.sparkContext.broadcast((lexicon, model, uuid.uuid4().hex))
    base_log = float(np.log10(total + distinct + 1))

    def run(ids, held, texts):
        lexicon, model, name = shared.value
        if model is not None and name not in _TABLES:
            _TABLES.clear()
            _TABLES[name] = Tables(model)
        texts = [as_text(t) for t in texts]
        names = ("n_tokens", "n_top", "log_count", "log_model")
        out = {n: np.zeros(len(texts)) for n in names}
        tail, tails = [], [0]
        for rows in groups(texts):
            h, starts = tokens([texts[r] for r in rows])
            if model is None:
                index, found = np.zeros(len(h), dtype=np.int64), np.zeros(len(h), dtype=np.int64)
            else:
                index, found = lexicon.look(h)
            rare = found < 0
            log_count = np.where(rare, 0.0, np.log10(found + 1.0, where=~rare, out=np.zeros(len(h))))
            if model is None:
                by_token = np.zeros(len(h))
            else:
                end = int(lexicon.look(np.array([END], dtype=U64))[0][0])
                by_token = _TABLES[name].log_probability(*contexts(index, starts, end), index) / np.log(10)
                by_token += np.where(index < CLASSES, log_count, 0.0) - lexicon.rest_log[index]
            values = (np.ones(len(h)), found > 0, log_count, by_token)
            for n, v in zip(names, values, strict=True):
                out[n][rows] = np.add.reduceat(v.astype(np.float64), starts)
            at = np.flatnonzero(rare)
            words, times, edges = _counted_by_text(h[at], np.searchsorted(starts, at, side="right") - 1, len(starts))
            tail.append((words.view(np.int64), times))
            tails.extend((tails[-1] + edges[1:]).tolist())
        words, times = (np.concatenate([t[k] for t in tail]) for k in (0, 1))
        rare_words = pa.StructArray.from_arrays([pa.array(words, pa.int64()), pa.array(times, pa.int32())], names=["word", "times"])
        return {
            "doc_id": pa.array(ids, pa.int64()), "held_out": held, "n_tokens": out["n_tokens"].astype(np.int64),
            "n_top": out["n_top"].astype(np.int64), "log_count": out["log_count"], "log_model": out["log_model"],
            "tail": pa.ListArray.from_arrays(pa.array(tails, pa.int32()), rare_words),
        }

    schema = (
        "doc_id bigint, held_out boolean, n_tokens bigint, n_top bigint, log_count double, log_model double,"
        " tail array<struct<word:bigint,times:int>>"
    )
    scored = map_rows(slim, ["doc_id", "held_out", "text"], run, schema)
    scored = stored.put(scored.withColumn("row", F.monotonically_increasing_id()))
    rare = scored.select("row", F.explode("tail").alias("t")).select("row", "t.word", "t.times")
    rest = (
        rare.join(counts, "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + 1)).alias("tail_log"),
            F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("tail_known"),
        )
    )
    zero = F.lit(0)
    log_count = F.col("log_count") + F.coalesce("tail_log", F.lit(0.0))
    base = log_count - F.col("n_tokens") * base_log
    # The map has already set the words of a class against their class, the rare ones with a
    # log count of zero.
    own = F.col("log_model") + F.coalesce("tail_log", F.lit(0.0))
    return scored.drop("tail").join(rest, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_top") + F.coalesce("tail_known", zero)).cast("bigint").alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"), base.alias("base_score"),
        (own if model is not None else base).alias("score"),
    )
