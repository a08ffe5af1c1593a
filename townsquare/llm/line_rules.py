"""Quality rules: frequent lines across documents, and documents they leave depleted.

Lines are normalised and hashed; per host, the distinct documents holding a line are counted,
lines above the limit are removed, and documents that lose too much are rejected. Copies must
not make prose look like boilerplate, so equal texts of a host are one document, and near
copies of each other, found by a MinHash sketch of the whole text, are one as well.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from townsquare.llm.common import (
    U64,
    Stored,
    as_text,
    components,
    encoded,
    hashed_words,
    map_rows,
    small_batches,
    windows,
)
from townsquare.llm.near_duplicates import signature

SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
#: A line is frequent in a host above this share of its documents and at least this number.
LINE_SHARE = 0.02
LINE_DOCUMENTS = 20
#: Texts of a host are one document if so much of their 3-word windows is shared, as their sketches tell.
COPY_SIMILARITY = 0.7
#: A sketch has so many bands of so many values; texts that share a band are compared.
BANDS = 16
BAND_VALUES = 4
#: A document is depleted when less than this share of its words is left.
LEFT_SHARE = 0.5
MIN_WORDS = 50
REPEAT_PERCENT = 50

_DIGITS = re.compile(r"\b[0-9]+\b")
_LINES = "array<struct<line:bigint,words:int>>"
_SCHEMA = (
    "doc_id bigint, source string, text_key bigint, n_words bigint, word_chars bigint, n_symbols bigint,"
    f" n_dup_lines bigint, n_repeat_words bigint, sketch array<int>, lines {_LINES}"
)
_RNG = np.random.default_rng(20240601)
_FACTORS = _RNG.integers(1, 1 << 32, BANDS * BAND_VALUES, dtype=np.uint32) | np.uint32(1)
_TERMS = _RNG.integers(1, 1 << 32, BANDS * BAND_VALUES, dtype=np.uint32)


def normal_line(line: str) -> str:
    """Case, spacing and numbers do not tell lines apart."""
    return _DIGITS.sub("0", " ".join(line.lower().split()))


def line_hash(line: str) -> int:
    value = xxhash.xxh3_64_intdigest(encoded(normal_line(line)))
    return value - (1 << 64) if value >= 1 << 63 else value


def repeated_words(h: np.ndarray) -> int:
    """Words that lie in a 3-word window found twice or more."""
    w = windows(h, 3)
    if len(w) < 2:
        return 0
    order = np.argsort(w)
    twice = np.zeros(len(w) + 1, dtype=bool)
    twice[1:-1] = w[order[1:]] == w[order[:-1]]
    hit = np.empty(len(w), dtype=bool)
    hit[order] = twice[1:] | twice[:-1]
    covered = np.zeros(len(h) + 1, dtype=np.int64)
    covered[: len(w)] += hit
    covered[3 : 3 + len(w)] -= hit
    return int((np.cumsum(covered)[:-1] > 0).sum())


def sketch(words: np.ndarray) -> np.ndarray | None:
    """MinHash values of the 3-word windows; a text without words has none."""
    w = windows(words, min(3, len(words))) if len(words) else words
    return signature(w >> U64(16), _FACTORS, _TERMS) if len(w) else None


def measure(text: str) -> tuple[int, int, int, int, int, np.ndarray | None]:
    words = hashed_words(encoded(text))
    filled = [line for line in text.split("\n") if line.strip(SPACES)]
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(filled) - len(set(filled)),
        repeated_words(words),
        sketch(words),
    )


def document_lines(text: str) -> list[dict]:
    """Each distinct normalised line once, with its words in all."""
    found: dict[int, dict] = {}
    for line in text.split("\n"):
        if line.strip(SPACES):
            h = line_hash(line)
            found.setdefault(h, {"line": h, "words": 0})["words"] += len(encoded(line).split())
    return list(found.values())


def profile(docs: DataFrame) -> DataFrame:
    """Base measures and lines of every document, in one scan."""

    def run(ids, texts, sources, keys):
        texts = [as_text(t) for t in texts]
        measures = [measure(t) for t in texts]
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "sketch")
        out = {"doc_id": ids, "source": sources, "text_key": keys}
        out |= {name: [m[k] for m in measures] for k, name in enumerate(names)}
        return _arrow(out | {"lines": [document_lines(t) for t in texts]})

    slim = docs.select(
        F.col("doc_id").cast("bigint"), F.col("text").cast("string"), F.col("source").cast("string"), text_key()
    )
    return map_rows(slim, ["doc_id", "text", "source", "text_key"], run, _SCHEMA)


def text_key() -> Column:
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text_key")


def _arrow(out: dict) -> dict:
    kinds = {"doc_id": pa.int64(), "source": pa.string(), "text_key": pa.int64()}
    kinds["sketch"] = pa.list_(pa.int32())
    kinds["lines"] = pa.list_(pa.struct([("line", pa.int64()), ("words", pa.int32())]))
    return {k: pa.array(v, kinds.get(k, pa.int64())) for k, v in out.items()}


def _node() -> Column:
    """A text of a host."""
    return F.xxhash64(F.col("source").isNull(), F.coalesce("source", F.lit("")), "text_key").alias("node")


def copies(profiled: DataFrame, stored: Stored) -> DataFrame:
    """Rows (node, root): the texts of a host that are near copies of others, and one text for each group.

    Texts that share a band of their sketches with the band's least text are compared with it
    on whole sketches; pairs similar enough are edges. Only keys and sketches are moved.
    """
    texts = profiled.where("sketch is not null").select("source", _node(), "sketch")
    paths = [
        F.xxhash64(F.col("source").isNull(), "source", F.lit(t), *[F.col("sketch")[t * BAND_VALUES + k] for k in range(BAND_VALUES)])
        for t in range(BANDS)
    ]
    bands = texts.select("node", F.explode(F.array(*paths)).alias("band"))
    least = (
        bands.groupBy("band").agg(F.min("node").alias("first"), F.max("node").alias("last"))
        .where("first != last").select("band", "first")
    )
    pairs = stored.put(bands.join(least, "band").where("node != first").select("node", "first").distinct())
    sketches = texts.select("node", "sketch").dropDuplicates(["node"])
    ends = pairs.select("node").union(pairs.select("first")).distinct()
    sketches = stored.put(sketches.join(ends, "node", "left_semi"))
    other = sketches.select(F.col("node").alias("first"), F.col("sketch").alias("other"))
    equal = F.aggregate(
        F.zip_with("sketch", "other", lambda a, b: (a == b).cast("int")), F.lit(0), lambda total, one: total + one
    )
    edges = (
        pairs.join(sketches, "node").join(other, "first")
        .where(equal >= COPY_SIMILARITY * BANDS * BAND_VALUES)
        .select(F.col("node").alias("a"), F.col("first").alias("b"))
    )
    return components(edges, stored)


def frequent_lines(profiled: DataFrame, stored: Stored, share: float, documents: int) -> DataFrame:
    """Lines above the limits: rows (source, line).

    A first count of rows, combined map-side, leaves the lines that can be frequent at all;
    for these the documents are counted, near copies as one.
    """
    roots = stored.put(copies(profiled, stored))
    places = profiled.select("source", "text_key", F.explode("lines.line").alias("line"))
    often = (
        places.groupBy("source", "line").count().where(F.col("count") > documents)
        .select(F.col("source").alias("often_source"), F.col("line").alias("often_line"))
    )
    same_line = (F.col("line") == F.col("often_line")) & F.col("source").eqNullSafe(F.col("often_source"))
    root = F.coalesce("root", "node")
    texts = profiled.select("source", _node()).distinct()
    hosts = (
        texts.join(roots, "node", "left").select("source", root.alias("root")).distinct()
        .groupBy(F.col("source").alias("host")).agg(F.count("*").alias("host_documents"))
    )
    counted = (
        places.join(often, same_line, "left_semi").select("source", "line", _node()).distinct()
        .join(roots, "node", "left").select("source", "line", root.alias("root")).distinct()
        .groupBy("source", "line").agg(F.count("*").alias("documents"))
        .where(F.col("documents") > documents)
    )
    return (
        counted.join(hosts, F.col("source").eqNullSafe(F.col("host")))
        .where(F.col("documents") > share * F.col("host_documents"))
        .select("source", "line")
    )


def judge(
    docs: DataFrame,
    stored: Stored,
    share: float = LINE_SHARE,
    documents: int = LINE_DOCUMENTS,
    left_share: float = LEFT_SHARE,
) -> DataFrame:
    """One row per document: measures, words removed with frequent lines, and the verdict.

    ``doc_id`` may be null or repeat; a null text counts as empty, has no words and fails
    the base rule; a null source is a host of its own. The verdict depends on text and
    source alone, so equal rows get equal verdicts. An empty table gives an empty result;
    columns besides doc_id, text and source are ignored.
    """
    profiled = stored.put(profile(docs))
    frequent = stored.put(frequent_lines(profiled, stored, share, documents))
    own = profiled.select("source", "text_key", F.explode("lines").alias("l")).select(
        F.col("source").alias("own_source"), "text_key", F.col("l.line").alias("own_line"), F.col("l.words").alias("words")
    ).distinct()
    lost = (
        own.join(frequent, F.col("own_source").eqNullSafe(F.col("source")) & (F.col("own_line") == F.col("line")))
        .groupBy("own_source", F.col("text_key").alias("lost_key"))
        .agg(F.sum("words").cast("bigint").alias("removed_words"), F.collect_set("line").alias("removed_lines"))
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    removed = F.coalesce("removed_words", F.lit(0))
    return (
        profiled.drop("lines", "sketch")
        .join(lost, F.col("source").eqNullSafe(F.col("own_source")) & (F.col("text_key") == F.col("lost_key")), "left")
        .withColumn("removed_words", removed.cast("bigint"))
        .withColumn("base_failed", failed)
        .withColumn("depleted", F.col("n_words") - F.col("removed_words") < left_share * F.col("n_words"))
        .withColumn("kept", ~F.col("base_failed") & ~F.col("depleted"))
        .drop("own_source", "lost_key")
    )


def without_lines(text: str, lines: set[int]) -> str:
    """The text without the named lines; lines without a word stay."""
    return "\n".join(x for x in text.split("\n") if not x.strip(SPACES) or line_hash(x) not in lines)


def clean(docs: DataFrame, stored: Stored) -> DataFrame:
    """The kept documents, without their frequent lines, in the columns of ``docs``.

    ``n_chars``, where there is such a column, follows the new text.
    """
    small_batches(docs.sparkSession)
    verdicts = (
        judge(docs, stored).where("kept")
        .groupBy(F.col("source").alias("__llm_source"), F.col("text_key").alias("__llm_key"))
        .agg(F.first("removed_lines").alias("__llm_lines"))
    )
    own = docs.withColumn("__llm_own", text_key())
    same = F.col("source").cast("string").eqNullSafe(F.col("__llm_source")) & (F.col("__llm_own") == F.col("__llm_key"))
    joined = own.join(verdicts, same)
    text = F.when(F.col("__llm_lines").isNull(), F.col("text")).otherwise(_strip("text", "__llm_lines"))
    out = joined.withColumn("text", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = F.when(F.col("__llm_lines").isNull(), F.col("n_chars")).otherwise(F.length("text"))
        out = out.withColumn("n_chars", changed.cast(kind))
    return out.select(*docs.columns)


@F.pandas_udf(T.StringType())
def _strip(texts: pd.Series, lines: pd.Series) -> pd.Series:
    return pd.Series([
        t if t is None or gone is None else without_lines(t, set(gone)) for t, gone in zip(texts, lines, strict=True)
    ], dtype=object)
