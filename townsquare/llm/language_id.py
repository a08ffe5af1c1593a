"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts of hashed 1- to 3-grams per language come from all labelled texts, summed in each
task before they are shuffled. The log-probability matrix, of fixed height and one column a
language, is broadcast; texts are scored in batches by gathering its rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from townsquare.llm.common import map_rows, small_batches

BITS = 16
ALPHA = 0.05
UNKNOWN = "und"
#: The matrix must stay small enough to broadcast.
MAX_LANGUAGES = 1000
GROUP_CHARS = 1 << 17
_FACTORS = tuple(np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D))
_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Which code points are letters."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000))
    return _LETTERS[0]


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased letters of the texts, everything else as spaces, with two spaces around
    each text, and where each text begins."""
    parts = [t.lower().encode("utf-32-le", "surrogatepass") for t in texts]
    gap = "  ".encode("utf-32-le")
    points = np.frombuffer(gap + gap.join(parts) + gap, dtype="<u4")
    starts = np.cumsum([0] + [len(p) // 4 + 2 for p in parts[:-1]])
    return np.where(letters()[points], points, np.uint32(32)).astype(np.uint32), starts


def features(points: np.ndarray) -> list[np.ndarray]:
    """Hashed n-grams that begin at each place, for n from 1 to 3; the last places are padded."""
    shift = np.uint32(32 - BITS)
    a, b, c = _FACTORS
    one = points * a
    two = (one[:-1] ^ (points[1:] * b)) * a
    three = (two[:-1] ^ (points[2:] * c)) * b
    return [((x ^ (x >> np.uint32(15))) * c) >> shift for x in (one, two, three)]


def _groups(texts: list[str]) -> Iterator[list[int]]:
    rows, size = [], 0
    for row, text in enumerate(texts):
        if rows and size + len(text) > GROUP_CHARS:
            yield rows
            rows, size = [], 0
        rows.append(row)
        size += len(text)
    if rows:
        yield rows


def train(labelled: DataFrame, alpha: float = ALPHA) -> tuple[list[str], np.ndarray, np.ndarray] | None:
    """Languages, log-probabilities (features by languages) and log-priors from (text, lang)."""
    small_batches(labelled.sparkSession)
    size = 1 << BITS

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        documents: dict[str, int] = {}
        for batch in batches:
            by_language: dict[str, list[str]] = {}
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                by_language.setdefault(lang, []).append(text)
            for lang, texts in by_language.items():
                total = sums.setdefault(lang, np.zeros(size, dtype=np.int64))
                documents[lang] = documents.get(lang, 0) + len(texts)
                for rows in _groups(texts):
                    for x in features(code_points([texts[r] for r in rows])[0]):
                        total += np.bincount(x, minlength=size)
        for lang, total in sums.items():
            at = np.flatnonzero(total)
            rows = {"lang": [lang] * (len(at) + 1), "feature": [-1, *at.tolist()], "n": [documents[lang], *total[at].tolist()]}
            yield pa.RecordBatch.from_pydict(
                rows, schema=pa.schema([("lang", pa.string()), ("feature", pa.int32()), ("n", pa.int64())])
            )

    def column(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(size)
        at = frame["feature"].to_numpy()
        total[at[at >= 0]] = frame["n"].to_numpy()[at >= 0]
        logs = np.log((total + alpha) / (total.sum() + alpha * size)).astype("<f4")
        documents = int(frame["n"].to_numpy()[at < 0].sum())
        return pd.DataFrame({"lang": [frame["lang"].iloc[0]], "documents": [documents], "logs": [logs.tobytes()]})

    rows = (
        labelled.select("text", "lang").mapInArrow(counts, "lang string, feature int, n bigint")
        .groupBy("lang", "feature").agg(F.sum("n").alias("n"))
        .groupBy("lang").applyInPandas(column, "lang string, documents bigint, logs binary")
        .orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    )
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: the model would not fit a broadcast")
    if not rows:
        return None
    logs = np.stack([np.frombuffer(r["logs"], dtype="<f4") for r in rows], axis=1)
    prior = np.log(np.array([r["documents"] for r in rows], dtype=float) / sum(r["documents"] for r in rows))
    return [r["lang"] for r in rows], np.ascontiguousarray(logs), prior


def score(texts: list[str], languages: list[str], logs: np.ndarray, prior: np.ndarray) -> list[tuple[str, float]]:
    """Most probable language and its posterior for each text."""
    out: list[tuple[str, float]] = []
    for rows in _groups(texts):
        points, starts = code_points([texts[r] for r in rows])
        sums = np.tile(prior, (len(rows), 1))
        for x in features(points):
            sums += np.add.reduceat(logs[x], starts, axis=0, dtype=np.float64)
        lettered = np.add.reduceat(points != 32, starts) > 0
        sums -= sums.max(axis=1, keepdims=True)
        posterior = np.exp(sums)
        posterior /= posterior.sum(axis=1, keepdims=True)
        best = posterior.argmax(axis=1)
        out += [
            (languages[b], float(p[b])) if ok else (UNKNOWN, 0.0)
            for b, p, ok in zip(best, posterior, lettered, strict=True)
        ]
    return out


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    Learns from text and lang of documents that are not held out and have both. Null texts,
    texts without letters and all texts, where nothing can be learned, are ``und`` with
    score 0. Ties go to the first language by name. A null doc_id is not held out; repeated
    rows each count; other columns are ignored.
    """
    slim = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"), held_out().alias("held_out"),
    )
    model = train(slim.where("text is not null and lang is not null and not held_out"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(ids, held, texts):
        model = shared.value
        found = [(UNKNOWN, 0.0)] * len(texts)
        filled = [k for k, t in enumerate(texts) if t]
        if model and filled:
            for k, answer in zip(filled, score([texts[k] for k in filled], *model), strict=True):
                found[k] = answer
        return {
            "doc_id": pa.array(ids, pa.int64()), "held_out": held,
            "lang_pred": [f[0] for f in found], "score": [f[1] for f in found],
        }

    columns = ["doc_id", "held_out", "text"]
    return map_rows(slim, columns, run, "doc_id bigint, held_out boolean, lang_pred string, score double")
