"""Benchmark decontamination by template windows.

Texts are canonicalised word by word: numbers, units and names become typed placeholders,
everything else its lower-cased letters and digits. Windows of the templates are joined by
hash with those of the benchmark. A document leaks an item if windows with consistent slots
cover enough of it: on a diagonal each value of the item answers to one value of the
document, and windows that hold a value with several answers do not count. So re-parameterised
questions are found too. Windows of the literal lower-cased words stand beside the templates,
so that a copy is found whatever its capitals, line ends and share of numbers are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from townsquare.llm.common import (
    ALNUM,
    ARROW_ROWS,
    U64,
    Stored,
    as_text,
    byte_table,
    encoded,
    run_hashes,
    small_batches,
    windows,
    word_runs,
)

WINDOW = 8
#: Shorter items are looked for as literal words only.
SHORTEST = 4
#: Share of an item's windows that must be found.
COVER = 0.5
#: The same for literal windows: copies, where changed values are the templates' part.
LITERAL_COVER = 0.8
#: An item is looked for literally from so many words on, or from so many bytes: a word like "four" is in any text.
LEAST_WORDS = 3
LEAST_BYTES = 24
#: Up to so many benchmark windows travel to the scan as a filter; beyond, all windows are joined.
FILTER_WINDOWS = 2_000_000
GROUP_CHARS = 1 << 16
UNITS = frozenset(
    "mm cm m km in ft mi mg g kg t lb oz ml l s sec min h hr hrs hours minutes seconds days weeks months years"
    " percent usd eur gbp dollars euros pounds miles meters metres grams litres liters".split()
)


def _code(word: bytes) -> np.ndarray:
    return run_hashes(np.frombuffer(word, dtype=np.uint8), np.array([0]), np.array([len(word)]))[0]


_LITERAL = _code(b"\0literal")
_PLACE = {kind: _code(b"\0" + kind.encode()) for kind in ("number", "measure", "unit", "name")}
_UNIT_CODES = np.sort(np.array([_code(u.encode()) for u in sorted(UNITS)], dtype=U64))
_UNIT_TABLE = np.zeros(1 << 16, dtype=bool)
_UNIT_TABLE[_UNIT_CODES >> U64(48)] = True
_DIGIT, _UPPER, _STOP, _SPACE = (byte_table(*ranges) for ranges in (
    [(0x30, 0x39)], [(0x41, 0x5A)], [(0x21, 0x21), (0x2E, 0x2E), (0x3A, 0x3B), (0x3F, 0x3F), (0x0A, 0x0A)], [(9, 13), (32, 32)]
))


def _counted(marks: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(marks, dtype=np.int32)])


class Template:
    """Canonical words of one text: hashes, slot marks and where they stand.

    A number and its decimals are one word. A name is a capitalised word that does not open
    a sentence; words all in capitals are plain words.
    """

    def __init__(self, text: str) -> None:
        own = np.frombuffer(encoded(text), dtype=np.uint8)
        self.data = encoded(text.lower())
        low = np.frombuffer(self.data, dtype=np.uint8)
        starts, ends = word_runs(low, ALNUM)
        hashes = run_hashes(low, starts, ends)
        self.literal, self.literal_starts = hashes.copy(), starts
        first = low[starts]
        lead = _DIGIT[first]
        slot = np.zeros(len(starts), dtype=bool)
        again = slot.copy()
        if lead.any():
            digits = _counted(_DIGIT[low])
            number = digits[ends] - digits[starts] == ends - starts
            hashes[lead & ~number] = _PLACE["measure"]
            hashes[number] = _PLACE["number"]
            slot = lead
            near = (starts[1:] - ends[:-1] == 1) & number[1:] & number[:-1]
            again[1:] = near & ~_SPACE[low[np.minimum(ends[:-1], len(low) - 1)]]
        units = np.flatnonzero(_UNIT_TABLE[hashes >> U64(48)])
        at = np.minimum(np.searchsorted(_UNIT_CODES, hashes[units]), len(_UNIT_CODES) - 1)
        units = units[_UNIT_CODES[at] == hashes[units]]
        hashes[units] = _PLACE["unit"]
        slot[units] = True
        if len(starts) > 1:
            # Lower case may change a word's length, never the number of words.
            own_starts, own_ends = word_runs(own, ALNUM)
            capital = np.flatnonzero(_UPPER[own[own_starts]] & ~slot)
            capital = capital[capital > 0]
            if len(capital):
                stops, upper = _counted(_STOP[own]), _counted(_UPPER[own])
                begin, end = own_starts[capital], own_ends[capital]
                title = (upper[end] - upper[begin] == 1) & (end - begin > 1)
                inside = stops[begin] == stops[own_ends[capital - 1]]
                names = capital[title & inside]
                hashes[names] = _PLACE["name"]
                slot[names] = True
        if again.any():
            # The value of a number reaches to the end of its last part.
            whole = ~again
            last = np.append(np.flatnonzero(whole)[1:], len(starts)) - 1
            starts, ends, hashes, slot = starts[whole], ends[last], hashes[whole], slot[whole]
        self.starts, self.ends, self.hashes, self.slot = starts, ends, hashes, slot

    def windows(self, length: int) -> np.ndarray:
        """Hashes of all windows of so many words."""
        return windows(self.hashes, length) ^ U64(length)

    def literal_windows(self, length: int) -> np.ndarray:
        """The same of the literal words, where each part of a number is a word."""
        return windows(self.literal, length) ^ (_LITERAL + U64(length))

    def tells(self, places: np.ndarray, length: int) -> np.ndarray:
        """Which windows hold enough literal words to tell texts apart."""
        slots = _counted(self.slot)
        return (length - (slots[places + length] - slots[places])) * 2 >= length

    def value(self, k: int) -> str:
        return self.data[self.starts[k] : self.ends[k]].decode("utf-8", "replace")

    def values(self, start: int, length: int) -> list[str]:
        return [self.value(k) for k in range(start, start + length) if self.slot[k]]


_WINDOWS = "array<struct<place:int,hash:bigint,slots:array<string>>>"
_WINDOW_TYPE = pa.list_(
    pa.struct([("place", pa.int32()), ("hash", pa.int64()), ("slots", pa.list_(pa.string()))])
)


def _entries(item: int, text: str, cover: float) -> Iterator[tuple]:
    """The template of an item, if it has windows with enough literal words, and its literal words."""
    t = Template(text)
    length = min(WINDOW, len(t.hashes))
    if length >= SHORTEST:
        h = t.windows(length)
        good = t.tells(np.arange(len(h)), length)
        seen: dict[str, int] = {}
        pattern = [seen.setdefault(t.value(k), len(seen)) for k in range(len(t.hashes)) if t.slot[k]]
        key = xxhash.xxh3_64_intdigest(t.hashes.tobytes() + np.array(pattern, dtype=np.int64).tobytes())
        kept = [
            {"place": int(k), "hash": int(h[k].view(np.int64)), "slots": t.values(k, length)}
            for k in np.flatnonzero(good)
        ]
        if kept:
            yield int(U64(key).view(np.int64)), item, length, len(kept), False, cover, kept
    length = min(WINDOW, len(t.literal))
    if length >= LEAST_WORDS or (length and t.ends[-1] - t.starts[0] >= LEAST_BYTES):
        h = t.literal_windows(length)
        key = xxhash.xxh3_64_intdigest(t.literal.tobytes(), seed=1)
        kept = [{"place": k, "hash": x, "slots": []} for k, x in enumerate(h.view(np.int64).tolist())]
        yield int(U64(key).view(np.int64)), item, length, len(kept), True, max(cover, LITERAL_COVER), kept


def benchmark_windows(benchmark: DataFrame, cover: float = COVER) -> DataFrame:
    """Rows (template, item_ids, length, n_windows, literal, least, windows), one per distinct
    template and one per distinct sequence of literal words.

    Items with equal templates and the same pattern of equal slots answer to the same
    documents and stand together. Items of fewer than ``LEAST_WORDS`` words and ``LEAST_BYTES`` bytes say nothing
    about a document that holds them and are not looked for.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for item, text in zip(*(batch.column(k).to_pylist() for k in (0, 1)), strict=True):
                out += _entries(item, as_text(text), cover)
            if out:
                columns = list(zip(*out, strict=True))
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.float64(), _WINDOW_TYPE)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    names=["template", "item_id", "length", "n_windows", "literal", "least", "windows"],
                )

    items = benchmark.select(F.col("item_id").cast("bigint"), F.col("text").cast("string"))
    schema = f"template bigint, item_id bigint, length int, n_windows int, literal boolean, least double, windows {_WINDOWS}"
    # Slot values are those of the item with the least id, whatever the partitions are.
    return items.mapInArrow(run, schema).groupBy("template").agg(
        F.sort_array(F.collect_set("item_id")).alias("item_ids"),
        *[F.first(name).alias(name) for name in ("length", "n_windows", "literal", "least")],
        F.min(F.struct(F.coalesce("item_id", F.lit(-1 << 63)), "windows"))["windows"].alias("windows"),
    )


class Filter:
    """Sorted window hashes with a table over their top bits, for quick misses."""

    BITS = 22

    def __init__(self, hashes: np.ndarray) -> None:
        self.sorted = np.unique(hashes)
        self.table = np.zeros(1 << self.BITS, dtype=bool)
        self.table[self.sorted >> U64(64 - self.BITS)] = True

    def hits(self, h: np.ndarray) -> np.ndarray:
        maybe = np.flatnonzero(self.table[h >> U64(64 - self.BITS)])
        if not len(maybe):
            return maybe
        at = np.searchsorted(self.sorted, h[maybe])
        at[at == len(self.sorted)] = 0
        return maybe[self.sorted[at] == h[maybe]]


def _groups(texts: list[str | None]) -> Iterator[list[int]]:
    """Row numbers of filled texts, in groups read together; a long text is a group of its own."""
    rows, size = [], 0
    for row, text in enumerate(texts):
        if text:
            if rows and size + len(text) > GROUP_CHARS:
                yield rows
                rows, size = [], 0
            rows.append(row)
            size += len(text)
    if rows:
        yield rows


def _found(texts: list[str], rows: list[int], lengths: list[tuple[bool, int]], filters: Filter | None) -> Iterator[tuple]:
    """Windows of the texts that pass the filter: row, place, hash, slot values."""
    t = Template("\n".join(texts))
    begins = np.cumsum([0] + [len(encoded(x.lower())) + 1 for x in texts])
    firsts = {False: np.searchsorted(t.starts, begins), True: np.searchsorted(t.literal_starts, begins)}
    for literal, length in lengths:
        first = firsts[literal]
        h = t.literal_windows(length) if literal else t.windows(length)
        places = filters.hits(h) if filters else np.arange(len(h))
        if not literal:
            places = places[t.tells(places, length)]
        which = np.searchsorted(first, places, side="right") - 1
        inside = places + length <= first[which + 1]
        for k, d in zip(places[inside], which[inside], strict=True):
            yield rows[d], int(k - first[d]), int(h[k].view(np.int64)), [] if literal else t.values(k, length)


def document_windows(docs: DataFrame, lengths: list[tuple[bool, int]], known: np.ndarray | None) -> DataFrame:
    """Rows (doc_id, text_key, place, hash, slots) of the windows that may be the benchmark's."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = Filter(shared.value) if shared.value is not None else None
        for whole in batches:
            for start in range(0, whole.num_rows, ARROW_ROWS):
                batch = whole.slice(start, ARROW_ROWS)
                ids, keys, texts = (batch.column(k).to_pylist() for k in range(3))
                out = []
                for rows in _groups(texts):
                    out += [
                        (ids[row], keys[row], place, h, slots)
                        for row, place, h, slots in _found([texts[r] for r in rows], rows, lengths, filters)
                    ]
                if out:
                    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.string()))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                        names=["doc_id", "text_key", "place", "hash", "slots"],
                    )

    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), _text_key().alias("text_key"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id bigint, text_key bigint, place int, hash bigint, slots array<string>")


def _text_key():
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


@F.pandas_udf(T.StructType().add("places", T.ArrayType(T.IntegerType())).add("same", T.BooleanType()))
def consistent(hits: pd.Series) -> pd.DataFrame:
    """Of the windows found on a diagonal, those without a value that has several answers in
    the document, and whether all windows hold the item's own values."""
    places, same = [], []
    for rows in hits:
        answers: dict[str, set[str]] = {}
        for row in rows:
            for value, answer in zip(row["item_slots"], row["slots"], strict=True):
                answers.setdefault(value, set()).add(answer)
        good = [row["item_place"] for row in rows if all(len(answers[v]) == 1 for v in row["item_slots"])]
        places.append(sorted(set(good)))
        same.append(all(found == {value} for value, found in answers.items()))
    return pd.DataFrame({"places": places, "same": same})


def leaks(docs: DataFrame, benchmark: DataFrame, stored: Stored, cover: float = COVER) -> DataFrame:
    """Rows (doc_id, text_key, item_ids, cover, verbatim): what each contaminated text leaks.

    ``cover`` is the greatest share of a template's windows found; ``verbatim`` tells
    whether all slot values of some leaked item are the benchmark's own. Null and empty
    texts leak nothing, rows with equal id and text stand together, and empty tables on
    either side give an empty result.
    """
    spark: SparkSession = docs.sparkSession
    templates = stored.put(benchmark_windows(benchmark, cover).coalesce(8))
    n_windows, lengths = templates.agg(F.sum("n_windows"), F.collect_set(F.struct("literal", "length"))).first()
    known = None
    if (n_windows or 0) <= FILTER_WINDOWS:
        known = np.array(
            [r[0] for r in templates.select(F.explode("windows.hash")).distinct().toLocalIterator()], dtype=np.int64
        ).view(U64)
    found = stored.put(document_windows(docs, sorted(map(tuple, lengths or [])), known))
    kept = ("template", "n_windows", "literal", "least")
    items = templates.select(*kept, F.explode("windows").alias("w")).select(
        *kept, F.col("w.place").alias("item_place"), F.col("w.hash").alias("hash"), F.col("w.slots").alias("item_slots")
    )
    met = found.join(items, "hash").withColumn("diagonal", F.col("place") - F.col("item_place"))
    group = ("doc_id", "text_key", *kept)
    diagonals = met.groupBy(*group, "diagonal").agg(
        F.collect_set(F.struct("item_place", "item_slots", "slots")).alias("hits")
    )
    judged = diagonals.withColumn("judged", consistent("hits")).select(*group, "judged.*")
    n = F.size(F.array_distinct(F.flatten(F.collect_list("places"))))
    covered = (
        judged.groupBy(*group)
        .agg(n.alias("n"), F.max("same").alias("same"))
        .withColumn("cover", F.col("n") / F.col("n_windows"))
        .where(F.col("cover") >= F.col("least"))
        .withColumn("same", F.when(F.col("literal"), F.col("n") == F.col("n_windows")).otherwise(F.col("same")))
    )
    out = covered.join(templates.select("template", "item_ids"), "template").groupBy("doc_id", "text_key").agg(
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"),
        F.max("cover").alias("cover"), F.max("same").alias("verbatim"),
    )
    return out


def label(docs: DataFrame, benchmark: DataFrame, stored: Stored) -> DataFrame:
    """One row per document: doc_id, contaminated, n_items, item_ids, cover, verbatim."""
    found = leaks(docs, benchmark, stored).withColumnRenamed("doc_id", "l_doc").withColumnRenamed("text_key", "l_key")
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), _text_key().alias("text_key"))
    same = F.col("doc_id").eqNullSafe(F.col("l_doc")) & (F.col("text_key") == F.col("l_key"))
    return own.join(found, same, "left").select(
        "doc_id", F.col("item_ids").isNotNull().alias("contaminated"),
        F.coalesce(F.size("item_ids"), F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("item_ids", F.array().cast("array<bigint>")).alias("item_ids"),
        F.coalesce("cover", F.lit(0.0)).alias("cover"), F.coalesce("verbatim", F.lit(False)).alias("verbatim"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, stored: Stored) -> DataFrame:
    """``docs`` without the contaminated ones."""
    found = leaks(docs, benchmark, stored).select(F.col("doc_id").alias("__llm_doc"), F.col("text_key").alias("__llm_text"))
    own = docs.withColumn("__llm_own", _text_key())
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col("__llm_doc")) & (F.col("__llm_own") == F.col("__llm_text"))
    return own.join(found, same, "left_anti").select(*docs.columns)
