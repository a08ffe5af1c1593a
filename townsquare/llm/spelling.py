"""Spelling variant grouping (operator 12): a dictionary of trie-node pairs finds words one edit apart.

Words are sorted and range-partitioned once forwards and once reversed; on each layout the nodes of the trie
get integers, a node known to several partitions one that all of them derive alike. A word then is its list of
prefix nodes and of suffix nodes. The pair (prefix node, suffix node) left and right of a skipped position
meets the same pair of a word with another code point there, and the pair at an inserted position of a shorter
word: equal integers are near words, exactly, and nothing else is. A pair holds one shorter word at most and one
longer word per code point of the alphabet, so no group can grow with the corpus.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from townsquare.llm.common import Stored, small_batches
from townsquare.operators.ranks import PART

#: A word: ASCII letters and the code points from U+00C0 to U+00FF.
RUN = re.compile("[a-zÀ-ÿ]+")
#: Distinct words counted in a task before its counts are handed on.
HELD_WORDS = 1 << 18
#: Texts from this length on are searched word by word, not listed at once.
LISTED_CHARS = 1 << 20

SPLIT, GAP, LATER_GAP = 0, 1, 2


# --- words ----------------------------------------------------------------------------------------


def counted_words(texts: DataFrame, every: int = 97, min_points: int = 5, min_count: int = 3) -> DataFrame:
    """Words of all ``texts`` (doc_id, text) with their number of occurrences ``n``.

    Only A-Z are lower-cased. Where ``every`` divides h, the crc32 of ``doc_id:word``, the code point
    h % length is left out. Null text has no words; a null doc_id stands as nothing before the colon.
    """
    small_batches(texts.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def flushed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_pydict({"word": list(total), "n": list(total.values())})
            total.clear()
            return out

        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                text = data.lower().decode("utf-8", "replace")
                found = RUN.findall(text) if len(text) < LISTED_CHARS else (m.group() for m in RUN.finditer(text))
                before = zlib.crc32(f"{name}:".encode())
                # Leaving out a code point only shortens: shorter words never count.
                for word, n in Counter(found).items():
                    if len(word) >= min_points:
                        h = zlib.crc32(word.encode(), before)
                        if h % every == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                        total[word] += n
                if len(total) >= HELD_WORDS:
                    yield flushed()
        if total:
            yield flushed()

    ids = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id")
    rows = texts.where("text is not null").select(ids, F.col("text").cast("binary").alias("text"))
    counts = rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where((F.col("n") >= min_count) & (F.length("word") >= min_points))


# --- trie nodes -----------------------------------------------------------------------------------


def _shared(layout: DataFrame, key: str) -> list[str]:
    """The prefixes that words of more than one range partition have, for numbers that all agree on.

    Reads the first and last word of every partition: two words per partition come to the driver.
    """
    ends = sorted(map(tuple, layout.groupBy(PART).agg(F.min(key), F.max(key)).collect()))
    found = set()
    for (_, _, last), (_, first, _) in zip(ends, ends[1:], strict=False):
        both = commonprefix([last, first])
        found.update(both[:k] for k in range(1, len(both) + 1))
    return sorted(found)


def _node_lists(shared: list[str]) -> Callable[[Iterator[tuple[int, str]]], Iterator[tuple[int, list[int]]]]:
    """A function that gives each of a partition's sorted words its rank and the numbers of its prefixes, from the empty one (0) on."""
    agreed = {prefix: -1 - k for k, prefix in enumerate(shared)}

    def number(words: Iterator[tuple[int, str]]) -> Iterator[tuple[int, list[int]]]:
        part, word_before, path, fresh, rank = None, "", [0], 0, 0
        for own, word in words:
            if own != part:
                part, word_before, path = own, "", [0]
                fresh = rank = (own + 1) << 40
            depth, most = 0, min(len(word), len(word_before))
            while depth < most and word[depth] == word_before[depth]:
                depth += 1
            path = path[: depth + 1]
            for end in range(depth + 1, len(word) + 1):
                fresh += 1
                path.append(agreed.get(word[:end], fresh) if agreed else fresh)
            rank += 1
            word_before = word
            yield rank, path

    return number


def _by_words(layout: DataFrame, key: str, function: Callable, schema: str) -> DataFrame:
    """``function`` over the rows of whole range partitions, sorted by ``key``."""
    laid = layout.repartition(PART).sortWithinPartitions(PART, key)
    return laid.mapInArrow(function, schema)


def _layout(table: DataFrame, key: str, stored: Stored) -> DataFrame:
    return stored.put(table.repartitionByRange(key).withColumn(PART, F.spark_partition_id()))


def numbered(words: DataFrame, stored: Stored) -> DataFrame:
    """Rows (rank, word, n, back, prefixes): words with their rank in code-point order and the nodes of their prefixes."""
    layout = _layout(words, "word", stored)
    number = _node_lists(_shared(layout, "word"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def keys() -> Iterator[tuple[int, str]]:
            for batch in batches:
                held.append(batch)
                yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)

        lists = number(keys())
        ranks, paths = [], []
        for rank, path in lists:
            ranks.append(rank)
            paths.append(path)
            if len(ranks) == held[-1].num_rows:
                batch = held.pop()
                yield pa.RecordBatch.from_pydict(
                    {"rank": ranks, "word": batch.column(1), "n": batch.column(2), "prefixes": pa.array(paths, pa.list_(pa.int64()))}
                )
                ranks, paths = [], []

    schema = "rank long, word string, n long, prefixes array<long>"
    return _by_words(layout.select(PART, "word", "n"), "word", run, schema).withColumn("back", F.reverse("word"))


PAIRS = "p long, s long, kind byte, rank long, n long"


def pairs(words: DataFrame, stored: Stored) -> DataFrame:
    """Rows (p, s, kind, rank, n): the node pairs at every position of the ``numbered`` words.

    A split stands between two code points, or at an end; a gap skips one. Of the gaps in a run of equal code
    points only the first can lose its code point (``GAP``), as the others would give the same word again.
    """
    layout = _layout(words, "back", stored)
    number = _node_lists(_shared(layout, "back"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def keys() -> Iterator[tuple[int, str]]:
            for batch in batches:
                held.append(batch.to_pydict())
                yield from zip(held[-1][PART], held[-1]["back"], strict=True)

        p, s, kinds, ranks, weights = [], [], [], [], []

        def made() -> pa.RecordBatch:
            arrays = [pa.array(p), pa.array(s), pa.array(kinds, pa.int8()), pa.array(ranks), pa.array(weights)]
            out = pa.RecordBatch.from_arrays(arrays, ["p", "s", "kind", "rank", "n"])
            for column in (p, s, kinds, ranks, weights):
                column.clear()
            return out

        at = 0
        for _, suffixes in number(keys()):
            own = held[-1]
            prefixes, back, rank, n = own["prefixes"][at], own["back"][at], own["rank"][at], own["n"][at]
            length = len(back)
            p += prefixes
            s += suffixes[::-1]
            kinds += [SPLIT] * (length + 1)
            p += prefixes[:-1]
            s += suffixes[-2::-1]
            kinds.append(GAP)
            # The reversed word holds the code points from the last to the first.
            kinds += [LATER_GAP if back[k] == back[k + 1] else GAP for k in range(length - 2, -1, -1)]
            ranks += [rank] * (2 * length + 1)
            weights += [n] * (2 * length + 1)
            at += 1
            if at == len(own["rank"]):
                held.clear()
                at = 0
            if len(p) >= 1 << 18:
                yield made()
        if p:
            yield made()

    return _by_words(layout.select(PART, "back", "rank", "n", "prefixes"), "back", run, PAIRS)


# --- near words -----------------------------------------------------------------------------------


def _better(a: tuple[int, int] | None, b: tuple[int, int] | None) -> tuple[int, int] | None:
    """The more frequent word, of equally frequent ones the smaller; both as (-n, rank)."""
    return b if a is None else a if b is None else min(a, b)


def _group(kinds: list[int], ranks: list[int], weights: list[int]) -> Iterator[tuple[int, int, tuple[int, int]]]:
    """(rank, near words, best of them) for each word of one node pair."""
    split = None
    gaps, first_gaps = [], []
    for kind, rank, n in zip(kinds, ranks, weights, strict=True):
        if kind == SPLIT:
            split = (-n, rank)
        else:
            gaps.append((-n, rank))
            if kind == GAP:
                first_gaps.append((-n, rank))
    best = sorted(gaps)[:2]
    able = set(first_gaps)
    for word in gaps:
        other = best[0] if best[0] != word else best[1] if len(best) > 1 else None
        longer = split is not None and word in able
        if len(gaps) > 1 or longer:
            yield word[1], len(gaps) - 1 + longer, _better(other, split if longer else None)
    if split is not None and first_gaps:
        yield split[1], len(first_gaps), min(first_gaps)


def _matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partners within the groups of equal (p, s) of sorted rows; the last group waits for the next batch."""
    rest: list[np.ndarray] | None = None

    def matched(columns: list[np.ndarray], starts: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
        out: list[tuple] = []
        several = np.flatnonzero(ends - starts > 1)
        for a, b in zip(starts[several].tolist(), ends[several].tolist(), strict=True):
            for rank, near, (minus_n, best) in _group(*(c[a:b].tolist() for c in columns[2:])):
                out.append((rank, near, -minus_n, best))
        kinds = (pa.int64(),) * 4
        lists = zip(*out, strict=True) if out else ([], [], [], [])
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(lists, kinds, strict=True)], ["rank", "near", "best_n", "best"]
        )

    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if rest is not None:
            columns = [np.concatenate(both) for both in zip(rest, columns, strict=True)]
        if not len(columns[0]):
            continue
        new = np.flatnonzero((columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1])) + 1
        starts = np.concatenate([[0], new])
        rest = [c[starts[-1] :] for c in columns]
        yield matched(columns, starts[:-1], starts[1:])
    if rest is not None:
        yield matched(rest, np.array([0]), np.array([len(rest[0])]))


def roots(forms: DataFrame, stored: Stored) -> DataFrame:
    """(rank, root): the last word reached from each word of ``forms`` (rank, form).

    Pointer doubling; a form is at least twice as frequent as its word, so there are as many steps at most as the
    largest count has binary digits, and as many rounds as that number has.
    """
    state = stored.put(forms.select("rank", F.col("form").alias("root")))
    while True:
        onward = state.select(F.col("rank").alias("root"), F.col("root").alias("far"))
        moved = stored.put(state.join(onward, "root", "left").select(
            "rank", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")
        ))
        stored.drop(state)
        state = moved.select("rank", "root")
        stored.paths[id(state)] = stored.paths.pop(id(moved))
        if not moved.where("moved").head(1):
            return state


def variants(texts: DataFrame, stored: Stored, every: int = 97, min_points: int = 5, min_count: int = 3, times: int = 2) -> DataFrame:
    """One row per word of ``texts``: word, form, root, n, n_near, form_n.

    Near words differ by exactly one inserted, deleted or replaced code point; a word's form is its most frequent
    near word (of equal ones the smallest in code-point order) if that is at least ``times`` as frequent, else null.
    Null and empty texts have no words; repeated rows count as often as they stand; other columns are ignored.
    """
    words = stored.put(numbered(stored.put(counted_words(texts, every, min_points, min_count)), stored))
    laid = pairs(words, stored).repartition("p", "s").sortWithinPartitions("p", "s")
    found = laid.mapInArrow(_matches, "rank long, near long, best_n long, best long").groupBy("rank").agg(
        F.sum("near").alias("n_near"), F.max(F.struct("best_n", (-F.col("best")).alias("minus"))).alias("best")
    )
    found = stored.put(found.select("rank", "n_near", F.col("best.best_n").alias("best_n"), (-F.col("best.minus")).alias("form")))
    judged = words.select("rank", "word", "n").join(found, "rank", "left")
    keeps = F.col("best_n") >= times * F.col("n")
    judged = stored.put(judged.select(
        "rank", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(keeps, F.col("form")).alias("form"), F.when(keeps, F.col("best_n")).alias("form_n"),
    ))
    follow = judged.where("form is not null")
    ends = roots(follow, stored)
    names = words.select(F.col("rank").alias("to"), F.col("word").alias("name"))
    named = (
        follow.join(ends, "rank")
        .join(names.withColumnsRenamed({"to": "form", "name": "form_word"}), "form")
        .join(names.withColumnsRenamed({"to": "root", "name": "root_word"}), "root")
    )
    alone = judged.where("form is null")
    return named.select("word", F.col("form_word").alias("form"), F.col("root_word").alias("root"), "n", "n_near", "form_n").unionByName(
        alone.select("word", F.lit(None).cast("string").alias("form"), F.col("word").alias("root"), "n", "n_near", "form_n")
    )
