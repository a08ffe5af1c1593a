"""Document fingerprints (operator 13): digests of improbable byte windows in chained Bloom filters.

Every window of ``WINDOW`` bytes has an entropy; how rare its level is in the whole corpus ranks it. A
window that is the rarest of ``WIDE`` neighbours at least ``OFTEN`` times over is a feature. Features enter a Bloom
filter in the order of the text; a filter with ``FILL`` features is full and the next one follows. Two
digests are compared filter by filter: common bits beyond what chance gives, as a share of what is possible.

A window's rank depends on its bytes alone and a choice on its neighbours, so an edit changes the features near it only.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from townsquare.llm.common import U64, Stored, encoded, mix, small_batches

#: Bytes of a window, neighbours it is compared with, and how often it must be the rarest of them.
WINDOW = 32
WIDE = 32
OFTEN = 8
#: Levels of entropy, and the level from which on a window counts as weak (entropy below about 2 of 5 bits).
LEVELS = 256
WEAK = 154
#: Bits of a filter, bits a feature sets, features of a full filter.
BITS = 2048
SETS = 5
FILL = 160
#: Common bits beyond the expected ones, in standard deviations, that count as chance.
CHANCE = 4.0
#: Windows handled at a time inside one text, and bytes of text handled together.
PIECE = 1 << 16
GROUP_BYTES = 1 << 20

_UNIT = 1 << 20
_TERMS = np.array([0] + [round(c * np.log2(c) * _UNIT) for c in range(1, WINDOW + 1)], dtype=np.int64)
_STEP = np.diff(_TERMS).astype(np.int32)
_TOP = int(_TERMS[WINDOW])


# --- features -------------------------------------------------------------------------------------


def levels(data: np.ndarray) -> np.ndarray:
    """The entropy level of every window of ``data``: 0 is the highest entropy, ``LEVELS`` - 1 the lowest.

    The sum of c log c over a window's byte counts follows from one window to the next by the counts of the byte that
    leaves and the byte that comes, which are counted for all places at once, lag by lag.
    """
    n = len(data) - WINDOW + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint8)
    out = np.empty(n, dtype=np.uint8)
    for start in range(0, n, PIECE):
        part = data[start : start + PIECE + WINDOW - 1]
        m = len(part) - WINDOW + 1
        before = np.zeros(len(part), dtype=np.uint8)
        after = np.zeros(len(part), dtype=np.uint8)
        for lag in range(1, WINDOW):
            same = (part[lag:] == part[:-lag]).view(np.uint8)
            before[lag:] += same
            after[:-lag] += same
        sums = np.empty(m, dtype=np.int64)
        sums[0] = _TERMS[np.bincount(part[:WINDOW])].sum()
        sums[1:] = _STEP[before[WINDOW:]] - _STEP[after[: m - 1]]
        np.cumsum(sums, out=sums)
        out[start : start + m] = np.minimum(sums * LEVELS // _TOP, LEVELS - 1)
    return out


def ranks(counts: list[int]) -> np.ndarray:
    """Rank of each level, 0 the rarest in the corpus; weak windows come last, the weakest at the very end."""
    strong = sorted(range(WEAK), key=lambda level: (counts[level], level))
    out = np.empty(LEVELS, dtype=np.int64)
    out[strong + list(range(WEAK, LEVELS))] = np.arange(LEVELS)
    return out


def chosen(rank: np.ndarray) -> np.ndarray:
    """Places of the windows that are the leftmost rarest of enough runs of ``WIDE`` neighbours."""
    m = len(rank)
    wide = min(WIDE, m)
    places, counts = [], []
    for start in range(0, m - wide + 1, PIECE):
        part = rank[start : start + PIECE + wide - 1]
        key = (part << 32) | np.arange(len(part))
        span = 1
        while 2 * span <= wide:
            key = np.minimum(key[:-span], key[span:])
            span *= 2
        if span < wide:
            key = np.minimum(key[: len(key) - (wide - span)], key[wide - span :])
        at = key & 0xFFFFFFFF
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        places.append(at[first] + start)
        counts.append(np.diff(np.append(first, len(at))))
    place, count = np.concatenate(places), np.concatenate(counts)
    # A run that goes on in the next piece is one run.
    new = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    place, count = place[new], np.add.reduceat(count, new)
    often = count >= min(OFTEN, m - wide + 1)
    return place[often] if often.any() else place


def features(data: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """64-bit hashes of the chosen windows in the order of the text, repeats left out; a short text is one feature."""
    if not len(data):
        return np.empty(0, dtype=U64)
    if len(data) < WINDOW:
        rows = np.zeros((1, WINDOW), dtype=np.uint8)
        rows[0, : len(data)] = data
    else:
        rows = data[chosen(rank)[:, None] + np.arange(WINDOW)]
    words = np.ascontiguousarray(rows).view("<u8").astype(U64)
    h = np.full(len(words), min(len(data), WINDOW), dtype=U64)
    for k in range(words.shape[1]):
        h = mix(h, words[:, k])
    _, first = np.unique(h, return_index=True)
    return h[np.sort(first)]


# --- digests --------------------------------------------------------------------------------------


def filters(hashes: np.ndarray) -> np.ndarray:
    """Chained Bloom filters of the features, as rows of bytes."""
    if not len(hashes):
        return np.empty((0, BITS // 8), dtype=np.uint8)
    chain = np.arange(len(hashes)) // FILL
    bits = np.zeros((int(chain[-1]) + 1, BITS), dtype=bool)
    for k in range(SETS):
        bits[chain, ((hashes >> U64(11 * k)) & U64(BITS - 1)).astype(np.int64)] = True
    return np.packbits(bits, axis=1)


def packed(hashes: np.ndarray) -> bytes:
    """A fingerprint as bytes: the number of features in eight, then the filters."""
    return len(hashes).to_bytes(8, "big") + filters(hashes).tobytes()


def written(fingerprint: bytes) -> str:
    """A fingerprint as text: base64 of its bytes."""
    return base64.b64encode(fingerprint).decode()


def read(fingerprint: str | bytes) -> tuple[int, np.ndarray]:
    data = base64.b64decode(fingerprint) if isinstance(fingerprint, str) else fingerprint
    return int.from_bytes(data[:8], "big"), np.frombuffer(data, dtype=np.uint8, offset=8).reshape(-1, BITS // 8)


def likeness(one: str | bytes, other: str | bytes) -> float:
    """Likeness of two fingerprints, 0 to 1, the same both ways; equal ones have 1, an empty one and another 0.

    Each filter of the shorter digest meets its best partner in the longer one; the results are
    weighted by their features. The work is the product of the numbers of filters, in blocks of bounded size.
    """
    if one == other:
        return 1.0
    (count, a), (other_count, b) = sorted((read(one), read(other)), key=lambda d: (d[0], d[1].tobytes()))
    if not count:
        return 0.0
    a, b = np.ascontiguousarray(a).view(U64), np.ascontiguousarray(b).view(U64)
    ones_a = np.bitwise_count(a).sum(axis=1, dtype=np.int64)
    ones_b = np.bitwise_count(b).sum(axis=1, dtype=np.int64)
    total = 0.0
    for k in range(len(a)):
        best = 0.0
        for start in range(0, len(b), 4096):
            part, ones = b[start : start + 4096], ones_b[start : start + 4096]
            common = np.bitwise_count(part & a[k]).sum(axis=1, dtype=np.int64)
            expected = ones * (ones_a[k] / BITS)
            spread = np.sqrt(expected * (1 - ones / BITS) * (1 - ones_a[k] / BITS))
            least = expected + CHANCE * spread
            most = np.minimum(ones, ones_a[k])
            share = np.where(most > least, (common - least) / np.maximum(most - least, 1e-9), common == most)
            best = max(best, float(share.max()))
        total += min(1.0, best) * min(FILL, count - k * FILL)
    return min(1.0, max(0.0, total / count))


def bytes_of(text: str) -> np.ndarray:
    return np.frombuffer(encoded(text), dtype=np.uint8)


def fingerprints(texts: list[str], rarity: np.ndarray, edits: list[tuple[int, str] | None]) -> list[tuple]:
    """(fingerprint, edited text, its fingerprint) of each text; the last two are None without an edit.

    An edit (kept, tail) keeps so many code points and adds a tail. Windows before the cut are looked at once.
    """
    parts: list[np.ndarray] = []
    plans = []
    for text, edit in zip(texts, edits, strict=True):
        data = bytes_of(text)
        parts.append(data)
        if edit is not None:
            kept = len(encoded(text[: edit[0]]))
            seam = max(0, kept - WINDOW + 1)
            parts.append(np.concatenate([data[seam:kept], bytes_of(edit[1])]))
            plans.append((text[: edit[0]] + edit[1], seam))
        else:
            plans.append(None)
    found = rarity[levels(np.concatenate(parts))] if parts else None
    out, at, k = [], 0, 0

    def next_ranks() -> np.ndarray:
        nonlocal at, k
        n = len(parts[k])
        own = found[at : at + max(0, n - WINDOW + 1)]
        at, k = at + n, k + 1
        return own

    for plan in plans:
        data = parts[k]
        rank = next_ranks()
        own = packed(features(data, rank))
        if plan is None:
            out.append((own, None, None))
            continue
        text, seam = plan
        tail = parts[k]
        whole = np.concatenate([data[:seam], tail])
        whole_rank = np.concatenate([rank[:seam], next_ranks()])
        out.append((own, text, packed(features(whole, whole_rank))))
    return out


# --- Spark ----------------------------------------------------------------------------------------


def level_counts(texts: DataFrame) -> list[int]:
    """How many windows of all ``texts`` have each level; one row per task and level is shuffled."""
    small_batches(texts.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(LEVELS, dtype=np.int64)
        for batch in batches:
            group: list[np.ndarray] = []
            held = 0
            for data in [*batch.column(0).to_pylist(), None]:
                if data is not None:
                    group.append(np.frombuffer(data, dtype=np.uint8))
                    held += len(data)
                if group and (data is None or held >= GROUP_BYTES):
                    all_levels, at = levels(np.concatenate(group)), 0
                    for part in group:
                        own = all_levels[at : at + max(0, len(part) - WINDOW + 1)]
                        total += np.bincount(own, minlength=LEVELS)
                        at += len(part)
                    group, held = [], 0
        yield pa.RecordBatch.from_pydict({"level": list(range(LEVELS)), "n": total})

    rows = texts.where("text is not null").select(F.col("text").cast("binary"))
    found = dict(map(tuple, rows.mapInArrow(count, "level long, n long").groupBy("level").agg(F.sum("n")).collect()))
    return [found.get(level, 0) for level in range(LEVELS)]


ROWS = (
    "part int, kind string, doc_id long, text string, n_chars long, edited_sha256 binary, fingerprint binary, "
    "edited_fingerprint binary, near_edited double, near_next double"
)
_FIELDS = [field.split()[0] for field in ROWS.split(", ")]
_ROW_SCHEMA = pa.schema([
    ("part", pa.int32()), ("kind", pa.string()), ("doc_id", pa.int64()), ("text", pa.string()), ("n_chars", pa.int64()),
    ("edited_sha256", pa.binary()), ("fingerprint", pa.binary()), ("edited_fingerprint", pa.binary()),
    ("near_edited", pa.float64()), ("near_next", pa.float64()),
])


def _edit(text: str, following: str) -> tuple[int, str]:
    k = len(text) // 4
    return len(text) - k, following[:k]


def _results(rows: list[tuple], rarity: np.ndarray, following: list[tuple]) -> list[dict]:
    """Result columns of ``rows`` (doc_id, text), each followed by the row of ``following`` at its place."""
    # The last row's successor needs a fingerprint of its own; the others' successors are rows themselves.
    texts = [text for _, text in rows] + [following[-1][1]]
    edits = [_edit(text, after[1]) for (_, text), after in zip(rows, following, strict=True)] + [None]
    found = fingerprints(texts, rarity, edits)
    out = []
    for (name, text), (own, edited, edited_own), (after, _, _) in zip(rows, found, found[1:], strict=False):
        out.append({
            "kind": "done", "doc_id": name, "n_chars": len(text), "edited_sha256": hashlib.sha256(encoded(edited)).digest(),
            "fingerprint": own, "edited_fingerprint": edited_own,
            "near_edited": likeness(own, edited_own), "near_next": likeness(own, after),
        })
    return out


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r.get(name) for r in rows], kind) for name, kind in zip(_FIELDS, _ROW_SCHEMA.types, strict=True)],
        schema=_ROW_SCHEMA,
    )


def edited_pairs(docs: DataFrame, stored: Stored) -> DataFrame:
    """Fingerprints of all ``docs`` (doc_id, text) and of their edited texts, with both likenesses.

    A document's last quarter of code points is replaced by the first as many of the next document, in the order
    of doc_id (null first; equal ids by the MD5 of their texts); the first document follows the last. Null text is
    empty. Equal texts have equal fingerprints; a text under 32 bytes is one feature; other columns are ignored; an empty
    table gives no rows. Texts move once, in a range shuffle; each partition's last document meets the first one of the
    next partition that has any, so two texts per partition are stored.
    """
    rarity = ranks(level_counts(docs))
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        rows: list[tuple] = []
        held, seen = 0, False

        def done() -> pa.RecordBatch:
            return _batch([{"part": part, **r} for r in _results(rows[:-1], rarity, rows[1:])])

        for batch in batches:
            for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not seen:
                    yield _batch([{"part": part, "kind": "first", "doc_id": row[0], "text": row[1]}])
                    seen = True
                rows.append(row)
                held += len(row[1])
                if held >= GROUP_BYTES and len(rows) > 1:
                    yield done()
                    rows = rows[-1:]
                    held = len(rows[0][1])
        if len(rows) > 1:
            yield done()
        if rows:
            yield _batch([{"part": part, "kind": "last", "doc_id": rows[-1][0], "text": rows[-1][1]}])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    keyed = texts.select("doc_id", "text", F.md5("text").alias("tie"), F.monotonically_increasing_id().alias("row"))
    order = [F.asc_nulls_first("doc_id"), "tie", "row"]
    laid = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    made = stored.put(laid.mapInArrow(run, ROWS))
    # One row per partition from here on.
    firsts = made.where("kind = 'first'").select("part", F.col("text").alias("next_text"))
    order = Window.orderBy("part")
    after = firsts.select("part", F.coalesce(F.lead("part").over(order), F.first("part").over(order)).alias("next_part"))
    lasts = (
        made.where("kind = 'last'").select("part", "doc_id", "text").join(after, "part")
        .join(firsts.withColumnRenamed("part", "next_part"), "next_part").select("doc_id", "text", "next_text")
    )

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, text, following in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield _batch(_results([(name, text)], rarity, [(None, following)]))

    found = made.where("kind = 'done'").drop("text").unionByName(lasts.mapInArrow(close, ROWS).drop("text"))
    # Spark may break base64 into lines.
    as_text = {c: F.regexp_replace(F.base64(c), "[\r\n]", "") for c in ("fingerprint", "edited_fingerprint")}
    return found.withColumns(as_text | {"edited_sha256": F.lower(F.hex("edited_sha256"))}).drop("part", "kind")
