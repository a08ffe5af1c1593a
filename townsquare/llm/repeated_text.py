"""Exact repeated passages: every byte that lies in a 200-byte string found elsewhere too.

A distributed suffix array would name sorted samples of a difference cover, recurse on the
names and merge the other suffixes before it compares neighbours. Here only strings of one
length matter, and sorting rows for all bytes costs many times the input on disk, so the
cover is a synchronising sample instead (README): the sample of a window is the place of
its least 64-byte block, so equal windows always pick the same sample at the same offset.

1. Sample: about one place in seventy; each answers for a run of neighbouring windows.
2. Name: the sampled block, and the whole extent of the windows it answers for, by hash.
3. Compare: a block found once repeats nothing. An extent found twice repeats wholly.
4. Merge the rest: blocks whose extents differ compare their windows one by one, among the
   few extents that share the block; a block with very many extents is dealt by offset.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from townsquare.llm.common import U64, Stored, as_text, encoded, map_rows, small_batches

LENGTH = 200
BLOCK = 64
#: Extents of one block that a task compares; beyond, their windows are dealt by offset.
GROUP_EXTENTS = 20_000
#: Extents of many blocks that one call compares on average.
BUCKET_EXTENTS = 4_000
#: Bytes of a text that are sampled at a time.
PIECE = 1 << 17
_CODES = np.random.default_rng(20240503).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0xD6E8FEB86659FD93
_POWERS: list[np.ndarray] = []
_PLACE_BITS = 20


def powers() -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS:
        n = PIECE + 2 * LENGTH + 2
        for value in (_BASE, pow(_BASE, -1, 1 << 64)):
            _POWERS.append(np.concatenate([[U64(1)], np.cumprod(np.full(n, value, dtype=U64))]))
    return _POWERS[0], _POWERS[1]


def _stirred(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U64(32))
    x *= U64(0x9FB21C651E98DF25)
    x ^= x >> U64(29)
    x *= U64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> U64(32))


class Hasher:
    """Hashes of any stretches of a piece of text, by prefix sums."""

    def __init__(self, data: np.ndarray) -> None:
        up, self.down = powers()
        self.sums = np.zeros(len(data) + 1, dtype=U64)
        np.cumsum(_CODES[data] * up[: len(data)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return _stirred((self.sums[ends] - self.sums[starts]) * self.down[starts])

    def blocks(self, length: int) -> np.ndarray:
        n = len(self.sums) - length
        return _stirred((self.sums[length:] - self.sums[:n]) * self.down[:n])


def _window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    out, reach = values, 1
    while reach * 2 <= width:
        out = np.minimum(out[: len(out) - reach], out[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def samples(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First windows of each run of windows with one sample, and block and extent hashes.

    Runs follow each other, so a run ends where the next begins. The last of equal blocks
    is taken, so periodic texts sample at every period.
    """
    firsts, blocks, extents = [], [], []
    n_windows = len(data) - LENGTH + 1
    width = LENGTH - BLOCK + 1
    mask = U64((1 << _PLACE_BITS) - 1)
    for begin in range(0, max(n_windows, 0), PIECE):
        count = min(PIECE, n_windows - begin)
        piece = data[begin : begin + count + LENGTH - 1]
        hasher = Hasher(piece)
        h = hasher.blocks(BLOCK)
        coded = (h & ~mask) | (mask - np.arange(len(h), dtype=U64))
        place = (mask - (_window_minima(coded, width) & mask)).astype(np.int64)
        run = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        last = np.append(run[1:], count) - 1
        at = place[run]
        firsts.append(run + begin)
        blocks.append(h[at])
        # Where the sample stands in the extent is part of the extent's name.
        extents.append(_stirred(hasher.of(run, last + LENGTH) + (at - run).astype(U64) * U64(0x9E3779B97F4A7C15)))
    if not firsts:
        return np.empty(0, np.int64), np.empty(0, U64), np.empty(0, U64)
    return np.concatenate(firsts), np.concatenate(blocks), np.concatenate(extents)


def text_id() -> Column:
    return F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text_id")


def sampled(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text_id, n_bytes, sha256, firsts, blocks, extents); one scan."""

    def run(ids, keys, texts):
        data = [encoded(as_text(t)) for t in texts]
        found = [samples(np.frombuffer(d, dtype=np.uint8)) for d in data]
        return {
            "doc_id": pa.array(ids, pa.int64()), "text_id": keys,
            "n_bytes": pa.array([len(d) for d in data], pa.int64()),
            "sha256": [hashlib.sha256(d).hexdigest() for d in data],
            "firsts": pa.array([f[0].astype(np.int32) for f in found], pa.list_(pa.int32())),
            "blocks": pa.array([f[1].view(np.int64) for f in found], pa.list_(pa.int64())),
            "extents": pa.array([f[2].view(np.int64) for f in found], pa.list_(pa.int64())),
        }

    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_id(), F.col("text").cast("string").alias("text"))
    schema = (
        "doc_id bigint, text_id string, n_bytes bigint, sha256 string, firsts array<int>, blocks array<bigint>,"
        " extents array<bigint>"
    )
    return map_rows(slim, ["doc_id", "text_id", "text"], run, schema)


def _window_codes(extent: bytes) -> np.ndarray:
    return Hasher(np.frombuffer(extent, dtype=np.uint8)).blocks(LENGTH)


_ASKED = "text_id string, k int, block bigint, many boolean, extent binary, offset int"
_ANSWER = "text_id string, k int, first int, last int"


def _compare(frame: pd.DataFrame) -> pd.DataFrame:
    """Repeated windows among the extents of each block; one call takes many blocks."""
    codes = [_window_codes(x) for x in frame["extent"]]
    sizes = np.array([len(c) for c in codes])
    every = np.concatenate(codes)
    inside = np.arange(len(every)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    offsets = np.repeat(frame["offset"].to_numpy(dtype=np.int64), sizes) - inside
    blocks = np.repeat(frame["block"].to_numpy(dtype=np.int64), sizes)
    every ^= _stirred(offsets.view(U64) + blocks.view(U64) * U64(0x9E3779B97F4A7C15))
    order = np.argsort(every)
    same = np.zeros(len(every) + 1, dtype=bool)
    same[1:-1] = every[order[1:]] == every[order[:-1]]
    marks = np.zeros(len(every) + len(sizes) + 1, dtype=np.int8)
    # A zero before each extent parts its windows from the extent's before it.
    own = np.repeat(np.arange(len(sizes)), sizes) + np.arange(len(every)) + 1
    twice = np.empty(len(every), dtype=bool)
    twice[order] = same[1:] | same[:-1]
    marks[own] = twice & ~np.repeat(frame["many"].to_numpy(dtype=bool), sizes)
    edges = np.flatnonzero(np.diff(marks)).reshape(-1, 2)
    begins = np.cumsum(sizes) - sizes + np.arange(len(sizes))
    which = np.searchsorted(begins, edges[:, 0], side="right") - 1
    first = edges - begins[which][:, None]
    return pd.DataFrame({
        "text_id": frame["text_id"].to_numpy()[which], "k": frame["k"].to_numpy()[which].astype("int32"),
        "first": first[:, 0].astype("int32"), "last": first[:, 1].astype("int32"),
    })


def _removed(n: int, runs: list[tuple[int, int]]) -> list[list[int]]:
    """Byte runs that windows [first, last) cover, joined."""
    out: list[list[int]] = []
    for a, b in sorted(runs):
        end = min(n, b - 1 + LENGTH)
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([a, end])
    return out


def remove(docs: DataFrame, stored: Stored, group_extents: int = GROUP_EXTENTS) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Null and empty texts and texts under 200 bytes lose nothing unless they are at least
    200 bytes long. Results depend on the texts alone, so repeated rows get equal results,
    and each counts as a place of its own. Ids may be null; other columns are ignored; an
    empty table gives an empty result.
    """
    base = stored.put(sampled(docs))
    places = base.select(
        "text_id", F.posexplode(F.arrays_zip("blocks", "extents")).alias("k", "s")
    ).select("text_id", "k", F.col("s.blocks").alias("block"), F.col("s.extents").alias("extent_name"))
    # Stored, so that the join below is free to split a block that a third of all texts share.
    blocks = stored.put(
        places.groupBy("block")
        .agg(F.count("*").alias("n"), F.min("extent_name").alias("least"), F.max("extent_name").alias("most"))
        .where("n > 1").select("block", (F.col("least") != F.col("most")).alias("differ"))
    )
    hits = stored.put(places.join(blocks, "block"))
    names = stored.put(
        hits.where("differ").groupBy("block", "extent_name")
        .agg(F.count("*").alias("n"), F.min(F.struct("text_id", "k")).alias("one"))
    )
    whole = hits.where("not differ").select("text_id", "k").unionByName(
        hits.where("differ").join(names.where("n > 1"), ["block", "extent_name"]).select("text_id", "k")
    ).distinct()
    asked = names.select(
        F.col("one.text_id").alias("text_id"), F.struct(F.col("one.k").alias("k"), (F.col("n") > 1).alias("many"), "block").alias("ask")
    ).groupBy("text_id").agg(F.collect_list("ask").alias("asks"))
    wholes = whole.groupBy("text_id").agg(F.collect_list("k").alias("wholes"))
    wanted = stored.put(asked.join(wholes, "text_id", "full"))
    stored.drop(blocks, hits, names)
    firsts = base.select("text_id", "firsts").dropDuplicates(["text_id"])
    texts = stored.put(
        docs.select(text_id(), F.col("text").cast("string").alias("text"))
        .join(wanted.select("text_id"), "text_id", "left_semi").dropDuplicates(["text_id"])
        .join(wanted, "text_id").join(firsts, "text_id")
    )
    stored.drop(wanted)
    small_batches(docs.sparkSession)

    def ask(ids, texts, asks, firsts):
        out = []
        for t, text, wishes, first in zip(ids, texts, asks, firsts, strict=True):
            data = encoded(as_text(text))
            ends = [*first[1:], len(data) - LENGTH + 1]
            for w in wishes or ():
                a, b = first[w["k"]], ends[w["k"]]
                extent = data[a : b - 1 + LENGTH]
                h = Hasher(np.frombuffer(extent, dtype=np.uint8)).blocks(BLOCK)
                offset = int(np.flatnonzero(h.view(np.int64) == w["block"])[-1])
                out.append((t, w["k"], w["block"], w["many"], extent, offset))
        columns = list(zip(*out, strict=True)) if out else [[]] * 6
        kinds = (pa.string(), pa.int32(), pa.int64(), pa.bool_(), pa.binary(), pa.int32())
        names = ("text_id", "k", "block", "many", "extent", "offset")
        return {n: pa.array(c, kind) for n, c, kind in zip(names, columns, kinds, strict=True)}

    extents = stored.put(map_rows(texts.where("asks is not null"), ["text_id", "text", "asks", "firsts"], ask, _ASKED))
    buckets = extents.count() // BUCKET_EXTENTS + 1
    crowded = extents.groupBy("block").agg(F.count("*").alias("n")).where(F.col("n") > group_extents).select("block")
    bucket = F.pmod(F.xxhash64("block"), F.lit(buckets))
    few = extents.join(crowded, "block", "left_anti").groupBy(bucket).applyInPandas(_compare, _ANSWER)
    parts = few.unionByName(_dealt(extents.join(crowded, "block", "left_semi")))
    parts = parts.groupBy("text_id").agg(F.collect_list(F.struct("k", "first", "last")).alias("parts"))
    joined = texts.drop("asks").join(parts, "text_id", "left")

    def cut(ids, texts, wholes, firsts, parts):
        out = []
        for text, full, first, some in zip(texts, wholes, firsts, parts, strict=True):
            data = encoded(as_text(text))
            ends = [*first[1:], len(data) - LENGTH + 1]
            runs = [(first[k], ends[k]) for k in full or ()]
            runs += [(first[p["k"]] + p["first"], first[p["k"]] + p["last"]) for p in some or ()]
            gone = _removed(len(data), runs)
            digest, last = hashlib.sha256(), 0
            for a, b in gone:
                digest.update(data[last:a])
                last = b
            digest.update(data[last:])
            out.append((sum(b - a for a, b in gone), len(gone), digest.hexdigest()))
        return {
            "text_id": ids, "n_removed": pa.array([o[0] for o in out], pa.int64()),
            "n_spans": pa.array([o[1] for o in out], pa.int64()), "kept": [o[2] for o in out],
        }

    schema = "text_id string, n_removed bigint, n_spans bigint, kept string"
    done = stored.put(map_rows(joined, ["text_id", "text", "wholes", "firsts", "parts"], cut, schema))
    stored.drop(texts, extents)
    zero = F.lit(0).cast("bigint")
    return base.select("doc_id", "text_id", "n_bytes", "sha256").join(done, "text_id", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("kept", "sha256").alias("kept_sha256"),
    )


def _dealt(extents: DataFrame) -> DataFrame:
    """The windows of crowded blocks, compared as rows; equal windows have equal offsets."""

    def codes(ids, ks, blocks, many, extents, offsets):
        out = []
        for t, k, block, m, extent, offset in zip(ids, ks, blocks, many, extents, offsets, strict=True):
            out += [(t, k, block, m, j, offset - j, c) for j, c in enumerate(_window_codes(extent).view(np.int64).tolist())]
        columns = list(zip(*out, strict=True)) if out else [[]] * 7
        kinds = (pa.string(), pa.int32(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.int64())
        names = ("text_id", "k", "block", "many", "first", "place", "code")
        return {n: pa.array(c, kind) for n, c, kind in zip(names, columns, kinds, strict=True)}

    rows = map_rows(
        extents, ["text_id", "k", "block", "many", "extent", "offset"], codes,
        "text_id string, k int, block bigint, many boolean, first int, place int, code bigint",
    )
    twice = rows.groupBy("block", "place", "code").agg(F.count("*").alias("n")).where("n > 1")
    return rows.where("not many").join(twice, ["block", "place", "code"]).select(
        "text_id", "k", "first", (F.col("first") + 1).alias("last")
    )
