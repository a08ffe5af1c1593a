"""N-gram Jaccard join by a MinHash LSH forest.

Signatures are cut into trees; a tree is the sorted trie of its part of the signatures. All
texts that share a prefix of the current depth in some tree are candidates. Candidates are
verified exactly on their shingle sets, the recall is estimated from the similarities of
the links found, and prefixes are shortened until the estimate meets the target.

Texts with equal shingle sets form a class and take part once. Candidate regions of bounded
size are verified in one unit; larger ones by prefix, in blocks, so no group is gathered
and no pair of texts becomes a row.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from townsquare.llm.common import (
    U64,
    Stored,
    as_text,
    components,
    encoded,
    hashed_words,
    map_rows,
    windows,
)

SHINGLE_WORDS = 5
SIMILARITY = 0.8
TREES = 32
DEPTH = 5
TARGET_RECALL = 0.99999
#: Texts a verification unit compares; two blocks make one unit of a larger bucket.
BLOCK = 256
#: Rows of a narrow side (a few longs each) up to which it is broadcast; beyond, joins shuffle.
SMALL_ROWS = 2_000_000
#: Bytes of shingle sets, of many units, that one call verifies on average.
UNIT_BYTES = 8_000_000
_SEED = 20240501
_SCHEMA = "doc_id bigint, text_key bigint, set_key bigint, n_shingles int, signature array<int>, shingles binary"
_CHUNK = 2048


def shingles(text: str) -> np.ndarray:
    """Sorted distinct 48-bit hashes of five lower-cased words; shorter texts are one shingle."""
    h = hashed_words(encoded(text.lower()))
    if not len(h):
        return h
    h = windows(h, SHINGLE_WORDS) if len(h) >= SHINGLE_WORDS else windows(h, len(h))
    return np.unique(h >> U64(16))


def signature(sets: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    low = None
    for start in range(0, len(sets), _CHUNK):
        part = (a[:, None] * sets[start : start + _CHUNK].astype(np.uint32) + b[:, None]).min(axis=1)
        low = part if low is None else np.minimum(low, part)
    return low.view(np.int32)


def packed(sets: np.ndarray) -> bytes:
    return sets.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 6, 8), dtype=np.uint8)
    wide[:, :6] = np.frombuffer(data, dtype=np.uint8).reshape(-1, 6)
    return wide.view("<u8").ravel()


def sign(docs: DataFrame, trees: int, depth: int) -> DataFrame:
    """Shingle set, its key and its signature for every document; one scan, no shuffle."""
    rng = np.random.default_rng(_SEED)
    a = rng.integers(1, 1 << 32, trees * depth, dtype=np.uint32) | np.uint32(1)
    b = rng.integers(1, 1 << 32, trees * depth, dtype=np.uint32)

    def run(ids, keys, texts):
        sets = [shingles(as_text(t)) for t in texts]
        data = [packed(s) for s in sets]
        set_keys = np.array([xxhash.xxh3_64_intdigest(d) for d in data], dtype=U64).view(np.int64)
        return {
            "doc_id": pa.array(ids, pa.int64()),
            "text_key": pa.array(keys, pa.int64()),
            "set_key": set_keys,
            "n_shingles": pa.array([len(s) for s in sets], pa.int32()),
            "signature": pa.array([signature(s, a, b) if len(s) else None for s in sets], pa.list_(pa.int32())),
            "shingles": pa.array(data, pa.binary()),
        }

    text = F.col("text").cast("string")
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), _text_key().alias("text_key"), text.alias("text"))
    return map_rows(slim, ["doc_id", "text_key", "text"], run, _SCHEMA)


def _text_key():
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def small_side(stored_table: DataFrame) -> DataFrame:
    """A stored narrow table, broadcast where its counted rows are within the bound."""
    return F.broadcast(stored_table) if stored_table.count() <= SMALL_ROWS else stored_table


def prefixes(classes: DataFrame, trees: int, depth: int, stored_depth: int) -> DataFrame:
    """Rows (set_key, prefixes): a hash of the first ``depth`` values of every tree."""
    paths = [
        F.xxhash64(F.lit(t), *[F.col("signature")[t * stored_depth + k] for k in range(depth)]) for t in range(trees)
    ]
    return classes.select("set_key", F.array(*paths).alias("prefixes"))


def found_probability(similarity: np.ndarray, trees: int, depth: int) -> np.ndarray:
    return 1 - (1 - similarity**depth) ** trees


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Shared shingles of each left with each right set."""
    every = np.concatenate([*left, *right])
    vocabulary, code = np.unique(every, return_inverse=True)
    ends = np.cumsum([len(s) for s in [*left, *right]])
    codes = np.split(code, ends[:-1])
    others = np.concatenate(codes[len(left) :])
    starts = np.concatenate([[0], np.cumsum([len(s) for s in right])[:-1]])
    out = np.empty((len(left), len(right)), dtype=np.int64)
    mark = np.zeros(len(vocabulary), dtype=np.int64)
    for k in range(len(left)):
        mark[codes[k]] = 1
        out[k] = np.add.reduceat(mark[others], starts)
        mark[codes[k]] = 0
    return out


class Unit:
    """Counts, weights and spanning edges of the verified links among a unit's texts."""

    def __init__(self, ids: np.ndarray, sides: np.ndarray, sets: list[np.ndarray], trees: int, depth: int) -> None:
        self.ids, self.sets, self.trees, self.depth = ids, sets, trees, depth
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        self.counts, self.weights = np.zeros(len(ids), dtype=np.int64), np.zeros(len(ids))
        self.root = np.arange(len(ids))
        self.first, self.second = np.flatnonzero(sides == 0), np.flatnonzero(sides == 1)

    def link(self, similarity: float, across: bool, paths: np.ndarray | None, tree: int) -> None:
        """Verify the pairs within one block or across two; with ``paths``, those that meet in
        this tree for the first time."""
        second = self.second if across else self.first
        if not len(self.first) or not len(second):
            return
        shared = _overlaps([self.sets[i] for i in self.first], [self.sets[i] for i in second])
        together = self.sizes[self.first][:, None] + self.sizes[second][None, :] - shared
        linked = shared * 1000 >= round(similarity * 1000) * together
        if not across:
            linked &= second[None, :] > self.first[:, None]
        jaccard = shared / together
        for row in np.flatnonzero(linked.any(axis=1)):
            i, at = self.first[row], np.flatnonzero(linked[row])
            if paths is not None and tree:
                at = at[~(paths[second[at], :tree] == paths[i, :tree]).any(axis=1)]
            if not len(at):
                continue
            partners = second[at]
            w = 1 / found_probability(jaccard[row, at], self.trees, self.depth)
            self.counts[i] += len(partners)
            self.weights[i] += w.sum()
            self.counts[partners] += 1
            self.weights[partners] += w
            roots = np.unique(self.root[[i, *partners]])
            self.root[np.isin(self.root, roots)] = roots[0]


def _verify(trees: int, depth: int, similarity: float):
    """A function over the rows of many units: their verified links."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["unit", "side", "set_key"], kind="stable", ignore_index=True)
        units = frame["unit"].to_numpy()
        cuts = np.flatnonzero(np.concatenate([[True], units[1:] != units[:-1], [True]]))
        ids, sides = frame["set_key"].to_numpy(), frame["side"].to_numpy()
        done = []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            unit = Unit(ids[a:b], sides[a:b], [unpacked(x) for x in frame["shingles"].iloc[a:b]], trees, depth)
            by_prefix = frame["by_prefix"].iat[a]
            paths = np.array(frame["prefixes"].iloc[a:b].tolist(), dtype=np.int64) if by_prefix else None
            unit.link(similarity, bool(frame["across"].iat[a]), paths, int(frame["tree"].iat[a]))
            done.append(unit)
        hit = [u.counts > 0 for u in done]

        def gathered(values: list[np.ndarray]) -> np.ndarray:
            return np.concatenate([v[h] for v, h in zip(values, hit, strict=True)])

        return pd.DataFrame({
            "set_key": gathered([u.ids for u in done]), "links": gathered([u.counts for u in done]),
            "weight": gathered([u.weights for u in done]), "joined": gathered([u.ids[u.root] for u in done]),
        })

    return run


def verified(signed: DataFrame, classes: DataFrame, stored: Stored, trees: int, depth: int, stored_depth: int,
             similarity: float) -> DataFrame:
    """Rows (set_key, links, weight, joined) of the verified links at this depth."""
    paths = prefixes(classes, trees, depth, stored_depth)
    rows = paths.select("set_key", F.posexplode("prefixes").alias("tree", "prefix"))
    heads = stored.put(
        rows.groupBy("prefix").agg(F.min("set_key").alias("head"), F.count("*").alias("members")).where("members > 1")
    )
    met = stored.put(rows.join(small_side(heads), "prefix").select("set_key", "tree", "prefix", "head", "members"))
    regions = components(met.select(F.col("set_key").alias("a"), F.col("head").alias("b")), stored)
    regions = stored.put(
        regions.unionByName(regions.select(F.col("root").alias("node"), "root")).distinct()
    )
    sizes = regions.groupBy("root").agg(F.count("*").alias("size"))
    large = stored.put(
        regions.join(sizes.where(F.col("size") > BLOCK), "root").select(F.col("node").alias("set_key"))
    )
    small = regions.join(sizes.where(F.col("size") <= BLOCK), "root").select(
        F.xxhash64(F.lit("region"), "root").alias("unit"), F.lit(0).alias("side"), F.lit(0).alias("tree"),
        F.lit(False).alias("by_prefix"), F.lit(False).alias("across"), F.col("node").alias("set_key"),
    )
    # Large regions: each bucket by blocks; a text goes to the units of its block with every other.
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    dealt = met.join(large, "set_key", "left_semi").withColumn("blocks", blocks).withColumn(
        "block", F.pmod(F.xxhash64("set_key", "tree"), F.col("blocks")).cast("int")
    )
    partner = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    units = dealt.select("*", partner).select(
        F.xxhash64(F.lit("bucket"), "prefix", F.least("block", "other"), F.greatest("block", "other")).alias("unit"),
        (F.col("block") > F.col("other")).cast("int").alias("side"), "tree", F.lit(True).alias("by_prefix"),
        (F.col("block") != F.col("other")).alias("across"), "set_key",
    )
    members = small.unionByName(units)
    inside = small_side(regions.select(F.col("node").alias("set_key")))
    bytes_of = classes.join(inside, "set_key", "left_semi").select("set_key", (6 * F.col("n_shingles")).alias("n"))
    times = members.groupBy("set_key").agg(F.count("*").alias("units"))
    size = times.join(bytes_of, "set_key").agg(F.sum(F.col("units") * F.col("n"))).first()[0]
    buckets = (size or 0) // UNIT_BYTES + 1
    # All keyed by set_key: the sets are shuffled here once, and once more to their units.
    sets = (
        signed.join(inside, "set_key", "left_semi").select("set_key", "shingles").dropDuplicates(["set_key"])
        .join(paths.join(inside, "set_key", "left_semi"), "set_key")
    )
    plain = members.join(sets, "set_key").select(
        "unit", "side", "tree", "by_prefix", "across", "set_key", "shingles",
        F.when(F.col("by_prefix"), F.col("prefixes")).alias("prefixes"),
    )
    out = plain.groupBy(F.pmod(F.xxhash64("unit"), F.lit(buckets))).applyInPandas(
        _verify(trees, depth, similarity), "set_key bigint, links bigint, weight double, joined bigint"
    )
    out = stored.put(out)
    stored.drop(heads, met, regions, large)
    return out


def join(
    docs: DataFrame,
    stored: Stored,
    similarity: float = SIMILARITY,
    trees: int = TREES,
    depth: int = DEPTH,
    target_recall: float = TARGET_RECALL,
) -> DataFrame:
    """One row per document: doc_id, text_key, class_id, n_links, group_id, kept.

    ``class_id`` is the least doc_id among texts with the same shingle set, ``n_links`` the
    number of other classes at or above ``similarity``, ``group_id`` the least doc_id that
    chains of links reach, and ``kept`` marks the group's representative (every repeated
    row of it). Documents without a word (null or empty texts) are classes of their own
    without links and are kept. Ids may be null, rows may repeat, tables may be empty;
    further columns are ignored.
    """
    signed = stored.put(sign(docs, trees, depth))
    filled = signed.where("n_shingles > 0")
    classes = stored.put(
        filled.groupBy("set_key").agg(
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("first"),
            F.first("signature").alias("signature"),
            F.first("n_shingles").alias("n_shingles"),
        )
    )
    at = depth
    while True:
        links = verified(signed, classes, stored, trees, at, depth, similarity)
        found, expected = links.agg(F.sum("links"), F.sum("weight")).first()
        if at == 1 or not found or found >= target_recall * expected:
            break
        stored.drop(links)
        at -= 1
    counts = links.groupBy("set_key").agg(F.sum("links").cast("bigint").alias("n_links"))
    groups = components(links.select(F.col("set_key").alias("a"), F.col("joined").alias("b")), stored)
    firsts = classes.select("set_key", "first")
    member = firsts.join(groups, F.col("set_key") == F.col("node"), "left").select(
        "set_key", "first", F.coalesce("root", "set_key").alias("root")
    ).join(counts, "set_key", "left")
    member = stored.put(member)
    heads = member.groupBy("root").agg(F.min("first").alias("head"))
    named = stored.put(member.join(heads, "root").select("set_key", "first", "head", "n_links"))
    own = filled.select("doc_id", "text_key", "set_key").join(named, "set_key").select(
        "doc_id", "text_key", F.col("first.doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.col("head.doc_id").alias("group_id"),
        (F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("text_key") == F.col("head.text_key"))).alias("kept"),
    )
    blank = signed.where("n_shingles = 0").select(
        "doc_id", "text_key", F.col("doc_id").alias("class_id"), F.lit(0).cast("bigint").alias("n_links"),
        F.col("doc_id").alias("group_id"), F.lit(True).alias("kept"),
    )
    stored.drop(links, member)
    return own.unionByName(blank)


def one_of_each(docs: DataFrame, stored: Stored) -> DataFrame:
    """``docs`` with one document of every group; rows repeated with id and text appear once."""
    found = join(docs, stored).groupBy(F.col("doc_id").alias("__llm_doc"), F.col("text_key").alias("__llm_text")).agg(
        F.bool_or("kept").alias("__llm_kept"), (F.count("*") > 1).alias("__llm_again")
    )
    # Most rows are kept and appear once; only the others have to be looked up.
    odd = small_side(stored.put(found.where("not __llm_kept or __llm_again")))
    own = docs.withColumn("__llm_own", _text_key())
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col("__llm_doc")) & (F.col("__llm_own") == F.col("__llm_text"))
    once = own.join(odd, same, "left_anti")
    again = own.join(odd.where("__llm_kept"), same, "left_semi").dropDuplicates(["doc_id", "__llm_own"])
    return once.unionByName(again).select(*docs.columns)
