"""Conversation prefix trie (operator 11): ternary search trees per range shard, merged at the shards' edges.

A conversation is a sequence of turns; a node is a distinct prefix of such sequences. Turns are known by a
128-bit digest, so texts are read once and never shuffled. Sequences are cut into blocks of ``BLOCK`` turns,
equal blocks collapse to one weighted row, and the rows are range-partitioned in the order of their turns.
Every run of sorted rows holding about ``SHARD_TURNS`` turns is a shard: its turns are numbered by a
dictionary, its sequences are inserted median first into ternary search trees, and a traversal sums members,
leaves and savings from the bottom. Only nodes that other shards may know too, those on the paths of a
shard's first and last sequence and those above a cut between blocks, are merged by key; their subtree sums
are completed by pointer doubling. A node is never gathered with its members or its children.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from decimal import Decimal
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from townsquare.llm.common import U64, Stored, signed
from townsquare.operators.ranks import running_total

#: Turns of one conversation in one row; longer conversations take several rows.
BLOCK = 256
#: Turns after which a run of sorted rows is closed as a shard; bounds a task's memory.
SHARD_TURNS = 1 << 18
#: Turns of a block that its place in the sorted order depends on, four bytes each.
HEAD = 16
#: Members whose ids are joined to one piece of text before hashing.
PIECE_BITS = 12

_WORD = 1 << 64
_MASK = _WORD - 1
#: Odd bases of the two polynomial hashes that name a prefix.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


# --- turns and sequences --------------------------------------------------------------------------


def numbered_turns(conversations: DataFrame, stored: Stored) -> DataFrame:
    """Rows (conv_id, pos, d1, d2, size): the turns of each conversation in order, from 1.

    Order is by ``turn``, null first; equal turns follow the digest of role and text. Null role or text is
    empty; rows without a ``conv_id`` belong to no conversation. One conversation may span many partitions:
    only its count of rows in earlier partitions is added.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.octet_length(text).cast("long").alias("size"), digest.alias("digest"),
        F.monotonically_increasing_id().alias("row"),
    )
    turns = turns.select(
        "conv_id", "turn", "size", "row",
        F.conv(F.substring("digest", 1, 15), 16, 10).cast("long").alias("d1"),
        F.conv(F.substring("digest", 16, 15), 16, 10).cast("long").alias("d2"),
    )
    order = ["conv_id", F.asc_nulls_first("turn"), "d1", "d2", "row"]
    laid = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    local = stored.put(
        laid.select("conv_id", "d1", "d2", "size").mapInArrow(
            _number, "conv_id long, d1 long, d2 long, size long, part int, place long"
        )
    )
    # One row per partition: its first conversation, and its last one with that one's rows.
    edges = local.groupBy("part").agg(F.min("conv_id").alias("first"), F.max(F.struct("conv_id", "place")).alias("last"))
    spans = edges.select("part", F.col("last.conv_id").alias("conv_id"), F.col("last.place").alias("n")).union(
        edges.select("part", "first", F.lit(0).cast("long"))
    )
    before = Window.partitionBy("conv_id").orderBy("part").rangeBetween(Window.unboundedPreceding, -1)
    offsets = spans.select("part", "conv_id", F.sum("n").over(before).alias("offset")).where("offset > 0").distinct()
    return local.join(F.broadcast(offsets), ["part", "conv_id"], "left").select(
        "conv_id", (F.col("place") + F.coalesce("offset", F.lit(0))).alias("pos"), "d1", "d2", "size"
    )


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the partition's number and each row's place in its conversation within the partition."""
    part = TaskContext.get().partitionId()
    last, seen = None, 0
    for batch in batches:
        conv = batch.column(0).to_numpy()
        if not len(conv):
            continue
        starts = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
        ends = np.append(starts[1:], len(conv))
        place = np.arange(1, len(conv) + 1) - np.repeat(starts, ends - starts)
        if conv[0] == last:
            place[: ends[0]] += seen
        last, seen = conv[-1], place[-1]
        parts = np.full(len(conv), part, dtype=np.int32)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(parts), pa.array(place)], [*batch.schema.names, "part", "place"]
        )


def spliced(turns: DataFrame, stored: Stored, every: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Rebuild every conversation c on the start of conversation c - c % ``every``.

    With h = crc32(c) % ``most`` its first h turns are replaced by the first h of that conversation (all if
    there are fewer, none if it is absent). Returns the rebuilt turns and one row (conv_id, length) per
    conversation, turnless ones included. No start is longer than ``most`` - 1 turns.
    """
    turns = stored.put(turns)
    heads = turns.where((F.col("conv_id") % every == 0) & (F.col("pos") < most)).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", "d1", "d2", "size"))).alias("head")
    )
    known = turns.groupBy("conv_id").agg(F.max("pos").alias("own"))
    plan = known.select(
        "conv_id", "own", (F.col("conv_id") - F.col("conv_id") % every).alias("base"),
        (F.crc32(F.col("conv_id").cast("string")) % most).alias("h"),
    )
    plan = plan.join(heads.select(F.col("conv_id").alias("base"), "head"), "base", "left").withColumn(
        "head", F.slice(F.coalesce("head", F.array().cast(heads.schema["head"].dataType)), F.lit(1), F.col("h").cast("int"))
    )
    plan = stored.put(
        plan.select("conv_id", "h", "head", (F.size("head") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length"))
    )
    kept = turns.join(plan.select("conv_id", "h", "length", F.size("head").alias("shift")), "conv_id").where("pos > h")
    kept = kept.select("conv_id", (F.col("pos") - F.col("h") + F.col("shift")).alias("pos"), "d1", "d2", "size", "length")
    lent = plan.select("conv_id", "length", F.explode("head").alias("t")).select(
        "conv_id", F.col("t.pos").alias("pos"), "t.d1", "t.d2", "t.size", "length"
    )
    return kept.unionByName(lent), plan.select("conv_id", "length")


# --- blocks ---------------------------------------------------------------------------------------


def _powers(base: int, start: int, n: int) -> np.ndarray:
    """base ** (start + 1), ..., base ** (start + n), modulo 2**64."""
    out = np.full(n, base, dtype=U64)
    out[0] = pow(base, start + 1, _WORD)
    return np.cumprod(out, dtype=U64)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block of turns: its part of the prefix hashes, its head, and its turns as plain lists."""
    for batch in batches:
        if not batch.num_rows:
            continue
        block = batch.column(1).to_numpy()
        lists = batch.column(3)
        offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        flat = lists.flatten()
        sizes = np.diff(offsets)
        columns = {name: flat.field(name) for name in ("d1", "d2", "size")}
        sums = []
        for base, name in zip(_BASES, ("d1", "d2"), strict=True):
            power = np.concatenate([_powers(base, int(b) * BLOCK, int(n)) for b, n in zip(block, sizes, strict=True)])
            sums.append(signed(np.add.reduceat(columns[name].to_numpy().view(U64) * power, offsets[:-1])))
        lead = (columns["d1"].to_numpy() >> 28).astype(">u4").tobytes()
        heads = [lead[4 * a : 4 * min(a + HEAD, b)] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        index = pa.array(offsets, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), *map(pa.array, sums), pa.array(heads, pa.binary()),
             *(pa.ListArray.from_arrays(index, columns[name]) for name in ("d1", "d2", "size"))],
            ["conv_id", "block", "length", "c1", "c2", "head", "d1", "d2", "size"],
        )


def _wrapped(value: Column) -> Column:
    """A sum of longs, held as a decimal, as a long modulo 2**64."""
    rest = F.pmod(value.cast("decimal(38,0)"), F.lit(Decimal(_WORD)))
    return F.when(rest >= F.lit(Decimal(_WORD >> 1)), rest - F.lit(Decimal(_WORD))).otherwise(rest).cast("long")


def blocks_of(turns: DataFrame, stored: Stored) -> DataFrame:
    """Rows of at most ``BLOCK`` turns of a conversation, with the hashes of the prefixes before (r1, r2) and at their end (e1, e2)."""
    grouped = (
        turns.withColumn("block", F.floor((F.col("pos") - 1) / BLOCK))
        .groupBy("conv_id", "block", "length")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "d1", "d2", "size"))).alias("turns"))
    )
    longs = "array<long>"
    blocks = stored.put(
        grouped.select("conv_id", "block", "length", "turns").mapInArrow(
            _blocks,
            f"conv_id long, block long, length long, c1 long, c2 long, head binary, d1 {longs}, d2 {longs}, size {longs}",
        )
    )
    blocks = blocks.withColumn("more", F.col("length") > (F.col("block") + 1) * BLOCK)
    if not blocks.where("block > 0").head(1):
        zero = F.lit(0).cast("long")
        return blocks.withColumns({"r1": zero, "r2": zero, "e1": F.col("c1"), "e2": F.col("c2")})
    long_ones = blocks.where(F.col("length") > BLOCK)
    before = None
    for name in ("1", "2"):
        weights = long_ones.select("conv_id", "block", F.col(f"c{name}").cast("decimal(20,0)").alias("c"))
        sums = running_total(weights, "block", "c", ["conv_id"]).select("conv_id", "block", _wrapped(F.col("before")).alias(f"r{name}"))
        before = sums if before is None else before.join(sums, ["conv_id", "block"])
    short = blocks.where(F.col("length") <= BLOCK).withColumns({"r1": F.lit(0).cast("long"), "r2": F.lit(0).cast("long")})
    blocks = long_ones.join(before, ["conv_id", "block"]).unionByName(short)
    ends = {f"e{k}": _wrapped(F.col(f"r{k}").cast("decimal(38,0)") + F.col(f"c{k}")) for k in (1, 2)}
    return stored.put(blocks.withColumns(ends))


# --- ternary search trees -------------------------------------------------------------------------


class Tree:
    """A ternary search tree over sorted, distinct, non-empty sequences of integers.

    Node k holds one symbol; ``lo`` and ``hi`` lead to smaller and larger symbols at the same place, ``eq`` to
    the next place. The median sequence of every range is inserted first, so each place's choice is a
    balanced search tree. ``first`` is a sequence through the node, ``end`` the one that ends there, or -1.
    """

    def __init__(self, sequences: list[list[int]]) -> None:
        self.symbol: list[int] = []
        self.first: list[int] = []
        self.end: list[int] = []
        self.lo: list[int] = []
        self.eq: list[int] = []
        self.hi: list[int] = []
        todo = [(0, len(sequences), 0, -1, self.eq)] if sequences else []
        while todo:
            left, right, place, owner, link = todo.pop()
            at = itemgetter(place)
            symbol = sequences[(left + right) // 2][place]
            a = bisect_left(sequences, symbol, left, right, key=at)
            b = bisect_right(sequences, symbol, a, right, key=at)
            node = len(self.symbol)
            if owner >= 0:
                link[owner] = node
            ends = len(sequences[a]) == place + 1
            self.symbol.append(symbol)
            self.first.append(a)
            self.end.append(a if ends else -1)
            for links in (self.lo, self.eq, self.hi):
                links.append(-1)
            if left < a:
                todo.append((left, a, place, node, self.lo))
            if b < right:
                todo.append((b, right, place, node, self.hi))
            if a + ends < b:
                todo.append((a + ends, b, place + 1, node, self.eq))

    def walk(self) -> Iterator[tuple[int, int, int]]:
        """(node, node of the prefix one shorter or -1, length of the prefix), parents before children."""
        todo = [(0, -1, 1)] if self.symbol else []
        while todo:
            node, parent, length = todo.pop()
            yield node, parent, length
            for other in (self.lo[node], self.hi[node]):
                if other >= 0:
                    todo.append((other, parent, length))
            if self.eq[node] >= 0:
                todo.append((self.eq[node], node, length + 1))


NODES = (
    "k1 long, k2 long, p1 long, p2 long, depth long, edge boolean, edge_above boolean, n long, least long, least_above long, "
    "size long, children long, leaves long, saved long, n_end long, least_end long"
)
_NAMES = [field.split()[0] for field in NODES.split(", ")]


def _signed(value: int) -> int:
    return value - _WORD if value >> 63 else value


def _least(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else min(a, b)


def _shard_nodes(rows: list[dict]) -> Iterator[tuple]:
    """The nodes of one shard, as tuples in the order of ``NODES``.

    Edge nodes carry what lies below them inside the shard; all others are complete.
    """
    code: dict[tuple[int, int], int] = {}
    tips = {(r["block"], r["r1"], r["r2"]): [] for r in (rows[0], rows[-1])}
    for r in (rows[0], rows[-1]):
        tips[r["block"], r["r1"], r["r2"]].append(r["head"])
    for (block, r1, r2), same in groupby(rows, key=itemgetter("block", "r1", "r2")):
        own = []
        for r in same:
            own.append(([code.setdefault(t, len(code)) for t in zip(r["d1"], r["d2"], strict=True)], r))
        own.sort(key=itemgetter(0))
        tree = Tree([s for s, _ in own])
        reach = tips.get((block, r1, r2), [])
        count = len(tree.symbol)
        order: list[tuple[int, int, int]] = list(tree.walk())
        # The last place of these lists stands for the block's root.
        n, n_end, children, leaves, saved = ([0] * (count + 1) for _ in range(5))
        least: list[int | None] = [None] * (count + 1)
        least_end: list[int | None] = [None] * (count + 1)
        edge = [False] * count + [True]
        size = [0] * (count + 1)
        k1, k2 = [0] * count + [r1 & _MASK], [0] * count + [r2 & _MASK]
        longest = max(length for _, _, length in order)
        power = [_powers(base, block * BLOCK, longest).tolist() for base in _BASES]
        for node, parent, length in order:
            r = own[tree.first[node]][1]
            k1[node] = (k1[parent] + r["d1"][length - 1] * power[0][length - 1]) & _MASK
            k2[node] = (k2[parent] + r["d2"][length - 1] * power[1][length - 1]) & _MASK
            size[node] = r["size"][length - 1]
            upto = 4 * min(length, HEAD)
            edge[node] = edge[parent] and any(r["head"][:upto] == head[:upto] for head in reach)
        for node, parent, _ in reversed(order):
            if tree.end[node] >= 0:
                r = own[tree.end[node]][1]
                n[node] += r["n"]
                n_end[node], least_end[node] = r["n_end"], r["least_end"]
                least[node] = _least(least[node], r["least"])
                edge[node] |= r["n"] > r["n_end"]
            if not edge[node]:
                leaves[node] += children[node] == 0
                saved[node] += (n[node] - 1) * size[node]
                children[parent] += 1
                leaves[parent] += leaves[node]
                saved[parent] += saved[node]
            edge[parent] |= edge[node]
            n[parent] += n[node]
            least[parent] = _least(least[parent], least[node])
        for node, parent, length in order:
            yield (
                _signed(k1[node]), _signed(k2[node]), _signed(k1[parent]), _signed(k2[parent]), block * BLOCK + length,
                edge[node], edge[parent], n[node], least[node], least[parent], size[node],
                children[node], leaves[node], saved[node], n_end[node], least_end[node],
            )
        # A later block's root is the node at the end of the block before, which has its members.
        top = n[count] if not block else 0
        yield (
            r1, r2, None, None, block * BLOCK, True, False, top, least[count] if not block else None, None, None,
            children[count], leaves[count], saved[count], 0, None,
        )


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(name, pa.bool_() if name.startswith("edge") else pa.int64()) for name in _NAMES])

    def nodes(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        found = list(_shard_nodes(rows))
        for start in range(0, len(found), 1 << 16):
            columns = zip(*found[start : start + (1 << 16)], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    rows: list[dict] = []
    held = 0
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            for r in batch.slice(start, 256).to_pylist():
                rows.append(r)
                held += len(r["d1"])
                if held >= SHARD_TURNS:
                    yield from nodes(rows)
                    rows, held = [], 0
    if rows:
        yield from nodes(rows)


# --- the trie -------------------------------------------------------------------------------------


def _subtree_sums(nodes: DataFrame, stored: Stored) -> DataFrame:
    """Add up ``leaves`` and ``saved`` over all descendants, by pointer doubling.

    After round k a node holds the sums of all nodes less than 2**k below it and points at its ancestor
    2**k above. The rounds grow with the logarithm of the depth, and nodes are only sent to one ancestor.
    """
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    state = stored.put(nodes.select("k1", "k2", "depth", F.col("p1").alias("a1"), F.col("p2").alias("a2"), "leaves", "saved"))
    step = 1
    while step <= deepest:
        below = state.where(F.col("depth") >= step).groupBy("a1", "a2").agg(
            F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")
        )
        above = state.where(F.col("depth") >= step).select(
            F.col("k1").alias("a1"), F.col("k2").alias("a2"), F.col("a1").alias("b1"), F.col("a2").alias("b2")
        )
        added = state.join(below.withColumnsRenamed({"a1": "k1", "a2": "k2"}), ["k1", "k2"], "left").withColumns(
            {name: F.col(name) + F.coalesce(f"more_{name}", F.lit(0)) for name in ("leaves", "saved")}
        )
        wanted = ["k1", "k2", "depth", "a1", "a2", "leaves", "saved"]
        far = stored.put(added.where(F.col("depth") >= 2 * step).select(*wanted))
        near = added.where(F.col("depth") < 2 * step).select(*wanted)
        moved = far.join(above, ["a1", "a2"]).select("k1", "k2", "depth", F.col("b1").alias("a1"), F.col("b2").alias("a2"), "leaves", "saved")
        before, state = state, stored.put(moved.unionByName(near))
        stored.drop(before, far)
        step *= 2
    return state.select("k1", "k2", "leaves", "saved")


def trie(turns: DataFrame, lengths: DataFrame, stored: Stored) -> tuple[DataFrame, DataFrame]:
    """All nodes of the trie of ``turns``, and the members that end at each.

    ``turns`` has (conv_id, pos, d1, d2, size, length), ``lengths`` (conv_id, length) for every conversation.
    Nodes: (k1, k2) name the prefix, ``depth``, ``conv_id`` the smallest member, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens``. Members: (k1, k2, conv_id). Without conversations both are empty.
    """
    blocks = blocks_of(turns, stored)
    held = blocks.groupBy("block", "e1", "e2").agg(
        F.count("*").alias("n"), F.min("conv_id").alias("least"),
        F.count(F.when(~F.col("more"), 1)).alias("n_end"), F.min(F.when(~F.col("more"), F.col("conv_id"))).alias("least_end"),
        *(F.any_value(name).alias(name) for name in ("r1", "r2", "head", "d1", "d2", "size")),
    )
    order = ["block", "r1", "r2", "head", "e1", "e2"]
    held = stored.put(held)
    shards = stored.put(held.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_shards, NODES))

    none = F.lit(None).cast("long")
    zero = F.lit(0).cast("long")
    turnless = lengths.where("length = 0").agg(F.count("*").alias("n"), F.min("conv_id").alias("least")).where("n > 0").select(
        zero.alias("k1"), zero.alias("k2"), none.alias("p1"), none.alias("p2"), zero.alias("depth"), "n", "least",
        none.alias("size"), zero.alias("children"), zero.alias("leaves"), zero.alias("saved"),
    )
    edges = shards.where("edge").select(*turnless.columns).unionByName(turnless).groupBy("k1", "k2").agg(
        F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.max("depth").alias("depth"), F.sum("n").alias("n"),
        F.min("least").alias("least"), F.max("size").alias("size"),
        *(F.sum(name).alias(name) for name in ("children", "leaves", "saved")),
    )
    edges = stored.put(edges)
    kids = edges.where("depth > 0").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("kids"))
    whole = edges.join(kids, ["k1", "k2"], "left").withColumn("children", F.col("children") + F.coalesce("kids", F.lit(0)))
    whole = stored.put(whole.withColumns({
        "leaves": F.col("leaves") + F.when(F.col("children") == 0, 1).otherwise(0),
        "saved": F.col("saved") + F.coalesce((F.col("n") - 1) * F.col("size"), F.lit(0)),
    }).drop("kids", "size"))
    sums = _subtree_sums(whole, stored)
    merged = stored.put(whole.drop("leaves", "saved").join(sums, ["k1", "k2"]))

    shown = ["k1", "k2", "p1", "p2", "depth", F.col("least").alias("conv_id"), F.col("n").alias("n_convs"),
             F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens")]
    inner = shards.where("not edge")
    parents = merged.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("least").alias("parent_conv_id"))
    hanging = inner.where("edge_above").select(*shown).unionByName(merged.where("depth > 0").select(*shown))
    nodes = (
        hanging.join(parents, ["p1", "p2"])
        .unionByName(inner.where("not edge_above").select(*shown, F.col("least_above").alias("parent_conv_id")))
        .unionByName(merged.where("depth = 0").select(*shown, none.alias("parent_conv_id")))
    )
    ends = blocks.where("not more").select(F.col("e1").alias("k1"), F.col("e2").alias("k2"), "conv_id")
    ends = ends.unionByName(lengths.where("length = 0").select(zero.alias("k1"), zero.alias("k2"), "conv_id"))
    return nodes, ends


def _hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's pieces, joined by commas as they come; one running hash at a time."""
    key, running = None, None
    done: tuple[list, list, list] = ([], [], [])

    def close() -> None:
        for column, value in zip(done, (*key, running.hexdigest()), strict=True):
            column.append(value)

    def flushed() -> pa.RecordBatch:
        out = pa.RecordBatch.from_pydict({"k1": list(done[0]), "k2": list(done[1]), "sha256": list(done[2])})
        for column in done:
            column.clear()
        return out

    for batch in batches:
        for k1, k2, piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (k1, k2) == key:
                running.update(b",")
            else:
                if key is not None:
                    close()
                key, running = (k1, k2), hashlib.sha256()
            running.update(piece.encode())
        if len(done[0]) >= 4096:
            yield flushed()
    if key is not None:
        close()
        yield flushed()


def member_hashes(ends: DataFrame) -> DataFrame:
    """Per node (k1, k2) the SHA-256 of its members' ids, ascending and joined by commas.

    Ids are joined to pieces of at most 2**12 in parallel; what is hashed in one place is the text alone, because the
    hash is sequential by definition.
    """
    pieces = ends.groupBy("k1", "k2", F.shiftright("conv_id", PIECE_BITS).alias("piece")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")
    )
    laid = pieces.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "piece").select("k1", "k2", "ids")
    return laid.mapInArrow(_hash_pieces, "k1 long, k2 long, sha256 string")


def report(conversations: DataFrame, stored: Stored) -> DataFrame:
    """The trie of the rebuilt ``conversations`` (see ``spliced``), one row per node, with the hash of the members that end there.

    Null role or text is empty, null turns come first, repeated rows are turns of their own, rows without a
    conv_id are left out, other columns are ignored; an empty table has no node, not even a root.
    """
    turns, lengths = spliced(numbered_turns(conversations, stored), stored)
    nodes, ends = trie(turns, lengths, stored)
    nodes = nodes.join(member_hashes(ends), ["k1", "k2"], "left")
    return nodes.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
