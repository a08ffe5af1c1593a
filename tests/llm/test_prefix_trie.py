"""The conversation trie against brute force, over shards, blocks and partitions of every size."""

import hashlib
import random
import zlib

import pytest

from townsquare.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, size long, k1 string, block int"


def rebuilt(rows):
    own = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(c, []).append(((turn is not None, turn or 0), digest, (role, text)))
    own = {c: [t for _, _, t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    return out


def brute(rows):
    members, ends = {}, {}
    for c, turns in rebuilt(rows).items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    children = {p: 0 for p in members}
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for p in members:
        worth = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += worth
    return [
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
         hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest())
        for p, m in members.items()
    ]


def chats(seed=3, convs=160, long_one=40):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        start = rng.choice(["hi", "hello", "hi there", "é"]) if c % 3 else "the very common first turn"
        turns = [start] + [rng.choice("abcd") * rng.choice([1, 2, 30]) for _ in range(rng.choice([0, 1, 3, 7, 12]))]
        if c == 5 or c == 10:
            turns = ["long"] + [f"t{k % 7}" for k in range(long_one)] + [f"end {c}"]
        rows += [(c * 3 if c > 100 else c, k, ["user", "assistant"][k % 2], t, 1, "x", 2) for k, t in enumerate(turns)]
    rows += [(700 + c, 0, "user", "only one turn", 1, "x", 2) for c in range(40)]  # many are left without turns
    rows += [(900, None, None, None, 1, "x", 2), (900, None, "user", "", 1, "x", 2), (900, 4, None, "z", 1, "x", 2)]
    rows += [(901, 1, "user", "tie", 1, "x", 2), (901, 1, "user", "other", 1, "x", 2)] + [(902, 1, "u", "same", 1, "x", 2)] * 4
    rows += [(None, 1, "user", "of no conversation", 1, "x", 2)]
    return rows


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("block, shard, head", [(256, 1 << 18, 16), (4, 20, 16), (3, 50, 1)])
def test_trie_equals_brute_force(spark, stored, monkeypatch, block, shard, head):
    rows = chats()
    # Workers read the module's settings from closures only if they are set there; run the shards here instead.
    import townsquare.llm.prefix_trie as module

    for name, value in (("BLOCK", block), ("SHARD_TURNS", shard), ("HEAD", head)):
        monkeypatch.setattr(module, name, value)
    inner = {name: _with_settings(getattr(module, name), block, shard, head) for name in ("_blocks", "_shards")}
    for name, function in inner.items():
        monkeypatch.setattr(module, name, function)
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    assert ordered(prefix_trie.report(df, stored).collect()) == ordered(brute(rows))


def _with_settings(function, block, shard, head):
    name = function.__name__

    def run(batches):
        import townsquare.llm.prefix_trie as module

        module.BLOCK, module.SHARD_TURNS, module.HEAD = block, shard, head
        try:
            yield from getattr(module, name)(batches)
        finally:
            module.BLOCK, module.SHARD_TURNS, module.HEAD = 256, 1 << 18, 16

    return run


def test_one_conversation_over_many_partitions(spark, stored):
    rows = [(c, k, "user", f"turn {k % 9}", 1, "x", 2) for c in (0, 1) for k in range(400)] + [(7, 0, "a", "b", 1, "x", 2)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    places = {}
    for r in prefix_trie.numbered_turns(df, stored).collect():
        places.setdefault(r.conv_id, []).append(r.pos)
    assert {c: sorted(p) for c, p in places.items()} == {0: [*range(1, 401)], 1: [*range(1, 401)], 7: [1]}
    assert ordered(prefix_trie.report(df, stored).collect()) == ordered(brute(rows))


def test_no_conversations(spark, stored):
    df = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.report(df, stored).collect() == []
    lost = spark.createDataFrame([(None, 1, "user", "x", 1, "y", 2)], SCHEMA)
    assert prefix_trie.report(lost, stored).collect() == []


def test_tree_is_balanced_and_holds_every_sequence():
    sequences = [[k] for k in range(1000)] + []
    tree = prefix_trie.Tree(sequences)

    def height(node):
        return 0 if node < 0 else 1 + max(height(tree.lo[node]), height(tree.hi[node]))

    assert height(0) <= 11
    rng = random.Random(1)
    sequences = sorted({tuple(rng.randrange(3) for _ in range(rng.randint(1, 6))) for _ in range(200)})
    tree = prefix_trie.Tree([list(s) for s in sequences])
    assert sorted(e for e in tree.end if e >= 0) == list(range(len(sequences)))
    prefixes = {s[:d] for s in sequences for d in range(1, len(s) + 1)}
    assert len(tree.symbol) == len(prefixes) == len(list(tree.walk()))
