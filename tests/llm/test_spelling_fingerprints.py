"""Spelling variants and document fingerprints against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from townsquare.llm import fingerprints, spelling


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


# --- spelling variants ----------------------------------------------------------------------------


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute_variants(rows):
    counts = collections.Counter()
    for name, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{'' if name is None else name}:{word}".encode())
            if h % 97 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            counts[word] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda v: (-words[v], v))
            if words[best] >= 2 * words[w]:
                form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None))
    return out


def spelled():
    rng = random.Random(8)
    base = ["harbour", "colour", "éclaireur", "aabbaab", "aaaaa", "aaaaaa", "abcde", "zébré", "ÿÿÿÿÿ", "wordword"]
    pool = list(base)
    for _ in range(3):
        for w in list(pool)[:60]:
            at = rng.randrange(len(w) + 1)
            pool.append(rng.choice([w[:at] + "x" + w[at:], w[:at] + w[at + 1 :], w[:at] + "y" + w[at + 1 :], w[:at] + "ab" + w[at:]]))
    rows = []
    for k in range(260):
        words = [rng.choice(pool[: 1 + rng.randrange(len(pool))]) for _ in range(rng.randrange(40))]
        rows.append((k if k % 40 else None, rng.choice([" ", ", ", "1", "Δ"]).join(words)))
    rows += [(1000 + k, "Colour COLOUR coloUr ÉCLAIREUR éclaireur İstanbul x×y÷zzz") for k in range(5)]
    return [*rows, (2000, None), (2001, ""), (2002, "12 34"), (1000, "colour colour"), (1000, "colour colour"), (None, None),
            *[(3000 + k, "q" * 3000 + " " + "q" * 2999) for k in range(3)]]


@pytest.mark.parametrize("partitions", [1, 7])
def test_variants_equal_brute_force(spark, stored, partitions, monkeypatch):
    monkeypatch.setattr(spelling, "HELD_WORDS", 20)
    rows = spelled()
    df = spark.createDataFrame([(*r, 3, "w", 1) for r in rows], "doc_id long, text string, n long, word string, rank int")
    got = spelling.variants(df.repartition(partitions), stored).collect()
    assert ordered(got) == ordered(brute_variants(rows))


def test_variants_of_nothing(spark, stored, nothing):
    assert spelling.variants(nothing, stored).collect() == []


def test_nodes_shared_by_partitions_have_one_number():
    words = sorted({"".join(random.Random(k).choices("ab", k=5 + k % 3)) for k in range(60)})
    cut = [words[:11], words[11:12], words[12:40], words[40:]]
    shared = set()
    for a, b in zip(cut, cut[1:], strict=False):
        both = fingerprints and spelling.commonprefix([a[-1], b[0]])
        shared.update(both[:k] for k in range(1, len(both) + 1))
    seen = {}
    for p, part in enumerate(cut):
        for word, (_, path) in zip(part, spelling._node_lists(sorted(shared))(iter([(p, w) for w in part])), strict=True):
            for d, node in enumerate(path):
                assert seen.setdefault(word[:d], node) == node
    assert len(set(seen.values())) == len(seen)


# --- fingerprints ---------------------------------------------------------------------------------


def brute_levels(data):
    out = []
    for k in range(len(data) - fingerprints.WINDOW + 1):
        counts = collections.Counter(data[k : k + fingerprints.WINDOW])
        total = sum(int(fingerprints._TERMS[c]) for c in counts.values())
        out.append(min(total * fingerprints.LEVELS // fingerprints._TOP, fingerprints.LEVELS - 1))
    return out


def test_levels_and_choice_equal_brute_force(monkeypatch):
    rng = random.Random(4)
    for piece in (1 << 16, 37):
        monkeypatch.setattr(fingerprints, "PIECE", piece)
        for n in (0, 31, 32, 33, 64, 70, 500):
            data = bytes(rng.choice(b"abcde fgh") for _ in range(n)) if n != 70 else b"a" * 70
            got = fingerprints.levels(np.frombuffer(data, dtype=np.uint8))
            assert got.tolist() == brute_levels(data)
            if len(got):
                rank = got.astype(np.int64) * 7 % 13
                wide = min(fingerprints.WIDE, len(rank))
                tops = collections.Counter(min(range(k, k + wide), key=lambda i: (rank[i], i)) for k in range(len(rank) - wide + 1))
                need = min(fingerprints.OFTEN, len(rank) - wide + 1)
                want = sorted(k for k, c in tops.items() if c >= need) or sorted(tops)
                assert fingerprints.chosen(rank).tolist() == want
    assert math.isclose(fingerprints._TERMS[32] / (1 << 20), 160)


def brute_edits(rows, rarity):
    def digest(text):
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        return fingerprints.written(fingerprints.packed(fingerprints.features(data, rarity[fingerprints.levels(data)])))

    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(r[1].encode()).hexdigest()))
    out = []
    for (name, text), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        k = len(text) // 4
        edited = text[: len(text) - k] + after[:k]
        own, own_edited = digest(text), digest(edited)
        out.append((name, len(text), hashlib.sha256(edited.encode()).hexdigest(), own, own_edited,
                    fingerprints.likeness(own, own_edited), fingerprints.likeness(own, digest(after))))
    return out


@pytest.mark.parametrize("partitions, group", [(1, 1 << 20), (6, 700)])
def test_edited_pairs_equal_brute_force(spark, stored, corpus, docs, partitions, group, monkeypatch):
    monkeypatch.setattr(fingerprints, "GROUP_BYTES", group)
    rows = [(i, t) for i, t, *_ in corpus]
    counts = [0] * fingerprints.LEVELS
    for _, text in rows:
        for level in brute_levels((text or "").encode()[:20_000]) if len(text or "") < 20_000 else fingerprints.levels(
            np.frombuffer(text.encode(), dtype=np.uint8)
        ):
            counts[level] += 1
    assert fingerprints.level_counts(docs) == counts
    got = fingerprints.edited_pairs(docs.repartition(partitions), stored).collect()
    assert ordered(got) == ordered(brute_edits(rows, fingerprints.ranks(counts)))


def test_edited_pairs_of_nothing_and_of_one(spark, stored, nothing):
    assert fingerprints.edited_pairs(nothing, stored).collect() == []
    one = spark.createDataFrame([(4, "abcd" * 40)], "doc_id long, text string")
    row = fingerprints.edited_pairs(one, stored).collect()[0]
    assert (row.doc_id, row.n_chars, row.near_next) == (4, 160, 1.0)


def test_likeness_tells_edits_from_strangers(spark, stored):
    rng = random.Random(12)
    vocabulary = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(3000)]
    rows = [(k, " ".join(rng.choices(vocabulary, k=rng.choice([60, 200, 2000])))) for k in range(40)]
    found = fingerprints.edited_pairs(spark.createDataFrame(rows, "doc_id long, text string"), stored).collect()
    assert min(r.near_edited for r in found) > 0.45
    assert sum(r.near_edited for r in found) / len(found) > 0.65
    assert max(r.near_next for r in found) < 0.1
    assert fingerprints.likeness(found[0].fingerprint, found[1].fingerprint) == fingerprints.likeness(
        found[1].fingerprint, found[0].fingerprint
    )
