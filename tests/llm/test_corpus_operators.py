"""Repeats, near duplicates, mixture, decontamination and the language model against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import prose
from townsquare.llm import decontamination, language_model, mixture, near_duplicates, repeated_text


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


# --- repeated passages --------------------------------------------------------------------------


def brute_repeats(texts, length=200):
    found = collections.Counter()
    data = [(t or "").encode() for t in texts]
    for d in data:
        for p in range(len(d) - length + 1):
            found[d[p : p + length]] += 1
    out = []
    for d in data:
        gone = bytearray(len(d))
        for p in range(len(d) - length + 1):
            if found[d[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        kept = bytes(c for c, g in zip(d, gone, strict=True) if not g)
        spans = sum(1 for k in range(len(d)) if gone[k] and not (k and gone[k - 1]))
        out.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def repeat_texts():
    rng = random.Random(21)
    passage, other = prose(rng, 90, 900), prose(rng, 60, 900)
    texts = [prose(rng, 120, 900) for _ in range(12)]
    texts += [f"{prose(rng, 30, 900)} {passage} {prose(rng, 30, 900)}" for _ in range(6)]
    # The same passage cut at both ends, by one byte too, and just long and short enough.
    texts += [passage[a:b] for a, b in ((0, 250), (30, 300), (100, 299), (100, 300), (100, 301), (1, len(passage) - 1))]
    texts += [prose(rng, 9, 900) + passage[50:249] + "!", prose(rng, 9, 900) + passage[50:250] + "!"]
    texts += [texts[0], texts[0] + "x", "y" + texts[0][5:], other + prose(rng, 40, 900) + other, "z" * 199, "z" * 200]
    texts += ["q" * 201, "ab" * 150, "ab" * 99, "é" * 100, "é" * 130, None, "", "abc" * 400]
    return texts


@pytest.mark.parametrize("group", [repeated_text.GROUP_EXTENTS, 1])
def test_repeats_equal_brute_force(spark, stored, group):
    texts = repeat_texts()
    rows = [(k if k % 5 else None, t, 1) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long").repartition(4)
    got = repeated_text.remove(docs, stored, group).collect()
    want = [(r[0], *b) for r, b in zip(rows, brute_repeats(texts), strict=True)]
    assert ordered(got) == ordered(want)


def test_repeats_across_pieces(spark, stored, monkeypatch):
    rng = random.Random(2)
    text = prose(rng, 400, 5000)
    repeated_text.powers()
    monkeypatch.setattr(repeated_text, "PIECE", 333)
    import numpy as np

    whole = repeated_text.samples(np.frombuffer(text.encode(), dtype=np.uint8))
    monkeypatch.setattr(repeated_text, "PIECE", 1 << 17)
    once = repeated_text.samples(np.frombuffer(text.encode(), dtype=np.uint8))
    assert set(once[0]) <= set(whole[0]) and set(once[1]) == set(whole[1])


# --- near duplicates ----------------------------------------------------------------------------


def near_texts():
    rng = random.Random(4)
    texts = []
    for _ in range(12):
        base = prose(rng, 200, 2000).split()
        texts.append(" ".join(base))
        for edits in (1, 2, 4, 6, 9):
            near = list(base)
            for _ in range(edits):
                near[rng.randrange(len(near))] = f"new{rng.randrange(10**6)}"
            texts.append(" ".join(near))
    crowd = prose(rng, 120, 2000).split()
    for _ in range(300):
        near = list(crowd)
        for _ in range(rng.randrange(5)):
            near[rng.randrange(len(near))] = f"c{rng.randrange(10**6)}"
        texts.append(" ".join(near))
    return texts + [texts[0].upper(), texts[3] + "  ", "a b c", "A B\nC", "a b c d", None, "", " ", "a b c d e f"]


def brute_links(texts):
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append(frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else None)
    classes = collections.defaultdict(list)
    for k, s in enumerate(sets):
        classes[s if s is not None else ("blank", k)].append(k)
    reps = {m[0]: s for s, m in classes.items() if not (isinstance(s, tuple) and s[0] == "blank")}
    ids = sorted(reps)
    links = collections.defaultdict(set)
    for x in ids:
        for y in ids:
            if x < y:
                shared = len(reps[x] & reps[y])
                if shared >= 0.8 * (len(reps[x]) + len(reps[y]) - shared):
                    links[x].add(y)
                    links[y].add(x)
    group = {}
    for x in ids:
        if x not in group:
            todo = [x]
            while todo:
                y = todo.pop()
                if y not in group:
                    group[y] = x
                    todo += links[y]
    out = []
    for k, s in enumerate(sets):
        rep = classes[s][0] if s is not None else k
        out.append((k, rep, len(links.get(rep, ())), group.get(rep, k), group.get(rep, k) == k))
    return out


def test_links_equal_brute_force(spark, stored):
    texts = near_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = near_duplicates.join(docs, stored).select("doc_id", "class_id", "n_links", "group_id", "kept").collect()
    assert ordered(got) == ordered(brute_links(texts))


def test_one_of_each_group_stays(spark, stored, docs, nothing):
    texts = near_texts()
    want = {k for k, _, _, _, kept in brute_links(texts) if kept}
    rows = [(k, t, 5) for k, t in enumerate(texts)]
    got = near_duplicates.one_of_each(spark.createDataFrame(rows + rows[:3], "doc_id long, text string, size int"), stored)
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(want) and got.columns == ["doc_id", "text", "size"]
    assert near_duplicates.join(docs, stored).count() == docs.count()
    assert near_duplicates.join(nothing, stored).count() == 0


def test_prefixes_shorten_until_the_recall_is_met(spark, stored):
    texts = near_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = near_duplicates.join(docs, stored, trees=3, depth=6, target_recall=0.999)
    want = {r[0]: r[2] for r in brute_links(texts)}
    found = {r["doc_id"]: r["n_links"] for r in got.collect()}
    assert all(found[k] <= want[k] for k in want)
    assert sum(found.values()) >= 0.99 * sum(want.values())


# --- mixture ------------------------------------------------------------------------------------


def brute_targets(sizes):
    names = sorted([s for s in sizes if s is not None]) + ([None] if None in sizes else [])
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(names)}
    left, goals, rest = sum(sizes.values()), {}, set(names)
    while rest:
        whole = sum(weight[s] for s in rest)
        over = [s for s in rest if left * weight[s] / whole > 3 * sizes[s]]
        if not over:
            goals |= {s: left * weight[s] / whole for s in rest}
            break
        for s in over:
            goals[s] = 3.0 * sizes[s]
        left -= sum(goals[s] for s in over)
        rest -= set(over)
    return goals


@pytest.mark.parametrize("bits", [15, 4, 1])
def test_mixture_meets_its_targets(spark, stored, docs, corpus, monkeypatch, bits):
    monkeypatch.setattr(mixture, "PLACE_BITS", bits)
    rng = random.Random(6)
    rows = list(corpus) + [(1000 + k, prose(rng, rng.randrange(1, 60)), "aa", rng.choice(["s0", "s1", "tiny"])) for k in range(400)]
    rows += [(2000, "one two", "aa", "small"), (2001, "", "aa", "void")]
    made = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(6)
    got = mixture.mix(made, stored).collect()
    again = mixture.mix(made.repartition(3), stored).collect()
    assert ordered(got) == ordered(again)
    sizes, taken, goals = collections.Counter(), collections.Counter(), {}
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        goals[r["source"]] = r["target"]
        assert r["taken"] in {r["size"] * k for k in range(4)}
    want = brute_targets(sizes)
    assert ordered((i, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t, _, _ in rows) == ordered(
        (r["doc_id"], r["size"]) for r in got
    )
    largest = {s: max(r["size"] for r in got if r["source"] == s) for s in sizes}
    for s, goal in want.items():
        assert goals[s] == pytest.approx(goal) and abs(taken[s] - goal) <= largest[s] / 2 + 1e-6


def test_mixture_in_documents(spark, stored, docs, nothing):
    out = mixture.mixed_documents(docs, stored)
    assert out.columns == [*docs.columns, "mix_epochs"] and 0 < out.count() <= docs.count()
    assert mixture.mix(nothing, stored).count() == 0
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_a_mix_can_be_mixed_again(spark, stored, docs):
    once = mixture.mixed_documents(docs, stored)
    again = mixture.mixed_documents(once.withColumn("mix_epochs", F.lit(-1)).withColumn("place", F.lit("p")), stored)
    assert again.columns == [*docs.columns, "place", "mix_epochs"]
    rows = again.collect()
    assert rows and all(r["mix_epochs"] >= 1 and r["place"] == "p" for r in rows)


@pytest.mark.parametrize("quality", [1.0, 0.4, 0.001])
def test_places_stay_fine_at_any_quality(spark, quality):
    uniform = (F.shiftrightunsigned(F.xxhash64("id"), 11).cast("double") + 0.5) / float(1 << 53)
    places = spark.range(100_000).select(mixture.place_of(-F.log(uniform) / quality).alias("place"))
    upper = places.groupBy(F.shiftright("place", mixture.PLACE_BITS).alias("b")).count().agg(F.max("count")).first()[0]
    whole = places.groupBy("place").count().agg(F.max("count")).first()[0]
    assert upper < 300 and whole <= 3


def test_keys_prefer_quality(spark, stored):
    rng = random.Random(1)
    rows = [(k, prose(rng, 30), "a") for k in range(500)] + [(500 + k, "## $$ " * 15, "a") for k in range(500)]
    rows += [(5000 + k, prose(rng, 30), "b") for k in range(10)]
    made = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = [r for r in mixture.mix(made, stored).collect() if r["source"] == "a" and r["copies"] > r["epochs"]]
    assert sum(r["doc_id"] < 500 for r in got) > sum(r["doc_id"] >= 500 for r in got) or not got


# --- decontamination ----------------------------------------------------------------------------

ITEM = "A farmer named Miller sold 12 baskets of apples at 3.50 dollars each and then bought 12 new trees. How much is left?"


def test_leaks_and_reparameterised_leaks(spark, stored):
    rng = random.Random(9)
    filler = [prose(rng, 40) for _ in range(9)]
    bench = [(7, ITEM), (8, prose(rng, 25)), (9, "too short"), (10, None), (11, ITEM.replace("12", "15"))]
    texts = {
        0: f"{filler[0]}. {ITEM} {filler[1]}",
        1: ITEM.replace("12", "77").replace("3.50", "9.25").replace("Miller", "Smith"),
        2: ITEM.replace("12 new", "99 new"),  # the two twelves of the item part: inconsistent
        3: filler[2], 4: None, 5: "",
        6: f"{filler[3]}\n{bench[1][1].upper()}\n{filler[4]}",
        7: " ".join(bench[1][1].split()[:6]),
        8: " ".join(bench[1][1].split()[:18]) + " " + filler[5],
        9: "1 2 3 4 5 6 7 8 9 10 11 12 13 14",
    }
    docs = spark.createDataFrame([(k, t, "x") for k, t in texts.items()], "doc_id long, text string, item_id string")
    benchmark = spark.createDataFrame(bench, "item_id long, text string")
    got = {r["doc_id"]: r for r in decontamination.label(docs, benchmark, stored).collect()}
    assert len(got) == len(texts)
    assert got[0]["item_ids"] == [7, 11] and got[0]["verbatim"] and got[0]["cover"] > 0.9
    assert got[1]["item_ids"] == [7, 11] and not got[1]["verbatim"]
    assert [k for k in got if got[k]["contaminated"]] and {k for k in got if got[k]["contaminated"]} == {0, 1, 6, 8}
    assert got[6]["item_ids"] == [8]
    kept = decontamination.clean(docs, benchmark, stored)
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 4, 5, 7, 9] and kept.columns == docs.columns


def test_names_do_not_depend_on_neighbours(spark, stored):
    rng = random.Random(10)
    bench = spark.createDataFrame([(7, ITEM)], "item_id long, text string")
    other = ITEM.replace("12", "77").replace("Miller", "Smith")
    rows = [(k, f"{prose(rng, 20)} \u0130 \u1e9e \u212a {prose(rng, 5)}") for k in range(6)] + [(50, other), (51, f"\u0130. {other}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for n in (1, 4):
        got = decontamination.label(docs.repartition(n), bench, stored).where("contaminated").collect()
        assert sorted(r["doc_id"] for r in got) == [50, 51]


def test_slots_are_judged_by_window_and_copies_are_found(spark, stored):
    rng = random.Random(14)
    half = [prose(rng, 40), prose(rng, 40)]
    long = f"{half[0]} costs 12 and {half[1]} takes 12 more"
    pair = "the boat with red sails carries 4 men while the other boat carries 9 women to the shore"
    items = {1: long, 2: pair, 3: "12 kg 15 m 8 s", 4: "Berlin or Rome", 5: "Which river runs through old Vienna today?",
             6: "Then Anna met Karl and Maria met Otto in Paris near Lyon"}
    texts = {
        1: long.replace("takes 12", "takes 13"),
        2: pair.replace("4", "6").replace("9", "6"),
        3: f"{half[0]}, 12 kg 15 m 8 s, and so on",
        4: "is it berlin or rome",
        5: "he asked: so Which river runs through old Vienna today? and left",
        6: f"{half[1]} {items[6].lower()}",
        7: items[6].replace(" and", "\nand").replace(" in ", "\nin ").replace("Anna ", "Anna\n").replace("Karl", "\nKarl"),
        10: "12 kg 15 m 9 s", 11: "berlin or paris", 12: "which river runs through old",
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = {r["doc_id"]: r["item_ids"] for r in decontamination.label(docs, bench, stored).collect()}
    assert got == {1: [1], 2: [2], 3: [3], 4: [4], 5: [5], 6: [6], 7: [6], 10: [], 11: [], 12: []}


def test_items_of_a_word_or_two_mark_nothing(spark, stored):
    items = ["the", "Yes", "four", "New York", "12", "", "Berlin or Rome", "巴黎是法国的首都而且很大"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    texts = ["I went to Paris yes", "the answer is four", "New York, the 12", "is it Berlin or Rome then", "巴黎是法国的首都而且很大"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["item_ids"] for r in decontamination.label(docs, bench, stored).collect()}
    assert got == {0: [], 1: [], 2: [], 3: [6], 4: [7]}


def test_the_window_filter_changes_nothing(spark, stored, docs, nothing, monkeypatch):
    benchmark = spark.createDataFrame([(k, r["text"]) for k, r in enumerate(docs.where("length(text) > 300").collect()[:6])],
                                      "item_id long, text string")
    first = decontamination.label(docs, benchmark, stored).collect()
    monkeypatch.setattr(decontamination, "FILTER_WINDOWS", 0)
    assert ordered(first) == ordered(decontamination.label(docs, benchmark, stored).collect())
    assert any(r["contaminated"] for r in first)
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.clean(docs, empty, stored).count() == docs.count()
    assert decontamination.label(nothing, benchmark, stored).count() == 0


# --- language model -----------------------------------------------------------------------------


def brute_unigrams(rows):
    def cut(t):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]

    def held(i):
        return i is not None and zlib.crc32(str(i).encode()) % 7 == 2

    c = collections.Counter(w for i, t in rows if not held(i) for w in cut(t))
    n, v = sum(c.values()), len(c)
    out = []
    for i, t in rows:
        words = cut(t)
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words)
        out.append((i, held(i), len(words), sum(c[w] > 0 for w in words), n, round(base, 6)))
    return out


@pytest.mark.parametrize("frequent", [language_model.FREQUENT, 40])
def test_base_scores_equal_brute_force(docs, corpus, stored, monkeypatch, frequent):
    monkeypatch.setattr(language_model, "FREQUENT", frequent)
    got = [
        (r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6))
        for r in language_model.score(docs, stored).collect()
    ]
    assert ordered(got) == ordered(brute_unigrams([(i, t) for i, t, _, _ in corpus]))


def test_probabilities_sum_to_one():
    import numpy as np

    rng = np.random.default_rng(0)
    share = rng.dirichlet(np.ones(50))
    trainer = language_model.Trainer(share, 1)
    index = rng.integers(0, 50, 20_000)
    trainer.learn(index, np.array([0]), 3)
    tables = language_model.Tables(trainer.model)
    far, near = np.meshgrid(np.arange(50), np.arange(50))
    total = sum(np.exp(tables.log_probability(far.ravel(), near.ravel(), np.full(2500, w))) for w in range(50))
    assert np.allclose(total, 1, atol=1e-4)


def test_the_model_learns_word_order(spark, stored):
    rng = random.Random(12)
    follow = {k: rng.sample(range(60), 3) for k in range(60)}
    rows = []
    for k in range(1500):
        w, words = rng.randrange(60), []
        for _ in range(60):
            words.append(f"t{w}")
            w = rng.choice(follow[w])
        rows.append((k, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    held = language_model.score(docs, stored).where("held_out").agg({"score": "sum", "base_score": "sum", "n_tokens": "sum"}).first()
    gain = (held["sum(score)"] - held["sum(base_score)"]) / held["sum(n_tokens)"]
    assert gain > 0.25


def test_scores_do_not_depend_on_the_layout(spark, stored, monkeypatch):
    monkeypatch.setattr(language_model, "PART_TOKENS", 8192)
    rng = random.Random(15)
    rows = []
    for k in range(600):
        w = rng.randrange(60)
        rows.append((k, " ".join(f"t{(w + 7 * j + rng.randrange(2)) % 60}" for j in range(60))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    one, many = (
        {r["doc_id"]: (r["score"], r["base_score"], r["n_tokens"]) for r in language_model.score(docs.repartition(n), stored).collect()}
        for n in (2, 64)
    )
    assert max(abs(one[k][0] - many[k][0]) for k in one) < 0.01
    assert sum(s - b for s, b, _ in many.values()) / sum(n for _, _, n in many.values()) > 0.1


def test_the_gain_rises_with_the_corpus(spark, stored, monkeypatch):
    monkeypatch.setattr(language_model, "PART_TOKENS", 1 << 14)
    rng = random.Random(5)
    kinds = {end: [f"{rng.randrange(10**6)}{end}" for _ in range(4000)] for end in ("ung", "ment", "ido")}
    rows = []
    for k in range(2400):
        words = kinds[rng.choice(list(kinds))]
        rows.append((k, " ".join(rng.choice(words) for _ in range(60))))
    gains = []
    for n in (100, 2400):
        docs = spark.createDataFrame(rows[:n], "doc_id long, text string").repartition(3)
        held = language_model.score(docs, stored).where("held_out").agg({"score": "sum", "base_score": "sum", "n_tokens": "sum"}).first()
        gains.append((held["sum(score)"] - held["sum(base_score)"]) / held["sum(n_tokens)"])
    # Most words are rare: what is learnt about them comes from their endings.
    assert gains[1] > gains[0] and gains[1] > 0.2


def test_a_training_step_works_on_the_symbols_of_its_batch(monkeypatch):
    import numpy as np

    rng = np.random.default_rng(3)
    share = rng.dirichlet(np.ones(2048))
    trainer = language_model.Trainer(share, 1)
    far, near, word = rng.integers(0, 40, (3, 700))
    noise = np.searchsorted(trainer.cumulative, np.random.default_rng((language_model.SEED, 1)).random(language_model.NOISE))
    before, squares = [x.astype(float) for x in trainer.model.arrays()], [s.astype(float) for s in trainer.squares]
    sums, gathered = [], language_model._gathered
    monkeypatch.setattr(language_model, "_gathered", lambda *args: sums.append(gathered(*args)) or sums[-1])
    trainer.step(far, near, word)
    own = len({*far, *near, *word, *noise})
    assert len(sums) == 3 and all(x is not None and len(x) == own < 110 for x in sums)

    # The same step, written plainly over all symbols.
    context, target, w_near, w_far, bias = before
    h = context[near] * w_near + context[far] * w_far
    logit = lambda words, scores: scores + bias[words] - np.log(language_model.NOISE * share[words])
    up = (1 / (1 + np.exp(-logit(word, (h * target[word]).sum(axis=1)))) - 1) / np.sqrt(700)
    down = 1 / (1 + np.exp(-logit(noise, h @ target[noise].T))) / np.sqrt(700)
    dh = up[:, None] * target[word] + down @ target[noise]
    grads = [np.zeros_like(x) for x in before]
    np.add.at(grads[0], near, dh * w_near)
    np.add.at(grads[0], far, dh * w_far)
    np.add.at(grads[1], word, up[:, None] * h)
    np.add.at(grads[1], noise, down.T @ h)
    grads[2][:], grads[3][:] = (dh * context[near]).sum(axis=0), (dh * context[far]).sum(axis=0)
    np.add.at(grads[4], word, up)
    np.add.at(grads[4], noise, down.sum(axis=0))
    for x, old, g, s in zip(trainer.model.arrays(), before, grads, squares, strict=True):
        assert np.allclose(x, old - language_model.RATE * g / np.sqrt(s + g * g), atol=1e-5)


def test_words_are_looked_up_without_a_search(monkeypatch):
    import numpy as np

    rng = np.random.default_rng(8)
    top = 1 << 64
    for n in (1, 2, 3000):
        words = np.unique(np.concatenate([[language_model.END], rng.integers(0, top, n - 1, dtype=np.uint64)]))
        if n == 3000:  # words of one upper part, and the least and the greatest of all
            words = np.unique(np.concatenate([words, np.arange(50, dtype=np.uint64), np.uint64(top - 1) - np.arange(50, dtype=np.uint64)]))
        counts = rng.integers(1, 9, len(words))
        classes = np.zeros((2, language_model.CLASSES), dtype=np.int64)
        own = (words % np.uint64(language_model.CLASSES)).astype(int)
        np.add.at(classes[0], own, counts)
        np.add.at(classes[1], own, 1)
        lexicon = language_model.Lexicon(words, counts, tuple(classes))
        asked = np.concatenate([words, words + np.uint64(1), words - np.uint64(1), rng.integers(0, top, 500, dtype=np.uint64)])
        known = {int(w): (int(i), int(c)) for w, i, c in zip(lexicon.words, lexicon.index, lexicon.counts, strict=True)}
        with monkeypatch.context() as patched:
            patched.setattr(np, "searchsorted", None)
            index, found = lexicon.look(asked)
        expected = [known.get(int(w), (int(w) % language_model.CLASSES, -1)) for w in asked]
        assert [*zip(index.tolist(), found.tolist(), strict=True)] == expected


def test_rare_words_are_counted_by_text():
    import numpy as np

    words, text = np.array([9, 4, 9, 4, 4, 7, 2**63], dtype=np.uint64), np.array([1, 1, 1, 2, 2, 4, 4])
    found, times, edges = language_model._counted_by_text(words, text, 6)
    assert found.tolist() == [4, 9, 4, 7, 2**63] and times.tolist() == [1, 2, 2, 1, 1] and edges.tolist() == [0, 0, 2, 3, 3, 5, 5]
    none = language_model._counted_by_text(words[:0], text[:0], 2)
    assert [x.tolist() for x in none] == [[], [], [0, 0, 0]]


def test_frequent_words_of_one_count(spark, monkeypatch):
    monkeypatch.setattr(language_model, "FREQUENT", 1000)
    end = int(language_model.END.view("int64"))
    counts = spark.createDataFrame([(k * 7919, 5) for k in range(1, 6000)] + [(end, 900)], "word long, c long")
    found = language_model.frequent_words(counts).collect()
    assert 700 < len(found) <= 1001 and end in {r["word"] for r in found}


def test_the_model_without_training_texts(spark, nothing, stored):
    held = [k for k in range(60) if zlib.crc32(str(k).encode()) % 7 == 2]
    docs = spark.createDataFrame([(k, "a b c") for k in held], "doc_id long, text string")
    assert all(r["score"] == 0 and r["n_known"] == 0 and r["n_tokens"] == 4 for r in language_model.score(docs, stored).collect())
    assert language_model.score(nothing, stored).count() == 0


def test_every_place_key_has_its_own_partition(spark):
    for n in (1, 7, 51):
        keys = language_model.place_keys(spark, n)
        placed = spark.createDataFrame([(k,) for k in keys], "place int").repartition(n, "place")
        assert len(set(keys)) == n == placed.select(F.spark_partition_id()).distinct().count()
