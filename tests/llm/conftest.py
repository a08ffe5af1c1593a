import random

import pytest

from townsquare.llm.common import Stored

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, key string, block string"


def prose(rng, words, vocabulary=300):
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(words))


@pytest.fixture
def stored(spark):
    with Stored(spark) as tables:
        yield tables
    tables.drop_all()


@pytest.fixture(scope="session")
def corpus():
    """Ids, texts, languages and sources with nulls, ties, copies, long and odd texts."""
    rng = random.Random(11)
    shared = prose(rng, 70)
    rows = []
    for k in range(60):
        text = prose(rng, rng.choice([3, 60, 150]))
        if k % 7 == 0:
            text = f"{prose(rng, 20)} {shared} {prose(rng, 20)}"
        rows.append((k, text, "aa" if k % 2 else "bb", f"s{k % 3}"))
    rows += [(100 + k, rows[1][1], "aa", "s1") for k in range(4)]
    rows += [(110, None, "aa", "s0"), (111, "", None, "s0"), (112, " \n\t ", "bb", None), (None, "no id at all", None, None)]
    rows += [(None, "no id at all", None, None), (113, "x", "aa", "s0"), (114, "é" * 150 + " ü", "bb", "s2")]
    rows += [(115, "a" * 900, "aa", "s0"), (116, "ab " * 400, "bb", None), (117, prose(rng, 30_000, 50_000), "aa", "s9")]
    rows += [(118, "line one here\nline one here\n\n12 3\n" * 30, "aa", "s0"), (119, "\U0001f600 𝔘𝔫𝔦 ß İ", "bb", "s2")]
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """The corpus with clashing extra columns, over several partitions."""
    rows = [(i, t, g, s, len(t or ""), 7, "k", "b") for i, t, g, s in corpus]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
