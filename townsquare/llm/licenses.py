"""License scan by a positional rare-token index.

Each template is posted under the word of its key phrase with the highest inverse document
frequency, over the whole corpus. Every place of such a word in a document, however many
there are, is looked up; where the key phrase stands around it, the template is aligned
from there to both sides, and the words found in order near their places are its score.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from townsquare.llm.common import ALNUM, U64, Stored, as_text, encoded, map_rows, run_hashes, word_runs

#: Fixed phrases: every place counts, whatever stands around it.
BASE = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}
#: Fixed notices, in long and short forms: label, text, key phrases; the first one anchors the form.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0 you may not use this file except in compliance with"
     " the license", ("apache license",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that"
     " the following conditions are met", ("binary forms",)),
    ("cc-attribution", "this work is licensed under a creative commons attribution license", ("creative commons attribution",)),
    ("gnu-agpl", "licensed under the gnu affero general public license version 3", ("affero general public license",)),
    ("gnu-gpl", "this work is licensed under the gnu general public license version 3", ("gnu general public license",)),
    ("gnu-lgpl", "licensed under the gnu lesser general public license version 2 1", ("lesser general public license",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby"
     " granted", ("hereby granted",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
     " documentation files", ("hereby granted free", "associated documentation files")),
    ("mpl", "this source code form is subject to the terms of the mozilla public license version 2 0", ("mozilla public license",)),
    ("proprietary", "all rights reserved no part of this publication may be reproduced distributed or transmitted in any"
     " form", ("rights reserved no part", "reproduced distributed")),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software",)),
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in"
     " compliance with the license", ("apache license version 2 0",)),
    ("boost", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software"
     " and accompanying documentation covered by this license", ("organization obtaining", "accompanying documentation covered")),
    ("cc0", "the person who associated a work with this deed has dedicated the work to the public domain by waiving all of"
     " his or her rights to the work worldwide under copyright law", ("public domain by waiving", "copyright law")),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license",
     ("eclipse public license", "accompanying materials")),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held"
     " liable for any damages arising from the use of this software", ("event will", "authors be held liable")),
)
#: Fixed names: the lines by which a text declares, or only mentions, a licence.
NAMES = {
    "apache-2.0": ("apache license version 2 0", "apache license 2 0", "apache 2 0 license", "identifier apache 2 0"),
    "boost": ("boost software license", "identifier bsl 1 0"),
    "bsd": ("bsd license", "bsd 2 clause", "bsd 3 clause", "2 clause bsd", "3 clause bsd"),
    "cc-attribution": ("creative commons attribution",),
    "cc-attribution-nc": ("creative commons attribution noncommercial", "creative commons attribution non commercial", "cc by nc"),
    "cc-attribution-nc-nd": ("creative commons attribution noncommercial noderivatives", "cc by nc nd"),
    "cc-attribution-nc-sa": ("creative commons attribution noncommercial sharealike", "cc by nc sa"),
    "cc-attribution-nd": ("creative commons attribution noderivatives", "creative commons attribution noderivs", "cc by nd"),
    "cc-attribution-sa": ("creative commons attribution sharealike", "creative commons attribution share alike", "cc by sa"),
    "cc0": ("cc0 1 0", "cc0 license", "identifier cc0 1 0"),
    "epl": ("eclipse public license", "identifier epl 2 0"),
    "gnu-agpl": ("gnu affero general public license", "identifier agpl 3 0", "agplv3"),
    "gnu-gpl": ("gnu general public license", "gnu gpl", "identifier gpl 2 0", "identifier gpl 3 0", "gplv2", "gplv3"),
    "gnu-lgpl": ("gnu lesser general public license", "gnu lgpl", "identifier lgpl 2 1", "identifier lgpl 3 0", "lgplv2", "lgplv3"),
    "isc": ("isc license", "identifier isc"),
    "mit": ("mit license", "identifier mit"),
    "mpl": ("mozilla public license", "identifier mpl 2 0"),
    "unlicense": ("unlicense license", "unlicense org", "identifier unlicense"),
    "zlib": ("zlib license", "identifier zlib"),
}
#: Notices come first, then a form for every name.
FORMS = (*TEMPLATES, *((label, name, (name,)) for label, names in NAMES.items() for name in names))
#: A name within so many words behind one of these is declared, any other one is mentioned.
GRANTS = frozenset("licensed released distributed available published provided identifier".split())
GRANT_WORDS = 6
#: Scores of names, below that of a whole notice.
DECLARED, MENTIONED = 0.95, 0.5
#: Words too common to be looked up; base phrases keep theirs, key phrases have none.
COMMON = frozenset("a and any are for in into is of or that the this to use under with you".split())
#: A candidate needs this share of the weight of its template's words, in order and near their places.
MIN_SCORE = 0.6
#: Words by which a word may be shifted against its anchor, beside a quarter of its distance.
SLACK = 3
GROUP_CHARS = 1 << 17


class Index:
    """Licence words by hash, the words of the templates and of their key phrases, with places."""

    def __init__(self) -> None:
        if any(COMMON & set(phrase.split()) for form in FORMS for phrase in form[2]):
            raise ValueError("a key phrase holds a word that is not looked up")
        words = {w for form in FORMS for w in form[1].split()} - COMMON | GRANTS
        words |= {w for phrase in BASE.values() for w in phrase.split()}
        self.words = sorted(words)
        self.number = {w: k for k, w in enumerate(self.words)}
        self.parts: list[list[tuple[int, int]]] = []
        self.keys: list[list[list[tuple[int, int]]]] = []
        for t, (_, text, phrases) in enumerate(FORMS):
            parts = text.split()
            self.parts.append([(self.number[w], k) for k, w in enumerate(parts) if w in self.number])
            self.keys.append([])
            for phrase in phrases:
                look = phrase.split()
                at = next(k for k in range(len(parts)) if parts[k : k + len(look)] == look)
                self.keys[t].append([(self.number[w], at + k) for k, w in enumerate(look) if w in self.number])
        self.grants = {self.number[w] for w in GRANTS}
        self.base = {label: [self.number[w] for w in phrase.split()] for label, phrase in BASE.items()}
        codes = np.array([_code(w) for w in self.words], dtype=U64)
        order = np.argsort(codes)
        self.codes, self.order = codes[order], order
        self.table = np.zeros(1 << 16, dtype=bool)
        self.table[self.codes >> U64(48)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of licence words among word hashes, and their numbers."""
        maybe = np.flatnonzero(self.table[h >> U64(48)])
        at = np.minimum(np.searchsorted(self.codes, h[maybe]), len(self.codes) - 1)
        found = self.codes[at] == h[maybe]
        return maybe[found], self.order[at[found]]


def _code(word: str) -> np.ndarray:
    data = np.frombuffer(word.encode(), dtype=np.uint8)
    return run_hashes(data, np.array([0]), np.array([len(data)]))[0]


_INDEX: list[Index] = []


def index() -> Index:
    if not _INDEX:
        _INDEX.append(Index())
    return _INDEX[0]


def occurrences(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, n_words, words, places): the licence words of each document."""

    def run(ids, texts):
        ix = index()
        n_words, words, places = [], [], []
        for start, stop in _groups(texts):
            data = [encoded(as_text(t)).lower() for t in texts[start:stop]]
            view = np.frombuffer(b"\n".join(data), dtype=np.uint8)
            starts, ends = word_runs(view, ALNUM)
            place, number = ix.find(run_hashes(view, starts, ends))
            edges = np.searchsorted(starts, np.cumsum([0] + [len(d) + 1 for d in data]))
            cuts = np.searchsorted(place, edges)
            for k in range(stop - start):
                n_words.append(int(edges[k + 1] - edges[k]))
                words.append(number[cuts[k] : cuts[k + 1]].astype(np.int32))
                places.append((place[cuts[k] : cuts[k + 1]] - edges[k]).astype(np.int32))
        ints = pa.list_(pa.int32())
        return {
            "doc_id": pa.array(ids, pa.int64()), "n_words": pa.array(n_words, pa.int64()),
            "words": pa.array(words, ints), "places": pa.array(places, ints),
        }

    slim = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return map_rows(slim, ["doc_id", "text"], run, "doc_id bigint, n_words bigint, words array<int>, places array<int>")


def _groups(texts: list[str | None]):
    start, size = 0, 0
    for k, text in enumerate(texts):
        n = len(text or "")
        if k > start and size + n > GROUP_CHARS:
            yield start, k
            start, size = k, 0
        size += n
    if texts:
        yield start, len(texts)


def base_places(words: list[int], places: list[int]) -> tuple[list[int], set[str]]:
    """Starts of all base phrases, and their labels."""
    at = dict(zip(places, words, strict=True))
    starts, labels = [], set()
    for place, word in at.items():
        for label, phrase in index().base.items():
            if word == phrase[0] and all(at.get(place + k) == w for k, w in enumerate(phrase)):
                starts.append(place)
                labels.add(label)
    return starts, labels


class Lookup:
    """The templates by the rarest word of their first key phrase."""

    def __init__(self, idf: dict[int, float]) -> None:
        ix = index()
        self.idf = idf
        self.postings: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for t, phrases in enumerate(ix.keys):
            word, there = max(phrases[0], key=lambda x: (idf.get(x[0], float("inf")), -x[0]))
            self.postings[word].append((t, there))
        self.entry = np.zeros(len(ix.words), dtype=bool)
        self.entry[list(self.postings)] = True


def _aligned(parts: list[tuple[int, int]], at: dict[int, int], shift: int, anchor: range, idf: dict[int, float]) -> float:
    """Weight of the words found in order, going left and right from the anchor.

    A word may stand SLACK and a quarter of its distance from the anchor beside its place: the
    best common subsequence of template and document within that band.
    """
    total = sum(idf.get(w, 0.0) for w, k in parts if k in anchor and at.get(shift + k) == w)
    for side in (-1, 1):
        edge = anchor.start if side < 0 else anchor.stop - 1
        # Best weight of an alignment that ends at a distance in the document, in rising order.
        best: dict[int, float] = {0: 0.0}
        for w, k in sorted(((w, (k - edge) * side) for w, k in parts if (k - edge) * side > 0), key=lambda x: x[1]):
            slack = SLACK + k // 4
            new = {}
            for d in range(max(1, k - slack), k + slack + 1):
                if at.get(shift + edge + side * d) == w:
                    new[d] = max(v for e, v in best.items() if e < d) + idf.get(w, 0.0)
            for d, v in new.items():
                best[d] = max(best.get(d, 0.0), v)
        total += max(best.values())
    return total


def templates_in(words: list[int], places: list[int], lookup: Lookup) -> dict[str, float]:
    """Labels of the forms found, each with its best score.

    Of names that begin at one place the longest counts, and a notice whose key phrase is the
    beginning of another licence's name does not: an attribution licence with a condition is
    not the plain one.
    """
    ix, idf = index(), lookup.idf
    hits = np.flatnonzero(lookup.entry[np.asarray(words)])
    found: dict[str, float] = {}
    if not len(hits):
        return found
    at = dict(zip(places, words, strict=True))
    names: dict[int, tuple[int, str]] = {}
    for hit in hits:
        for form, there in lookup.postings[words[hit]]:
            shift = places[hit] - there
            first = ix.keys[form][0]
            if form >= len(TEMPLATES) and all(at.get(shift + k) == w for w, k in first):
                names[shift] = max(names.get(shift, (0, "")), (shift + len(first), FORMS[form][0]))
    for start, (_, label) in names.items():
        declared = any(at.get(place) in ix.grants for place in range(start - GRANT_WORDS, start + 1))
        found[label] = max(found.get(label, 0.0), DECLARED if declared else MENTIONED)
    for hit in hits:
        for template, there in lookup.postings[words[hit]]:
            if template >= len(TEMPLATES):
                continue
            shift = places[hit] - there
            first, *others = ix.keys[template]
            label, text, phrases = TEMPLATES[template]
            if found.get(label) == 1.0 or not all(at.get(shift + k) == w for w, k in first):
                continue
            stop, name = names.get(shift + first[0][1], (0, label))
            if name != label and stop > shift + first[-1][1] + 1:
                continue
            drift = SLACK + len(text.split()) // 4
            if not all(
                any(all(at.get(shift + move + k) == w for w, k in phrase) for move in range(-drift, drift + 1))
                for phrase in others
            ):
                continue
            whole = sum(idf.get(w, 0.0) for w, _ in ix.parts[template])
            anchor = range(min(k for _, k in first), max(k for _, k in first) + 1)
            value = _aligned(ix.parts[template], at, shift, anchor, idf) / whole if whole else 0.0
            if value >= MIN_SCORE:
                found[label] = max(found.get(label, 0.0), 1.0 if value > 1 - 1e-9 else value)
    return found


def scan(docs: DataFrame, stored: Stored) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``score`` is 1 where a base phrase stands, else that of the best form, else 0: up to 1 for a
    notice, DECLARED for a name behind a word of granting, MENTIONED for any other name. Null
    and empty texts have no words. Rows are independent but for the word frequencies: ids
    may be null or repeat, other columns are ignored, an empty table gives an empty result.
    """
    found = stored.put(occurrences(docs))
    documents = found.count()
    frequency = found.select(F.explode(F.array_distinct("words")).alias("w")).groupBy("w").count().collect()
    idf = {r["w"]: float(np.log((1 + documents) / (1 + r["count"]))) + 1e-9 for r in frequency}

    lookup = Lookup(idf)

    def run(ids, n_words, words, places):
        out = []
        for w, p in zip(words, places, strict=True):
            starts, base = base_places(w, p) if w else ([], set())
            more = templates_in(w, p, lookup) if w else {}
            out.append((
                len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
                ",".join(sorted(base | set(more))), 1.0 if base else max(more.values(), default=0.0),
            ))
        n_base, first, last, base_labels, labels, score = zip(*out, strict=True)
        return {
            "doc_id": pa.array(ids, pa.int64()), "n_words": pa.array(n_words, pa.int64()),
            "n_base": pa.array(n_base, pa.int64()), "first_word": pa.array(first, pa.int64()),
            "last_word": pa.array(last, pa.int64()), "base_labels": list(base_labels), "labels": list(labels),
            "score": pa.array(score, pa.float64()),
        }

    schema = (
        "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string,"
        " labels string, score double"
    )
    return map_rows(found, ["doc_id", "n_words", "words", "places"], run, schema)
