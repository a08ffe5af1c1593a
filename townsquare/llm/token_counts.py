"""Token counts by overlap resynchronisation.

Huge documents are encoded in overlapping chunks with offsets. Two chunks are spliced behind a
token that both encodings hold at the same place. That is proven stable: merges of this kind
of tokenizer give a sequence exactly if they give each two neighbours in it, and here every
two neighbours stand side by side in one of the encodings; a token at the end of a word has
another id than one inside, so both agree on the words too. If an overlap holds no such
token it is widened, and if a whole chunk holds none the chunks grow. Shorter documents fall
apart at white space; their distinct words are encoded once a worker.
"""

from __future__ import annotations

import os
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from townsquare.llm.common import SPACED, U64, as_text, encoded, map_rows, run_hashes, word_runs

TOKENIZER = "word_bpe_49k.json"
LIMIT = 2048
#: From so many characters on a document is encoded in chunks.
HUGE_CHARS = 1 << 16
CHUNK_CHARS = 1 << 14
OVERLAP_CHARS = 256
#: Characters between a splice and the end of an overlap: more than any special string or contraction has.
MARGIN_CHARS = 32
GROUP_CHARS = 1 << 19
#: Words whose counts a worker remembers.
KNOWN_WORDS = 1_000_000

_LOADED: dict[str, Counter] = {}


class Counter:
    """A tokenizer with the counts of the words it has met."""

    def __init__(self, name: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.forget()

    def forget(self) -> None:
        self.words, self.counts = np.empty(0, dtype=U64), np.empty(0, dtype=np.int64)

    def encode(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def of_words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Tokens of each word."""
        distinct, first, inverse = np.unique(run_hashes(data, starts, ends), return_index=True, return_inverse=True)
        at = np.searchsorted(self.words, distinct)
        at[at == len(self.words)] = 0
        new = self.words[at] != distinct if len(self.words) else np.ones(len(distinct), dtype=bool)
        counts = np.zeros(len(distinct), dtype=np.int64)
        if len(self.words):
            counts[~new] = self.counts[at[~new]]
        if new.any():
            texts = [bytes(data[starts[i] : ends[i]]).decode("utf-8", "replace") for i in first[new]]
            counts[new] = self.encode(texts)
            if len(self.words) + len(texts) > KNOWN_WORDS:
                self.forget()
            words = np.concatenate([self.words, distinct[new]])
            order = np.argsort(words)
            self.words, self.counts = words[order], np.concatenate([self.counts, counts[new]])[order]
        return counts[inverse]

    def of_texts(self, texts: list[str]) -> list[int]:
        """Tokens of each text, by its words."""
        data = [encoded(t) for t in texts]
        view = np.frombuffer(b"\n".join(data), dtype=np.uint8)
        starts, ends = word_runs(view, SPACED)
        sums = np.concatenate([[0], np.cumsum(self.of_words(view, starts, ends))]) if len(starts) else np.zeros(1, np.int64)
        edges = np.searchsorted(starts, np.cumsum([0] + [len(d) + 1 for d in data]))
        return (sums[edges[1:]] - sums[edges[:-1]]).tolist()

    def _tokens(self, text: str, begin: int, end: int) -> np.ndarray:
        """Rows (id, start, end) of the tokens of a part, placed in the whole text."""
        found = self.tokenizer.encode(text[begin:end], add_special_tokens=False)
        out = np.empty((len(found.ids), 3), dtype=np.int64)
        out[:, 0] = found.ids
        out[:, 1:] = np.array(found.offsets, dtype=np.int64).reshape(-1, 2) + begin
        return out

    def of_huge(self, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> int:
        """Tokens of one text by overlapping chunks, larger ones where these cannot be aligned."""
        while True:
            total = self._spliced(text, chunk, overlap)
            if total is not None:
                return total
            chunk, overlap = 2 * chunk, 2 * overlap

    def _spliced(self, text: str, chunk: int, overlap: int) -> int | None:
        total, from_here, end = 0, 0, min(len(text), chunk)
        own = self._tokens(text, 0, end)
        while end < len(text):
            width = overlap
            while True:
                begin = max(from_here, end - width)
                next_end = min(len(text), max(end + chunk - overlap, end + width))
                following = self._tokens(text, begin, next_end)
                splice = self._stable(text, own, following, begin, end)
                if splice is not None:
                    break
                if begin == from_here:
                    return None
                width *= 2
            total += int(((own[:, 1] >= from_here) & (own[:, 1] < splice)).sum())
            from_here, end, own = splice, next_end, following
        return total + int((own[:, 1] >= from_here).sum())

    @staticmethod
    def _stable(text: str, left: np.ndarray, right: np.ndarray, begin: int, end: int) -> int | None:
        """The last place behind a token of both encodings, well inside the part that both have read."""
        left = left[np.searchsorted(left[:, 1], begin) :]
        right = right[: np.searchsorted(right[:, 1], end)]
        both = set(map(tuple, left.tolist())) & set(map(tuple, right.tolist()))
        for place in sorted({stop for _, start, stop in both if start > begin}, reverse=True):
            if not begin + MARGIN_CHARS <= place <= end - MARGIN_CHARS or _composes(text, place):
                continue
            # No token, as one that holds part of a character, may reach over the place.
            if all((x[x[:, 1] < place, 2] <= place).all() for x in (left, right)):
                return place
        return None


def _composes(text: str, place: int) -> bool:
    """Whether a character may be joined with those before it when the text is normalised."""
    pair = text[place - 1 : place + 1]
    parts = (unicodedata.normalize("NFC", c) for c in pair)
    return unicodedata.combining(pair[-1]) != 0 or unicodedata.normalize("NFC", pair) != "".join(parts)


def _groups(texts: list[str]) -> Iterator[list[int]]:
    rows, size = [], 0
    for row, text in enumerate(texts):
        if len(text) >= HUGE_CHARS:
            continue
        if rows and size + len(text) > GROUP_CHARS:
            yield rows
            rows, size = [], 0
        rows.append(row)
        size += len(text)
    if rows:
        yield rows


def count(docs: DataFrame, tokenizer: str = TOKENIZER, limit: int = LIMIT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit.

    Counts are those of the library over the whole text, without special tokens. Null and
    empty texts have none. Rows are independent: ids may be null or repeat, other columns
    are ignored, an empty table gives an empty result.
    """

    def run(ids, texts):
        counter = _LOADED.get(tokenizer) or _LOADED.setdefault(tokenizer, Counter(tokenizer))
        texts = [as_text(t) for t in texts]
        tokens = [0] * len(texts)
        for rows in _groups(texts):
            for row, n in zip(rows, counter.of_texts([texts[r] for r in rows]), strict=True):
                tokens[row] = n
        for row, text in enumerate(texts):
            if len(text) >= HUGE_CHARS:
                tokens[row] = counter.of_huge(text)
        return {
            "doc_id": pa.array(ids, pa.int64()),
            "n_bytes": pa.array([len(encoded(t)) for t in texts], pa.int64()),
            "n_tokens": pa.array(tokens, pa.int64()),
            "over_limit": [n > limit for n in tokens],
        }

    slim = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return map_rows(slim, ["doc_id", "text"], run, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")
