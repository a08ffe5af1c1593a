"""What the text operators share: table access, word hashes, Arrow batches, graph components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from townsquare.runtime import drop_intermediate, read_intermediate, write_intermediate

#: Texts handed to Python at a time; bounds a worker's memory when texts are long.
ARROW_ROWS = 512

U64 = np.uint64
_MIX_A = U64(0x9E3779B97F4A7C15)
_MIX_B = U64(0xC2B2AE3D27D4EB4F)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small unless the session says otherwise."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, None) in (None, "10000"):
        spark.conf.set(key, str(ARROW_ROWS))


class Stored:
    """Tables written along the way, dropped once later tables replace them."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: dict[int, str] = {}

    def put(self, df: DataFrame) -> DataFrame:
        path = write_intermediate(df)
        stored = read_intermediate(self.spark, path, df.schema)
        self.paths[id(stored)] = path
        self._keep = [*getattr(self, "_keep", []), stored]
        return stored

    def drop(self, *frames: DataFrame) -> None:
        for frame in frames:
            path = self.paths.pop(id(frame), None)
            if path:
                drop_intermediate(self.spark, path)

    def drop_all(self) -> None:
        for path in self.paths.values():
            drop_intermediate(self.spark, path)
        self.paths.clear()

    def __enter__(self) -> Stored:
        return self

    def __exit__(self, kind, *_) -> None:
        if kind is not None:
            self.drop_all()


def map_rows(df: DataFrame, columns: list[str], function: Callable, schema: str) -> DataFrame:
    """Apply ``function(*lists) -> dict of columns`` to Arrow batches of the named columns."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ARROW_ROWS):
                part = batch.slice(start, ARROW_ROWS)
                out = function(*(part.column(i).to_pylist() for i in range(part.num_columns)))
                if out is not None:
                    yield pa.RecordBatch.from_pydict(out)

    return df.select(*columns).mapInArrow(run, schema)


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Order-dependent 64-bit combination of two hash arrays."""
    x = (a * _MIX_A) ^ (b + (a >> U64(31)))
    x = x * _MIX_B
    return x ^ (x >> U64(29))


def windows(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every ``n`` consecutive entries of ``h``."""
    if len(h) < n:
        return h[:0]
    m = len(h) - n + 1
    out = h[:m]
    for k in range(1, n):
        out = mix(out, h[k : k + m])
    return out


def byte_table(*kept: tuple[int, int]) -> np.ndarray:
    """A table over byte values: which belong to words, given as inclusive ranges."""
    table = np.zeros(256, dtype=bool)
    for low, high in kept:
        table[low : high + 1] = True
    return table


#: Words parted by ASCII white space, and words of ASCII letters, digits and all else beyond ASCII.
SPACED = byte_table((0, 8), (14, 31), (33, 255))
ALNUM = byte_table((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 255))

_HASH_BYTES = 1 << 18
_BYTE_CODES = np.random.default_rng(20240502).integers(1, 1 << 63, 256, dtype=np.uint64)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    if len(_POWERS.get("up", ())) <= n:
        base = 0x9E3779B97F4A7C15 | 1
        for name, value in (("up", base), ("down", pow(base, -1, 1 << 64))):
            _POWERS[name] = np.concatenate([[U64(1)], np.cumprod(np.full(max(n, _HASH_BYTES), value, dtype=U64))])
    return _POWERS["up"], _POWERS["down"]


def word_runs(data: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes that ``table`` marks."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = table[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[0::2], edges[1::2]


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``data[starts:ends]``, equal wherever the bytes are equal.

    Polynomial prefix sums, so all words are hashed together; long texts go in pieces.
    """
    out = np.empty(len(starts), dtype=U64)
    first = 0
    while first < len(starts):
        origin = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, origin + _HASH_BYTES, side="right")))
        n = int(ends[last - 1] - origin)
        up, down = _powers(n)
        sums = np.empty(n + 1, dtype=U64)
        sums[0] = 0
        np.cumsum(_BYTE_CODES[data[origin : origin + n]] * up[:n], out=sums[1:])
        s, e = starts[first:last] - origin, ends[first:last] - origin
        out[first:last] = (sums[e] - sums[s]) * down[s] + (e - s).astype(U64)
        first = last
    out ^= out >> U64(32)
    out *= _MIX_B
    out ^= out >> U64(29)
    return out


def encoded(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def hashed_words(data: bytes, table: np.ndarray = SPACED) -> np.ndarray:
    """Hashes of the words of a text, in order."""
    view = np.frombuffer(data, dtype=np.uint8)
    return run_hashes(view, *word_runs(view, table))


def signed(values: np.ndarray) -> np.ndarray:
    """Unsigned hashes as Spark longs."""
    return values.view(np.int64)


def as_text(value: str | None) -> str:
    return value if value is not None else ""


def components(edges: DataFrame, stored: Stored, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an edge list: rows (node, root), root the smallest node.

    Alternates large-star and small-star steps until the edges no longer change. Every
    step sends a node's least neighbour, aggregated map-side, to its edges; the edges
    shrink to one star per component, and no component is ever gathered.
    """
    edges = stored.put(
        edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a != b").distinct()
    )
    signature = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (
            both.where("b > a").join(least, "a")
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()
        )
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a")
        before = edges
        edges = stored.put(
            small.select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                                           F.struct(F.col("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.*").where("a != b").distinct()
        )
        stored.drop(before)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == signature:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        signature = now
