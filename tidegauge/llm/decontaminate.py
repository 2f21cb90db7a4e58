"""Benchmark decontamination by Wu-Manber search over words.

The test strings are the windows of ``width`` consecutive words of every benchmark item (an
item with fewer words is one window). Symbols are words rather than characters: a block is
the hash of up to two words, a shift table over blocks says how far a search position can move
on without passing an occurrence, and where the shift is 0 the windows that end in the same
block are compared word by word, first by hash, then by their bytes. Many positions move in
step, as numpy arrays.

Defined cases: a null or empty text has no words and no hits; an item without words is ignored;
items with equal text are all reported; a null item id is reported as the empty string; a document
that occurs twice is reported twice; an empty benchmark hits nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.llm.textbytes import ALNUM, STEP, Words, map_texts, sliced, text_of, words
from tidegauge.session import shared_dir

WIDTH = 10
#: Item words whose tables are held at once; a larger benchmark is searched in several blocks.
BLOCK_WORDS = 2_000_000
LANE = 256

HITS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("hit_starts", T.ArrayType(T.LongType())),
        T.StructField("hit_ends", T.ArrayType(T.LongType())),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


@dataclass
class Tables:
    """Search tables of the windows of one length."""

    length: int
    windows: np.ndarray
    texts: list[tuple[bytes, ...]]
    items: list[list[str]]
    bits: int = 18
    shift: np.ndarray = field(init=False)
    order: np.ndarray = field(init=False)
    suffix: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        block = min(2, self.length)
        self.shift = np.full(1 << self.bits, self.length - block + 1, np.int64)
        for end in range(block - 1, self.length):
            np.minimum.at(self.shift, self.slot(self.block(self.windows, end)), self.length - 1 - end)
        last = self.block(self.windows, self.length - 1)
        self.order = np.argsort(last, kind="stable")
        self.suffix = last[self.order]

    def block(self, rows: np.ndarray, end: int) -> np.ndarray:
        return rows[:, end] if self.length == 1 else rows[:, end - 1] * STEP + rows[:, end]

    def slot(self, block: np.ndarray) -> np.ndarray:
        return ((block * STEP) >> np.uint64(64 - self.bits)).astype(np.int64)

    def search(self, found: Words) -> Iterator[tuple[int, int]]:
        """(first word, window) of every occurrence."""
        h, m = found.hash, self.length
        at, stop = lanes(found.first, m)
        hits = []
        while len(at):
            block = h[at] if m == 1 else h[at - 1] * STEP + h[at]
            step = self.shift[self.slot(block)]
            hits.append(at[step == 0])
            at = at + np.maximum(step, 1)
            live = at < stop
            at, stop = at[live], stop[live]
        ends = np.concatenate(hits) if hits else np.zeros(0, np.int64)
        if not len(ends):
            return
        block = h[ends] if m == 1 else h[ends - 1] * STEP + h[ends]
        low, high = (np.searchsorted(self.suffix, block, side) for side in ("left", "right"))
        size = high - low
        which = np.repeat(np.arange(len(ends)), size)
        rank = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
        window = self.order[np.repeat(low, size) + rank]
        first = ends[which] - m + 1
        same = np.ones(len(window), bool)
        for j in range(m):
            same &= h[first + j] == self.windows[window, j]
        for f, w in zip(first[same].tolist(), window[same].tolist(), strict=True):
            if all(found.text(f + j) == part for j, part in enumerate(self.texts[w])):
                yield f, w


def lanes(first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Ranges of positions at which a window can end, none longer than ``LANE``."""
    a, b = first[:-1] + length - 1, first[1:]
    a, b = a[a < b], b[a < b]
    pieces = -(-(b - a) // LANE)
    rank = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    at = np.repeat(a, pieces) + rank * LANE
    return at, np.minimum(at + LANE, np.repeat(b, pieces))


def build(items: list[tuple[object, str | None]], width: int = WIDTH) -> list[Tables]:
    """Tables for the windows of ``(item_id, text)`` rows, by length."""
    found = words(pa.array([text or "" for _, text in items], pa.string()), ALNUM)
    by_length: dict[int, dict[tuple[bytes, ...], tuple[np.ndarray, set[str]]]] = {}
    for k, (item, _) in enumerate(items):
        a, b = int(found.first[k]), int(found.first[k + 1])
        m = min(width, b - a)
        for s in range(a, b - m + 1) if m else ():
            key = tuple(found.text(s + j) for j in range(m))
            _, ids = by_length.setdefault(m, {}).setdefault(key, (found.hash[s : s + m], set()))
            ids.add("" if item is None else str(item))
    return [
        Tables(
            m,
            np.array([h for h, _ in known.values()], np.uint64),
            list(known),
            [sorted(ids) for _, ids in known.values()],
        )
        for m, known in sorted(by_length.items())
    ]


def occurrences(found: Words, tables: list[Tables]) -> tuple[np.ndarray, np.ndarray, list]:
    """Whether each word is hit, where each text's words begin, and each text's items."""
    docs = len(found.first) - 1
    change = np.zeros(len(found.hash) + 1, np.int64)
    items: list[set[str]] = [set() for _ in range(docs)]
    for table in tables:
        for f, w in table.search(found):
            change[f] += 1
            change[f + table.length] -= 1
            items[int(np.searchsorted(found.first, f, "right")) - 1].update(table.items[w])
    hit = np.cumsum(change)[:-1] > 0
    return hit, found.first, items


def ranges(hit: np.ndarray) -> tuple[list[int], list[int]]:
    edge = np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()


def blocks_of(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[tuple[list, bool]]:
    """Blocks of about ``BLOCK_WORDS`` words, one at a time, and whether each is the last."""
    rows = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).alias("text"))
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    count = -(-size // (4 * BLOCK_WORDS)) or 1
    part = F.pmod(F.xxhash64("item", "text"), F.lit(count))
    for k in range(count):
        yield [tuple(r) for r in rows.where(part == k).collect()], k + 1 == count


def in_blocks(docs: DataFrame, benchmark: DataFrame, item_col: str, width: int, one: Callable) -> DataFrame:
    """Sends the documents past each block; between blocks they are written, so that executors hold
    the tables of one block only."""
    spark = docs.sparkSession
    for items, last in blocks_of(benchmark, item_col, "text"):
        docs = one(docs, spark.sparkContext.broadcast(build(items, width)), last)
        if not last:
            path = shared_dir(spark, "searched")
            docs.write.parquet(path)
            docs = spark.read.schema(docs.schema).parquet(path)
    return docs


def find_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = WIDTH,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
) -> DataFrame:
    """A row per document: its words, the ranges of hit words and the items that occur in it."""
    name = docs.select(id_col).columns[0]
    none = F.array().cast("array<bigint>")
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), none.alias("starts"))
    own = own.withColumns({"ends": none, "items": F.array().cast("array<string>")})

    def one(docs: DataFrame, tables, last: bool) -> DataFrame:
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in sliced(batches, "text"):
                found = words(text_of(batch, "text"), ALNUM)
                hit, first, items = occurrences(found, tables.value)
                earlier = [batch.column(k).to_pylist() for k in (2, 3, 4)]
                rows = []
                for k, (a, b) in enumerate(zip(first[:-1], first[1:], strict=True)):
                    own = hit[a:b].copy()
                    for s, e in zip(earlier[0][k], earlier[1][k], strict=True):
                        own[s:e] = True
                    rows.append((*ranges(own), sorted(items[k].union(earlier[2][k]))))
                starts, ends, items = ([r[k] for r in rows] for k in range(3))
                lists = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(found.counts, pa.int64()) if last else batch.column(1),
                        pa.array(starts, lists),
                        pa.array(ends, lists),
                        pa.array(items, pa.list_(pa.string())),
                    ],
                    names=schema.names,
                )

        schema = T.StructType([docs.schema["id"], *HITS.fields]) if last else docs.schema
        return map_texts(docs, work, schema)

    return in_blocks(own, benchmark, item_col, width, one).withColumnRenamed("id", name)


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, text_col: str = "text", item_col: str = "item_id"
) -> DataFrame:
    """The documents in which no window of the benchmark occurs, with all their columns."""

    def one(docs: DataFrame, tables, last: bool) -> DataFrame:
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in sliced(batches, text_col):
                _, _, items = occurrences(words(text_of(batch, text_col), ALNUM), tables.value)
                yield batch.filter(pa.array([not x for x in items], pa.bool_()))

        return map_texts(docs, work, docs.schema)

    return in_blocks(docs, benchmark, item_col, width, one)
