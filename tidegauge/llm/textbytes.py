"""Words of many texts at once, as numpy arrays over the UTF-8 bytes of an Arrow column.

Separators are ASCII bytes, so words found in bytes are the words of the text. A word's
hash is a polynomial of its bytes from one running sum over the whole buffer, so no
Python code runs per word. Memory is about 40 bytes for each byte of a slice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

SLICE_BYTES = 1 << 20
#: Rows that Spark puts into one Arrow batch. Its own 10,000 would be tens of MB of text in the
#: JVM and again in Python, for each task.
BATCH_ROWS = 1000
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
STEP = np.uint64(0xD6E8FEB86659FD93)

#: True for the bytes of a word.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over the 64 output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and its row offsets, from 0; null is empty."""
    texts = pc.fill_null(column.cast(pa.large_binary()), b"")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    every = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return every[at[0] : at[-1]], at - at[0]


def text_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    column = batch.column(batch.schema.get_field_index(name))
    return column if not pa.types.is_null(column.type) else column.cast(pa.string())


def map_texts(df: DataFrame, work: Callable, schema) -> DataFrame:
    """``mapInArrow`` in batches of at most ``BATCH_ROWS`` rows. This lowers the session's setting."""
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(BATCH_SETTING)) <= BATCH_ROWS:
        conf.set(BATCH_SETTING, BATCH_ROWS)
    return df.mapInArrow(work, schema)


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that the table does not have."""
    taken = {c.lower() for c in df.columns}
    name = f"__{name}"
    while name.lower() in taken:
        name += "_"
    return name


def sliced(
    batches: Iterator[pa.RecordBatch], name: str, limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``limit`` bytes of text, or of one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(text_of(batch, name).cast(pa.large_binary())), 0)
        total = np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < len(total):
            before = total[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(total, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


@dataclass
class Words:
    """Words of a slice, in order; ``first[d]`` to ``first[d + 1]`` are those of text d."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hash: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def text(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each range of bytes."""
    powers = np.full(len(data), BASE)
    powers[0] = 1
    np.cumprod(powers, out=powers)
    sums = np.zeros(len(data) + 1, np.uint64)
    powers *= data.astype(np.uint64) + np.uint64(1)
    np.cumsum(powers, out=sums[1:])
    back = np.full(len(data), INVERSE)
    back[0] = 1
    np.cumprod(back, out=back)
    value = (sums[end] - sums[start]) * back[start]
    return mix(value ^ ((end - start).astype(np.uint64) * STEP))


def words(column: pa.Array, member: np.ndarray, lower: bool = True) -> Words:
    data, offsets = flat(column)
    if lower:
        data = LOWER[data]
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        first = np.zeros(len(offsets), np.int64)
        return Words(data, offsets, none, none, first, np.zeros(0, np.uint64))
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = member[data]
    opens = inside[1:-1] & ~inside[:-2]
    closes = inside[1:-1] & ~inside[2:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < n)]  # texts that touch without a separator
    opens[edges] = inside[1:-1][edges]
    closes[edges - 1] = inside[1:-1][edges - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    value = hashes(data, start, end)
    return Words(data, offsets, start, end, np.searchsorted(start, offsets), value)


def combined(values: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of ``width`` neighbours, by its first; the last runs are left out."""
    n = max(0, len(values) - width + 1)
    out = values[:n].copy()
    for j in range(1, width):
        out = out * STEP + values[j : j + n]
    return mix(out)


def whole_hash(values: np.ndarray) -> np.uint64:
    """A hash of a sequence of any length."""
    out = np.uint64(len(values))
    with np.errstate(over="ignore"):
        for v in values:
            out = out * STEP + v
    return mix(np.array([out]))[0]


def shingle_sets(found: Words, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a shorter text is one shingle."""
    runs = combined(found.hash, width)
    sets = []
    for a, b in zip(found.first[:-1], found.first[1:], strict=True):
        if b - a >= width:
            own = np.sort(runs[a : b - width + 1])
            sets.append(own[np.concatenate(([True], own[1:] != own[:-1]))])
        elif b > a:
            sets.append(np.array([whole_hash(found.hash[a:b])], np.uint64))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets
