"""Packing of tokenised documents into sequences of a fixed length, by large-item matching.

A document becomes its token ids and one end id; what exceeds the capacity is cut into pieces
of exactly the capacity, the first piece being the shorter one. Pieces above one third of the
capacity are large: at most two fit into a sequence, and each, from the longest down, is matched
with the longest large piece that still fits. Smaller pieces, from the longest down, go into the
smallest gap that holds them, or into a new sequence.

Only lengths matter for this, and there are at most ``capacity`` of them. So the driver packs the
histogram of lengths, many equal sequences at a time, into placements: "pieces of length l and
rank r to r + n go to sequences s to s + n at offset o". Their number depends on the capacity and
not on the data. Executors count ranks and look their placement up.

Defined cases: a null or empty text is the end id alone; a document that occurs twice is packed
twice; an empty table gives no pieces.
"""

from __future__ import annotations

import os
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.llm.textbytes import flat, hashes, map_texts, sliced, text_of
from tidegauge.session import shared_dir

CAPACITY = 2048
END_ID = 0
#: Distinct units whose ids a task remembers, about 30 bytes each.
REMEMBERED = 400_000
#: Bytes of text that a task encodes at once: what it holds besides is a small multiple of this.
ENCODED_BYTES = 256 << 10
RANK_BITS = 50

#: A space before one of these bytes always begins a token: visible ASCII and the lead
#: bytes of characters that are certainly no white space.
VISIBLE = np.zeros(256, bool)
VISIBLE[[*range(0x21, 0x7F), *range(0xC3, 0xE0), *range(0xE4, 0xF5)]] = True
#: A mark right after a letter always begins a token too.
LETTER = np.zeros(256, bool)
LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
MARK = np.zeros(256, bool)
MARK[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True


class UnitEncoder:
    """Token ids of whole texts, encoding each distinct unit once.

    A unit begins at a space before a visible character, or at a mark after a letter, where the
    tokenizer's own pattern always begins a token too. Units that begin with a space can be joined and
    encoded together, in any order. A text that holds the string of an added token, which the
    tokenizer looks for first of all, is one unit.
    """

    def __init__(self, path: str, end_id: int) -> None:
        # A task has one core; each thread of a pool would keep memory of its own in the worker.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [token.content.encode() for token in added]
        size = self.tokenizer.get_vocab_size()
        # Each character of a byte-level token stands for one byte.
        self.bytes = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(size)])
        self.end_id = end_id
        self.forget()

    def forget(self) -> None:
        #: Sorted hashes of the units, and the place of each in ``at`` and ``size``.
        self.known, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.ids = np.array([self.end_id], np.uint32)
        self.at, self.size = np.zeros(1, np.int64), np.ones(1, np.int64)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def with_added(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The texts that hold an added token's string."""
        whole, found = data.tobytes(), set()
        for token in self.added:
            at = whole.find(token)
            while at >= 0:
                text = int(np.searchsorted(offsets, at, "right")) - 1
                if at + len(token) <= offsets[text + 1]:
                    found.add(text)
                at = whole.find(token, at + 1)
        return np.array(sorted(found), np.int64)

    def learn(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, alone: np.ndarray) -> None:
        spaced = (data[start] == 0x20) & (end - start > 1) & ~alone
        spaced[spaced] = VISIBLE[data[start[spaced] + 1]]
        own, sizes = [], np.zeros(len(start), np.int64)
        order = np.concatenate((np.flatnonzero(spaced), np.flatnonzero(~spaced)))
        many = int(spaced.sum())
        for k in range(0, many, 200):
            units = order[k : min(many, k + 200)]
            joined = b"".join(data[a:b].tobytes() for a, b in zip(start[units], end[units], strict=True))
            ids = np.array(self.encode([joined.decode("utf-8")])[0], np.uint32)
            stops = np.searchsorted(np.cumsum(self.bytes[ids]), np.cumsum(end[units] - start[units])) + 1
            sizes[units] = np.diff(stops, prepend=0)
            own.append(ids)
        rest = order[many:]
        for k in range(0, len(rest), 1000):
            units = rest[k : k + 1000]
            encoded = self.encode([data[a:b].tobytes().decode() for a, b in zip(start[units], end[units], strict=True)])
            sizes[units] = [len(x) for x in encoded]
            own.append(np.fromiter((i for x in encoded for i in x), np.uint32))
        at = np.empty(len(start), np.int64)
        at[order] = len(self.ids) + np.cumsum(sizes[order]) - sizes[order]
        self.ids = np.concatenate((self.ids, *own))
        self.at, self.size = np.concatenate((self.at, at)), np.concatenate((self.size, sizes))

    def documents(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text's followed by the end id, and where each text begins."""
        data, offsets = flat(column)
        if len(self.known) > REMEMBERED:
            self.forget()
        begins = np.zeros(len(data), bool)
        if len(data):
            begins[:-1] = (data[:-1] == 0x20) & VISIBLE[data[1:]]
            begins[1:] |= MARK[data[1:]] & LETTER[data[:-1]]
            special = self.with_added(data, offsets)
            for text in special.tolist():
                begins[offsets[text] : offsets[text + 1]] = False
            begins[offsets[:-1][np.diff(offsets) > 0]] = True
        start = np.flatnonzero(begins)
        end = np.append(start[1:], len(data))
        unit = np.zeros(0, np.int64)
        if len(start):
            distinct, first, back = np.unique(
                hashes(data, start, end), return_index=True, return_inverse=True
            )
            after = np.searchsorted(self.known, distinct, "right")
            new = np.append(np.uint64(0), self.known)[after] != distinct
            new |= after == 0
            if new.any():
                places = np.arange(len(self.at), len(self.at) + new.sum())
                chosen = first[new]
                self.learn(data, start[chosen], end[chosen], np.isin(start[chosen], offsets[special]))
                self.known = np.insert(self.known, after[new], distinct[new])
                self.place = np.insert(self.place, after[new], places)
            unit = self.place[np.searchsorted(self.known, distinct)][back]
        per_text = np.searchsorted(start, offsets)
        unit = np.insert(unit, per_text[1:], 0)  # unit 0 is the end id
        size = self.size[unit]
        stops = np.cumsum(size)
        total = int(stops[-1]) if len(stops) else 0
        where = np.repeat(self.at[unit] - (stops - size), size) + np.arange(total)
        firsts = np.concatenate(([0], stops[per_text[1:] + np.arange(len(offsets) - 1)]))
        return self.ids[where], firsts


def pieces_of(docs: DataFrame, tokenizer: str, capacity: int, id_col: str, text_col: str, keep_ids: bool):
    """A row per piece, with its task and its rank among the task's pieces of that length."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = UnitEncoder(tokenizer, END_ID)
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in sliced(batches, text_col, ENCODED_BYTES):
            ids, firsts = encoder.documents(text_of(batch, text_col))
            total = np.diff(firsts)
            count = -(-total // capacity)
            doc = np.repeat(np.arange(len(total)), count)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            short = np.repeat(total - (count - 1) * capacity, count)
            start = np.where(piece == 0, 0, short + (piece - 1) * capacity)
            length = np.where(piece == 0, short, capacity)
            begin = firsts[doc] + start
            raw = ids.astype("<u4")
            crc = [zlib.crc32(raw[a : a + n]) for a, n in zip(begin.tolist(), length.tolist(), strict=True)]
            order = np.argsort(length, kind="stable")
            ordered = length[order]
            rank = np.empty(len(length), np.int64)
            rank[order] = np.arange(len(length)) - np.searchsorted(ordered, ordered)
            rank += seen[length]
            seen += np.bincount(length, minlength=capacity + 1)
            columns = [batch.column(0).take(pa.array(doc)), piece, start, length, crc, np.full(len(doc), part), rank]
            if keep_ids:
                columns.append([raw[a : a + n].tolist() for a, n in zip(begin.tolist(), length.tolist(), strict=True)])
            yield pa.RecordBatch.from_arrays(
                [
                    c if isinstance(c, pa.Array) else pa.array(c, f.dataType == T.IntegerType() and pa.int32() or None)
                    for c, f in zip(columns, schema.fields, strict=True)
                ],
                names=schema.names,
            )

    own = docs.select(F.col(id_col), F.col(text_col))
    schema = T.StructType(
        [
            own.schema[id_col],
            T.StructField("piece", T.IntegerType()),
            *(T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "part", "rank")),
        ]
    )
    if keep_ids:
        schema = schema.add("ids", T.ArrayType(T.LongType()))
    return map_texts(own, work, schema)


class Plan:
    """Placements of a histogram of lengths."""

    def __init__(self, counts: dict[int, int], capacity: int) -> None:
        self.capacity, self.left = capacity, dict(counts)
        self.taken = defaultdict(int)
        self.gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.sequences, self.rows = 0, []
        self.match_large()
        self.fit_small()

    def place(self, length: int, first: int, count: int, offset: int) -> None:
        self.rows.append((length, self.taken[length], first, count, offset))
        self.taken[length] += count
        self.left[length] -= count

    def open(self, count: int) -> int:
        first = self.sequences
        self.sequences += count
        return first

    def match_large(self) -> None:
        large = sorted((n for n in self.left if 3 * n > self.capacity), reverse=True)
        for a in large:
            for b in (b for b in large if b <= a and a + b <= self.capacity):
                pairs = self.left[a] // 2 if a == b else min(self.left[a], self.left[b])
                if pairs:
                    first = self.open(pairs)
                    self.place(a, first, pairs, 0)
                    self.place(b, first, pairs, a)
                    self.gaps[self.capacity - a - b].append((first, pairs))
            if alone := self.left[a]:
                first = self.open(alone)
                self.place(a, first, alone, 0)
                self.gaps[self.capacity - a].append((first, alone))

    def fit_small(self) -> None:
        for n in sorted((n for n in self.left if 3 * n <= self.capacity), reverse=True):
            while self.left[n]:
                gap = min((g for g, bins in self.gaps.items() if g >= n and bins), default=None)
                if gap is None:
                    gap = self.capacity
                    count = -(-self.left[n] // (gap // n))
                    self.gaps[gap].append((self.open(count), count))
                self.fill(n, gap)

    def fill(self, n: int, gap: int) -> None:
        """Fills sequences of one gap one after another; the last may stay half filled."""
        first, count = self.gaps[gap].pop()
        each = gap // n
        full = min(count, self.left[n] // each)
        used = self.capacity - gap
        for j in range(each if full else 0):
            self.place(n, first, full, used + j * n)
        if full:
            self.gaps[gap - each * n].append((first, full))
        if full < count:
            rest = min(self.left[n], each - 1) if full * each < count * each else 0
            for j in range(rest):
                self.place(n, first + full, 1, used + j * n)
            if rest:
                self.gaps[gap - rest * n].append((first + full, 1))
            if keep := count - full - bool(rest):
                self.gaps[gap].append((first + full + bool(rest), keep))

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted keys (length and first rank), first sequences and offsets."""
        rows = np.array(sorted(self.rows), np.int64).reshape(-1, 5)
        return (rows[:, 0] << RANK_BITS) | rows[:, 1], rows[:, 2], rows[:, 4]


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """A row per piece: its place in its document, its sequence and its offset there.

    ``tokenizer`` is the path of a byte-level tokenizer file on every executor. Texts are
    tokenised once, into a table in the shared folder; ``keep_ids`` adds the ids themselves.
    """
    spark = docs.sparkSession
    path = shared_dir(spark, "pieces")
    pieces_of(docs, tokenizer, capacity, id_col, text_col, keep_ids).write.parquet(path)
    pieces = spark.read.parquet(path)
    counts = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    lengths = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most `capacity` rows
    plan = spark.sparkContext.broadcast(Plan({r["length"]: r["n"] for r in lengths}, capacity).arrays())
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["part", "length"])
    kept = [id_col, "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else [])]
    ranked = ranked.select(*kept, (F.col("rank") + F.col("base")).alias("rank"))
    schema = ranked.drop("rank").schema.add("sequence_id", T.LongType()).add("offset", T.LongType())

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sequences, offsets = plan.value
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            row = np.searchsorted(keys, (length << RANK_BITS) | rank, "right") - 1
            sequence = sequences[row] + rank - (keys[row] & ((1 << RANK_BITS) - 1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sequence), pa.array(offsets[row])], names=schema.names
            )

    return map_texts(ranked, assign, schema)
