"""Periodic runs of words in each text, from an enhanced suffix array.

A run is a stretch of consecutive words with smallest period q, at least ``2 * q`` and ``least``
words long, that no neighbouring word extends with period q. Runs are found by the branching-tandem
test, without a tree: in the suffix array of a text's words, each boundary with longest common
prefix d parts an LCP interval into two sides whose suffixes share exactly d words. For each suffix i
of the **smaller** side, the inverse suffix array says whether i + d or i - d is on the other side. If
so, the earlier of the two begins a square of period d that the next word breaks: the last square of
a run. Rotating it to the left, as long as the words d apart agree, gives the run. Every run is found
once for its smallest period and once for multiples of it, which have the same ends and are merged
away. Listing smaller sides only costs n log n in all.

Suffixes are sorted by prefix doubling over many texts at once, with ranks that never tie between
texts. The ranks of each doubling step are kept: they answer, by halving steps and without hashes, how
far two places agree forwards (the LCP array) or backwards (the rotations). Everything is numpy over
whole arrays; no Python code runs per word.

A run of 12 words with period q has 12 - q >= 6 words that occur again q further, so texts in which no
six words occur twice (by their hash; a collision only costs time) have no run and are not sorted.

Defined cases: a null or empty text has no words, no runs and an empty collapsed text. A very long text
is sorted alone, in memory of about 60 bytes a word times the log of its longest repeat. Repeated rows and
null ids are returned like any others. An empty table gives no rows. Only the id and text columns are
read, so other columns' names never clash. Runs come by start, then period, so ties are settled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.textbytes import NOT_SPACE, combined, map_texts, mix, sliced, text_of, words

#: Words that a run has at least, and the words of it that must occur twice then.
LEAST = 12
#: Suffixes of smaller sides that are listed at a time.
LISTED = 1 << 20

RUN = "array<struct<start long, length long, period long>>"


class Suffixes:
    """Suffix array of several word sequences at once, with the ranks after every doubling step."""

    def __init__(self, ids: np.ndarray, first: np.ndarray) -> None:
        """``ids``: words as numbers; ``first[d]`` to ``first[d + 1]`` are those of sequence d."""
        n = len(ids)
        doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
        self.begin, self.end = first[doc], first[doc + 1]
        key = doc * (int(ids.max(initial=0)) + 1) + ids
        order = np.argsort(key, kind="stable")
        rank, tied = self.ranked(order, key[order], np.arange(n))
        self.levels = [rank]
        while len(tied):
            h = 1 << (len(self.levels) - 1)
            after = tied + h
            inside = after < self.end[tied]
            then = np.where(inside, rank[np.minimum(after, n - 1)] + 1, 0)
            key = rank[tied].astype(np.int64) * (n + 1) + then
            order = np.argsort(key, kind="stable")
            sorted_key, place = key[order], rank[tied][order]
            heads = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
            slots = place + np.arange(len(place)) - np.repeat(heads, np.diff(np.append(heads, len(place))))
            fresh, still = self.ranked(tied[order], sorted_key, slots, rank)
            rank, tied = fresh, still
            self.levels.append(rank)
        self.rank = rank
        self.sa = np.empty(n, np.int64)
        self.sa[rank] = np.arange(n)

    @staticmethod
    def ranked(
        at: np.ndarray, key: np.ndarray, slots: np.ndarray, before: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of places sorted by key, equal keys sharing the first slot; and the places that share."""
        rank = np.empty(len(at), np.int32) if before is None else before.copy()
        new = np.concatenate(([True], key[1:] != key[:-1])) if len(key) else np.zeros(0, bool)
        heads = np.flatnonzero(new)
        sizes = np.diff(np.append(heads, len(key)))
        rank[at] = np.repeat(slots[heads], sizes)
        return rank, at[np.repeat(sizes, sizes) > 1]

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words agree from places i and j on (different places of one sequence)."""
        off, last = np.zeros(len(i), np.int64), np.maximum(i, j)
        end = self.end[i]
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            can = np.flatnonzero(last + off < end)
            same = can[level[i[can] + off[can]] == level[j[can] + off[can]]]
            off[same] += 1 << k
        return off

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words agree before places i < j of one sequence."""
        off, begin = np.zeros(len(i), np.int64), self.begin[i]
        for k in range(len(self.levels) - 1, -1, -1):
            level, step = self.levels[k], 1 << k
            can = np.flatnonzero(i - off - step >= begin)
            same = can[level[i[can] - off[can] - step] == level[j[can] - off[can] - step]]
            off[same] += step
        return off

    def lcp(self) -> np.ndarray:
        """Common words of each suffix and the one sorted before it; 0 between sequences."""
        out = np.zeros(len(self.sa), np.int64)
        a, b = self.sa[:-1], self.sa[1:]
        same = np.flatnonzero(self.levels[0][a] == self.levels[0][b])
        out[same + 1] = self.forward(a[same], b[same])
        return out


def sides(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Boundaries r with common words, and the LCP interval ``[low, high)`` that each parts.

    On the left it ends at the next boundary that is not deeper, on the right at the next less deep
    one, so that of equally deep boundaries the first takes all that follow. Found in a table of
    minima over 2**k neighbours, from the largest step down.
    """
    r = np.flatnonzero(lcp > 0)
    table = [lcp]
    while 1 << len(table) <= len(lcp) and (table[-1] > 0).any():
        half = 1 << (len(table) - 1)
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))
    low, high, deep = r.copy(), r + 1, lcp[r]
    for k in range(len(table) - 1, -1, -1):
        least, step = table[k], 1 << k
        can = np.flatnonzero(low - step >= 0)
        can = can[least[low[can] - step] > deep[can]]
        low[can] -= step
        can = np.flatnonzero(high + step <= len(lcp))
        can = can[least[high[can]] >= deep[can]]
        high[can] += step
    return r, low - 1, high


def branching_squares(suffixes: Suffixes) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods of all squares that end with a break: ``(i, d)``."""
    lcp = suffixes.lcp()
    r, low, high = sides(lcp)
    left = r - low <= high - r
    begin, size = np.where(left, low, r), np.where(left, r - low, high - r)
    begin_other, end_other = np.where(left, r, low), np.where(left, high, r)
    deep, n = lcp[r], len(lcp)
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    total = np.cumsum(size)
    start = 0
    while start < len(r):
        before = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, before + LISTED, "right")))
        part = slice(start, stop)
        count = size[part]
        rank = np.repeat(begin[part] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        i, d = suffixes.sa[rank], np.repeat(deep[part], count)
        a, b = np.repeat(begin_other[part], count), np.repeat(end_other[part], count)
        for way in (1, -1):
            j = i + way * d
            can = np.flatnonzero((j >= 0) & (j < n))
            at = suffixes.rank[j[can]]
            hit = can[(at >= a[can]) & (at < b[can])]
            found.append((np.minimum(i[hit], j[hit]), d[hit]))
        start = stop
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def runs_of(ids: np.ndarray, first: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, ...]:
    """``(start, length, period)`` of the runs of all sequences, by start, then period.

    Starts count from the first word of all sequences.
    """
    if not len(ids):
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    suffixes = Suffixes(ids, first)
    i, d = branching_squares(suffixes)
    start, end = i - suffixes.backward(i, i + d), i + 2 * d
    long = end - start >= least
    start, end, d = start[long], end[long], d[long]
    order = np.lexsort((d, end, start))
    start, end, d = start[order], end[order], d[order]
    fresh = np.ones(len(start), bool)  # of equal ends, the smallest period is the run's
    fresh[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, d = start[fresh], end[fresh], d[fresh]
    order = np.lexsort((d, start))
    return start[order], (end - start)[order], d[order]


def numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Words as numbers, equal words alike, and where each text begins."""
    known: dict[bytes, int] = {}
    ids = [known.setdefault(w, len(known)) for text in texts for w in text]
    return np.array(ids, np.int64), np.cumsum([0, *map(len, texts)], dtype=np.int64)


def repeats(column: pa.Array, width: int) -> np.ndarray:
    """Texts in which some ``width`` words occur twice, by their hash."""
    found = words(column, NOT_SPACE, lower=False)
    again = np.zeros(len(found.first) - 1, bool)
    runs = combined(found.hash, width)
    if len(runs):
        doc = found.doc
        inside = np.flatnonzero(doc[: len(runs)] == doc[width - 1 :])
        key = mix(runs[inside] ^ mix(doc[inside].astype(np.uint64)))
        order = np.argsort(key)
        same = np.flatnonzero(key[order][1:] == key[order][:-1])
        again[doc[inside[order[same]]]] = True
    return again


def find_runs(
    docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: its id, its ``runs`` by start and period, and its ``collapsed`` text.

    Collapsing drops every word that a run holds after that run's first period; the words that
    stay are joined by one space.
    """
    if least < 2:
        raise ValueError("a run has two words at least")
    own = docs.select(F.col(id_col), F.col(text_col).alias("__text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "__text"):
            column = text_of(batch, "__text")
            texts = [(x or "").encode().split() for x in column.to_pylist()]
            some = np.flatnonzero(repeats(column, least // 2)).tolist()
            runs, kept = [[] for _ in texts], list(texts)
            if some:
                ids, first = numbered([texts[k] for k in some])
                start, length, period = runs_of(ids, first, least)
                edges = np.searchsorted(start, first).tolist()
                drop = np.zeros(len(ids) + 1, np.int64)
                np.add.at(drop, start + period, 1)
                np.add.at(drop, start + length, -1)
                stay = np.cumsum(drop[:-1]) == 0
                for at, k in enumerate(some):
                    a, b = edges[at], edges[at + 1]
                    if a < b:
                        rows = zip((start[a:b] - first[at]).tolist(), length[a:b].tolist(), period[a:b].tolist())
                        runs[k] = [{"start": s, "length": n, "period": q} for s, n, q in rows]
                        keep = np.flatnonzero(stay[first[at] : first[at + 1]]).tolist()
                        kept[k] = [texts[k][i] for i in keep]
            collapsed = pa.array([b" ".join(x) for x in kept], pa.binary()).cast(pa.string())
            run = pa.struct([(x, pa.int64()) for x in ("start", "length", "period")])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(runs, pa.list_(run)), collapsed], names=["id", "runs", "collapsed"]
            )

    name = own.columns[0]
    kind = own.schema[0].dataType.simpleString()
    return map_texts(own, work, f"id {kind}, runs {RUN}, collapsed string").withColumnRenamed("id", name)
