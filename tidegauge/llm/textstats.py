"""Counts of whole texts and of their lines, for many texts at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from tidegauge.llm.textbytes import NOT_SPACE, Words, combined, hashes, mix, words

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
UPPER = np.zeros(256, bool)
UPPER[0x41:0x5B] = True
DIGIT = np.zeros(256, bool)
DIGIT[0x30:0x3A] = True
STOP = np.zeros(256, bool)
STOP[list(b".?:;,\"')]")] = True
MARKS = np.zeros(256, bool)
MARKS[list(b"!-_=+~^/\\@{}[]")] = True
WINDOW = 5


def sums(mask: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many are true between neighbouring offsets."""
    total = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
    return np.diff(total[at])


@dataclass
class Lines:
    """Lines with a word; ``first[d]`` to ``first[d + 1]`` are those of text d."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    n_words: np.ndarray
    hash: np.ndarray
    repeated: np.ndarray
    word_first: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def lines_of(found: Words) -> Lines:
    data, offsets = found.data, found.offsets
    edge = np.concatenate((offsets[:-1], np.flatnonzero(data == 0x0A) + 1))
    start = np.unique(edge[edge < len(data)]) if len(data) else np.zeros(0, np.int64)
    end = np.append(start[1:], len(data))[: len(start)]
    ends_in_break = np.zeros(len(start), bool)
    if len(start):
        ends_in_break = data[end - 1] == 0x0A
    first_word = np.searchsorted(found.start, np.append(start, len(data)))
    count = np.diff(first_word)
    some = count > 0
    start, end, count = start[some], (end - ends_in_break)[some], count[some]
    own = hashes(data, start, end) if len(start) else np.zeros(0, np.uint64)
    first = np.searchsorted(start, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    repeated = np.ones(len(start), bool)
    _, earliest = np.unique(mix(own ^ mix(doc.astype(np.uint64))), return_index=True)
    repeated[earliest] = False
    return Lines(start, end, first, count, own, repeated, np.searchsorted(found.start, start))


def repeated_words(found: Words) -> np.ndarray:
    """For each word, whether a window of five words around it occurs again in its text."""
    runs = combined(found.hash, WINDOW)
    hit = np.zeros(len(found.hash) + 1, np.int64)
    if len(runs):
        doc = found.doc
        inside = np.flatnonzero(doc[: len(runs)] == doc[WINDOW - 1 :])
        key = mix(runs[inside] ^ mix(doc[inside].astype(np.uint64)))
        _, back, count = np.unique(key, return_inverse=True, return_counts=True)
        again = inside[count[back] > 1]
        hit[again] += 1
        np.subtract.at(hit, again + WINDOW, 1)
    return np.cumsum(hit)[:-1] > 0


@dataclass
class Stats:
    found: Words
    lines: Lines
    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray


def stats_of(column: pa.Array) -> Stats:
    """The counts of each text; lines and windows are compared exactly as written."""
    found = words(column, NOT_SPACE, lower=False)
    data, offsets = found.data, found.offsets
    lines = lines_of(found)
    return Stats(
        found,
        lines,
        found.counts,
        sums(NOT_SPACE[data] & ((data & 0xC0) != 0x80), offsets),
        sums(SYMBOLS[data], offsets),
        sums(lines.repeated, lines.first),
        sums(repeated_words(found), found.first),
    )
