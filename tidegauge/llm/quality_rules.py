"""Quality rules, and labelling of lines as content or boilerplate by a linear-chain CRF.

The CRF has two states and a few features of each line (length, shares of symbols, capitals, digits
and marks, repetition, final punctuation, document frequency). Document frequency is counted over all
documents, by different texts, so that copies of a document do not make its lines boilerplate; lines of
at least ``COMMON`` texts have the feature. Executors hold the most frequent ``FREQUENT`` of them, and
the others meet their texts in a join.

The CRF is trained by conditional likelihood on stretches of at most ``LINES`` lines of each of at most
``sample`` documents, whose states come from distant supervision: a line is boilerplate if it repeats
within its text, if at least ``COMMON`` texts and one in ``COMMON_PARTS`` of all have it, or if a large share
of it is symbols, capitals or marks. Viterbi decoding then labels the lines of every document, and a
document is kept if at least ``CONTENT_SHARE`` of its words stand in content lines, unless the base
rules reject it: fewer than 10 words, or over a fifth of them in repeated windows of five.

Defined cases: a null or empty text has no words and is rejected; rows with equal ids are judged
one by one; with no document to sample, no line is boilerplate; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.llm.textbytes import ALNUM, LOWER, fresh, map_texts, sliced, text_of
from tidegauge.llm.textstats import DIGIT, MARKS, STOP, SYMBOLS, UPPER, Stats, stats_of
from tidegauge.session import shared_dir

SAMPLE = 2000
CONTENT_SHARE = 0.5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
FEATURES = 10
COMMON = 10
COMMON_PARTS = 1000
FREQUENT = 1 << 20
LINES = 200
NO_LINES = "array_repeat(named_struct('hash', 0L, 'texts', 0L), 0)"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def line_features(stats: Stats, common: np.ndarray) -> np.ndarray:
    """A row of numbers between 0 and 1 for each line, the last of which is ``common``."""
    data, lines = stats.found.data, stats.lines
    size = np.maximum(lines.end - lines.start, 1)

    def share(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(mask[data], dtype=np.int64)))
        return (total[lines.end] - total[lines.start]) / size

    letters = np.maximum(share(ALNUM[LOWER]), 1e-9)
    last = STOP[data[lines.end - 1]] if len(lines.end) else np.zeros(0, bool)
    return np.column_stack(
        [
            np.ones(len(size)),
            np.minimum(np.log1p(lines.n_words) / 6, 1),
            np.minimum(share(SYMBOLS) * 5, 1),
            np.minimum(share(UPPER) / letters, 1),
            np.minimum(share(DIGIT) * 3, 1),
            np.minimum(share(MARKS) * 5, 1),
            lines.repeated,
            last,
            np.minimum(size / np.maximum(lines.n_words, 1) / 20, 1),
            common,
        ]
    ).astype(np.float64)


@dataclass
class Crf:
    """Weights of the boilerplate state, and scores of moving between states."""

    weights: np.ndarray
    moves: np.ndarray

    def emissions(self, features: np.ndarray) -> np.ndarray:
        return np.column_stack((np.zeros(len(features)), features @ self.weights))


def steps(first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(sequences, their t-th lines) for t = 0, 1, ... while a sequence is that long."""
    length = np.diff(first)
    order = np.argsort(-length, kind="stable")
    length, begin = length[order], first[:-1][order]
    for t in range(int(length[0]) if len(length) else 0):
        live = int(np.searchsorted(-length, -t, "left"))
        yield order[:live], begin[:live] + t


def viterbi(crf: Crf, features: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The most likely state of each line: 0 content, 1 boilerplate."""
    score = crf.emissions(features)
    best = np.zeros((len(first) - 1, 2))
    came = np.zeros((len(features), 2), np.int8)
    for t, (who, at) in enumerate(steps(first)):
        if t:
            paths = best[who][:, :, None] + crf.moves[None]
            came[at] = paths.argmax(1)
            best[who] = paths.max(1) + score[at]
        else:
            best[who] = score[at]
    state = np.zeros(len(features), np.int8)
    some = np.diff(first) > 0
    state[first[1:][some] - 1] = best[some].argmax(1)
    for _, at in list(steps(first))[:0:-1]:
        state[at - 1] = came[at, state[at]]
    return state


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def train(features: np.ndarray, state: np.ndarray, first: np.ndarray, rounds: int = 150) -> Crf:
    """Gradient ascent on the conditional likelihood, by forward and backward sums."""
    crf = Crf(np.zeros(features.shape[1]), np.zeros((2, 2)))
    plan = list(steps(first))
    lines = max(len(features), 1)
    later = np.ones(len(features), bool)
    later[first[:-1][np.diff(first) > 0]] = False
    after = np.flatnonzero(later)
    seen = np.zeros((2, 2))
    np.add.at(seen, (state[after - 1], state[after]), 1)
    rate, power_w, power_m = 0.3, np.zeros_like(crf.weights), np.zeros((2, 2))
    for _ in range(rounds):
        score = crf.emissions(features)
        ahead, behind = score.copy(), np.zeros_like(score)
        for t, (_, at) in enumerate(plan):
            if t:
                ahead[at] += log_sum(ahead[at - 1][:, :, None] + crf.moves[None], 1)
        for t in range(len(plan) - 1, 0, -1):
            at = plan[t][1]
            behind[at - 1] = log_sum((score[at] + behind[at])[:, None, :] + crf.moves[None], 2)
        joint = ahead + behind
        total = log_sum(joint, 1)
        expected = np.exp(joint[:, 1] - total)
        pair = ahead[after - 1][:, :, None] + crf.moves[None] + (score[after] + behind[after])[:, None, :]
        moved = np.exp(pair - total[after][:, None, None]).sum(0)
        slope_w = features.T @ (state - expected) / lines - 1e-4 * crf.weights
        slope_m = (seen - moved) / lines - 1e-4 * crf.moves
        power_w, power_m = power_w + slope_w**2, power_m + slope_m**2
        crf.weights += rate * slope_w / np.sqrt(power_w + 1e-12)
        crf.moves += rate * slope_m / np.sqrt(power_m + 1e-12)
    return crf


def distant_states(features: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Boilerplate by rule, for training only."""
    symbols, capitals, marks, again = (features[:, k] for k in (2, 3, 5, 6))
    return ((symbols > 0.3) | (capitals > 0.5) | (marks > 0.3) | (again > 0) | frequent).astype(np.int8)


@dataclass
class Common:
    """How many texts have a line, for common lines: the most frequent ones by ascending hash."""

    hashes: np.ndarray
    texts: np.ndarray
    least: int  # makes a line boilerplate in training

    def of(self, stats: Stats, rare: pa.Array) -> np.ndarray:
        """0 for each line that is not common, up to 1 for ``least`` texts and more, by the logarithm.

        ``rare`` lists the common lines of each text that are not held here.
        """
        out = np.zeros(len(stats.lines.hash), np.int64)
        flat = rare.flatten()
        known, at = np.unique(flat.field("hash").to_numpy(zero_copy_only=False).astype(np.int64), return_index=True)
        texts = flat.field("texts").to_numpy(zero_copy_only=False).astype(np.int64)[at]
        wanted = stats.lines.hash.view(np.int64)
        for hashes, n in ((self.hashes, self.texts), (known, texts)):
            if len(hashes):
                row = np.minimum(np.searchsorted(hashes, wanted), len(hashes) - 1)
                out = np.where(hashes[row] == wanted, n[row], out)
        return np.minimum(np.log(np.maximum(out, 1)) / np.log(self.least), 1)


@dataclass
class Model:
    """The CRF, the common lines that executors hold, and the table ``(hash, texts)`` of the others."""

    crf: Crf
    common: Common
    others: DataFrame


def lines_of(docs: DataFrame, text_col: str) -> DataFrame:
    """``(key, hash)``: the different lines of each different text, which its hash stands for."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            lines = stats_of(text_of(batch, "text")).lines
            at = pa.array(lines.first.astype(np.int32))
            hashes = pa.ListArray.from_arrays(at, pa.array(lines.hash.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), hashes], names=["key", "hashes"])

    own = docs.select(F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"))
    return map_texts(own, work, "key long, hashes array<long>").select("key", F.explode("hashes").alias("hash")).distinct()


def common_lines(docs: DataFrame, text_col: str) -> tuple[Common, DataFrame]:
    """Common lines over all documents: those that executors hold, and the table of the others."""
    path = shared_dir(docs.sparkSession, "lines")
    counts = lines_of(docs, text_col).groupBy("hash").agg(F.count(F.lit(1)).alias("texts"))
    counts.where(F.col("texts") >= COMMON).write.parquet(path)
    counts = docs.sparkSession.read.schema("hash long, texts long").parquet(path)
    least = [1 << b for b in range(48)]
    sizes = counts.agg(*(F.count(F.when(F.col("texts") >= t, 1)).alias(str(t)) for t in least)).first()
    least = next((t for t in least if sizes[str(t)] <= FREQUENT), 1 << 62)
    table, others = counts.where(F.col("texts") >= least).toArrow(), counts.where(F.col("texts") < least)
    hashes, texts = (table.column(c).to_numpy() for c in ("hash", "texts"))
    order = np.argsort(hashes)
    least = max(COMMON, docs.select(F.xxhash64(text_col)).distinct().count() // COMMON_PARTS)
    return Common(hashes[order], texts[order], least), others


def with_rare(docs: DataFrame, others: DataFrame, text_col: str) -> DataFrame:
    """Adds a last column: the common lines (hash, texts) of each text that executors do not hold."""
    rare, key = fresh(docs, "rare"), fresh(docs, "k")
    if others.isEmpty():
        return docs.withColumn(rare, F.expr(NO_LINES))
    met = lines_of(docs, text_col).join(others, "hash").groupBy(F.col("key").alias(key))
    met = met.agg(F.collect_list(F.struct("hash", "texts")).alias(rare))
    both = docs.join(met, F.xxhash64(docs[text_col]) == met[key], "left")
    return both.select(*(docs[c] for c in docs.columns), F.coalesce(rare, F.expr(NO_LINES)).alias(rare))


def fit(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Model | None:
    """Counts the common lines of all documents, and trains on those whose ids come first in hash order."""
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    common, others = common_lines(own, "text")
    ids = own.select("id").where("id is not null").distinct()
    ids = F.broadcast(ids.orderBy(F.xxhash64("id"), "id").limit(sample))  # at most `sample` rows

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            stats = stats_of(text_of(batch, "text"))
            lines = stats.lines
            features = line_features(stats, common.of(stats, batch.column(1)))
            state = distant_states(features, features[:, -1] == 1)
            for a, b in itertools.pairwise(lines.first.tolist()):
                if a < b:
                    # A stretch at a place that the text itself gives.
                    a += int(lines.hash[a]) % max(b - a - LINES + 1, 1)
                    b = min(b, a + LINES)
                    rows = [pa.array([features[a:b].ravel()]), pa.array([state[a:b].astype(np.int32)])]
                    yield pa.RecordBatch.from_arrays(rows, names=["features", "states"])

    schema = "features array<double>, states array<int>"
    rows = with_rare(own.join(ids, "id").select("text"), others, "text")
    rows = map_texts(rows, work, schema).orderBy(F.xxhash64("features"), F.xxhash64("states")).toArrow()
    if not len(rows):
        return None
    features, states = (rows.column(c).combine_chunks() for c in ("features", "states"))
    first = np.concatenate(([0], np.cumsum(states.value_lengths().to_numpy())))
    features = features.flatten().to_numpy().reshape(-1, FEATURES)
    return Model(train(features, states.flatten().to_numpy().astype(np.int8), first), common, others)


def shared_of(docs: DataFrame, model: Model | None, text_col: str):
    """What executors need of a model, and the documents with the column of :func:`with_rare`."""
    shared = docs.sparkSession.sparkContext.broadcast((model.crf, model.common) if model else None)
    if model:
        return shared, with_rare(docs, model.others, text_col)
    return shared, docs.withColumn(fresh(docs, "rare"), F.expr(NO_LINES))


def verdicts(stats: Stats, model: tuple[Crf, Common] | None, rare: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words in content lines, whether the base rules fail and whether the document is kept."""
    lines = stats.lines
    state = np.zeros(len(lines.start), np.int8)
    if model:
        crf, common = model
        state = viterbi(crf, line_features(stats, common.of(stats, rare)), lines.first)
    content = np.bincount(lines.doc, weights=lines.n_words * (state == 0), minlength=len(stats.n_words))
    content = content.astype(np.int64)
    failed = stats.n_words < MIN_WORDS
    failed |= 100 * stats.n_repeat_words > MAX_REPEAT_PERCENT * stats.n_words
    return content, failed, ~failed & (content >= CONTENT_SHARE * stats.n_words)


def judge(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its counts, its words in content lines and the verdict."""
    own = docs.select(id_col, text_col)
    name = own.columns[1]
    shared, rows = shared_of(own, model, name)
    names = [own.columns[0], *COUNTS, "content_words", "base_failed", "kept"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, name):
            stats = stats_of(text_of(batch, name))
            content, failed, kept = verdicts(stats, shared.value, batch.column(2))
            counts = [pa.array(getattr(stats, c), pa.int64()) for c in COUNTS]
            rest = [pa.array(content), pa.array(failed), pa.array(kept)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, *rest], names=names)

    schema = T.StructType([own.schema[0], *(T.StructField(c, T.LongType()) for c in names[1:-2])])
    schema = schema.add("base_failed", T.BooleanType()).add("kept", T.BooleanType())
    return map_texts(rows, work, schema)


def keep_good(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The kept documents, with all their columns."""
    shared, rows = shared_of(docs, model, text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, text_col):
            kept = verdicts(stats_of(text_of(batch, text_col)), shared.value, batch.column(len(docs_columns)))[2]
            yield batch.select(docs_columns).filter(pa.array(kept))

    docs_columns = docs.columns
    return map_texts(rows, work, docs.schema)
