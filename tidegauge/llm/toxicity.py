"""Toxicity by class-conditional Kneser-Ney models.

Two models predict the bytes of each word from the word's beginning: the last ``ORDER - 1`` bytes,
reaching back no further than the space before the word. The highest order is counted by class;
all lower orders are continuation counts shared by both classes. A gram that a class has not seen gets
that class's own backoff mass of the longest context it knows, times the shared lower order, so an
expression that is rare in a class is smoothed alike in both. A toxic document is mostly ordinary
language, so the toxic class draws each word from its own counts with probability ``MIX`` and from the
ordinary ones otherwise. The score compares the log-likelihoods of the whole text under the two classes, each
divided by the number of words.

The model is fitted on at most ``per_class`` labelled documents of each class, and at most as many rows. Counts
of three of four of them give the threshold on the fourth; counts of all give the model. Everything else
covers all documents.

Defined cases: a null or empty text has no words, and both its log-likelihoods are 0; without labels of both
classes every score is 0; null labels and ids are not learnt from; a document that occurs twice is
scored twice; equal errors put the threshold into the widest gap, then the lowest; texts of any length are read
whole, in slices; an empty table gives no rows. Only the id and text columns are read, so other columns' names
never clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.llm.labelled import labelled_texts, remainder
from tidegauge.llm.textbytes import ALNUM, Words, map_texts, sliced, text_of, words

ORDER = 5
DISCOUNT = 0.75
MIX = 0.005
PER_CLASS = 4000


def grams(found: Words) -> np.ndarray:
    """For each byte of each word, a code of it and its context."""
    size = found.end - found.start
    total = int(size.sum())
    depth = np.arange(total) - np.repeat(np.cumsum(size) - size, size)  # bytes of the word before it
    at = np.repeat(found.start, size) + depth
    code = np.zeros(total, np.uint64)
    for back in range(ORDER - 1, -1, -1):
        byte = np.where(back <= depth, found.data[at - np.minimum(back, depth)], 0x20).astype(np.uint64)
        code = np.where(back <= depth + 1, (code << np.uint64(8)) | byte, code)
    return code


@dataclass
class Level:
    """Log-probabilities of the known grams of one order, and log backoff masses of its contexts."""

    codes: np.ndarray
    logs: np.ndarray
    contexts: np.ndarray
    backoff: np.ndarray


def find(table: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where sorted ``table`` has each value, and whether it does."""
    if not len(table):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    row = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return row, table[row] == values


def last_bytes(codes: np.ndarray, order: int) -> np.ndarray:
    return codes & np.uint64((1 << (8 * order)) - 1)


def level(codes: np.ndarray, counts: np.ndarray, lower: np.ndarray) -> Level:
    """Kneser-Ney interpolation of counts with lower-order probabilities of the same grams."""
    contexts, context = np.unique(codes >> np.uint64(8), return_inverse=True)
    total = np.bincount(context, weights=counts)
    taken = np.minimum(counts, DISCOUNT)
    # A context that the class lacks leaves everything to the lower order.
    mass = np.where(total > 0, np.bincount(context, weights=taken) / np.maximum(total, 1e-9), 1.0)
    own = (counts - taken) / np.maximum(total, 1e-9)[context]
    return Level(codes, np.log(own + mass[context] * lower), contexts, np.log(mass))


def shared_levels(codes: np.ndarray, counts: np.ndarray, order: int) -> list[Level]:
    """The levels of ``order`` and all lower ones, highest first, of grams with continuation counts."""
    if order == 1:
        share = np.bincount(codes.astype(np.int64), weights=counts, minlength=256)
        every = np.log(0.99 * share / share.sum() + 0.01 / 256)
        return [Level(np.arange(256, dtype=np.uint64), every, np.zeros(0, np.uint64), np.zeros(0))]
    shorter, back = np.unique(last_bytes(codes, order - 1), return_inverse=True)
    kinds = np.bincount(back)  # how many longer contexts continue with it
    lower = shared_levels(shorter, kinds.astype(float), order - 1)
    return [level(codes, counts, np.exp(lower[0].logs[find(lower[0].codes, shorter)[0]])[back]), *lower]


def shared_logs(levels: list[Level], codes: np.ndarray) -> np.ndarray:
    """Log-probabilities under the shared orders; ``levels`` are those of ORDER - 1 and down."""
    out = np.zeros(len(codes))
    todo = np.arange(len(codes))
    for order, own in zip(range(ORDER - 1, 0, -1), levels, strict=True):
        code = last_bytes(codes[todo], order)
        row, hit = find(own.codes, code)
        out[todo[hit]] += own.logs[row[hit]]
        todo, code = todo[~hit], code[~hit]
        row, hit = find(own.contexts, code >> np.uint64(8))
        out[todo[hit]] += own.backoff[row[hit]]
    return out


@dataclass
class ToxicityModel:
    """The classes' own highest orders, toxic first, the shared lower ones, and the threshold and scale
    of a document's mean difference."""

    own: tuple[Level, Level]
    shared: list[Level]
    threshold: float = 0.0
    scale: float = 1.0

    def log_likelihoods(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each text: under the toxic class, under the ordinary one, and the number of words."""
        found = words(column, ALNUM)
        texts, count = len(found.first) - 1, found.counts
        if not len(found.start):
            return np.zeros(texts), np.zeros(texts), count
        code, back = np.unique(grams(found), return_inverse=True)
        row, known = find(self.own[0].codes, code)
        lower = shared_logs(self.shared, code[~known])
        context, seen = find(self.own[0].contexts, code[~known] >> np.uint64(8))
        size = found.end - found.start
        logs = []
        for own in self.own:
            each = np.empty(len(code))
            each[known] = own.logs[row[known]]
            each[~known] = lower + np.where(seen, own.backoff[context], 0)
            logs.append(np.add.reduceat(each[back], np.cumsum(size) - size))
        mixed = np.logaddexp(np.log(MIX) + logs[0], np.log1p(-MIX) + logs[1])
        toxic, ordinary = (np.bincount(found.doc, weights=x, minlength=texts) for x in (mixed, logs[1]))
        return toxic, ordinary, count

    def means(self, column: pa.Array) -> np.ndarray:
        """The difference of the length-normalised log-likelihoods of each text."""
        toxic, ordinary, count = self.log_likelihoods(column)
        return (toxic - ordinary) / np.maximum(count, 1)

    def scores(self, means: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip((means - self.threshold) / self.scale, -30, 30)))


def fit_counts(codes: np.ndarray, toxic: np.ndarray, ordinary: np.ndarray) -> ToxicityModel:
    """A model of sorted distinct grams with their counts in both classes."""
    shorter, back = np.unique(last_bytes(codes, ORDER - 1), return_inverse=True)
    shared = shared_levels(shorter, np.bincount(back).astype(float), ORDER - 1)
    lower = np.exp(shared[0].logs)[back]
    return ToxicityModel((level(codes, toxic.astype(float), lower), level(codes, ordinary.astype(float), lower)), shared)


def calibrated(model: ToxicityModel, means: np.ndarray, toxic: np.ndarray) -> ToxicityModel:
    """The threshold with the fewest errors, in the middle of its gap."""
    order = np.argsort(means, kind="stable")
    value, label = means[order], toxic[order]
    errors = np.concatenate(([0], np.cumsum(label))) + np.concatenate((np.cumsum((1 - label)[::-1])[::-1], [0]))
    padded = np.concatenate(([value[0] - 1e-3], value, [value[-1] + 1e-3]))
    width = np.diff(padded)
    best = np.lexsort((-width, errors))[0]
    model.threshold = float((padded[best] + padded[best + 1]) / 2)
    spread = means[toxic == 1].mean() - means[toxic == 0].mean()
    model.scale = float(max(spread, 1e-6) / 6)
    return model


def fit(
    docs: DataFrame,
    labels: DataFrame,
    per_class: int = PER_CLASS,
    label_col: str = "toxic",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> ToxicityModel | None:
    rows = labelled_texts(docs, labels, label_col, per_class, id_col, text_col)
    rows = rows.withColumn("tuning", F.pmod(F.xxhash64("id", F.lit("tuning")), F.lit(4)) == 0)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            found = words(text_of(batch, "text"), ALNUM)
            label, tuning = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.uint64) for k in (1, 2))
            flags = (label << np.uint64(1) | tuning)[np.repeat(found.doc, found.end - found.start)]
            code, n = np.unique((grams(found) << np.uint64(2)) | flags, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(code.view(np.int64)), pa.array(n)], names=["code", "n"])

    learnt = map_texts(rows.select("text", "label", "tuning"), count, "code long, n long")
    table = learnt.groupBy("code").agg(F.sum("n").alias("n")).toPandas().sort_values("code")
    coded, n = table["code"].to_numpy().astype(np.uint64), table["n"].to_numpy(float)
    trial, model = fit_part(coded, n, coded & np.uint64(1) == 0), fit_part(coded, n, np.ones(len(n), bool))
    if model is None:
        return None
    held = with_means(rows.where("tuning").select("text", "label"), trial or model, ["label"]).toPandas()
    if held["label"].nunique() < 2:
        held = with_means(rows.select("text", "label"), model, ["label"]).toPandas()
    return calibrated(model, held["mean"].to_numpy(), held["label"].to_numpy())


def fit_part(coded: np.ndarray, n: np.ndarray, part: np.ndarray) -> ToxicityModel | None:
    """The model of some of the rows; None unless they have words of both classes."""
    coded, n = coded[part], n[part]
    toxic = (coded >> np.uint64(1)) & np.uint64(1) == 1
    if not toxic.any() or toxic.all():
        return None
    codes, back = np.unique(coded >> np.uint64(2), return_inverse=True)
    return fit_counts(codes, *(np.bincount(back, weights=n * x, minlength=len(codes)) for x in (toxic, ~toxic)))


def with_means(docs: DataFrame, model: ToxicityModel, keep: list[str]) -> DataFrame:
    """The kept columns and the mean ratio of each text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            means = shared.value.means(text_of(batch, "text"))
            yield pa.RecordBatch.from_arrays([*batch.select(keep).columns, pa.array(means)], names=[*keep, "mean"])

    own = docs.select(*keep, "text")
    schema = T.StructType([own.schema[c] for c in keep]).add("mean", T.DoubleType())
    return map_texts(own, work, schema)


def score(
    docs: DataFrame, model: ToxicityModel | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: its id, whether it is held out, and a score from 0 to 1."""
    name = docs.select(id_col).columns[0]
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    held_out = (remainder("id", 5) == 0).alias("held_out")
    if model is None:
        return own.select(F.col("id").alias(name), held_out, F.lit(0.0).alias("score"))
    value = (F.col("mean") - F.lit(model.threshold)) / F.lit(model.scale)
    logistic = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), value))))
    return with_means(own, model, ["id"]).select(F.col("id").alias(name), held_out, logistic.alias("score"))
