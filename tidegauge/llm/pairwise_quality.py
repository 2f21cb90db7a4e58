"""Quality by Bradley-Terry ranking on preference pairs.

Every good document is preferred to every bad one. A linear score of document features is learnt by
logistic loss on the feature differences of all such pairs. Its threshold is a quantile of the labelled
documents' scores: the one that best separates the labels. The score returned is a logistic of the distance from that
threshold, which lies at ``CUT``.

All labelled documents outside the held-out part are learnt from. The pairs are never made: a pair's loss depends
on the difference of two scores, so each round sums both classes along a grid of ``GRID`` scores, and the loss and its
slope over all pairs follow from these sums, up to the grid's step.

Defined cases: a null or empty text has the features of no text and gets a score; without labels of
both classes every score is 1; null labels and ids are not learnt from.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.llm.labelled import remainder
from tidegauge.llm.textbytes import map_texts, sliced, text_of
from tidegauge.llm.textstats import DIGIT, MARKS, STOP, SYMBOLS, UPPER, Stats, stats_of, sums
from tidegauge.session import shared_dir

#: Points of the grid of scores, and most quasi-Newton steps.
GRID = 2048
ROUNDS = 30
PENALTY = 1e-3
CUT = 0.3


def features(stats: Stats) -> np.ndarray:
    """Shape of each text: shares of kinds of characters, of repetition and of vocabulary."""
    found, lines = stats.found, stats.lines
    data, n = found.data, np.maximum(stats.n_words, 1)
    size = np.maximum(np.diff(found.offsets), 1)
    n_lines = np.diff(lines.first)
    key = found.doc
    order = np.lexsort((found.hash, key))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (np.diff(found.hash[order].view(np.int64)) != 0) | (np.diff(key[order]) != 0)
    distinct = np.bincount(key[order][fresh], minlength=len(n))
    chars = {m: sums(mask[data], found.offsets) for m, mask in (("s", SYMBOLS), ("u", UPPER), ("d", DIGIT), ("m", MARKS), ("p", STOP))}
    closed = STOP[data[lines.end - 1]] if len(lines.end) else np.zeros(0, bool)
    return np.column_stack(
        [
            np.log1p(stats.n_words) / 8,
            np.minimum(stats.word_chars / n / 20, 2),
            np.minimum(chars["s"] / n, 3),
            chars["u"] / size,
            np.minimum(chars["d"] / n, 3),
            np.minimum(chars["m"] / n, 3),
            np.minimum(chars["p"] / n, 3),
            stats.n_dup_lines / np.maximum(n_lines, 1),
            stats.n_repeat_words / n,
            distinct / n,
            np.log1p(n_lines) / 8,
            sums(closed, lines.first) / np.maximum(n_lines, 1),
        ]
    ).astype(np.float64)


@dataclass
class Ranking:
    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    threshold: float = 0.0
    spread: float = 1.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((self.raw(x) - self.threshold) / self.spread + np.log(CUT / (1 - CUT)), -30, 30)
        return np.where(z >= np.log(CUT / (1 - CUT)), np.maximum(1 / (1 + np.exp(-z)), CUT), 1 / (1 + np.exp(-z)))


def moments(x: np.ndarray) -> np.ndarray:
    """Number of rows, sums and sums of products of the features: additive over parts of a class."""
    own = np.column_stack((np.ones(len(x)), x))
    return own.T @ own


def binned(x: np.ndarray, position: np.ndarray) -> np.ndarray:
    """Number of rows and sums of features by grid point, each row shared by the two points around it."""
    low = np.clip(np.floor(position).astype(np.int64), 0, GRID - 2)
    upper = position - low
    out = np.zeros((GRID, x.shape[1] + 1))
    for at, share in ((low, 1 - upper), (low + 1, upper)):
        out[:, 0] += np.bincount(at, share, GRID)
        for k in range(x.shape[1]):
            out[:, k + 1] += np.bincount(at, share * x[:, k], GRID)
    return out


@dataclass
class Grid:
    """Equal steps that hold every score that given weights can give to features within ``low`` and ``high``."""

    weights: np.ndarray
    first: float
    step: float

    @classmethod
    def of(cls, weights: np.ndarray, low: np.ndarray, high: np.ndarray) -> Grid:
        first, last = np.minimum(weights * low, weights * high).sum(), np.maximum(weights * low, weights * high).sum()
        return cls(weights, first, max((last - first) / (GRID - 1), 1e-6))

    def sums(self, x: np.ndarray) -> np.ndarray:
        return binned(x, (x @ self.weights - self.first) / self.step)


def loss_and_slope(grid: Grid, good: np.ndarray, bad: np.ndarray) -> tuple[float, np.ndarray]:
    """Mean logistic loss of all pairs of a good and a bad row, and its slope, from both classes' grid sums.

    The loss of a pair depends on the difference of two scores alone, so what a row meets in the
    other class is a convolution of that class's counts along the grid.
    """
    gap = grid.step * np.arange(1 - GRID, GRID)
    doubt, loss = 1 / (1 + np.exp(np.clip(gap, -500, 500))), np.logaddexp(0, -gap)

    def against(kernel: np.ndarray, counts: np.ndarray) -> np.ndarray:
        size = 4 * GRID
        met = np.fft.irfft(np.fft.rfft(kernel, size) * np.fft.rfft(counts, size), size)
        return met[GRID - 1 : 2 * GRID - 1]

    pairs = good[:, 0].sum() * bad[:, 0].sum()
    mean_loss = good[:, 0] @ against(loss, bad[:, 0]) / pairs
    lifts = against(doubt, bad[:, 0]) @ good[:, 1:] - against(doubt[::-1], good[:, 0]) @ bad[:, 1:]
    return float(mean_loss), -lifts / pairs


def descended(along: Callable[[Grid], tuple[np.ndarray, np.ndarray]], both, low, high, rounds: int) -> np.ndarray:
    """Weights of the least penalised loss, by quasi-Newton steps; ``both`` has the moments of either class."""
    (g, b), k = both, len(low)
    mean = [m[0, 1:] / m[0, 0] for m in (g, b)]
    spread = sum(m[1:, 1:] / m[0, 0] - np.outer(x, x) for m, x in zip((g, b), mean, strict=True))
    # No slope changes faster than a quarter of the pairs' differences allow.
    inverse = np.linalg.inv((spread + np.outer(mean[0] - mean[1], mean[0] - mean[1])) / 4 + (PENALTY + 1e-9) * np.eye(k))

    def at(weights: np.ndarray) -> tuple[float, np.ndarray]:
        grid = Grid.of(weights, low, high)
        loss, slope = loss_and_slope(grid, *along(grid))
        return loss + PENALTY / 2 * weights @ weights, slope + PENALTY * weights

    weights = np.zeros(k)
    loss, slope = at(weights)
    for _ in range(rounds):
        if np.abs(slope).max() < 1e-5:
            break
        step, size = -inverse @ slope, 1.0
        while True:
            new_loss, new_slope = at(weights + size * step)
            if new_loss <= loss + 1e-4 * size * (slope @ step) or size < 1e-3:
                break
            size /= 2
        if new_loss >= loss:
            break
        moved, turned = size * step, new_slope - slope
        if (curve := moved @ turned) > 1e-12:
            left = np.eye(k) - np.outer(moved, turned) / curve
            inverse = left @ inverse @ left.T + np.outer(moved, moved) / curve
        weights, loss, slope = weights + moved, new_loss, new_slope
    return weights


def standardised(both: tuple[np.ndarray, np.ndarray]) -> Ranking:
    """A model without weights, whose mean and scale are those of all rows."""
    total = both[0] + both[1]
    mean = total[0, 1:] / total[0, 0]
    variance = np.diag(total)[1:] / total[0, 0] - mean**2
    return Ranking(np.zeros(len(mean)), mean, np.sqrt(np.maximum(variance, 0)) + 1e-6)


def finished(model: Ranking, weights: np.ndarray, both: tuple[np.ndarray, np.ndarray]) -> Ranking:
    model.weights = weights
    good, bad = (model.raw(m[0, 1:] / m[0, 0]) for m in both)  # the score is linear
    model.spread = float(max(good - bad, 1e-6) / 6)
    return model


def rank(good: np.ndarray, bad: np.ndarray, rounds: int = ROUNDS) -> Ranking:
    """The least logistic loss over all preference pairs, with a small penalty, of rows in memory."""
    model = standardised((moments(good), moments(bad)))
    z = [(x - model.mean) / model.scale for x in (good, bad)]
    both = np.concatenate(z)
    of = tuple(map(moments, z))
    weights = descended(lambda grid: tuple(map(grid.sums, z)), of, both.min(0), both.max(0), rounds)
    model = finished(model, weights, (moments(good), moments(bad)))
    value, label = model.raw(np.concatenate((good, bad))), np.concatenate((np.ones(len(good)), np.zeros(len(bad))))
    order = np.argsort(value, kind="stable")
    # Weighted so that the classes count as often as each other.
    weight = np.where(label[order] == 1, 1 / len(good), 1 / len(bad))
    wrong = np.concatenate(([0], np.cumsum(weight * label[order])))
    wrong += np.concatenate((np.cumsum((weight * (1 - label[order]))[::-1])[::-1], [0]))
    quantile = int(np.argmin(wrong))
    edges = np.concatenate((value[order][:1] - 1, value[order], value[order][-1:] + 1))
    model.threshold = float((edges[quantile] + edges[quantile + 1]) / 2)
    return model


def added(rows: DataFrame, work: Callable[[np.ndarray, np.ndarray], np.ndarray], combine=np.add) -> np.ndarray:
    """``work`` of the features and labels of each part of the rows, combined on executors in a tree."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if len(batch):
                x = batch.column(1).flatten().to_numpy().reshape(len(batch), -1)
                own = work(x, batch.column(0).to_numpy())
                total = own if total is None else combine(total, own)
        if total is not None:
            yield pa.RecordBatch.from_pydict({"part": [total.tobytes()]})

    partial = map_texts(rows.select("label", "made"), parts, "part binary").rdd.map(lambda r: np.frombuffer(r[0]))
    found = partial.treeAggregate(None, lambda a, b: b if a is None else combine(a, b), lambda a, b: a if b is None else b if a is None else combine(a, b), 2)
    return np.zeros(0) if found is None else found


def by_class(work: Callable[[np.ndarray], np.ndarray]) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    return lambda x, label: np.concatenate([work(x[label == c]).ravel() for c in (1, 0)])


def best_cut(rows: DataFrame, model: Ranking, n_good: float, n_bad: float) -> float:
    """The threshold that separates all rows best; scores are sorted in ranges, of which only totals are collected."""
    spark = rows.sparkSession
    terms = [(F.element_at("made", k + 1) - F.lit(float(m))) / F.lit(float(s)) * F.lit(float(w))
             for k, (m, s, w) in enumerate(zip(model.mean, model.scale, model.weights, strict=True))]
    value = sum(terms[1:], terms[0]).alias("value")
    sides = [F.sum((F.col("label") == c).cast("long")).alias(name) for c, name in ((1, "good"), (0, "bad"))]
    each = rows.select("label", value).groupBy("value").agg(*sides)
    path = shared_dir(spark, "ranked")
    each.repartitionByRange("value").withColumn("part", F.spark_partition_id()).write.parquet(path)
    ranked = spark.read.parquet(path)
    totals = ranked.groupBy("part").agg(F.sum("good"), F.sum("bad"), F.min("value"), F.max("value")).collect()
    good, bad, last, before = 0, 0, None, []
    for part, g, b, low, high in sorted(totals, key=lambda r: r[3]):
        before.append((part, good, bad, low - 1 if last is None else last))
        good, bad, last = good + g, bad + b, high
    starts = spark.createDataFrame(before, "part int, g long, b long, below double")
    order = Window.partitionBy("part").orderBy("value")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    cuts = ranked.join(F.broadcast(starts), "part").select(
        "value",
        F.coalesce(F.lag("value").over(order), "below").alias("below"),
        *((F.coalesce(F.sum(c).over(earlier), F.lit(0)) + F.col(c[0])).alias(c) for c in ("good", "bad")),
    )
    wrong = (F.col("good") / F.lit(float(n_good)) + (F.lit(float(n_bad)) - F.col("bad")) / F.lit(float(n_bad))).alias("wrong")
    cut = cuts.select(wrong, "below", "value").orderBy("wrong", "value").first()
    return (cut["below"] + cut["value"]) / 2 if cut["wrong"] <= 1 else last + 0.5


def with_features(docs: DataFrame, keep: list[str], model: Ranking | None) -> DataFrame:
    """The kept columns and each text's features, or its score under the model."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            x = features(stats_of(text_of(batch, "text")))
            held = shared.value
            made = pa.array(held.scores(x)) if held else pa.array(x.tolist(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.select(keep).columns, made], names=[*keep, "made"])

    own = docs.select(*keep, "text")
    kind = T.DoubleType() if model else T.ArrayType(T.DoubleType())
    return map_texts(own, work, T.StructType([own.schema[c] for c in keep]).add("made", kind))


def training_rows(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str, text_col: str) -> DataFrame:
    """``(label, made)``: label and features of every labelled document outside the held-out part, equal rows once."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    known = known.where("id is not null and label in (0, 1)").where(remainder("id", 5) != 0).distinct()
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    own = own.where("id is not null").where(remainder("id", 5) != 0).withColumn("key", F.xxhash64("text"))
    # Features are in the shuffle, and not texts.
    rows = with_features(own, ["id", "key"], None).join(known, "id")
    return rows.dropDuplicates(["id", "key", "label"]).select("label", "made")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    rounds: int = ROUNDS,
    label_col: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Ranking | None:
    spark, path = docs.sparkSession, shared_dir(docs.sparkSession, "features")
    training_rows(docs, labels, label_col, id_col, text_col).write.parquet(path)
    rows = spark.read.parquet(path)
    found = added(rows, by_class(moments))
    both = found.reshape(2, *([int(np.sqrt(len(found) / 2))] * 2))
    if not len(found) or not both[0, 0, 0] or not both[1, 0, 0]:
        return None
    model = standardised(tuple(both))

    def scaled(x: np.ndarray) -> np.ndarray:
        return (x - model.mean) / model.scale

    edges = added(rows, lambda x, label: np.concatenate((scaled(x).max(0), -scaled(x).min(0))), np.maximum)
    high, low = edges[: len(model.mean)], -edges[len(model.mean) :]

    def along(grid: Grid) -> tuple[np.ndarray, np.ndarray]:
        return tuple(added(rows, by_class(lambda x: grid.sums(scaled(x)))).reshape(2, GRID, -1))

    unit = tuple(added(rows, by_class(lambda x: moments(scaled(x)))).reshape(both.shape))
    model = finished(model, descended(along, unit, low, high, rounds), tuple(both))
    model.threshold = best_cut(rows, model, both[0, 0, 0], both[1, 0, 0])
    return model


def score(docs: DataFrame, model: Ranking | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its id, whether it is held out, and a score from 0 to 1."""
    name = docs.select(id_col).columns[0]
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    held_out = (remainder("id", 5) == 0).alias("held_out")
    if model is None:
        return own.select(F.col("id").alias(name), held_out, F.lit(1.0).alias("score"))
    return with_features(own, ["id"], model).select(F.col("id").alias(name), held_out, F.col("made").alias("score"))
