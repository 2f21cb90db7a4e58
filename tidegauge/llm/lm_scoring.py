"""Language-model scores by prediction by partial matching (PPM) over bytes.

Each text, in lower case, is a sequence of bytes and one end symbol. The trie holds how often each
symbol follows each context of up to ``ORDER`` bytes in all training texts, counted by Spark. A symbol
is coded in the longest known context; a context that does not have it is left with an escape, whose
probability comes from the number of kinds of symbols seen there (method C), and the symbols of
longer contexts are excluded from shorter ones. The score is the sum of log10 probabilities.

The trie is a set of tables of all counted events, of any size: events with their counts, and contexts
with totals, kinds and excluded totals. Executors hold only the values of the most frequent events of the
longest order, at most ``MAX_NODES`` of them; each text's other events, counted, meet their values in a
join. Every value comes from all counts, so the bound decides cost only, never a score.

Beside it stands a unigram score with additive smoothing, whose counts are exact. Words counted at
least N / ``FREQUENT`` times, of which there are at most ``FREQUENT``, are looked up locally; all
others meet their counts in a join.

Defined cases: a null or empty text is the end symbol alone; a null id counts as the empty text where
its remainder is taken; rows with equal ids are scored one by one; without training texts every
symbol is uniform; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.llm.labelled import remainder
from tidegauge.llm.textbytes import LOWER, NOT_SPACE, STEP, Words, flat, map_texts, sliced, text_of, words
from tidegauge.session import shared_dir

ORDER = 4
MAX_NODES = 1 << 21
FREQUENT = 1 << 20
HELD_OUT = 10
END_WORD = np.uint64(0x5851F42D4C957F2D)
END_SYMBOL = 0xFF  # never a byte of UTF-8
SLOT_BITS = 22


def mask(size: int) -> np.uint64:
    return np.uint64((1 << (8 * size)) - 1)


def events(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For each symbol the code of its context and itself, and where each text begins."""
    data, offsets = flat(column)
    texts = len(offsets) - 1
    size = np.diff(offsets)
    framed = np.full(len(data) + (ORDER + 1) * texts, END_SYMBOL, np.uint8)
    doc = np.repeat(np.arange(texts), size)
    framed[np.arange(len(data)) + ORDER + (ORDER + 1) * doc] = LOWER[data]
    code = framed[: len(framed) - ORDER].astype(np.uint64)
    for k in range(1, ORDER + 1):
        code <<= np.uint64(8)
        code |= framed[k : len(framed) - ORDER + k]
    real = np.ones(len(code), bool)  # by the place of the context's first byte
    begin = (offsets[:-1] + (ORDER + 1) * np.arange(texts)).astype(np.int64)
    for k in range(1, ORDER + 1):
        real[begin[1:] - k] = False
    return code[real], offsets[:-1] + np.arange(texts)


def tokens(found: Words) -> np.ndarray:
    """Hashes of the words and of each text's end."""
    return np.insert(found.hash, found.first[1:], END_WORD)


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, back = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
    return codes, np.bincount(back, weights=np.concatenate([n for _, n in parts])).astype(np.int64)


def corpus_counts(docs: DataFrame) -> DataFrame:
    """``(kind, code, n)`` over all texts: kind 0 for symbols in context, 1 for words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[tuple[np.ndarray, np.ndarray]]] = [[], []]
        for batch in sliced(batches, "text"):
            column = text_of(batch, "text")
            for kind, values in ((0, events(column)[0]), (1, tokens(words(column, NOT_SPACE)))):
                held[kind].append(np.unique(values, return_counts=True))
                if sum(len(c) for c, _ in held[kind]) > 3_000_000:
                    held[kind] = [merged(held[kind])]
                    if len(held[kind][0][0]) > 2_000_000:
                        yield from rows(kind, *held[kind].pop())
        for kind in (0, 1):
            if held[kind]:
                yield from rows(kind, *merged(held[kind]))

    def rows(kind: int, codes: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        for a in range(0, len(codes), 200_000):
            part = codes[a : a + 200_000].view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(part), kind, np.int32)), pa.array(part), pa.array(n[a : a + 200_000])],
                names=["kind", "code", "n"],
            )

    partial = map_texts(docs.select("text"), work, "kind int, code long, n long")
    return partial.groupBy("kind", "code").agg(F.sum("n").alias("n"))


def shorter(code: Column, size: int) -> Column:
    """The last ``size`` bytes of codes."""
    return code.bitwiseAND(F.lit(int(mask(size))))


class Trie:
    """Tables of events and contexts of each order, and the probabilities that follow from them."""

    def __init__(self, symbols: DataFrame) -> None:
        self.symbols, self.contexts = symbols, []

    def prepare(self) -> None:
        """Stores each order's contexts with totals, kinds, excluded totals and the counts of their symbols."""
        if self.contexts:
            return
        below = None
        for k in range(ORDER + 1):
            level = self.symbols
            if k < ORDER:
                level = level.groupBy(shorter(F.col("code"), k + 1).alias("code")).agg(F.sum("n").alias("n"))
                level = stored(self.symbols.sparkSession, level, "events")
            own, lower = level, F.lit(0).cast("long")
            if k:
                known = below.select(F.col("code").alias("suffix"), F.col("n").alias("lower"))
                own, lower = level.join(known, shorter(F.col("code"), k) == F.col("suffix")), F.col("lower")
            # A context has at most 256 symbols.
            symbol = F.struct(shorter(F.col("code"), 1).cast("int"), "n")
            context = own.groupBy(F.shiftright("code", 8).alias("context")).agg(
                F.sum("n").cast("double").alias("total"),
                F.count(F.lit(1)).cast("double").alias("kinds"),
                F.sum(lower).cast("double").alias("excluded"),
                *([F.map_from_entries(F.collect_list(symbol)).alias("children")] if k < ORDER else []),
            )
            self.contexts.append(stored(self.symbols.sparkSession, context, "contexts"))
            below = level

    def learnt(self) -> DataFrame:
        """``(code, n, value)`` of every event of the longest order that was learnt."""
        self.prepare()
        events = self.symbols.withColumn("context", F.shiftright("code", 8))
        value = F.log10(F.col("n") / (F.col("total") + F.col("kinds")))
        return events.join(self.contexts[ORDER], "context").select("code", "n", value.alias("value"))

    def unseen(self, codes: DataFrame) -> DataFrame:
        """``(code, value)`` of events that were not learnt: escapes from the longest context down."""
        self.prepare()
        at = codes.select("code", F.lit(0.0).alias("value"), F.lit(False).alias("done"))
        at = at.withColumns({"gone": F.lit(0.0), "out_of": F.lit(0.0)})  # excluded kinds, and their count
        for k in range(ORDER, -1, -1):
            level = self.contexts[k]
            context = shorter(F.shiftright("code", 8), k)
            n = F.try_element_at(F.col("children"), shorter(F.col("code"), 1).cast("int")) if k < ORDER else F.lit(None)
            # Contexts of up to one byte are at most 257 rows, and hold a large share of the events each.
            at = at.join(F.broadcast(level) if k < 2 else level, context == F.col("context"), "left")
            known = F.col("context").isNotNull()
            kinds = F.col("kinds") - F.col("gone")
            whole = F.col("total") - F.col("out_of") + kinds
            escape = F.when(kinds > 0, F.log10(kinds / whole)).otherwise(0.0)
            step = F.coalesce(F.log10(F.col("n") / whole), escape)
            at = at.withColumn("n", n.cast("long")).select(
                "code",
                F.when(F.col("done") | ~known, F.col("value")).otherwise(F.col("value") + step).alias("value"),
                (F.col("done") | (known & F.col("n").isNotNull())).alias("done"),
                F.when(known, F.col("kinds")).otherwise(F.col("gone")).alias("gone"),
                F.when(known, F.col("excluded")).otherwise(F.col("out_of")).alias("out_of"),
            )
        uniform = F.when(F.col("done"), 0.0).otherwise(F.log10(F.greatest(256 - F.col("gone"), F.lit(1.0))))
        return at.select("code", (F.col("value") - uniform).alias("value"))

    def values(self, codes: DataFrame) -> DataFrame:
        """``(code, value)``: log10 of each distinct event's probability."""
        learnt = self.learnt().select("code", "value")
        new = codes.join(learnt, "code", "left_anti")
        return codes.join(learnt, "code").select("code", "value").unionByName(self.unseen(new))

    def log_probability(self, code: np.ndarray) -> np.ndarray:
        """The values of a few events, brought to the driver."""
        wanted, back = np.unique(code, return_inverse=True)
        rows = [(int(c),) for c in wanted]
        frame = self.symbols.sparkSession.createDataFrame(rows, "code long")
        found = {r["code"]: r["value"] for r in self.values(frame).collect()}
        return np.array([found[int(c)] for c in wanted])[back]

    def frequent(self) -> Values:
        """The most frequent events, counted at least 2^k times for the smallest k that suffices."""
        least = [1 << b for b in range(48)]
        sizes = self.symbols.agg(*(F.count(F.when(F.col("n") >= t, 1)).alias(str(t)) for t in least)).first()
        least = next((t for t in least if sizes[str(t)] <= MAX_NODES), 1 << 62)
        table = self.learnt().where(F.col("n") >= least).toArrow()
        code, n, value = (table.column(c).to_numpy() for c in ("code", "n", "value"))
        return Values(code.astype(np.uint64), n, value)


class Values:
    """Values of some events, looked up locally."""

    def __init__(self, code: np.ndarray, n: np.ndarray, value: np.ndarray) -> None:
        order = np.argsort(n, kind="stable")  # the most frequent is written last
        self.by_count = code[order], value[order]
        order = np.argsort(code)
        self.codes, self.values = code[order], value[order]
        self.keys = None

    def prepare(self) -> None:
        if self.keys is not None:
            return
        code, value = self.by_count
        self.keys = np.full(1 << SLOT_BITS, np.uint64(0xFFFFFFFFFFFFFFFF))
        self.held = np.zeros(1 << SLOT_BITS)
        slot = self.slot(code)
        self.keys[slot] = code
        kept = self.keys[slot] == code
        self.held[slot[kept]] = value[kept]

    @staticmethod
    def slot(code: np.ndarray) -> np.ndarray:
        return ((code * STEP) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)

    @staticmethod
    def find(known: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(known):
            return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
        row = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
        return row, known[row] == wanted

    def of(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each event's value, and whether it is here."""
        self.prepare()
        slot = self.slot(code)
        value, here = self.held[slot], self.keys[slot] == code
        missed = np.flatnonzero(~here)
        rare, back = np.unique(code[missed], return_inverse=True)
        row, there = self.find(self.codes, rare)
        if len(self.codes):
            value[missed] = np.where(there, self.values[row], 0.0)[back]
            here[missed] = there[back]
        return value, here


def build_trie(counts: DataFrame) -> Trie:
    """The trie of all counted events."""
    return Trie(counts.where("kind = 0").select("code", "n"))


def folded(code: np.ndarray, doc: np.ndarray, texts: int) -> tuple[pa.Array, pa.Array]:
    """Each text's different codes, and how often it has them; ``doc`` ascends."""
    order = np.lexsort((code, doc))
    code, doc = code[order], doc[order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    times = np.diff(np.append(first, len(code)))
    lists = pa.array(np.searchsorted(doc[first], np.arange(texts + 1)).astype(np.int32))
    codes = pa.array(code[first].view(np.int64))
    return pa.ListArray.from_arrays(lists, codes), pa.ListArray.from_arrays(lists, pa.array(times))


def with_scores(docs: DataFrame, values: Values, frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Per text: the sums over frequent events and words, and its other ones with their counts."""
    spark = docs.sparkSession
    shared, known = spark.sparkContext.broadcast(values), spark.sparkContext.broadcast(frequent)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts = known.value
        logs = np.log10(counts + 0.1)
        row = TaskContext.get().partitionId() << 33
        for batch in sliced(batches, "text"):
            column = text_of(batch, "text")
            found = words(column, NOT_SPACE)
            texts = len(column)
            token = tokens(found)
            doc = np.repeat(np.arange(texts), found.counts + 1)
            at, there = Values.find(hashes, token)
            base = np.bincount(doc[there], weights=logs[at[there]], minlength=texts).astype(float)
            seen = np.bincount(doc[there], minlength=texts)
            code, begin = events(column)
            value, here = shared.value.of(code)
            symbols = np.diff(np.append(begin, len(code)))
            home = np.repeat(np.arange(texts), symbols)
            score = np.bincount(home, weights=value * here, minlength=texts).astype(float)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.select(["id", "held_out"]).columns,
                    pa.array(np.arange(row, row + texts)),
                    pa.array(found.counts + 1),
                    pa.array(seen),
                    pa.array(base),
                    pa.array(score),
                    *folded(token[~there], doc[~there], texts),
                    *folded(code[~here], home[~here], texts),
                ],
                names=schema.names,
            )
            row += texts

    own = docs.select("id", "held_out", "text")
    schema = T.StructType([own.schema["id"], own.schema["held_out"], T.StructField("row", T.LongType())])
    schema = schema.add("n_tokens", T.LongType()).add("n_known", T.LongType())
    schema = schema.add("base", T.DoubleType()).add("score", T.DoubleType())
    for name in ("rare", "times", "events", "event_times"):
        schema = schema.add(name, T.ArrayType(T.LongType()))
    return map_texts(own, work, schema)


def stored(spark: SparkSession, df: DataFrame, purpose: str) -> DataFrame:
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Learns from the documents outside the held-out tenth and scores all of them.

    Returns the id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``
    and ``score``.
    """
    spark = docs.sparkSession
    name = docs.select(id_col).columns[0]
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    own = own.withColumn("held_out", remainder("id", HELD_OUT) == 0)
    counts = stored(spark, corpus_counts(own.where("not held_out")), "counts")
    vocabulary = counts.where("kind = 1").select("code", "n")
    total, kinds = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    least = -(-total // FREQUENT)
    frequent = vocabulary.where(F.col("n") >= least).toArrow()  # at most FREQUENT rows
    hashes = frequent.column("code").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    frequent = hashes[order], frequent.column("n").to_numpy()[order]
    trie = build_trie(counts)
    scored = stored(spark, with_scores(own, trie.frequent(), frequent), "scores")
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("w"))
    rare = rare.select("row", F.col("w.rare").alias("code"), F.col("w.times").alias("times"))
    # Every rare word that was learnt is joined; the others have count 0 and are left out here.
    met = rare.join(vocabulary.where(F.col("n") < least), "code")
    gain = F.log10(F.col("n") + 0.1) - F.log10(F.lit(0.1))
    sums = met.groupBy("row").agg(
        F.sum(F.col("times") * gain).alias("gain"), F.sum("times").alias("more")
    )
    left = scored.select("row", F.explode(F.arrays_zip("events", "event_times")).alias("e"))
    left = left.select("row", F.col("e.events").alias("code"), F.col("e.event_times").alias("times"))
    values = stored(spark, trie.values(left.select("code").distinct()), "values")
    further = left.join(values, "code").groupBy("row").agg(F.sum(F.col("times") * F.col("value")).alias("further"))
    both = scored.drop("rare", "times", "events", "event_times")
    both = both.join(sums, "row", "left").join(further, "row", "left")
    unknown = F.col("n_tokens") - F.col("n_known")
    base = F.col("base") + unknown * F.log10(F.lit(0.1)) + F.coalesce("gain", F.lit(0.0))
    base = base - F.col("n_tokens") * float(np.log10(total + 0.1 * (kinds + 1)))
    return both.select(
        F.col("id").alias(name),
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        (F.col("score") + F.coalesce("further", F.lit(0.0))).alias("score"),
    )
