"""Groups of spelling variants in a corpus's vocabulary, by composing finite-state machines.

**Vocabulary.** Words are maximal runs of ``[A-Za-z\\u00C0-\\u00FF]`` with A-Z lower-cased. Tasks add
up counts as they read, Spark adds those up; words of ``shortest`` letters and ``fewest`` occurrences stay.

**Near words** differ by exactly one inserted, deleted or replaced letter. They are the pairs that the
composition A . E . A accepts: A is the minimal acyclic acceptor of the words and E the transducer that
makes one edit. Before the edit both sides of the composition are in one state of A, so it is
worked off per state: at each state p, a replacement goes on in the pair of two successors of p, a
deletion in the pair of a successor and p itself, and from there both sides read the same letters. The
common words of a pair of states are found once, whatever paths lead to it. Only first differences count,
so a pair is accepted by one path. States carry the number of words they accept, so a word is
identified by the sum along its path, and pairs of words by two numbers.

**Partitions.** A pair whose shorter word has m letters shares its first ``m // 2`` letters, or else
its last ``m - m // 2``. So the machine is cut by initial state: the state that the shared letters
lead to, of A or of the acceptor of the reversed words. Each word goes to at most four such
partitions. One with more than ``PART`` words is cut again, by the next letter; its pairs that
differ at that very letter agree in all others and meet by equality on these, in groups of at
most one word for each letter and one without. So no task holds an unbounded group, and none is capped.

**Forms.** A word's form is its near word of largest count (ties: the smallest in code-point order),
if that is ``ratio`` times its own or more; its root is found by following forms. Counts grow
by the ratio at each step, so there are few steps; each is a join and a written table.

Defined cases: null and empty texts have no words; a null id counts as an empty one where ids matter;
repeated rows count each time; words of any length are handled; an empty table gives no rows. Only the
id and text columns are read, so other columns' names never clash.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.textbytes import map_texts, text_of
from tidegauge.session import shared_dir

SHORTEST, FEWEST, RATIO = 7, 2, 10
#: Words of a partition of the machine that one task holds.
PART = 4096
#: Distinct words that a task counts before it passes the counts on.
COUNTED = 1 << 18
#: Parts a word and the rest of a path; no letter of a word is below it.
CUT = "\t"

LETTERS = re.compile(rb"[a-z\xc0-\xff]+")

Edit = Callable[[object, Counter], Counter]


def vocabulary(
    docs: DataFrame,
    shortest: int = SHORTEST,
    fewest: int = FEWEST,
    edit: Edit | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(word, n)``: the words of all texts with their counts.

    ``edit`` may change a text's words before they are counted: it gets the text's id and the counts of
    its words, in Latin-1 bytes, and returns counts.
    """
    own = docs.select(F.col(id_col), F.col(text_col).alias("__text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def passed_on() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in counts], pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(counts.values(), pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), text_of(batch, "__text").to_pylist(), strict=True):
                # Letters are those of Latin-1: what it lacks becomes a question mark, which parts words.
                found = Counter(LETTERS.findall((text or "").encode("latin-1", "replace").lower()))
                for word, n in (edit(doc, found) if edit else found).items():
                    if len(word) >= shortest:
                        counts[word] += n
                if len(counts) >= COUNTED:
                    yield passed_on()
                    counts.clear()
        yield passed_on()

    counted = map_texts(own, work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= fewest)


class Acceptor:
    """The minimal acyclic acceptor of sorted distinct words, with the number of words of each state.

    ``moves[p]`` maps a letter to ``(successor, words of p that sort before those it leads to)``.
    Successors are numbered before the states that lead to them.
    """

    def __init__(self, words: list[str]) -> None:
        self.moves: list[dict[str, tuple[int, int]]] = []
        self.final: list[bool] = []
        self.size: list[int] = []
        self.known: dict[tuple, int] = {}
        path: list[tuple[dict[str, int], bool]] = [({}, False)]
        before = ""
        for word in words:
            same = 0
            for a, b in zip(before, word, strict=False):
                if a != b:
                    break
                same += 1
            self.closed(path, before, same)
            path.extend(({}, False) for _ in range(len(word) - same))
            path[-1] = path[-1][0], True
            before = word
        self.closed(path, before, 0)
        self.start = self.registered(*path[0])

    def closed(self, path: list, word: str, depth: int) -> None:
        """Registers the states of the last word below ``depth``."""
        while len(path) > depth + 1:
            state = self.registered(*path.pop())
            path[-1][0][word[len(path) - 1]] = state

    def registered(self, moves: dict[str, int], final: bool) -> int:
        key = final, *moves.items()
        state = self.known.get(key)
        if state is None:
            state = self.known[key] = len(self.moves)
            size, own = int(final), {}
            for letter, to in moves.items():
                own[letter] = to, size
                size += self.size[to]
            self.moves.append(own)
            self.final.append(final)
            self.size.append(size)
        return state


def shared(machine: Acceptor, p: int, q: int, memo: dict) -> list[tuple[int, int]]:
    """Words that both states accept, as pairs of their numbers among the words of p and of q."""
    moves, final = machine.moves, machine.final
    before_p = before_q = 0
    while p != q:
        mine, other = moves[p], moves[q]
        # Chains of single moves are followed in place, so long words need no deep recursion.
        if len(mine) != 1 or len(other) != 1 or (final[p] and final[q]):
            break
        ((a, (to_p, n_p)),) = mine.items()
        if a not in other:
            return []
        to_q, n_q = other[a]
        p, q, before_p, before_q = to_p, to_q, before_p + n_p, before_q + n_q
    if p == q:
        return [(before_p + k, before_q + k) for k in range(machine.size[p])]
    found = memo.get((p, q))
    if found is None:
        found = [(0, 0)] if final[p] and final[q] else []
        mine, other = moves[p], moves[q]
        for a in mine.keys() & other.keys():
            (x, i), (y, j) = mine[a], other[a]
            found += [(i + k, j + m) for k, m in shared(machine, x, y, memo)]
        memo[p, q] = found
    if before_p or before_q:
        return [(before_p + k, before_q + m) for k, m in found]
    return found


def near_pairs(words: list[str]) -> list[tuple[int, int]]:
    """Pairs of sorted distinct words that the composition accepts, by their places."""
    machine, memo = Acceptor(words), {}
    pairs: list[list[tuple[int, int]]] = []  # below each state, by numbers among its words
    for p, moves in enumerate(machine.moves):
        own: list[tuple[int, int]] = []
        items = list(moves.items())
        for k, (a, (x, i)) in enumerate(items):
            if not i and not own and len(items) == 1:
                own = pairs[x]  # a chain shares its end's list
            else:
                own = own + [(i + m, i + n) for m, n in pairs[x]]
            for _, (y, j) in items[k + 1 :]:  # a replaced letter
                own = own + [(i + m, j + n) for m, n in shared(machine, x, y, memo)]
            # A deleted letter: the successor goes on as p does, but not by the same letter, which
            # would be a later first difference.
            if machine.final[p] and machine.final[x]:
                own = own + [(i, 0)]
            for b in machine.moves[x].keys() & moves.keys():
                if b != a:
                    (y, j), (z, n) = machine.moves[x][b], moves[b]
                    own = own + [(i + j + m, n + r) for m, r in shared(machine, y, z, memo)]
        pairs.append(own)
    return pairs[machine.start]


def common_prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n - 1
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid - 1)
    return low


def neighbours(
    side: str, base: int, at: int, paths: list[str], counts: list[int], only_here: bool
) -> list[tuple[str, int, int, str]]:
    """``(word, near words, the largest count among them, the smallest word with it)`` of a partition.

    ``paths`` are the words in reading direction, sorted. A pair belongs to it if its shorter word is
    cut at ``base`` letters and, read backwards, if its first difference forwards is not past the cut.
    ``only_here``: the paths agree but for the letter ``at``, which may be missing.
    """
    forward = side == "F"
    if only_here:
        rest = sorted(range(len(paths)), key=lambda k: len(paths[k]))
        short = rest[0] if len(paths[rest[0]]) < len(paths[rest[-1]]) else None
        pairs = [(a, b) for k, a in enumerate(rest) for b in rest[k + 1 :] if a != short]
        if short is not None:
            # Where the short word goes on with the same letter, the first difference is a later one.
            then = paths[short][at : at + 1]
            pairs += [(k, short) for k in rest[1:] if paths[k][at] != then]
    else:
        pairs = [(a, b) for a, b in near_pairs([p[at:] for p in paths])]
    near: dict[int, list] = {}
    for a, b in pairs:
        x, y = paths[a], paths[b]
        shorter = min(len(x), len(y))
        half = shorter // 2
        if (half if forward else shorter - half) != base:
            continue
        if not forward and common_prefix(x[::-1], y[::-1]) >= half:
            continue
        for k, other in ((a, b), (b, a)):
            rank = -counts[other], paths[other] if forward else paths[other][::-1]
            known = near.setdefault(k, [0, rank])
            known[0] += 1
            known[1] = min(known[1], rank)
    return [
        (paths[k] if forward else paths[k][::-1], n, -best[0], best[1]) for k, (n, best) in near.items()
    ]


def partitions(vocab: DataFrame) -> DataFrame:
    """``(side, base, path, n)``: each word under the cuts of pairs in which it is the shorter, an equal or
    the longer word."""
    size = F.length("word")
    half = F.floor(size / 2).cast("int")
    less = F.floor((size - 1) / 2).cast("int")
    cuts = [("F", half), ("F", less), ("B", size - half), ("B", size - 1 - less)]
    sides = [F.struct(F.lit(s).alias("side"), c.cast("int").alias("base")) for s, c in cuts]
    each = vocab.withColumn("cut", F.explode(F.array_distinct(F.array(*sides))))
    path = F.when(F.col("cut.side") == "F", F.col("word")).otherwise(F.reverse("word"))
    # A word of one letter shares nothing; it is in the one partition of the empty path.
    return each.select("cut.side", "cut.base", path.alias("path"), "n")


def enumerated(groups: DataFrame) -> DataFrame:
    """Near words of each group ``(side, base, at, key)``; a key with ``CUT`` is one of :func:`cut_again`."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, paths, counts = None, [], []

        def finished() -> list:
            if len(paths) < 2:
                return []
            side, base, at, key = held
            return neighbours(side, base, at, paths, counts, CUT in key)

        def packed(rows: list) -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            arrays = [pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=["word", "n_near", "form_n", "form"])

        out: list = []
        for batch in batches:
            for *group, path, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if group != held:
                    out += finished()
                    held, paths, counts = group, [], []
                paths.append(path)
                counts.append(n)
                if len(out) >= 10_000:
                    yield packed(out)
                    out = []
        out += finished()
        if out:
            yield packed(out)

    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
    dealt = groups.repartition("side", "base", "at", "key").sortWithinPartitions("side", "base", "at", "key", "path")
    columns = dealt.select("side", "base", "at", "key", "path", "n")
    return map_texts(columns, work, "word string, n_near long, form_n long, form string")


def cut_again(large: DataFrame) -> DataFrame:
    """Words of large partitions by what is left of their path without the letter at the cut, and whole:
    two that differ by that letter meet under one key."""
    at = F.col("at")
    shared_part = F.col("path").substr(F.lit(1), at)
    without = F.when(F.length("path") > at, F.col("path").substr(at + 2, F.length("path")))
    rests = F.array_compact(F.array(without, F.col("path").substr(at + 1, F.length("path"))))
    each = large.withColumn("rest", F.explode(rests))
    key = F.concat(shared_part, F.lit(CUT), "rest")
    return each.select("side", "base", "at", key.alias("key"), "path", "n")


def near_words(vocab: DataFrame, part: int = PART) -> DataFrame:
    """``(word, n_near, form_n, form)`` of words that have near words: how many, the largest count
    among them, and the smallest word with it. ``vocab`` should be a stored table."""
    spark = vocab.sparkSession
    dealt, found, at = partitions(vocab).withColumn("at", F.col("base")), [], 0
    while True:
        dealt = dealt.withColumn("key", F.col("path").substr(F.lit(1), F.col("at")))
        sizes = dealt.groupBy(F.struct("side", "base", "key").alias("of")).agg(F.count(F.lit(1)).alias("words"))
        large = written(spark, sizes.where(F.col("words") > part).select("of"), "large")
        if large.isEmpty():
            found.append(enumerated(dealt))
            break
        # Grouped by a struct and joined by its fields, so that AQE may split a large partition here.
        of = large.select(F.col("of.side").alias("side"), F.col("of.base").alias("base"), F.col("of.key").alias("key"))
        found.append(enumerated(dealt.join(of, ["side", "base", "key"], "left_anti")))
        again = dealt.join(of, ["side", "base", "key"], "left_semi").select("side", "base", "at", "path", "n")
        again = written(spark, again, "large")
        found.append(enumerated(cut_again(again)))
        dealt = again.where(F.length("path") > F.col("at")).withColumn("at", F.col("at") + 1)
        at += 1
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    near = every.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return near.select("word", "n_near", (-F.col("best.less")).alias("form_n"), F.col("best.form").alias("form"))


def written(spark, df: DataFrame, purpose: str) -> DataFrame:
    """Cuts the lineage by a table in the shared folder."""
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def variants(vocab: DataFrame, ratio: int = RATIO, part: int = PART) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of every word of a vocabulary ``(word, n)``."""
    spark = vocab.sparkSession
    vocab = written(spark, vocab.select("word", "n"), "vocabulary")
    near = vocab.join(near_words(vocab, part), "word", "left")
    formed = F.col("form_n") >= ratio * F.col("n")
    near = near.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(formed, F.col("form")).alias("form"),
        F.when(formed, F.col("form_n")).alias("form_n"),
    )
    near = written(spark, near, "near")
    steps = near.where("form is not null").select(F.col("word").alias("from"), F.col("form").alias("to"))
    # Roots of words with a form; each round moves those one step on whose root has a form itself.
    roots = steps.select(F.col("from").alias("word"), F.col("to").alias("root"))
    ended = []
    while True:
        met = roots.join(steps, roots["root"] == steps["from"], "left").drop("from")
        met = written(spark, met, "roots")
        ended.append(met.where("to is null").select("word", "root"))
        roots = met.where("to is not null").select("word", F.col("to").alias("root"))
        if roots.isEmpty():
            break
    known = ended[0]
    for more in ended[1:]:
        known = known.union(more)
    out = near.join(known, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
