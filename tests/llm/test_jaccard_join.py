import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidegauge.llm import jaccard_join
from tidegauge.llm.jaccard_join import least_apart, similarity_components, sketch


def brute(rows, width, num, den):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        n = max(len(w) - width, 0) + 1 if w else 0
        sets.append({tuple(w[i : i + width]) for i in range(n)})
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            if x and den * len(x & sets[j]) >= num * len(x | sets[j]):
                label[root(i)] = root(j)
    ids = [r[0] for r in rows]
    least = {}
    for i in range(len(rows)):
        if ids[i] is not None:
            least[root(i)] = min(least.get(root(i), ids[i]), ids[i])
    return sorted(((ids[i], len(sets[i]), least.get(root(i))) for i in range(len(rows))), key=str)


def fixture(seed, docs=120, vocabulary=400):
    """Families of edited copies, chains of small edits, exact copies, short and empty texts."""
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(vocabulary)}"
    texts = [None, "", " \t\n", "one", "One", "two words", "a b c", "A  b\nc"]
    while len(texts) < docs:
        base = [word() for _ in range(r.choice([5, 12, 30, 60, 150]))]
        for _ in range(r.choice([1, 2, 8, 25])):
            for _ in range(r.randrange(4)):
                base = list(base) if r.random() < 0.6 else base
                base[r.randrange(len(base))] = word()
            texts.append(" ".join(base))
    return list(enumerate(texts[:docs]))


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed,limit,num", [(1, None, 85), (2, 1, 85), (3, 4, 80), (4, 8, 70)])
def test_agrees_with_brute_force(spark, monkeypatch, seed, limit, num):
    if limit:
        monkeypatch.setattr(jaccard_join, "frequent_from", lambda counts: limit)
        monkeypatch.setattr(jaccard_join, "BLOCK_OUT", 3)
        monkeypatch.setattr(jaccard_join, "BLOCK_ALL", 4)
    rows = fixture(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("x"))
    assert got(similarity_components(df, 3, num, 100)) == brute(rows, 3, num, 100)


def test_odd_rows(spark):
    same = "a b c d e f g h i j"
    rows = [(1, same), (1, same), (1, "q r s t u v"), (None, same), (None, "z y x w v u"), (2, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(similarity_components(df)) == brute(rows, 5, 80, 100)
    assert got(similarity_components(df.limit(0))) == []


def test_a_large_group_needs_few_comparisons(spark, monkeypatch):
    """Comparisons grow with the group, not with its square."""
    compared = []
    plain = jaccard_join.compared

    def counting(pairs, *rest):
        compared.append(pairs.count())
        return plain(pairs, *rest)

    monkeypatch.setattr(jaccard_join, "compared", counting)
    r = random.Random(5)
    base = [f"b{i}" for i in range(100)]
    rows = []
    for i in range(300):
        own = list(base)
        own[r.randrange(100)] = f"x{i}"
        rows.append((i, " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {x[2] for x in got(similarity_components(df, 4, 85, 100))} == {0}
    assert sum(compared) < 300 * 20


def test_rows_repeated_over_a_block_beside_a_pivot_they_do_not_link_to(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_OUT", 3)
    found = []
    plain = jaccard_join.compared

    def counting(*args):
        out = plain(*args)
        found.append((out.count(), out.select("a", "b").distinct().count()))
        return out

    monkeypatch.setattr(jaccard_join, "compared", counting)
    shared = [f"w{i}" for i in range(17)]
    pivot, member = (" ".join([*shared, f"{x}1", f"{x}2", f"{x}3"]) for x in "pm")
    rows = [(1, pivot)] * 40 + [(2, member)] * 20 + [(None, "z")] * 5
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(similarity_components(df, 1, 85, 100)) == brute(rows, 1, 85, 100)
    assert found[0] == (1, 1)


def test_sketches_never_overstate_a_distance():
    r = np.random.default_rng(3)
    for size in (1, 5, 16, 17, 200, 3000):
        own = np.unique(r.integers(0, 1 << 63, size, dtype=np.uint64))
        for lost in (0, size // 20, size // 2, size):
            other = np.concatenate((own[lost:], r.integers(0, 1 << 63, lost + size // 3, dtype=np.uint64)))
            least = least_apart(*(np.frombuffer(sketch(x), np.uint8) for x in (own, other)))
            assert least <= len(np.setxor1d(own, other))
            assert least or not len(np.setxor1d(own, other)) or size < 200


def test_texts_that_share_a_passage_alone_are_not_compared(spark, monkeypatch):
    """Sketches decide them; before, each member's text went to its pivot's group."""
    compared = []
    plain = jaccard_join.compared

    def counting(pairs, *rest):
        compared.append(pairs.count())
        return plain(pairs, *rest)

    monkeypatch.setattr(jaccard_join, "compared", counting)
    passage = [f"p{i}" for i in range(30)]
    rows = [(i, " ".join([*passage, *(f"x{i}_{k}" for k in range(120))])) for i in range(30)]
    rows += [(100 + i, f"{rows[0][1]} tail{i}") for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(jaccard_join, "signatures", lambda tokens, *rest: tokens)
    assert got(similarity_components(df, 4, 85, 100)) == brute(rows, 4, 85, 100)
    assert sum(compared) < 10


def test_tables_of_a_task_hold_no_more_than_their_final_size(spark):
    """What a task holds for its table: before, one of four bytes a slot and copies of it, or a byte a bit."""
    held = []

    def traced(work, batches):
        tracemalloc.start()
        list(work(iter(batches)))
        held.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()

    docs = pa.RecordBatch.from_pydict({"text": ["a b c d e f"] * 3})
    values = pa.RecordBatch.from_pydict({"v": pa.array([1, 2, 3], pa.int64())})
    with pytest.MonkeyPatch.context() as m:
        m.setattr(jaccard_join, "map_texts", lambda df, work, schema: traced(work, [docs]))
        m.setattr(jaccard_join, "combined_tables", lambda partial, combine, empty: b"")
        jaccard_join.slot_counts(spark.createDataFrame([("a",)], "text string"), 4)
        m.setattr(jaccard_join, "map_texts", lambda df, work, schema: traced(work, [values]))
        jaccard_join.bitmap(None)
    assert held[0] < 3 << jaccard_join.SLOT_BITS
    assert held[1] < 3 << (jaccard_join.BITMAP_BITS - 3)


def test_sets_are_made_of_little_text_at_once(spark):
    """Before, sets were made of 1 MB of text at once, with some 50 MB of arrays."""
    docs = pa.RecordBatch.from_pydict({"text": [" ".join(f"w{i}x{j}" for j in range(1000)) for i in range(200)]})
    held = []

    def traced(df, work, schema):
        tracemalloc.start()
        list(work(iter([docs])))
        held.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()

    with pytest.MonkeyPatch.context() as m:
        m.setattr(jaccard_join, "map_texts", traced)
        m.setattr(jaccard_join, "combined_tables", lambda partial, combine, empty: b"")
        jaccard_join.slot_counts(spark.createDataFrame([("a",)], "text string"), 4)
    assert held[0] < 40 << 20
