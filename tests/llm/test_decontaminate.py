import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidegauge.llm import decontaminate
from tidegauge.llm.decontaminate import build, drop_contaminated, find_hits, occurrences
from tidegauge.llm.textbytes import ALNUM, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def hits(text, items, width):
    """Words, hit positions and items that occur, position by position."""
    own, hit, found = split(text), set(), set()
    for item, passage in items:
        w = split(passage)
        m = min(width, len(w))
        for s in range(len(w) - m + 1) if m else ():
            for i in range(len(own) - m + 1):
                if own[i : i + m] == w[s : s + m]:
                    hit |= set(range(i, i + m))
                    found.add("" if item is None else str(item))
    return len(own), hit, sorted(found)


ITEMS = [(1, "a b c d e f g h i j k l"), (2, "b c d e f g h i j k"), (3, "Short one"), (4, None), (5, "..."), (None, "é漢 x1"), (6, "z"), (7, "a a a a a")]
ODD = [
    None, "", "A-b.c d\ne f g h i j k l m", "x short ONE y short", "short-one", "é漢 X1 é漢 x1", "zz z z zzz", "a " * 12,
    "a b c d e f g h i", "q " * 700 + "b c d e f g h i j k " + "r " * 700, "one short",
]


def result(df):
    return {
        r["doc_id"]: (r["n_words"], {p for a, b in zip(r["hit_starts"], r["hit_ends"]) for p in range(a, b)}, r["items"])
        for r in df.collect()
    }


@pytest.mark.parametrize("block_words,width", [(2_000_000, 10), (3, 10), (2_000_000, 3)])
def test_odd_texts(spark, monkeypatch, block_words, width):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block_words)
    docs = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string").withColumn("items", F.lit(1))
    bench = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("text_", F.lit(0))
    assert result(find_hits(docs, bench, width)) == {i: hits(t, ITEMS, width) for i, t in enumerate(ODD)}
    kept = {r["doc_id"] for r in drop_contaminated(docs, bench, width).collect()}
    assert kept == {i for i, t in enumerate(ODD) if not hits(t, ITEMS, width)[2]}


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert result(find_hits(docs, bench.limit(0))) == {1: (1, set(), [])}
    assert find_hits(docs.limit(0), bench).count() == 0


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.lists(st.sampled_from("abc"), max_size=40), min_size=1, max_size=4),
    st.lists(st.lists(st.sampled_from("abc"), max_size=9), max_size=5),
    st.integers(1, 5),
)
def test_search_finds_every_occurrence(docs, items, width):
    import pyarrow as pa

    texts = [" ".join(d) for d in docs]
    bench = [(i, " ".join(w)) for i, w in enumerate(items)]
    found = words(pa.array(texts), ALNUM)
    hit, first, got = occurrences(found, build(bench, width))
    for k, text in enumerate(texts):
        n, expected, ids = hits(text, bench, width)
        assert set((hit[first[k] : first[k + 1]]).nonzero()[0].tolist()) == expected and sorted(got[k]) == ids
