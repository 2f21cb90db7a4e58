import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidegauge.llm.queries import op13_spelling_variants
from tidegauge.llm.spelling_variants import near_pairs, variants, vocabulary

WORD = re.compile("[A-Za-zÀ-ÿ]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def near(x, y):
    if len(x) > len(y):
        x, y = y, x
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) == 1
    return len(y) == len(x) + 1 and any(y[:i] + y[i + 1 :] == x for i in range(len(y)))


def plain(counts, ratio=10):
    """All pairs of words, compared letter by letter."""
    by_size, out = {}, {}
    for w in counts:
        by_size.setdefault(len(w), []).append(w)
    form = {}
    for w, n in counts.items():
        others = [o for size in (len(w) - 1, len(w), len(w) + 1) for o in by_size.get(size, ()) if near(w, o)]
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None
        out[w] = [form[w], None, n, len(others), counts[best] if form[w] is not None else None]
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w][1] = root
    return {w: tuple(x) for w, x in out.items()}


def result(df):
    rows = df.collect()
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"] and len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


@settings(max_examples=400, deadline=None)
@given(st.sets(st.text("abé", max_size=6), max_size=30))
def test_composition_accepts_pairs_one_edit_apart(words):
    words = sorted(words)
    pairs = sorted(tuple(sorted(p)) for p in near_pairs(words))
    assert pairs == [(i, j) for i in range(len(words)) for j in range(i + 1, len(words)) if near(words[i], words[j])]


def test_long_words():
    long = "ab" * 40_000
    words = sorted([long, long + "c", long[:30_000] + "x" + long[30_000:], long[1:], "q" * 9, "q" * 10])
    assert {tuple(sorted((words[a], words[b]), key=len)) for a, b in near_pairs(words)} == {
        (long, long + "c"), (long, long[:30_000] + "x" + long[30_000:]), (long[1:], long), ("q" * 9, "q" * 10),
    }


@pytest.mark.parametrize("part", [2, 4096])
def test_partitions_cut_to_any_size(spark, part):
    import random

    random.seed(3)
    counts = Counter()
    for k in range(300):
        w = "".join(random.choice("abé") for _ in range(random.choice((1, 2, 4, 5, 6, 7))))
        counts[w] = random.choice((1, 2, 30, 400, 5000))
    counts |= {"aaaaaaaaa": 7, "aaaaaaaaaa": 70, "aaaaaaaaaaa": 700}
    vocab = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert result(variants(vocab, part=part)) == plain(counts)


def test_chain_of_forms_and_ties(spark):
    counts = {"spelling": 4000, "speling": 40, "spelin": 3, "spellingx": 5, "wordzzz": 50, "wordzza": 50, "wordzzb": 5}
    vocab = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = result(variants(vocab))
    assert got["spelin"] == ("speling", "spelling", 3, 1, 40)
    assert got["wordzzb"][0] == "wordzza" and got["wordzzz"] == (None, "wordzzz", 50, 2, None)
    assert got == plain(counts)


def test_vocabulary_of_odd_texts(spark, monkeypatch):
    monkeypatch.setattr("tidegauge.llm.spelling_variants.COUNTED", 2)
    texts = [
        None, "", "spelling SPELLING spelling's", "Éclairsé éclairsé ÉCLAIRSÉ", "naïvety漢naïvety ŒUVRES÷a×b", "abc1abcdefg_abcdefg",
        "x" * 90_000 + " " + "x" * 90_000, "spelling",
    ]
    df = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, word long")
    df = df.union(df.where("doc_id = 7"))
    expected = Counter(w for t in [*texts, texts[7]] for w in WORD.findall(lowered(t)))
    expected = {w: n for w, n in expected.items() if len(w) >= 7 and n >= 2}
    assert {r["word"]: r["n"] for r in vocabulary(df).collect()} == expected
    assert vocabulary(df.limit(0)).count() == 0 and variants(vocabulary(df.limit(0))).count() == 0


def test_query_on_documents(spark, sf):
    counts = Counter()
    for d in spark.read.parquet(f"{sf}/documents.parquet").collect():
        for word in WORD.findall(lowered(d["text"])):
            h = zlib.crc32(f"{d['doc_id']}:{word}".encode())
            if h % 31 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    got = result(op13_spelling_variants(spark, sf))
    assert got == plain(counts) and any(x[0] for x in got.values())
