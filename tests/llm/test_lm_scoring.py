import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidegauge.llm import lm_scoring
from tidegauge.llm.lm_scoring import score
from tidegauge.llm.queries import op8_ppm_scoring

ORDER = 4


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def held_out(doc):
    return zlib.crc32(str(doc).encode() if doc is not None else b"") % 10 == 0


def brute(rows):
    """A trie of dictionaries, and symbol by symbol coding with exclusion."""
    trie, unigrams = defaultdict(Counter), Counter()
    for doc, text in rows:
        if held_out(doc):
            continue
        data = b"\xff" * ORDER + lower(text).encode() + b"\xff"
        for i in range(ORDER, len(data)):
            for k in range(ORDER + 1):
                trie[data[i - k : i]][data[i]] += 1
        unigrams.update(re.findall(r"[^\x20\x09-\x0D]+", lower(text)) + [None])
    total, kinds = sum(unigrams.values()), len(unigrams)
    out = []
    for doc, text in rows:
        data = b"\xff" * ORDER + lower(text).encode() + b"\xff"
        bits = 0.0
        for i in range(ORDER, len(data)):
            excluded = set()
            for k in range(ORDER, -1, -1):
                children = trie.get(data[i - k : i])
                if not children:
                    continue
                left = {s: n for s, n in children.items() if s not in excluded}
                if not left:
                    continue
                whole = sum(left.values()) + len(left)
                if data[i] in left:
                    bits += math.log10(left[data[i]] / whole)
                    break
                bits += math.log10(len(left) / whole)
                excluded |= set(left)
            else:
                bits -= math.log10(256 - len(excluded))
        words = re.findall(r"[^\x20\x09-\x0D]+", lower(text)) + [None]
        base = sum(math.log10((unigrams[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in words)
        out.append((doc, held_out(doc), len(words), sum(unigrams[w] > 0 for w in words), total, base, bits))
    return out


def agree(df, expected):
    got = sorted((tuple(r) for r in df.collect()), key=str)
    expected = sorted(expected, key=str)
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    for g, e in zip(got, expected, strict=True):
        assert g[5] == pytest.approx(e[5], rel=1e-9, abs=1e-9)
        assert g[6] == pytest.approx(e[6], rel=1e-9, abs=1e-9)


ODD = [None, "", " ", "a", "A b\tc\n\n", "é漢字 é", "abab" * 300, "the cat the cat the dog", "zzzz qqqq"]


@pytest.mark.parametrize("frequent", [None, 4, 1])
def test_agrees_with_brute_force(spark, monkeypatch, frequent):
    if frequent:
        monkeypatch.setattr(lm_scoring, "FREQUENT", frequent)
    rows = [(i, t) for i, t in enumerate(ODD * 6)] + [(3, "a"), (None, "none")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit(1))
    agree(score(df), brute(rows))


def test_query_on_documents(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    agree(op8_ppm_scoring(spark, sf), brute(rows))


@pytest.mark.parametrize("nodes", [0, 7, 60])
def test_scores_do_not_depend_on_the_bound(spark, monkeypatch, nodes):
    """Events that executors do not hold get their values, of all counts, in a join."""
    monkeypatch.setattr(lm_scoring, "MAX_NODES", nodes)
    rows = [(i, t) for i, t in enumerate(ODD * 6)] + [(3, "a"), (None, "none")]
    agree(score(spark.createDataFrame(rows, "doc_id long, text string")), brute(rows))


def test_smaller_trie_still_sums_to_one(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "MAX_NODES", 40)
    df = spark.createDataFrame([(i, "abcabd") for i in range(1, 5)], "doc_id long, text string")
    counts = lm_scoring.corpus_counts(df)
    import numpy as np

    trie = lm_scoring.build_trie(counts)
    trie.prepare()
    for context in (b"\xff\xff\xff\xff", b"abca", b"zzab", b"zzzz"):
        code = np.array([int.from_bytes(context + bytes([s]), "big") for s in range(256)], np.uint64)
        assert (10 ** trie.log_probability(code)).sum() == pytest.approx(1)


def test_no_training_texts_and_empty_table(spark):
    doc = next(i for i in range(1000) if held_out(i))
    df = spark.createDataFrame([(doc, "ab")], "doc_id long, text string")
    agree(score(df), brute([(doc, "ab")]))
    assert score(df.limit(0)).count() == 0
