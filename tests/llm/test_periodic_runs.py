import hashlib
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tidegauge.llm import periodic_runs
from tidegauge.llm.periodic_runs import find_runs, numbered, runs_of
from tidegauge.llm.queries import op12_periodic_runs


def plain_runs(words, least=12):
    """Every period at every place."""
    found = []
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            s = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            run = words[s : i + q]
            if i > s and len(run) >= max(least, 2 * q):
                if not any(run[p:] == run[:-p] for p in range(1, q)):
                    found.append((s, len(run), q))
            i = max(i, s + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def split(text):
    return [w.decode() for w in (text or "").encode().split()]


def fibonacci(n):
    a, b = ["a"], ["a", "b"]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


ODD = [
    None, "", " \n\t", "a", "a " * 11, "a " * 12, "a\x0bb " * 6, "a b " * 5 + "a", "x " + "a b c " * 5 + "a y", "A a " * 9,
    "é漢 👍 " * 7, "\x1f \x85x " * 8, " ".join(fibonacci(200)), "one two three " * 4000 + "end", "q " * 6 + "r " + "q " * 6,
    " ".join(bin(i).count("1") % 2 and "a" or "b" for i in range(256)),
]


def check(rows, texts):
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        words = split(texts[r["doc_id"]])
        expected = plain_runs(words) if len(words) < 2000 else [(0, 12000, 3)]
        assert [tuple(x) for x in r["runs"]] == expected
        assert r["collapsed"] == collapsed(words, expected)


def test_odd_texts(spark, monkeypatch):
    texts = dict(enumerate(ODD))
    rows = [(i, t, i, "x") for i, t in texts.items()]
    df = spark.createDataFrame(rows, "doc_id long, text string, id long, runs string").withColumnRenamed("runs", "__text")
    check(find_runs(df).collect(), texts)


def test_repeated_rows_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a " * 12), (1, "a " * 12), (None, "b")], "doc_id long, text string")
    rows = find_runs(df).collect()
    assert sorted((r["doc_id"] or 0, len(r["runs"]), r["collapsed"]) for r in rows) == [(0, 0, "b"), (1, 1, "a"), (1, 1, "a")]
    assert find_runs(df.limit(0)).count() == 0


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.lists(st.integers(0, 2), max_size=50) | st.lists(st.integers(0, 1), max_size=9).map(lambda x: x * 6), max_size=4),
    st.sampled_from([2, 4, 12]),
)
def test_every_run_is_found(docs, least):
    texts = [[b"%d" % w for w in d] for d in docs]
    ids, first = numbered(texts)
    start, length, period = runs_of(ids, first, least)
    expected = [(int(first[k]) + s, n, q) for k, d in enumerate(texts) for s, n, q in plain_runs(d, least)]
    assert list(zip(start.tolist(), length.tolist(), period.tolist())) == expected


def test_listing_in_parts(monkeypatch):
    ids = np.array([len(w) + ord(w[0]) for w in fibonacci(500)])
    whole = runs_of(ids, np.array([0, 200, 500]))
    monkeypatch.setattr(periodic_runs, "LISTED", 7)
    assert all((a == b).all() for a, b in zip(whole, runs_of(ids, np.array([0, 200, 500]))))


def planted(doc_id, text):
    words, h = split(text), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    return words


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query_on_documents(spark, sf):
    rows = {r["doc_id"]: r for r in op12_periodic_runs(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(rows) == len(docs)
    some = 0
    for d in docs:
        words, got = planted(d["doc_id"], d["text"]), rows[d["doc_id"]]
        if len(words) > 1500:  # the plain search is quadratic
            continue
        runs = plain_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        some += bool(runs)
        assert got["n_runs"] == len(runs)
        assert (got["start"], got["length"], got["period"]) == (best or (None,) * 3)
        assert got["exponent_milli"] == (1000 * best[1] // best[2] if best else None)
        assert got["runs_sha256"] == digest("".join("%d,%d,%d\n" % r for r in runs))
        assert got["collapsed_sha256"] == digest(collapsed(words, runs))
    assert some
