import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidegauge.llm import pairwise_quality, quality_rules, toxicity
from tidegauge.llm.queries import op5_pairwise_quality, op6_line_labelling_rules, op9_class_models_toxicity
from tidegauge.llm.quality_rules import Crf, judge, keep_good, train, viterbi
from tidegauge.llm.textstats import stats_of

MEDIUM = "/root/testdata/sf0.01"
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    hit = {p for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for p in range(i, i + 5)}
    return (
        len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit)
    )


ODD = [
    None, "", "\n\n", " \t\r\n", "a", "a\na\n a\na \n\na\n", "x y z w v x y z w v", "a " * 30, "# é*漢 |<>&%$\né*漢",
    "one\r\none\none", "a b c d e\na b c d e", "long " * 3000, "no end\n\n", "A a A a A a A a",
]


@pytest.mark.parametrize("size", [1, 20, 1 << 20])
def test_counts_agree_with_a_plain_version(size):
    from tidegauge.llm.textbytes import sliced

    got = []
    for batch in sliced([pa.RecordBatch.from_pydict({"text": pa.array(ODD)})], "text", size):
        s = stats_of(batch.column(0))
        got += zip(s.n_words, s.word_chars, s.n_symbols, s.n_dup_lines, s.n_repeat_words, strict=True)
    assert [tuple(map(int, x)) for x in got] == [plain(t) for t in ODD]


def test_viterbi_finds_the_best_path():
    r = np.random.default_rng(3)
    lengths = [0, 1, 4, 0, 7, 2, 7]
    first = np.cumsum([0, *lengths])
    x = r.normal(size=(first[-1], 3))
    crf = Crf(r.normal(size=3), r.normal(size=(2, 2)))
    got, score = viterbi(crf, x, first), crf.emissions(x)
    for a, b in itertools.pairwise(first):
        def value(path, a=a):
            moves = sum(crf.moves[p, q] for p, q in itertools.pairwise(path))
            return moves + sum(score[a + t, s] for t, s in enumerate(path))

        best = max(itertools.product((0, 1), repeat=int(b - a)), key=value)
        assert tuple(got[a:b]) == best


def test_training_learns_emissions_and_moves():
    r = np.random.default_rng(1)
    first = np.arange(0, 2001, 20)
    state = np.repeat(r.integers(0, 2, 400), 5).astype(np.int8)
    x = np.column_stack((np.ones(2000), state + r.normal(0, 0.7, 2000)))
    crf = train(x, state, first)
    alone = ((x[:, 1] > 0.5) == state).mean()  # the best that one line by itself allows
    assert (viterbi(crf, x, first) == state).mean() > alone + 0.05
    assert crf.moves[0, 0] > crf.moves[0, 1] and crf.moves[1, 1] > crf.moves[1, 0]


def test_odd_rows_and_empty_table(spark):
    df = spark.createDataFrame([(i % 9, t) for i, t in enumerate(ODD)] + [(None, "a b")], "doc_id long, text string")
    df = df.withColumn("kept", F.lit("x"))
    crf = quality_rules.fit(df)
    rows = judge(df, crf).collect()
    assert sorted(tuple(r)[1:6] for r in rows) == sorted([plain(t) for t in ODD] + [plain("a b")])
    assert keep_good(df, crf).columns == df.columns
    none = df.limit(0)
    assert quality_rules.fit(none) is None and judge(none, None).count() == 0


def test_rules_on_documents(spark, sf):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op6_line_labelling_rules(spark, sf).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n, chars, symbols, lines, repeated = plain(docs[r["doc_id"]])
        failed = n < 10 or 100 * repeated > 20 * n
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            n, chars, symbols, lines, repeated
        )
        assert r["base_failed"] == failed and not (failed and r["kept"])


@pytest.mark.parametrize("held", [1 << 20, 0])
def test_common_lines_are_counted_over_all_documents(spark, monkeypatch, held):
    """A plain notice in one document of 200 is learnt, and copies of a document are no notice."""
    monkeypatch.setattr(quality_rules, "FREQUENT", held)
    r = np.random.default_rng(2)
    vocabulary = np.array([f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)])
    line = lambda: " ".join(r.choice(vocabulary, 9)) + "."
    notice = [line(), line(), line()]
    rows = [(i, "\n".join([*notice, line()] if i % 200 == 0 else [line() for _ in range(4)])) for i in range(3000)]
    copy = "\n".join(line() for _ in range(4))
    rows += [(i, copy) for i in range(3000, 3040)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = {x["doc_id"] for x in keep_good(df, quality_rules.fit(df)).collect()}
    assert not kept & set(range(0, 3000, 200))
    assert len(kept) >= 0.99 * 3025 and kept >= set(range(3000, 3040))


def held_out(spark, query, label):
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet").where(f"{label} is not null")
    rows = query(spark, MEDIUM).join(labels, "doc_id").collect()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1
    return [(r[label], r["predicted"]) for r in rows if r["held_out"]]


def test_kept_documents_follow_the_labels(spark):
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    rows = op6_line_labelling_rules(spark, MEDIUM).where("not base_failed").join(labels, "doc_id").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.2 * len(bad)


@pytest.mark.parametrize("query,label", [(op5_pairwise_quality, "quality"), (op9_class_models_toxicity, "toxic")])
def test_held_out_accuracy(spark, query, label):
    pairs = held_out(spark, query, label)
    assert len(pairs) > 50
    assert sum(a == b for a, b in pairs) >= 0.95 * len(pairs)
    assert sum(b for a, b in pairs if a == 1) >= 0.75 * sum(a for a, _ in pairs)


@pytest.mark.parametrize("module,label", [(pairwise_quality, "quality"), (toxicity, "toxic")])
def test_classifiers_on_odd_rows(spark, module, label):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)] + [(None, "x"), (1, "q")], "doc_id long, text string")
    docs = docs.withColumns({"score": F.lit("x"), "label": F.lit(1)})
    marks = spark.createDataFrame(
        [(i, i % 2) for i in range(len(ODD))] + [(None, 1), (2, None), (2, 1), (2, 0), (2, 0), (99, 1)],
        f"doc_id long, {label} int",
    )
    model = module.fit(docs, marks)
    rows = module.score(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert module.fit(docs, marks.limit(0)) is None
    assert {r["score"] for r in module.score(docs, None).collect()} == {1.0 if label == "quality" else 0.0}
    assert module.score(docs.limit(0), model).count() == 0


def test_kneser_ney_probabilities_sum_to_one():
    r = np.random.default_rng(0)
    context = np.uint64(int.from_bytes(b"word", "big"))
    codes = (context << np.uint64(8)) | np.arange(256, dtype=np.uint64)
    counts = r.integers(0, 4, 256).astype(float)
    own = toxicity.level(codes, counts, np.full(256, 1 / 256))
    assert np.exp(own.logs).sum() == pytest.approx(1) and own.contexts.tolist() == [int(context)]


def grams_of(text):
    """Bytes of each word with up to four before them, from the space on."""
    found = []
    for word in re.findall(rb"[0-9a-z\x80-\xff]+", text.encode().lower()):
        whole = b" " + word
        found.append([whole[max(0, i - 4) : i + 1] for i in range(1, len(whole))])
    return found


def plain_log_likelihoods(text, toxic, ordinary, order=5):
    """Under both classes, gram by gram from counters."""
    own = [Counter(g for t in texts for w in grams_of(t) for g in w) for texts in (toxic, ordinary)]
    kinds = {order - 1: Counter(g[1 - order :] for g in own[0] | own[1])}
    for k in range(order - 2, 0, -1):
        kinds[k] = Counter(g[-k:] for g in kinds[k + 1])

    def interpolated(counts, gram, lower):
        after = {g: c for g, c in counts.items() if g[:-1] == gram[:-1]}
        total = sum(after.values())
        if not total:
            return lower
        taken = sum(min(c, toxicity.DISCOUNT) for c in after.values())
        c = counts.get(gram, 0)
        return (c - min(c, toxicity.DISCOUNT) + taken * lower) / total

    def shared(gram, k):
        if k == 1:
            return 0.99 * kinds[1][gram[-1:]] / sum(kinds[1].values()) + 0.01 / 256
        return interpolated(kinds[k], gram[-k:], shared(gram, k - 1))

    both = [0.0, 0.0]
    for word in grams_of(text):
        p = [np.prod([interpolated(c, g, shared(g, order - 1)) for g in word]) for c in own]
        both[0] += np.log(toxicity.MIX * p[0] + (1 - toxicity.MIX) * p[1])
        both[1] += np.log(p[1])
    return both


def test_log_likelihoods_of_both_classes():
    toxic = ["You vile vile worm", "worms are vile, wormy", "é漢 vil"]
    ordinary = ["You are kind", "the kind worm of old", "old and kinder words", ""]
    texts = ["vile kind worm", "Unseen zzz vi vilest", "", "é漢é you're 12", "word wordword words"]
    found = [np.concatenate([toxicity.grams(toxicity.words(pa.array(part), toxicity.ALNUM))]) for part in (toxic, ordinary)]
    codes, back = np.unique(np.concatenate(found), return_inverse=True)
    counts = [np.bincount(part, minlength=len(codes)) for part in (back[: len(found[0])], back[len(found[0]) :])]
    model = toxicity.fit_counts(codes, *counts)
    got = model.log_likelihoods(pa.array(texts))
    expected = [plain_log_likelihoods(t, toxic, ordinary) for t in texts]
    assert np.allclose(got[0], [e[0] for e in expected]) and np.allclose(got[1], [e[1] for e in expected])
    assert got[2].tolist() == [3, 4, 0, 4, 3]
    means = model.means(pa.array(texts))
    assert np.allclose(means, (got[0] - got[1]) / np.maximum(got[2], 1))


def test_unseen_gram_gets_each_class_its_own_backoff():
    """Context with toxic {e: 10} and ordinary {f: 10, g: 1}: h, unseen, falls back with other masses."""
    context = int.from_bytes(b"abcd", "big") << 8
    codes = np.array([context | b for b in b"efg"], np.uint64)
    model = toxicity.fit_counts(codes, np.array([10, 0, 0]), np.array([0, 10, 1]))
    row = toxicity.find(model.own[0].contexts, np.array([context >> 8], np.uint64))[0]
    difference = model.own[0].backoff[row] - model.own[1].backoff[row]
    assert difference[0] == pytest.approx(np.log(0.75 / 10) - np.log(1.5 / 11))


def test_sample_is_bounded_by_rows(spark):
    from tidegauge.llm.labelled import labelled_texts

    docs = spark.createDataFrame([(i % 4, f"t{i}") for i in range(400)] + [(1, "same")] * 50, "doc_id long, text string")
    marks = spark.createDataFrame([(i, i % 2) for i in range(4)], "doc_id long, toxic int")
    rows = labelled_texts(docs, marks, "toxic", 20, "doc_id", "text").collect()
    sizes = Counter(r["label"] for r in rows)
    assert max(sizes.values()) <= 20 and len({(r["id"], r["text"]) for r in rows}) == len(rows)


def test_ranking_is_a_minimum_and_cuts_at_the_best_quantile():
    r = np.random.default_rng(5)
    good, bad = r.normal(0.6, 1, (300, 3)), r.normal(-0.4, 1.5, (400, 3))
    model = pairwise_quality.rank(good, bad)

    def loss(weights):
        gap = ((good[:, None, :] - bad[None, :, :]) / model.scale).reshape(-1, 3) @ weights
        return np.log1p(np.exp(-gap)).mean() + 5e-4 * (weights**2).sum()

    base = loss(model.weights)
    for k in range(3):
        for step in (-0.3, 0.3):
            assert loss(model.weights + step * np.eye(3)[k]) > base
    values = np.concatenate((model.raw(good), model.raw(bad)))

    def wrong(cut):
        return (model.raw(good) < cut).mean() + (model.raw(bad) >= cut).mean()

    assert wrong(model.threshold) == pytest.approx(min(wrong(c) for c in [*values, values.max() + 1]))
    assert ((model.scores(good) >= pairwise_quality.CUT) == (model.raw(good) >= model.threshold)).all()


def test_all_pairs_follow_from_the_grid():
    r = np.random.default_rng(7)
    good, bad, weights = r.normal(0.5, 1, (90, 3)), r.normal(-0.5, 2, (70, 3)), np.array([0.8, -0.3, 1.1])
    both = np.concatenate((good, bad))
    grid = pairwise_quality.Grid.of(weights, both.min(0), both.max(0))
    loss, slope = pairwise_quality.loss_and_slope(grid, grid.sums(good), grid.sums(bad))
    gaps = (good[:, None, :] - bad[None, :, :]).reshape(-1, 3)
    assert loss == pytest.approx(np.log1p(np.exp(-gaps @ weights)).mean(), abs=1e-4)
    assert slope == pytest.approx(-(gaps / (1 + np.exp(gaps @ weights))[:, None]).mean(0), abs=1e-4)


def test_every_labelled_document_is_learnt_from(spark):
    """More rows of a class than the former sample of 4,000 had."""
    rows = [(i, "some words here." if i % 2 else "other words, here and there") for i in range(10_500)]
    rows = [(i, t) for i, t in rows if zlib.crc32(str(i).encode()) % 5]
    assert min(Counter(i % 2 for i, _ in rows).values()) > 4000
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(i, i % 2) for i, _ in rows] + [(None, 1)], "doc_id long, quality int")
    model = pairwise_quality.fit(docs, marks)
    x = pairwise_quality.features(stats_of(pa.array([t for _, t in rows])))
    good = np.array([i % 2 == 1 for i, _ in rows])
    assert np.allclose(model.mean, x.mean(0)) and np.allclose(model.scale, x.std(0) + 1e-6, atol=1e-5)
    plain = pairwise_quality.rank(x[good], x[~good])
    assert np.allclose(model.weights, plain.weights, atol=1e-3) and model.threshold == pytest.approx(plain.threshold, abs=1e-3)
