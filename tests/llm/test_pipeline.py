"""The pipeline's stages against plain versions of what they decide."""

import re

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from test_decontaminate import hits
from test_jaccard_join import brute
from test_packing import check, naive
from test_personal_data import base

from tidegauge.llm import quality_rules


@pytest.fixture(scope="module")
def steps(spark, sf, tmp_path_factory):
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("steps") / name)
        stage(spark, docs, sf).write.parquet(path)
        out.append((docs, docs := spark.read.parquet(path)))
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_columns_stay_until_packing(steps):
    for before, after in steps[:-1]:
        assert after.columns == before.columns


def test_quality_rules_drop_what_they_reject(steps):
    before, after = steps[0]
    kept = quality_rules.judge(before, quality_rules.fit(before)).where("kept")
    assert {r["doc_id"] for r in kept.collect()} == set(texts(after))


def test_one_document_of_each_group_stays(steps):
    before, after = (texts(x) for x in steps[1])
    assert set(after) == {c for _, _, c in brute(sorted(before.items()), 5, 80, 100)}
    assert all(after[i] == before[i] for i in after)


def test_contaminated_documents_go(spark, sf, steps):
    before, after = (texts(x) for x in steps[2])
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    assert set(after) == {i for i, t in before.items() if not hits(t, items, 10)[2]}


def test_personal_data_is_replaced(steps):
    before, after = (texts(x) for x in steps[3])
    assert set(before) == set(after)
    for i, text in before.items():
        assert (after[i] == text) == (not base(text)) or re.search("<NEW_", after[i])
        assert not base(after[i])


def test_packing_holds_what_is_left(steps):
    before, after = steps[4]
    check(after.collect(), {i: naive(t) for i, t in texts(before).items()})


def test_odd_documents_pass_through(spark, sf):
    prose = " ".join(f"Word{i} of a plain sentence number {i}." for i in range(12))
    rows = [(1, prose), (1, prose), (2, prose + " more"), (None, "Other " + prose.replace("plain", "short")), (3, None), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.withColumns({"n": F.lit("x"), "part": F.lit(1), "label": F.lit(None).cast("string")})
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, docs.limit(0), sf)
        assert empty.count() == 0
        if name != "best_fit_packing":
            assert empty.columns == docs.columns
    near = corpus_pipeline.near_duplicates(spark, docs, sf)
    assert sorted((r["doc_id"] or 0) for r in near.collect()) == [0, 1, 3, 4]


def test_run(spark, sf):
    assert corpus_pipeline.run(spark, sf).count() > 0
