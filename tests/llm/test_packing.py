import os
import subprocess
import sys
import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidegauge.llm import packing
from tidegauge.llm.packing import Plan, UnitEncoder, pack
from tidegauge.llm.queries import op10_best_fit_packing, tokenizer_path

ODD = [
    None, "", " ", "a", " a", "  a  b \n c\t\td ", "x" * 5000, "don't we'll I'd  's", " a  b c",
    "<|endoftext|> a <|endoftext|>", "x  <|endoftext|>b<|endoftext|><|endoftext|>  \n c <|endoftext", "<|endoftext", "|>",
    "word's, it'S; (a-b).c,d!!e ##f# g_h i%%%j é%%% x.'s y'%'t", "é è ü 漢字 かな 👍🏽 ́x", "a\r\n b\x1c c \x85 d", "1 22 333 4,444 !! ?? -- a",
    "word " * 6000, "\n\n\n", "end ", "end  ", " 　x  y",
]


def naive(text):
    own = Tokenizer.from_file(tokenizer_path())
    return own.encode(text or "", add_special_tokens=False).ids + [0]


def check(rows, expected, capacity=2048):
    """Every document's ids are all there, once, and sequences are gapless and within capacity."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(by_doc) == set(expected)
    for doc, ids in expected.items():
        at = 0
        for k, r in enumerate(sorted(by_doc[doc], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (k, at)
            own = np.array(ids[at : at + r["length"]], "<u4").tobytes()
            assert r["ids_crc32"] == zlib.crc32(own)
            at += r["length"]
            assert k == 0 or r["length"] == capacity
        assert at == len(ids)
    for spans in by_seq.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_seq)


def test_odd_texts(spark):
    df = spark.createDataFrame([(i, t, i) for i, t in enumerate(ODD)], "doc_id long, text string, rank long")
    check(pack(df, tokenizer_path()).collect(), {i: naive(t) for i, t in enumerate(ODD)})


def test_repeated_rows_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string")
    rows = pack(df, tokenizer_path()).collect()
    assert sorted((r["doc_id"] or 0, r["offset"]) for r in rows) == [(0, 6), (1, 0), (1, 3)]
    assert pack(df.limit(0), tokenizer_path()).count() == 0


def test_ids_kept(spark):
    df = spark.createDataFrame([(1, "some words here")], "doc_id long, text string")
    assert pack(df, tokenizer_path(), keep_ids=True).first()["ids"] == naive("some words here")


def test_query_on_documents(spark, sf):
    docs = {r["doc_id"]: naive(r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    used = check(op10_best_fit_packing(spark, sf).collect(), docs)
    least = -(-sum(map(len, docs.values())) // 2048)
    assert used <= 1.03 * least + 1


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 30), max_size=25))
def test_plan_is_a_packing(counts):
    plan = Plan(counts, 60)
    used = defaultdict(list)
    placed = defaultdict(int)
    for length, rank, first, count, offset in plan.rows:
        assert rank == placed[length]
        placed[length] += count
        for s in range(first, first + count):
            used[s].append((offset, length))
    assert dict(placed) == counts
    for spans in used.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 60
    assert len(used) == plan.sequences


@pytest.mark.parametrize("size", [1, 3, 50])
def test_encoder_forgets(monkeypatch, size):
    monkeypatch.setattr("tidegauge.llm.packing.REMEMBERED", size)
    import pyarrow as pa

    encoder = UnitEncoder(tokenizer_path(), 0)
    for _ in range(3):
        ids, firsts = encoder.documents(pa.array(ODD))
        assert [ids[a:b].tolist() for a, b in zip(firsts[:-1], firsts[1:])] == [naive(t) for t in ODD]


def test_task_holds_little_beside_the_tokenizer(spark, monkeypatch):
    """Before: some 40 bytes for each of 1 MB of text, and a dictionary of the units."""
    rows = [" ".join(f"w{i}x{j}" for j in range(1000)) for i in range(200)]
    batch = pa.RecordBatch.from_pydict({"doc_id": range(200), "text": rows})
    monkeypatch.setattr(packing.TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda self: 0})())
    monkeypatch.setattr(packing, "map_texts", lambda df, work, schema: work)
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    work = packing.pieces_of(docs, tokenizer_path(), 2048, "doc_id", "text", False)
    tracemalloc.start()
    assert sum(len(x) for x in work(iter([batch]))) >= 200
    held = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert held < 32 << 20


def test_encoder_starts_no_threads():
    """A pool of them would keep memory of its own in each Python worker."""
    code = (
        "import os, sys; from tidegauge.llm.packing import UnitEncoder; import pyarrow as pa\n"
        "threads = lambda: len(os.listdir('/proc/self/task'))\n"
        "encoder = UnitEncoder(sys.argv[1], 0); texts = pa.array(['a b', 'c%d'] * 2000); before = threads()\n"
        "encoder.documents(texts); sys.exit(threads() - before)"
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(packing.__file__)))
    env = {k: v for k, v in os.environ.items() if k != "TOKENIZERS_PARALLELISM"}
    env["PYTHONPATH"] = os.path.dirname(root)
    assert subprocess.run([sys.executable, "-c", code, tokenizer_path()], env=env).returncode == 0
