import hashlib
import re

from tidegauge.llm.queries import op1_zstd_novelty_secrets
from tidegauge.llm.secrets import identifier_dictionary, scan

ORDER = ("assign", "access", "hex")


def base(text):
    text = text or ""
    key = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in k) for k in ("password", "passwd", "secret", "token"))
    key += "|[aA][pP][iI]_?[kK][eE][yY]"
    spans = [
        ("assign", m)
        for m in re.finditer(rf"({key})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text)
        if len(m[2]) >= 6
    ]
    spans += [("access", m) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [("hex", m) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(((k, m.start(), m.end()) for k, m in spans), key=lambda s: (s[1], ORDER.index(s[0])))


ODD = [
    None, "", "password=abcdef", "PassWord : 'abc.def'", "secret=token:abcdefgh", "token=api_key=abcdefgh", "apikey=short",
    "AKIA" + "A" * 16, "xAKIAAKIA" + "B" * 15, "AKIA" + "A" * 15, "0" * 24, "0" * 23, "g" + "abcdef0123" * 5 + "z",
    "é password=é secret = \"zzzzzz\"", "ſecret=abcdefgh toKen=abcdefgh", "password=" + "f" * 40, "İİ token=abcdef",
]


def found(df, dictionary=b""):
    return {r[0]: [(s["kind"], s["start"], s["end"]) for s in r[1]] for r in scan(df, dictionary).collect()}


def test_base_spans_of_odd_texts(spark):
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(ODD)], "doc_id long, text string, found long")
    for i, spans in found(df).items():
        assert [s for s in spans if s[0] != "novel"] == base(ODD[i]), ODD[i]


def test_novelty_finds_random_strings_and_leaves_code_alone(spark):
    texts = [
        "the private key is q8Zr4T1xVbW9sLmK2yPdHc7u and more",
        "private static_final_identifier_name of the private static_final_identifier_name",
        "auth aaaaaaaaaaaaaaaaaaaaaaaaaaaa",
        "nothing here q8Zr4T1xVbW9sLmK2yPdHc7u",
        "bearer: Zk3+vX9/LmQ2rT8wYp5sNc1b",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = found(df, identifier_dictionary(df))
    assert [texts[i][a:b] for i, s in sorted(got.items()) for k, a, b in s if k == "novel"] == [
        "q8Zr4T1xVbW9sLmK2yPdHc7u", "Zk3+vX9/LmQ2rT8wYp5sNc1b"
    ]


def test_values_glued_to_longer_identifiers(spark):
    value = "Zk3vX9LmQ2rT8wYp5sNc1b"
    names = ["db_credential", "my-auth", "aws.private_key", "x credential", "my_oauth_bearer_of_requests"]
    texts = [f"{n}={value};" for n in names] + [f"db_credential={value}==", "my-auth=Zk3vX9LmQ2rT8w=="]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = found(df)
    new = [[texts[i][a:b] for k, a, b in got[i] if k == "novel"] for i in range(len(texts))]
    assert new == [[value]] * 5 + [[value + "=="], ["Zk3vX9LmQ2rT8w=="]]


def test_a_word_of_the_dictionary_is_not_novel(spark):
    text = "auth RequestHandlerFactoryBean"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert found(df, b"RequestHandlerFactoryBean") == {1: []}


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "token=abcdef"), (1, "token=abcdef"), (None, None)], "doc_id long, text string")
    assert sorted(len(r[1]) for r in scan(df, b"").collect()) == [0, 1, 1]
    assert identifier_dictionary(df.limit(0)) and scan(df.limit(0), b"").count() == 0


def test_query_on_documents(spark, sf):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op1_zstd_novelty_secrets(spark, sf).collect()
    assert len(rows) == len(docs)
    for r in rows:
        spans = base(docs[r["doc_id"]])
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in ORDER] == [sum(s[0] == k for s in spans) for k in ORDER]
        assert set(text.split(",")) <= set(r["spans"].split(","))
