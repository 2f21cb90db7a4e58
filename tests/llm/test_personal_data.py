import hashlib
import re

from pyspark.sql import functions as F

from tidegauge.llm.personal_data import KINDS, find, redact
from tidegauge.llm.queries import op3_contextual_personal_data


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base(text):
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    rules = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m[0].split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
    }
    return [(k, m.start(), m.end()) for k, (p, ok) in rules.items() for m in re.finditer(p, text) if ok(m)]


ODD = [
    None, "", "a@b.co_x@y.zz", "a@b@c.de .a..b@c-d.e-f.g. @a.b a@b", "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.255 1..2.3.4",
    "4111 1111-1111 1111 4111111111111112 4111111111111111", "4111111111111111 1", "+1 (555) 123-4567 +12345 +1....... 2",
    "++49 30 1234567-", "é漢 x@y.z é 漢@a.b 👍 a.b@c.d", "1.2.3.4" * 40, "a@b.c" * 50, "." * 300 + "@a.b", "x" * 30000,
    "a." * 20000 + "@b", "b@" + "a." * 20000, "1-" * 20000, "1." * 20000, "+1" + " " * 20000, "+1 2 3 4 5 6 7 8\n9",
    "999999999999999999999999.1.1.1 1.1.1.000000000000000000000000000001",
]


def rows(df):
    return {r[0]: [(s["kind"], s["start"], s["end"]) for s in r["found"]] for r in df.collect()}


def test_base_spans_of_odd_texts(spark):
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(ODD)], "doc_id long, text string, found long")
    got = rows(find(df))
    for i, text in enumerate(ODD):
        assert [s for s in got[i] if s[0] in KINDS] == base(text), text


def contextual():
    texts = [f"some words then contact user at mail{i}@example.com and more text" for i in range(8)]
    texts += ["some words then contact user at mx-90210-aa and more text", "another one with mx-90210-aa elsewhere"]
    texts += [f"nothing special about version number {i}234 here" for i in range(8)]
    return texts


def test_patterns_of_seeds_find_new_identifiers(spark):
    texts = contextual()
    got = rows(find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    new = [(texts[i][a:b], k) for i, spans in sorted(got.items()) for k, a, b in spans if k not in KINDS]
    assert new == [("mx-90210-aa", "new_email")] * 2


def test_redaction(spark):
    texts = [*contextual(), None, "", "é 1.2.3.4 +1.2.3.4.5678 z", "a@b.cc"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("key", F.lit(1))
    out = {r["doc_id"]: r["text"] for r in redact(df).collect()}
    assert redact(df).columns == df.columns
    assert out[0] == "some words then contact user at <EMAIL> and more text"
    assert out[9] == "another one with <NEW_EMAIL> elsewhere"
    assert out[12] == texts[12] and out[18] is None and out[19] == ""
    assert out[20] == "é <IP> <PHONE> z" and out[21] == "<EMAIL>"


def test_new_identifiers_are_found_wherever_they_stand(spark):
    long = "mx-" + "9a" * 60
    places = ["mx-90210-aa", "x mx-90210-aa y", "see (mx-90210-aa)", '"mx-90210-aa"', "a,mx-90210-aa,b", "id:mx-90210-aa", "[mx-90210-aa]."]
    texts = [*contextual(), f"some words then contact user at {long} and more text", *places, f"({long}) {long}b {long[:64]}"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in redact(df).collect()}
    start = len(contextual())
    assert out[start] == "some words then contact user at <NEW_EMAIL> and more text"
    for i, text in enumerate(places, start + 1):
        assert out[i] == text.replace("mx-90210-aa", "<NEW_EMAIL>")
    assert out[len(texts) - 1] == f"(<NEW_EMAIL>) {long}b {long[:64]}"


def test_odd_rows(spark):
    pairs = [(1, "a@b.cc"), (1, "a@b.cc"), (1, "none"), (None, "1.1.1.1"), (None, None)]
    df = spark.createDataFrame(pairs, "doc_id long, text string")
    assert sorted(len(r["found"]) for r in find(df).collect()) == [0, 0, 1, 1, 1]
    assert sorted(str(r["text"]) for r in redact(df).collect()) == ["<EMAIL>", "<EMAIL>", "<IP>", "None", "none"]
    assert find(df.limit(0)).count() == 0 and redact(df.limit(0)).count() == 0


def test_query_on_documents(spark, sf):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op3_contextual_personal_data(spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        spans = base(docs[r["doc_id"]])
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in KINDS] == [sum(s[0] == k for s in spans) for k in KINDS]
        assert r["spans"].startswith(text)
