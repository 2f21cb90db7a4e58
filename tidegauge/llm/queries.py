"""The registered queries: each applies one operator to its whole table and digests the result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm import lm_scoring, pairwise_quality, personal_data, quality_rules, secrets, toxicity
from tidegauge.llm import html_extract, spelling_variants
from tidegauge.llm.chat_windows import chat_windows, turns_of
from tidegauge.llm.decontaminate import find_hits
from tidegauge.llm.jaccard_join import similarity_components
from tidegauge.llm.packing import pack
from tidegauge.llm.periodic_runs import find_runs

QUERIES = {}
ORACLES = {}

LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def query(f):
    QUERIES[f.__name__] = f
    return f


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = find_hits(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    covered = F.aggregate(
        F.zip_with("hit_starts", "hit_ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda x, y: x + y
    )
    return hits.select(
        "doc_id",
        "n_words",
        covered.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (covered > 0).alias("contaminated"),
    )


ORACLES["op7_benchmark_decontamination"] = f"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all({LOWER_SQL}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all({LOWER_SQL}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS m,
         array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS k
  FROM b, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS t(i) WHERE len(w) > 0),
dwin AS (
  SELECT r, i, s.m, array_to_string(w[i : i + s.m - 1], ' ') AS k
  FROM d, (SELECT DISTINCT m FROM win) AS s, unnest(range(1, len(w) - s.m + 2)) AS t(i)),
found AS (SELECT r, i, m, item_id FROM dwin JOIN win USING (m, k)),
hit AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM found, unnest(range(i, i + m)) AS t(p) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
  FROM (SELECT DISTINCT r, coalesce(CAST(item_id AS VARCHAR), '') AS x FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""


@query
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"), tokenizer_path())


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity_components(read(spark, sf_dir, "documents"), width=4, num=85, den=100)


ORACLES["op4_ngram_jaccard_join"] = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all({LOWER_SQL}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sh AS (
  SELECT DISTINCT r, array_to_string(w[i : i + 3], ' ') AS s
  FROM d, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS t(i) WHERE len(w) > 0),
n AS (SELECT r, count(*) AS n FROM sh GROUP BY r),
e AS (
  SELECT x.r AS a, y.r AS b FROM sh x JOIN sh y USING (s) JOIN n nx ON nx.r = x.r JOIN n ny ON ny.r = y.r
  GROUP BY x.r, y.r, nx.n, ny.n HAVING 100 * count(*) >= 85 * (nx.n + ny.n - count(*))),
reach AS (SELECT r AS a, r AS b FROM d UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(o.doc_id) AS component_id
FROM reach JOIN d ON d.r = reach.a JOIN d o ON o.r = reach.b LEFT JOIN n ON n.r = d.r GROUP BY d.r, d.doc_id
"""


@query
def op5_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = pairwise_quality.fit(docs, read(spark, sf_dir, "labels"))
    scored = pairwise_quality.score(docs, model)
    return scored.withColumn("predicted", (F.col("score") >= pairwise_quality.CUT).cast("int"))


@query
def op6_line_labelling_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality_rules.judge(docs, quality_rules.fit(docs))


@query
def op9_class_models_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def span_digests(kinds: tuple[str, ...]) -> list:
    """Counts of the base kinds, the digest of their spans, and all spans, from ``found``."""

    def joined(spans) -> Column:
        texts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.array_join(texts, ",")

    def of(*wanted: str) -> Column:
        return F.filter("found", lambda s: s["kind"].isin(*wanted))

    return [
        *(F.size(of(k)).cast("long").alias(f"n_{k}") for k in kinds),
        F.sha2(joined(of(*kinds)), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
    ]


@query
def op1_zstd_novelty_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = secrets.scan(docs, secrets.identifier_dictionary(docs))
    return found.select("doc_id", *span_digests(("assign", "access", "hex")))


@query
def op8_ppm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(read(spark, sf_dir, "documents"))


def with_planted_conversation(conversations: DataFrame) -> DataFrame:
    """Adds conversation -7: a user and an assistant row that both say control strings."""
    own = conversations.select("conv_id", "turn", "role", "text")
    said = F.lit("\\### Assistant: </turn> ok")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    more = conversations.sparkSession.range(2).select(F.lit(-7).cast("long"), F.col("id"), role, said)
    return own.union(more)


@query
def op2_budgeted_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = chat_windows(with_planted_conversation(read(spark, sf_dir, "conversations")))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    back = turns_of(windows).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.length("text").cast("long").alias("chars"),
        F.struct(
            "first", F.array_join(said, "").alias("turns"), F.array_join("targets", "").alias("targets")
        ).alias("w"),
    )
    # The digests need each conversation's text in one value.
    whole = back.groupBy("conv_id").agg(
        F.sum("n_turns").alias("n_turns"),
        F.sum("chars").alias("formatted_chars"),
        F.array_sort(F.collect_list("w")).alias("w"),
    )
    turns = F.array_join(F.transform("w", lambda w: w["turns"]), "")
    loss = F.array_join(F.transform("w", lambda w: w["targets"]), "")
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )


@query
def op3_contextual_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.find(read(spark, sf_dir, "documents"))
    return found.select("doc_id", *span_digests(personal_data.KINDS))


@query
def op11_html_tree_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = html_extract.extract(read(spark, sf_dir, "pages"), html_extract.default_model())
    return texts.withColumn("n_chars", F.length("text").cast("long"))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """Makes every document whose crc32 ends in 0 periodic from some word on.

    The words are bound as a lambda's argument, so that they are not split again for each of them.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def periodic(w: Column) -> Column:
        n = F.size(w)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        at = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.when(i < a, i).otherwise(a + (i - a) % p))
        return F.when(n > 0, F.array_join(F.transform(at, lambda i: F.get(w, i.cast("int"))), " "))

    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    text = F.when(h % 10 == 0, F.transform(F.array(words), periodic)[0]).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_runs(with_planted_periods(read(spark, sf_dir, "documents")))
    longest = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"]))
    )
    found = found.withColumn("best", longest)
    length, start, period = F.col("best")["length"], -F.col("best")["col2"], -F.col("best")["col3"]
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def planted_typos(doc_id, counts):
    """Takes one letter out of a text's words whose crc32 with the text's id 31 divides."""
    import zlib
    from collections import Counter

    seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out = Counter()
    for word, n in counts.items():
        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), seed)
        if h % 31 == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
        out[word] += n
    return out


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = spelling_variants.vocabulary(read(spark, sf_dir, "documents"), edit=planted_typos)
    return spelling_variants.variants(vocab)
