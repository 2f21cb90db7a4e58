"""Personal data by fixed patterns and bootstrapped contextual extraction, with DataFrame functions only.

Base spans come from four patterns (written with possessive loops and look-behind, so that matching
takes linear time; they match exactly what the plain patterns match). They are the seeds. Each
identifier-like token (it holds a digit or ``@``) is an instance, and the two words before it are a
lexical pattern. Patterns and instances form a graph, which Spark scores in rounds: a pattern is worth
the confidence of its instances over their number plus ``SMOOTH``, an instance is the noisy-or of the
patterns it occurs with, seeds count 1. Only patterns with ``SUPPORT`` different seeds take part. After
``ROUNDS`` rounds, instances that a pattern of at least ``PATTERN_SCORE`` introduces and whose confidence
is at least ``INSTANCE_SCORE`` are new identifiers, reported wherever they occur as ``new_`` and the kind
that most of the pattern's seeds have.

Texts are read once, into a narrow table of spans and candidates in the shared folder. Edges are counted
before they are shuffled, so a frequent pattern is one row for each of its instances.

Defined cases: a null or empty text has no spans; rows with equal ids and different texts are told apart
by a hash of the text; null ids are kept; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.textbytes import fresh
from tidegauge.session import shared_dir

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 2
SUPPORT = 3
SMOOTH = 1.0
PATTERN_SCORE = 0.5
INSTANCE_SCORE = 0.5
REACH = 80

LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Texts without these have no match.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9](?:[ -]?[0-9]){15}", "phone": r"\+[0-9]"}
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
#: Whole tokens of any length with a digit or ``@``, between white space, quotes, brackets, commas, semicolons and bars.
SEPARATOR = r"\s\"'`()\[\]{}<>,;|"
CANDIDATE = rf"(?<![^{SEPARATOR}])(?=[^{SEPARATOR}0-9@]*+[0-9@])[^{SEPARATOR}]++"
#: Marks before a token, and a label such as ``id:`` (but not the first pair of a hardware address).
BEFORE = r"[^\p{L}\p{N}@+#_]*+"
LEAD = rf"^{BEFORE}(?:\p{{L}}++[:=](?![0-9A-Fa-f]{{2}}:){BEFORE})?"
TAIL = r"(?<=[\p{L}\p{N}])[^\p{L}\p{N}]++$"
EMPTY = "array_repeat(named_struct('start', 0, 'end', 0, 'value', ''), 0)"


def spans_of(text: Column, pattern: str) -> Column:
    """``(start, end, value)`` of all matches: pieces between matches give their places."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.zip_with(F.split(text, pattern, -1), found, lambda gap, value: F.struct(gap.alias("gap"), value.alias("value")))
    pieces = F.filter(pieces, lambda p: p["value"].isNotNull())
    start = F.struct(F.lit(0).alias("at"), F.expr(EMPTY).alias("spans"))

    def add(so_far: Column, piece: Column) -> Column:
        begin = so_far["at"] + F.length(piece["gap"])
        end = begin + F.length(piece["value"])
        span = F.struct(begin.alias("start"), end.alias("end"), piece["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(so_far["spans"], F.array(span)).alias("spans"))

    return F.aggregate(pieces, start, add, lambda done: done["spans"])


def valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return value.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        fits = F.length(digits).between(16, 19)
        return fits & F.call_function("luhn_check", F.when(fits, digits).otherwise("0"))
    return F.length(digits).between(8, 15)


def base_spans(text: Column) -> Column:
    """``(kind, start, end)`` of all base kinds, by kind as listed, then start."""
    return F.concat(*(spans_of_kind(text, kind) for kind in KINDS))


def spans_of_kind(text: Column, kind: str) -> Column:
    hinted = F.contains(text, F.lit("@")) if kind == "email" else text.rlike(HINTS[kind])
    found = F.when(hinted, spans_of(text, PATTERNS[kind])).otherwise(F.expr(EMPTY))
    kept = F.filter(found, lambda s: valid(kind, s["value"]))
    return F.transform(
        kept, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    )


def candidate_spans(text: Column, base: Column) -> Column:
    """Identifier-like tokens with the pattern before them, empty if there is none, and the kind of the seed
    they overlap."""
    found = F.when(text.rlike("[0-9@]"), spans_of(text, CANDIDATE)).otherwise(F.expr(EMPTY))

    def trimmed(s: Column) -> Column:
        value = F.regexp_replace(s["value"], LEAD, "")
        begin = s["end"] - F.length(value)
        value = F.regexp_replace(value, TAIL, "")
        return F.struct(begin.alias("start"), (begin + F.length(value)).alias("end"), value.alias("value"))

    found = F.filter(
        F.transform(found, trimmed), lambda s: (F.length(s["value"]) > 1) & s["value"].rlike(r"[0-9@]") & s["value"].rlike(r"[\p{L}\p{N}]$")
    )

    def described(s: Column) -> Column:
        before = F.substr(text, F.greatest(s["start"] - REACH + 1, F.lit(1)), F.least(s["start"], F.lit(REACH)))
        words = F.regexp_extract(before, r"([^\s]+)\s+([^\s]+)\s+$", 0)
        pattern = F.trim(F.regexp_replace(F.regexp_replace(F.lower(words), "[0-9]+", "0"), r"\s+", " "))
        over = F.filter(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
        return F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            F.lower(s["value"]).alias("instance"),
            pattern.alias("pattern"),
            F.when(F.size(over) > 0, over[0]["kind"]).alias("seed"),
        )

    return F.transform(found, described)


def stored(spark: SparkSession, df: DataFrame, purpose: str) -> DataFrame:
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_spans(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per document: id, hash of the text, base spans and candidates."""
    own = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    own = own.select("id", F.xxhash64("text").alias("key"), "text", base_spans(F.col("text")).alias("base"))
    own = own.withColumn("candidates", candidate_spans(F.col("text"), F.col("base"))).drop("text")
    return stored(docs.sparkSession, own, "spans")


def new_identifiers(spans: DataFrame) -> DataFrame:
    """``(instance, kind)`` of identifiers that high-confidence patterns introduce."""
    spark = spans.sparkSession
    seen = spans.select(F.explode("candidates").alias("c")).select("c.pattern", "c.instance", "c.seed")
    # An instance without a pattern is an occurrence, and a seed if it is one, but no edge.
    edges = seen.groupBy("pattern", "instance").agg(F.max("seed").alias("seed"))
    # An instance that is a seed anywhere is one everywhere.
    seeds = edges.groupBy("instance").agg(F.max("seed").alias("known"))
    edges = edges.where("pattern != ''").join(seeds, "instance")
    support = edges.groupBy("pattern").agg(
        F.count("known").alias("seeds"), F.count(F.lit(1)).alias("instances"), F.mode("known", True).alias("kind")
    )
    support = support.where((F.col("seeds") >= SUPPORT) & (F.col("instances") > F.col("seeds")))
    edges = stored(spark, edges.join(support, "pattern"), "edges")
    confidence = edges.withColumn("confidence", F.col("known").isNotNull().cast("double"))
    for _ in range(ROUNDS):
        patterns = confidence.groupBy("pattern").agg(
            (F.sum("confidence") / (F.count(F.lit(1)) + SMOOTH)).alias("score")
        )
        scored = edges.join(patterns, "pattern")
        doubt = F.exp(F.sum(F.log(1 - F.col("score"))))
        instances = scored.groupBy("instance").agg((1 - doubt).alias("noisy_or"))
        scored = scored.join(instances, "instance")
        held = F.when(F.col("known").isNotNull(), 1.0).otherwise(F.col("noisy_or"))
        confidence = stored(spark, scored.withColumn("confidence", held).drop("noisy_or"), "scores").drop("score")
        final = confidence.join(patterns, "pattern")
    new = final.where(
        F.col("known").isNull() & (F.col("score") >= PATTERN_SCORE) & (F.col("confidence") >= INSTANCE_SCORE)
    )
    best = F.max(F.struct("score", "kind"))["kind"]
    return new.groupBy("instance").agg(F.concat(F.lit("new_"), best).alias("kind"))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its id, the hash of its text and ``found``, spans (kind, start, end): base kinds as
    listed, then new identifiers, each by start."""
    name = docs.select(id_col).columns[0]
    spans = read_spans(docs, id_col, text_col)
    each = spans.select("id", "key", F.explode("candidates").alias("c")).where("c.seed is null")
    each = each.select("id", "key", "c.instance", "c.start", "c.end")
    more = each.join(new_identifiers(spans), "instance").groupBy("id", "key").agg(
        F.array_sort(F.collect_set(F.struct("kind", "start", "end"))).alias("more")
    )
    more = more.select(F.col("id").alias("i"), F.col("key").alias("k"), "more")
    same = spans["id"].eqNullSafe(more["i"]) & (spans["key"] == more["k"])
    both = spans.join(more, same, "left")
    found = F.when(F.col("more").isNull(), F.col("base")).otherwise(F.concat("base", "more"))
    return both.select(F.col("id").alias(name), F.col("key").alias("text_key"), found.alias("found"))


def redacted(text: Column, found: Column) -> Column:
    """The text with each span, or run of overlapping spans, replaced by its kind in angle brackets."""
    spans = F.array_sort(F.transform(found, lambda s: F.struct(s["start"], s["end"], s["kind"])))
    none = F.filter(spans, lambda s: F.lit(False))

    def add(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        wider = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), last["kind"].alias("kind"))
        apart = F.concat(done, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
        joined = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(wider))
        return F.when(F.size(done) == 0, apart).when(s["start"] < last["end"], joined).otherwise(apart)

    merged = F.aggregate(spans, none, add)

    def piece(s: Column, i: Column) -> Column:
        begin = F.when(i == 0, 0).otherwise(F.get(merged, i - 1)["end"])
        return F.concat(F.substr(text, begin + 1, s["start"] - begin), F.lit("<"), F.upper(s["kind"]), F.lit(">"))

    tail = F.substr(text, F.element_at(merged, -1)["end"] + 1)
    return F.when(F.size(found) == 0, text).otherwise(F.concat(F.array_join(F.transform(merged, piece), ""), tail))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with personal data replaced; all columns and rows stay, null texts too."""
    found = find(docs, id_col, text_col).where(F.size("found") > 0).distinct()
    id_, key_, spans, own = (fresh(docs, name) for name in ("id", "key", "found", "own"))
    found = found.select(F.col(id_col).alias(id_), F.col("text_key").alias(key_), F.col("found").alias(spans))
    marked = docs.withColumn(own, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    same = marked[id_col].eqNullSafe(found[id_]) & (marked[own] == found[key_])
    both = marked.join(found, same, "left")
    text = F.when(F.col(spans).isNull(), F.col(text_col)).otherwise(redacted(F.col(text_col), F.col(spans)))
    return both.withColumn(text_col, text).select(*docs.columns)
