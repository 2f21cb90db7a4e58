"""The training-corpus pipeline: five stages over documents, each written and read again.

    quality rules -> near duplicates -> benchmark decontamination -> personal data -> packing

The first three drop documents and the fourth rewrites texts; these return the columns of
documents. The last packs what is left into token sequences. Near duplicates are judged on
shingles of five words and a similarity of 0.8.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm import personal_data, quality_rules
from tidegauge.llm.decontaminate import drop_contaminated
from tidegauge.llm.jaccard_join import keep_one
from tidegauge.llm.packing import pack
from tidegauge.llm.queries import tokenizer_path
from tidegauge.session import shared_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs, quality_rules.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs, width=5, num=80, den=100)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = personal_data.redact(docs)
    if "n_chars" in clean.columns:
        size = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text"))
        clean = clean.withColumn("n_chars", size.cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("personal_data", personal),
    ("best_fit_packing", packing),
]

#: CRF decoding, redaction by learnt patterns and tokens are beyond SQL; tests/llm holds the
#: stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
