"""A bounded sample of labelled documents, and the held-out rule of both classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(parts))


def sample_ids(labels: DataFrame, label_col: str, per_class: int, id_col: str) -> DataFrame:
    """At most ``per_class`` ids of each label 0 and 1 outside the held-out part, by hash order.

    Returns ``(id, label)``; null ids and null labels are left out, and a document with
    both labels is in both classes.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    known = known.where("id is not null and label in (0, 1)").where(remainder("id", 5) != 0).distinct()
    parts = [
        known.where(F.col("label") == c).orderBy(F.xxhash64("id"), "id").limit(per_class) for c in (0, 1)
    ]
    return parts[0].unionByName(parts[1])


def labelled_texts(
    docs: DataFrame, labels: DataFrame, label_col: str, per_class: int, id_col: str, text_col: str
) -> DataFrame:
    """``(id, label, text)`` of the sample; its ids are few enough to broadcast.

    Equal rows count once, and of ids that the documents repeat with other texts the smallest hashes of
    all make up at most ``per_class`` rows of each class.
    """
    ids = F.broadcast(sample_ids(labels, label_col, per_class, id_col))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(ids, "id")
    # Few rows as a rule; texts follow only for those that stay.
    first = rows.groupBy("id", "label", F.xxhash64("text").alias("key")).agg(F.first("text").alias("text"))
    parts = [
        first.where(F.col("label") == c).orderBy(F.xxhash64("id", "key"), "id", "key").limit(per_class) for c in (0, 1)
    ]
    return parts[0].unionByName(parts[1]).select("id", "label", "text")
