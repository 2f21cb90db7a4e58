"""Archives laid out for searches of single members: sorted files, statistics and Bloom filters.

A file holds a range of members of one day, sorted, so the row groups' minimum and maximum leave out most of
them; a Bloom filter for each row group leaves out those whose range holds the member by chance. A
busy member is split over files by time. Searches are plain filters, which the scan applies to both.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROW_GROUP_BYTES = 32 << 20
#: Distinct members that a row group's Bloom filter is sized for, at a false hit in a hundred.
GROUP_MEMBERS = 200_000


def write_searchable(
    df: DataFrame,
    path: str,
    *partitions: str,
    by: str = "member_id",
    ts: str = "ts",
    row_group_bytes: int = ROW_GROUP_BYTES,
    members: int = GROUP_MEMBERS,
    bloom: bool = True,
    files: int | None = None,
) -> None:
    """Replaces the partitions that ``df`` has rows of, in about ``files`` files or as many as shuffles have."""
    order = [*partitions, by, ts]
    dealt = df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)
    writer = dealt.sortWithinPartitions(*order).write.mode("overwrite")
    writer = writer.option("partitionOverwriteMode", "dynamic").option("parquet.block.size", row_group_bytes)
    writer = writer.option("parquet.page.row.count.limit", 5000)
    if bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{by}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{by}", members)
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)


def grep(
    spark: SparkSession,
    path: str,
    members: Sequence[str],
    actions: Sequence[str] = (),
    first: date | None = None,
    last: date | None = None,
    by: str = "member_id",
    matching: Column | None = None,
) -> DataFrame:
    """Rows of some members, of some actions and days if given, that also match a condition if given."""
    rows = spark.read.parquet(path).where(F.col(by).isin(list(members)))
    if actions:
        rows = rows.where(F.col("action").isin(list(actions)))
    if first is not None:
        rows = rows.where(F.col("dt") >= F.lit(first))
    if last is not None:
        rows = rows.where(F.col("dt") <= F.lit(last))
    return rows if matching is None else rows.where(matching)
