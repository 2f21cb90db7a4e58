"""Key sets stored in buckets, so that merging into them shuffles the new keys alone.

Each period's set is one folder, laid out by a hash of its ids into a fixed number of buckets. Declared as a
bucketed table, a join with it by these ids needs no exchange on the stored side: the new keys, a day's
worth, are dealt out to the same buckets. The number of buckets is part of the layout; it is stored
beside the set the first time and kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidegauge.sources.archive import read_if_stored

#: Buckets of a new set. Size it for the largest period: a bucket should fit a task.
BUCKETS = 16
_LAYOUT = "_layout"  # readers pass over names that begin so


def stored_buckets(spark: SparkSession, path: str, wanted: int = BUCKETS) -> int:
    """The number of buckets of the set at ``path``; ``wanted``, if it has none yet."""
    known = read_if_stored(spark, f"{path}/{_LAYOUT}")
    if known is None:
        spark.createDataFrame([(wanted,)], "buckets int").write.parquet(f"{path}/{_LAYOUT}")
        return wanted
    return known.first()["buckets"]


@dataclass(frozen=True)
class BucketedSet:
    """The keys of one period, as a folder ``path/partition=value`` of bucket files."""

    spark: SparkSession
    path: str
    partition: str
    value: object
    ids: tuple[str, ...]
    buckets: int

    @classmethod
    def of(cls, spark, path: str, partition: str, value, ids: Sequence[str], buckets: int = BUCKETS) -> BucketedSet:
        return cls(spark, path, partition, value, tuple(ids), stored_buckets(spark, path, buckets))

    @property
    def folder(self) -> str:
        return f"{self.path}/{self.partition}={self.value}"

    def _table(self, schema: T.StructType) -> str:
        """Declares the folder as a table of this session. The name follows from the place and layout."""
        layout = "/".join((self.folder, str(self.buckets), *self.ids))
        name = f"keys_{hashlib.md5(layout.encode()).hexdigest()}"
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            by = ", ".join(f"`{c}`" for c in self.ids)
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet"
                f" CLUSTERED BY ({by}) SORTED BY ({by}) INTO {self.buckets} BUCKETS LOCATION '{self.folder}'"
            )
        self.spark.catalog.refreshTable(name)
        return name

    def stored(self) -> DataFrame | None:
        """The keys there are, without the period; None before the first write."""
        files = read_if_stored(self.spark, self.folder)
        if files is None:
            return None
        return self.spark.table(self._table(files.schema))

    def _dealt(self, keys: DataFrame) -> DataFrame:
        return keys.drop(self.partition).repartition(self.buckets, *self.ids)

    def unseen(self, keys: DataFrame) -> DataFrame:
        """Keys that the set lacks, dealt out to its buckets; the stored side is not shuffled."""
        stored = self.stored()
        dealt = self._dealt(keys)
        return dealt if stored is None else dealt.join(stored.select(*self.ids), list(self.ids), "left_anti")

    def append(self, keys: DataFrame) -> None:
        """Adds the keys that the set lacks. ``keys`` has each of them once."""
        new = self.unseen(keys)
        columns = [f for f in new.schema]
        stored = self.stored()
        if stored is not None:
            new, columns = new.select(*stored.columns), stored.schema.fields
        new.write.insertInto(self._table(T.StructType(columns)))

    def replace(self, keys: DataFrame) -> None:
        """Puts these keys in place of all that the set has."""
        rows = self._dealt(keys)
        rows.write.insertInto(self._table(rows.schema), overwrite=True)
