"""Dimension and report tables in a relational database, through Spark's own JDBC source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    table: str,
    split_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    splits: int = 1,
    **extra: str,
) -> dict[str, str]:
    """Options of a read; a numeric ``split_column`` makes it run as several tasks."""
    options = {"url": url, "dbtable": table, **extra}
    if split_column is not None:
        if bounds is None:
            raise ValueError("bounds are needed to split a read")
        options |= {
            "partitionColumn": split_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(splits),
        }
    return options


def read_table(spark: SparkSession, **kwargs) -> DataFrame:
    """Arguments as in :func:`jdbc_options`; filters on the result are pushed to the database."""
    return spark.read.format("jdbc").options(**jdbc_options(**kwargs)).load()


def replace_table(df: DataFrame, url: str, table: str, **extra: str) -> None:
    """Replaces the rows of a report table, keeping its definition."""
    options = jdbc_options(url, table, **extra) | {"truncate": "true"}
    df.write.format("jdbc").options(**options).mode("overwrite").save()
