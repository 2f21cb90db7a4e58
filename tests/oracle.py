"""Runs a query in Spark and its SQL in DuckDB and compares the rows."""

from __future__ import annotations

import os
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        if os.path.exists(path):
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return db


def rows_of_sql(db: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    cursor = db.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = Counter(tuple(row[i] for i in order) for row in cursor.fetchall())
    return sorted(names), rows


def rows_of_df(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(row) for row in df.select(*names).collect())


def difference(df, db, sql: str) -> str | None:
    """What differs, or None."""
    spark_names, spark_rows = rows_of_df(df)
    sql_names, sql_rows = rows_of_sql(db, sql)
    if spark_names != sql_names:
        return f"columns {spark_names} and {sql_names}"
    if spark_rows != sql_rows:
        only_spark = list((spark_rows - sql_rows).items())[:3]
        only_sql = list((sql_rows - spark_rows).items())[:3]
        return (
            f"{sum(spark_rows.values())} and {sum(sql_rows.values())} rows; columns {spark_names};"
            f" only in Spark: {only_spark}; only in SQL: {only_sql}"
        )
    return None
