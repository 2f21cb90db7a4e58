"""Operators that return the input's columns leave them alone, whatever they are called."""

import pytest
from pyspark.sql import functions as F

from tidegauge.llm import personal_data, quality_rules
from tidegauge.llm.decontaminate import drop_contaminated
from tidegauge.llm.jaccard_join import keep_one

ODD_NAMES = ["__rare", "__k", "__found", "__own", "__key", "__id", "__first", "__rare_", "found", "key", "id", "node", "label"]
TEXT = "A line of many quite ordinary words stands here, and mail goes to someone@example.org now."


@pytest.mark.parametrize("work", [
    lambda d: quality_rules.keep_good(d, quality_rules.fit(d)),
    lambda d: quality_rules.keep_good(d, None),
    personal_data.redact,
    keep_one,
    lambda d: drop_contaminated(d, d.select(F.col("doc_id").alias("item_id"), "text").limit(0)),
])
def test_clashing_columns_keep_their_values(spark, work):
    df = spark.createDataFrame([(1, TEXT), (2, TEXT + " But this one goes on a little."), (3, None)], "doc_id long, text string")
    df = df.withColumns({name: F.concat(F.lit(name), F.col("doc_id").cast("string")) for name in ODD_NAMES})
    rows = work(df).collect()
    assert rows and rows[0].asDict().keys() == set(df.columns)
    for r in rows:
        assert all(r[name] == f"{name}{r['doc_id']}" for name in ODD_NAMES)
