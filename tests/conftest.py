import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidegauge.session import build  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build(
        "local[4]",
        "tests",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF_DIR


@pytest.fixture(scope="session")
def db(sf):
    from oracle import connect

    return connect(sf)


@pytest.fixture
def column(spark):
    """Values of an expression over one column ``c``."""

    def evaluate(expression, values, kind="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
        rows = df.select("i", expression.alias("r")).orderBy("i").collect()
        return [row["r"] for row in rows]

    return evaluate
