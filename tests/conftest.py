import os
import tempfile
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from touchline.session import build_session

    session = build_session(
        "tests", "local[4]", spark__checkpoint__dir=tempfile.mkdtemp(prefix="touchline-tests-"), spark__sql__shuffle__partitions="4", spark__driver__memory="4g", spark__ui__showConsoleProgress="false"
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def one(spark):
    """Evaluate a column expression over a list of texts."""

    def evaluate(expression, values, kind="string"):
        from pyspark.sql import functions as F

        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"i int, v {kind}").repartition(2)
        return [r[1] for r in sorted(df.select("i", expression(F.col("v")).alias("o")).collect())]

    return evaluate
