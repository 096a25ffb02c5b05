import os

import pytest

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    if not os.path.isdir(FOLDER):
        pytest.skip("no driver tables")
    return spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "source").toPandas().sort_values("doc_id")


@pytest.fixture
def make(spark):
    """A table from rows, over three partitions, with further columns whose names operators use themselves."""

    def build(rows, schema, clash=("key", "row", "_text", "_row", "start", "toxic", "_own")):
        extra = [c for c in clash if c not in [part.split()[0] for part in schema.split(", ")]]
        full = ", ".join([schema, *[f"{c} string" for c in extra]])
        return spark.createDataFrame([(*r, *["x"] * len(extra)) for r in rows], full).repartition(3)

    return build
