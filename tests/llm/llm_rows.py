"""Small document tables and fixtures for the tests of this folder (the session is the one of all tests)."""

import pytest

from kestrel.llm.common import ship

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(autouse=True)
def shipped(spark):
    """The training-data package is at the workers."""
    ship(spark)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def frame(spark, rows):
    """documents from (doc_id, text) pairs, with columns whose names operators use inside."""
    return spark.createDataFrame([(i, t, None, None, 0, 1, "x", [b"y"], True) for i, t in rows],
                                 DOCS + ", id int, score string, spans array<binary>, kept boolean")
