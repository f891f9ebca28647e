from __future__ import annotations

import pytest

from postsift.llm.tables import importable

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def _workers(spark):
    importable(spark)


@pytest.fixture(scope="session")
def sf_dir():
    import os

    if not os.path.isdir(SF_DIR):
        pytest.skip("no test data")
    return SF_DIR


@pytest.fixture
def documents(spark):
    """A table of documents from (doc_id, text) pairs, with columns whose names clash with results."""

    def build(rows):
        schema = "doc_id bigint, text string, n_words string, kept string, size string, class_id string, n_bytes string, rank string"
        return spark.createDataFrame([(i, t, "x", "y", None, "z", "b", "r") for i, t in rows], schema)

    return build
