import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from odd_cases import ODD  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs; further columns clash with names the operators use inside."""

    def make(rows):
        full = [(i, t, "en", "src0", len(t) if t is not None else None, 1, "x", 0.5) for i, t in rows]
        return spark.createDataFrame(full, DOCS + ", d long, rid string, score double").repartition(4)

    return make


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))


@pytest.fixture(scope="session")
def texts_of(documents):
    return {r.doc_id: r.text or "" for r in documents.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    return make_docs(ODD)


@pytest.fixture(scope="session")
def no_docs(make_docs, odd_docs):
    return odd_docs.filter("false")
