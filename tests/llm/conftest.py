from __future__ import annotations

import pytest

from tests.oracle import connect

FOLDER = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def sf():
    return FOLDER


@pytest.fixture(scope="session")
def con():
    return connect(FOLDER)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r["doc_id"]: r["text"] for r in documents.collect()}


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text) rows, with columns that could clash with ours."""

    def make(rows):
        full = [(i, t, "en", "s", len(t or ""), "x", 1, 2, 3, "y", 4, 5, 6, 7, "z", 8) for i, t in rows]
        extra = "digest string, rep int, row_no int, keep_id int, text_sha256 string, kept_id int, bad_id int, BAD_KEY int, gone_id int, kept_sha string, copy_no int"
        return spark.createDataFrame(full, f"{DOCUMENTS}, {extra}", verifySchema=False)

    return make
