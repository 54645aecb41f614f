import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("test data not present")
    return SF


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def make_docs(spark):
    """Rows (doc_id, text[, lang, source]) as a documents frame."""
    def make(rows):
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        full = []
        for r in rows:
            r = tuple(r) + (None,) * (4 - len(r))
            full.append((*r[:4], len(r[1]) if r[1] is not None else None))
        return spark.createDataFrame(full, schema)
    return make
