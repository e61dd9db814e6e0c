"""Small tables with the awkward cases that every operator must take."""

import pytest


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table from (doc_id, text) or (doc_id, text, lang), with extra columns whose names operators use themselves."""
    def of(rows):
        rows = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", len(r[1] or ""), "x", 7, "y") for r in rows]
        return spark.createDataFrame(
            rows, "doc_id long, text string, lang string, source string, n_chars long, digest string, key long, row string"
        )
    return of
