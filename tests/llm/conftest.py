from __future__ import annotations

import pytest

#: id, text, lang, source and a column whose name clashes with those the operators make.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, size int, g int, fp string, spans string, bytes int, h int"


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows: list[tuple]):
        """Documents from (doc_id, text[, lang[, source]]) with clashing further columns."""
        full = []
        for r in rows:
            doc, text, lang, source = (*r, *(None,) * (4 - len(r)))
            full.append((doc, text, lang, source, len(text) if text is not None else None, "x", 1, 2, "y", "z", 3, 4))
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def documents(spark, smallest):
    return spark.read.parquet(f"{smallest}/documents.parquet")
