import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

#: Columns beside the documents' own whose names the operators use inside.
CLASH = "size long, row string, position long, block long, id long, kept string, spans string, component_id long"


@pytest.fixture(scope="session")
def as_documents(spark):
    """Documents from (doc_id, text, lang, source), with extra columns of clashing names."""

    def make(rows):
        full = [(i, t, lang, src, len(t or ""), 1, "x", 2, 3, 4, "k", "s", 5) for i, t, lang, src in rows]
        return spark.createDataFrame(full, f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}")

    return make


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, empty, blank and very long texts, ties and repeated rows."""
    long_text = " ".join(f"w{i * i % 9973}" for i in range(30_000))
    return [
        (1, "One two three. " * 20, "en", "a"), (1, "One two three. " * 20, "en", "a"), (2, None, None, None),
        (3, "", "en", None), (4, " \n\t ", None, "b"), (5, long_text, "de", "a"), (6, "Ünïcode ß " * 40, "de", "b"),
        (7, "a" * 3000, "en", "b"), (8, "word", "en", "c"), (9, long_text[:5000], "de", "a"), (10, "One two three. " * 20, "fr", "d"),
    ]
