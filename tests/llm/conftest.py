import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (doc_id, text) or (doc_id, text, lang) rows."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Null id, null, empty and blank texts, a repeated row, a long text and characters beyond ASCII."""
    draw = random.Random(3)
    long = " ".join(draw.choice("alpha beta gamma delta epsilon zeta".split()) for _ in range(20_000))
    return [
        (1, "The quick brown fox jumps over the lazy dog."),
        (1, "The quick brown fox jumps over the lazy dog."),
        (None, "The quick brown fox jumps over the lazy dog."),
        (2, None),
        (3, ""),
        (4, " \n\t "),
        (5, long),
        (6, "Überraschung, naïve café 日本語   ½ </s> <|endoftext|>"),
        (None, None),
        (7, "a"),
    ]
