from __future__ import annotations

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def docs(spark):
    """documents from (doc_id, text) or (doc_id, text, lang)."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", len(r[1]) if r[1] is not None else None) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture
def odd(spark):
    """Nulls, empty and blank texts, repeated rows, ties, one long text and clashing columns."""
    long = " ".join(f"word{i % 977} and{i % 31}" for i in range(20_000))
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (5, "one two\nthree"), (None, "one two\nthree"),
        (None, None), (6, long), (7, long), (8, long + " end"), (9, "the same line\n" * 9), (10, "the same line\n" * 9),
        (11, "a\r\nb c d \U0001f600 naïve ß"), (12, "...,,,!!!"), (13, "x" * 500),
    ]
    names = "ids n tokens kind tag bucket rep id piece th start _cover_lines component lang_pred".split()
    full = [(*r, None, "s", None, *[7] * len(names)) for r in rows]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    return spark.createDataFrame(full, schema + ", ".join(f"`{n}` int" for n in names))
