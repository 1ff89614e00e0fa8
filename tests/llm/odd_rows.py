"""Fixtures of awkward document rows, shared by the test modules of this folder."""

from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, shard int, score double, copy string, node long, id string"


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty and very long texts, ties, repeated rows and clashing extra columns."""

    def row(i, text, source="a"):
        return (i, text, "en", source, None if text is None else len(text), 7, 0.5, "x", 3, "y")

    long = " ".join(f"w{i % 977}x{i}" for i in range(20_000))
    rows = [row(1, None), row(2, ""), row(3, "one"), row(4, "one two three four five six"), row(4, "one two three four five six")]
    rows += [row(5, "One, two three four five six!", None), row(6, long), row(7, long + " more", "b"), row(None, "nobody's words here"), row(8, " \t\n ")]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)
