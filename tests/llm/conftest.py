from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi".split()


def sentence(start: int, size: int) -> str:
    return " ".join(WORDS[(start * 5 + i * i + i * start) % len(WORDS)] for i in range(size))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing names."""
    rows = [(i, sentence(i, 5 + 3 * i), "en", f"s{i % 4}", 0) for i in range(24)]
    rows += [(100 + i, sentence(3, 14), "en", "s0", 0) for i in range(6)]
    rows += [(7, sentence(7, 26), "en", "s3", 0)] * 2
    rows += [
        (200, None, None, None, None),
        (201, "", "en", "s1", 0),
        (None, "no id at all", None, None, None),
        (None, None, None, None, None),
        (202, " \t\n ", "xx", "", 3),
        (203, "long " * 20_000 + "end", "en", "s2", 1),
        (204, "x" * 50_000, "en", "s2", 1),
        (205, "née 😀 Über line\x1cword", "fr", "s2", 1),
    ]
    docs = spark.createDataFrame(rows, DOCS)
    for name in ("row", "score", "fp", "component", "size", "word", "bucket", "pii", "doc", "blob"):
        docs = docs.selectExpr("*", f"'{name}' AS {name}")
    return docs


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
