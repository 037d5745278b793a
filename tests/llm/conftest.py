from __future__ import annotations

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row int, size string, label string"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text[, lang[, source]]), with more columns whose names operators use inside."""

    def of(rows, partitions: int = 3):
        full = []
        for doc, text, *more in rows:
            lang, source = [*more, None, None][:2]
            full.append((doc, text, lang, source, len(text or ""), 7, "big", "x"))
        return spark.createDataFrame(full, SCHEMA).repartition(partitions)

    return of


@pytest.fixture(scope="session")
def edges():
    """Nulls, empty and long texts, repeated rows, one id with two texts."""
    long_text = " ".join(f"w{i % 997} the of" for i in range(20_000))
    return [
        (1, "The quick brown fox jumps over the lazy dog, again and again it jumps over it."),
        (1, "The quick brown fox jumps over the lazy dog, again and again it jumps over it."),
        (1, "another text with the same id"),
        (None, "The quick brown fox jumps over the lazy dog, again and again it jumps over it."),
        (None, None),
        (3, None),
        (4, ""),
        (5, " \t\n\x0b\x0c\r "),
        (6, long_text),
        (7, long_text),
        (8, "one"),
        (9, "ONE"),
        (10, "é ß   日本 🙂"),
    ]
