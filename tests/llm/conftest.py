from __future__ import annotations

import pytest

WORDS = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua".split()
EXTRA = "n long, token string, s1 string, part int, size string, shard int, row int, score string, spans string, kept int, task int, y int"


def rows_of(texts):
    """(doc_id, text, extra columns) of texts."""
    return [(i, t, *range(1), "a", "b", 1, "c", 2, 3, "d", "e", 4, 5, 6) for i, t in texts]


@pytest.fixture(scope="session")
def frame(spark):
    """Documents with extra columns whose names the operators use inside."""

    def make(texts):
        return spark.createDataFrame(rows_of(texts), f"doc_id long, text string, {EXTRA}").repartition(3)

    return make


@pytest.fixture(scope="session")
def odd_texts():
    """Null ids and texts, empty, blank and very long texts, ties and repeated rows."""
    prose = " ".join(WORDS * 4) + "."
    return [
        (1, prose), (1, prose), (2, prose), (None, prose), (3, None), (4, ""), (5, " \t\n\x0b "), (6, "one"), (7, "one"),
        (8, "x" * 300_000), (9, "word " * 60_000), (None, None), (10, "a\x00b c\x00 d   é漢😀 " * 30), (11, "1" * 50_000), (12, "@" * 20_000),
    ]
