from __future__ import annotations

import pytest

#: Empty, blank, repeated, very long, unusual and special texts; null ids and texts; extra columns whose names clash with outputs.
WORDS = "the cat sat on a mat while seven dogs ran past the old mill near our quiet river bank at dawn every day of spring".split()


def passage(k: int, n: int = 60) -> str:
    return " ".join(WORDS[(i * (k + 3) + i // 7) % len(WORDS)] + str((i * k) % 11) for i in range(n))


EDGE = [
    (1, passage(1)),
    (2, passage(1)),
    (3, passage(1) + " tail"),
    (4, None),
    (5, ""),
    (6, "   \n\t \n"),
    (7, "word " * 40_000),
    (8, "x" * 50_000),
    (9, "ΣΑΣ İstanbul ﬁ é 日本語 😀 <|endoftext|> it's\x1c y"),
    (10, passage(2) + "\n" + passage(3) + "\nshort\n" + passage(4)),
    (11, "other start\n" + passage(3) + "\nshort\n" + passage(4) + "\n" + passage(3)),
    (12, "two words"),
    (13, "two words"),
    (13, "two words"),
    (None, passage(1)),
    (14, "1234 !!! ..."),
]


@pytest.fixture(scope="session", name="passage")
def passage_fixture():
    return passage


@pytest.fixture(scope="session")
def edge_rows():
    return EDGE


@pytest.fixture(scope="session")
def edge(spark):
    rows = [(i, t, "en" if (i or 0) % 2 else None, "s", -1, "block", 1.5) for i, t in EDGE]
    # lang may be null; the last columns bear names that the operators use themselves.
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_tokens int, block string, score double").repartition(3)


@pytest.fixture(scope="session")
def nothing(edge):
    return edge.limit(0)
