"""Fixtures of odd rows."""

import pytest

WORDS = "the of a river stone walks slowly under green light while every small bird sings again about water and bread".split()


def prose(seed: int, n: int) -> str:
    return " ".join(WORDS[(seed * 7 + k * k * (seed % 5 + 1) + k // 3) % len(WORDS)] for k in range(n))


#: Null, empty and blank texts, ties, repeated rows, a very long word and a long text, odd characters.
ODD = [
    (1, prose(1, 80)), (2, prose(1, 80)), (2, prose(1, 80)), (3, None), (4, ""), (5, " \t\n "), (None, prose(2, 60)), (None, None), (6, "x" * 50_000), (7, prose(3, 20_000)),
    (8, "Éa\u00a0b\u3000c 😀 d\u0000e ▁f"), (9, "ONE two\nONE two\nONE two\n"), (10, "MIT License MIT license mit-license"), (11, "under CC BY-NC 4.0."), (12, prose(4, 9)), (13, prose(1, 79) + " extra"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows as documents, with columns of names that the operators use themselves."""
    rows = [(i, t, "en" if k % 3 else None, f"s{k % 2}" if k % 5 else None, len(t or ""), f"r{k}", k, "w", 1.5) for k, (i, t) in enumerate(ODD)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row string, n long, words string, bits double").repartition(3)


@pytest.fixture
def none(odd):
    return odd.where("false")
