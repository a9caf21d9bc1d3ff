import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, shard string, score string"


def words(n, start=0):
    return " ".join(f"w{i}" for i in range(start, start + n))


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls in every column, empty and long texts, repeated rows and ids, clashing column names."""
    long = " ".join(f"Palavra{i % 977}é" for i in range(60_000))
    rows = [
        (1, "Ana e Beto. Ana e Beto, de novo.", "pt", "a"),
        (1, "Ana e Beto. Ana e Beto, de novo.", "pt", "a"),
        (1, "another text with the same id", "en", "b"),
        (2, None, None, "a"),
        (3, "", "en", None),
        (4, " \t\n", None, ""),
        (None, "no id here but words", "en", "b"),
        (None, None, None, None),
        (5, long, "pt", "b"),
        (6, "1234 5678 !!!", "en", "a"),
        (7, "\u0130stanbul \ufb01n \u00a0 x\u00a0y \U0001f600 e\u0301 \u212b", "tr", "c"),
        (8, words(40), "en", "c"),
        (9, words(40), "en", "c"),
        (10, words(36), "en", "c"),
        (-5, "negative id", "en", "c"),
    ]
    return spark.createDataFrame([(*r, None, "own", "own", "own") for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def nothing(messy):
    return messy.limit(0)
