import random
from pathlib import Path

import pytest

FOLDER = Path("/root/testdata/sf0.001")
COLUMNS = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # names that operators use for columns of their own
    "row long, size string, size_2 int, target string, copies string, score string, "
    "n_lines string, n_dropped string, before string, u string, of string, nth string"
)


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    syllables = "ba be ku lo mi na po ra se ti vu zo".split()
    out = []
    for i in range(words):
        word = "".join(r.choices(syllables, k=r.randint(1, 4)))
        out.append(word + ("." if i % 11 == 10 else "") + ("\n" if i % 23 == 22 else ""))
    return " ".join(out)


@pytest.fixture(scope="session")
def make(spark):
    """A documents table with clashing extra columns, from (doc_id, text, lang, source) rows."""

    def build(rows):
        full = [(i, t, la, s, len(t or ""), 7, *["x"] * 1, 3, *["x"] * 9) for i, t, la, s in rows]
        return spark.createDataFrame(full, COLUMNS).repartition(3)

    return build


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls everywhere, empty, very short and very long texts, repeated rows, odd characters."""
    long = prose(1, 30_000)
    return [
        (1, prose(2, 120), "en", "a"),
        (1, prose(2, 120), "en", "a"),
        (2, prose(2, 120), "en", "b"),
        (3, None, "en", "a"),
        (4, "", None, None),
        (None, prose(3, 80), "de", None),
        (None, None, None, None),
        (5, " \t\r\n\n ", "de", "b"),
        (6, "word", "de", "b"),
        (7, long, "en", "a"),
        (8, "x" * 50_000, None, "b"),
        (9, "Ä ß é 日本語 🎉 \x00   don't <|endoftext|> AİB", "fr", "c"),
        (10, "\n".join(["same line"] * 60), "en", "c"),
    ]


@pytest.fixture(scope="session")
def odd(make, odd_rows):
    return make(odd_rows)


@pytest.fixture(scope="session")
def empty(make):
    return make([(0, "x", "en", "a")]).limit(0)
