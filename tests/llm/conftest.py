import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

WORD = r"[^\x20\x09-\x0D]+"


@pytest.fixture(scope="session")
def oddities(spark):
    """Documents with nulls in every column, empty and long texts, repeated rows, repeated keys, and columns
    whose names the operators use themselves."""
    long = " ".join(f"word{i % 700}" for i in range(30_000))
    shape = ("doc_id long, text string, lang string, source string, n_chars long, row int, rank int, size int, "
             "cell string, kept string, target int, offset int")
    rows = [
        (1, "One plain text of some words, written once.", "en", "a", 43),
        (2, None, "en", "a", None),
        (3, "", None, None, 0),
        (4, " \t\n\x0b\x0c\r ", "en", "b", 7),
        (5, long, "en", "b", len(long)),
        (5, long, "en", "b", len(long)),
        (5, "another text with the same key", "en", None, 30),
        (None, "a text without a key, é ñ 漢字 😀", "fr", "a", 31),
        (None, None, None, None, None),
        (6, "One plain text of some words, written once.", "en", "", 43),
    ]
    return spark.createDataFrame([(*r, 1, 2, 3, "c", "k", 4, 5) for r in rows], shape)


@pytest.fixture(scope="session")
def nothing(oddities):
    return oddities.where("false")
