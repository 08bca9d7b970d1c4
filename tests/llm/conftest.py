from __future__ import annotations

import re
import random

import pytest

TABLE = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, bits int, kept string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def lowered(text: str | None) -> str:
    return (text or "").translate(_LOWER)


def sentence(seed: int, size: int) -> str:
    random_ = random.Random(seed)
    return " ".join("".join(random_.choice("abcdefghinorstué") for _ in range(random_.randint(2, 8))) for _ in range(size))


SHARED = "A Line that Several Documents share, word for word"

#: (doc_id, text, lang, source): nulls in every column, empty and blank texts, a very long text,
#: exact copies, near copies, repeated rows, ties.
EDGES = [
    (1, "One two three four five six seven eight nine ten\n" + SHARED, "en", "b"),
    (2, f"  {SHARED.upper()}\t\nother words here", "en", "a"),
    (3, f"{SHARED}\r\n{SHARED}\nlast line of the third", "en", None),
    (4, "", "fr", "a"),
    (5, None, None, None),
    (6, " \t\n\x0b ", "de", "c"),
    (7, sentence(7, 6000), "en", "b"),
    (8, sentence(8, 60), "fr", "b"),
    (9, sentence(8, 60), "fr", "c"),
    (10, sentence(8, 60) + " more", None, "c"),
    (10, sentence(8, 60) + " more", None, "c"),
    (None, "a row without id but with some words", "en", "a"),
    (None, None, None, None),
    (11, "1234 5678 !!! ###", "en", "d"),
    (12, "short", "en", "d"),
    (13, "Ümläute Étude ÀB \U0001f600 naïve\n\n\nend", "de", "a"),
]


@pytest.fixture(scope="session")
def edges(spark):
    rows = [(i, t, lang, s, len(t or ""), "x", 1, None) for i, t, lang, s in EDGES]
    return spark.createDataFrame(rows, TABLE).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], TABLE)
