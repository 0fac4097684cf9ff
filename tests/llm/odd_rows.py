"""Odd documents that every operator has to bear."""

from __future__ import annotations

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, f bigint, score string"

ODD = [
    (0, "plain words in a row that make a text", "en", "a", 37, "x", 1, "s"),
    (1, None, None, None, None, None, None, None),
    (2, "", "en", "a", 0, "x", 1, "s"),
    (3, " \t\n ", "en", "a", 4, "x", 1, "s"),
    (4, "plain words in a row that make a text", "en", "b", 37, "y", 2, "t"),
    (4, "plain words in a row that make a text", "en", "b", 37, "y", 2, "t"),
    (5, "écrit à jane.doe+x@mail.example.com ou +1 (555) 010-9999 🎉 fin", "fr", "c", 62, "z", 3, "u"),
    (6, "word " * 20000, "en", "d", 100000, "z", 3, "u"),
    (None, "no id at all", "en", "e", 12, "z", 3, "u"),
    (7, "x" * 30000, "en", "f", 30000, "z", 3, "u"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)
