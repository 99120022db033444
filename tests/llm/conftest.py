from __future__ import annotations

import pytest

from tidelake.session import find_package

# A token of 5,000 words, as a very long text beside short ones.
LONG = " ".join(f"w{i % 997}x{i}" for i in range(5000))

# Texts that tables of documents may hold: none, empty, blank, short, odd, long, repeated.
ODD_TEXTS = [
    None,
    "",
    " \t\n ",
    "one",
    "One two THREE four",
    "one two three four five",
    "one two three four five",
    "ONE two three four five \U0001f600 中文",
    "\x00\x01 null bytes \x1f and   marks",
    LONG,
    LONG + " with an end",
]


@pytest.fixture(autouse=True)
def package(spark):
    find_package(spark)


@pytest.fixture
def odd(spark):
    """Documents with odd texts, repeated and null keys, and columns whose names may clash."""
    rows = [(i if i != 3 else None, t, i, "x", b"y", 0.5) for i, t in enumerate(ODD_TEXTS)]
    rows.append((5, ODD_TEXTS[5], 99, None, None, None))
    return spark.createDataFrame(
        rows, "doc_id long, text string, ids long, digest string, decoded binary, score double"
    )


@pytest.fixture
def empty(odd):
    return odd.limit(0)
