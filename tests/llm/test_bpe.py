from __future__ import annotations

import base64

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from tests.llm.conftest import ODD_TEXTS

from tidelake.llm import bpe, pieces

RANKS = bpe.read_ranks(bpe.RANKS)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
CODER = bpe.coder()


def test_ranks_are_read_whole():
    with open(bpe.RANKS, "rb") as lines:
        assert {base64.b64decode(x.split()[0]) for x in lines} == set(RANKS)


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60))
def test_ids_are_those_of_the_library(text):
    ids = CODER.encode(text)
    assert ids == LIBRARY.encode_ordinary(text)
    assert CODER.decode(ids) == text.encode()


@settings(max_examples=100, deadline=None)
@given(st.text("aeinrst ' 1é \n", max_size=200))
def test_latin_pre_tokens_are_those_of_the_pattern(text):
    import regex

    assert pieces.splitter()(text) == regex.findall(pieces.PATTERN, text)


@pytest.mark.parametrize("piece", ["a" * 20_000, "ab" * 9_999, "the" * 5_000, "é" * 3_000])
def test_very_long_pre_tokens(piece):
    assert list(bpe.merge(piece.encode(), RANKS)) == LIBRARY.encode_ordinary(piece)


def test_the_cache_is_bounded_and_short():
    cache = pieces.Cache(len, pieces=3)
    assert [cache["x" * n] for n in (1, 2, 3, 4, 200)] == [1, 2, 3, 4, 200]
    assert len(cache) <= 3 and "x" * 200 not in cache


def test_tables(odd, empty):
    rows = bpe.decode(bpe.encode(odd)).collect()
    assert len(rows) == odd.count()
    assert rows[0].asDict().keys() == {"doc_id", "text", "digest", "score", "ids", "decoded"}
    for row in rows:
        assert row["ids"] == LIBRARY.encode_ordinary(row["text"] or "")
        assert bytes(row["decoded"]) == (row["text"] or "").encode()
    assert sorted(str(r["text"]) for r in rows) == sorted([*map(str, ODD_TEXTS), ODD_TEXTS[5]])
    assert bpe.decode(bpe.encode(empty)).count() == 0


def test_both_in_one_pass(odd, empty):
    rows = bpe.round_trip(odd.drop("ids")).collect()
    assert rows[0].asDict().keys() == {"doc_id", "text", "digest", "score", "ids", "decoded"}
    assert all(r["ids"] == CODER.encode(r["text"] or "") and bytes(r["decoded"]) == (r["text"] or "").encode() for r in rows)
    assert len(rows) == odd.count() and bpe.round_trip(empty).count() == 0


def test_what_is_remembered_is_dropped_for_others():
    from tidelake.llm import memory

    dropped = []
    memory.enter("one", lambda: dropped.append("one"))
    memory.enter("one", lambda: dropped.append("one again"))
    assert dropped == []
    memory.enter("two")
    memory.enter("two")
    assert dropped == ["one again"]


def test_null_ids_are_empty(spark):
    df = spark.createDataFrame([(1, None), (2, [])], "id long, ids array<int>")
    assert {bytes(r["decoded"]) for r in bpe.decode(df).collect()} == {b""}


def test_an_output_cannot_replace_its_input(odd):
    with pytest.raises(ValueError):
        bpe.encode(odd, out="TEXT")
