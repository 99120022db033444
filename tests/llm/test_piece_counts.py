from __future__ import annotations

import pytest
from hypothesis import given, settings, strategies as st

from tidelake.llm import bpe, pieces
from tidelake.llm.piece_counts import Automaton, count_tokens

RANKS = bpe.read_ranks(bpe.RANKS)
AUTOMATON = Automaton(RANKS)


def greedy(piece: bytes, vocabulary) -> int:
    count = at = 0
    while at < len(piece):
        end = min(len(piece), at + 200)
        while piece[at:end] not in vocabulary:
            end -= 1
        at, count = end, count + 1
    return count


@settings(max_examples=200, deadline=None)
@given(st.text("theinroa sdé1.", max_size=60))
def test_counts_are_those_of_the_greedy_match(text):
    assert AUTOMATON.count(text.encode()) == greedy(text.encode(), RANKS)


@settings(max_examples=200, deadline=None)
@given(st.sets(st.binary(min_size=1, max_size=5).map(lambda b: bytes(97 + x % 3 for x in b))), st.text("abc", max_size=30))
def test_any_vocabulary_with_all_bytes(tokens, text):
    vocabulary = tokens | {b"a", b"b", b"c"}
    assert Automaton(vocabulary).count(text.encode()) == greedy(text.encode(), vocabulary)


def test_an_unknown_byte_is_an_error():
    with pytest.raises(ValueError):
        Automaton([b"a", b"ab"]).count(b"abz")


def test_tables(odd, empty):
    split = pieces.splitter()
    found = sorted((r["n_words"], r["n_tokens"]) for r in count_tokens(odd).collect())
    texts = [r["text"] or "" for r in odd.collect()]
    assert found == sorted((len(split(t)), sum(greedy(p.encode(), RANKS) for p in split(t))) for t in texts)
    assert count_tokens(empty).count() == 0
