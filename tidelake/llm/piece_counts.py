"""Token counts by greedy longest match, in one pass and without building pieces.

The vocabulary is a trie. Each node knows its failure link, the node that stands for
what is left once the longest matches are taken from the front, and how many tokens
were taken on the way. A character thus either goes one edge down or follows links,
and the count of a pre-token takes time in proportion to its length.

Pre-tokens carry their leading space, which plays the part of the mark for the first
piece of a word. Every single byte is in the vocabulary, so that each text has a
count. Null and empty texts count 0; repeated rows are counted each; an empty table
gives an empty result; columns other than the key and the text are left out.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tidelake.llm.bpe import RANKS, read_ranks
from tidelake.llm.memory import enter
from tidelake.llm.pieces import PATTERN, Cache, splitter
from tidelake.llm.tables import keyed, texts

_ROOT = 0


class Automaton:
    """Longest-match automaton of a vocabulary that holds every byte it will meet."""

    def __init__(self, vocabulary: Iterable[bytes]):
        self.goto: dict[int, int] = {}  # node << 8 | byte -> node
        children: list[list[tuple[int, int]]] = [[]]
        is_token = [False]
        for token in vocabulary:
            node = _ROOT
            for byte in token:
                child = self.goto.get(node << 8 | byte)
                if child is None:
                    child = len(children)
                    self.goto[node << 8 | byte] = child
                    children[node].append((byte, child))
                    children.append([])
                    is_token.append(False)
                node = child
            is_token[node] = node != _ROOT
        self.fail = [-1] * len(children)
        self.popped = [0] * len(children)
        level = [_ROOT]
        while level:  # by depth, as links lead to shorter strings
            below = []
            for node in level:
                for byte, child in children[node]:
                    self._link(node, byte, child, is_token[child])
                    below.append(child)
            level = below

    def _link(self, node: int, byte: int, child: int, token: bool) -> None:
        if token:
            self.fail[child], self.popped[child] = _ROOT, 1
            return
        popped, at = self.popped[node], self.fail[node]
        while at >= 0 and at << 8 | byte not in self.goto:
            popped += self.popped[at]
            at = self.fail[at]
        if at >= 0:
            self.fail[child], self.popped[child] = self.goto[at << 8 | byte], popped

    def count(self, piece: bytes) -> int:
        """How many tokens the greedy longest match takes."""
        goto, fail, popped = self.goto.get, self.fail, self.popped
        node, total = _ROOT, 0
        for byte in piece:
            below = goto(node << 8 | byte)
            while below is None:
                total += popped[node]
                node = fail[node]
                if node < 0:
                    raise ValueError(f"byte {byte} is not in the vocabulary")
                below = goto(node << 8 | byte)
            node = below
        while node != _ROOT:
            total += popped[node]
            node = fail[node]
        return total


class Counter:
    def __init__(self, path: str, pattern: str):
        automaton = Automaton(read_ranks(path))
        self.split = splitter(pattern)
        self.counts = Cache(lambda piece: automaton.count(piece.encode("utf-8")))

    def __call__(self, text: str) -> tuple[int, int]:
        pieces = self.split(text)
        return len(pieces), sum(map(self.counts.__getitem__, pieces))


@functools.lru_cache(maxsize=2)
def counter(path: str = RANKS, pattern: str = PATTERN) -> Counter:
    return Counter(path, pattern)


def count_tokens(df: DataFrame, key: str = "doc_id", text: str = "text", path: str = RANKS, pattern: str = PATTERN) -> DataFrame:
    """doc_id, n_words (pre-tokens) and n_tokens of each whole text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("piece_counts", counter.cache_clear)
        count = counter(path, pattern)
        for batch in batches:
            counts = [count(text) for text in texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([words for words, _ in counts], pa.int64()),
                    pa.array([tokens for _, tokens in counts], pa.int64()),
                ],
                ["doc_id", "n_words", "n_tokens"],
            )

    return keyed(df, key, text).mapInArrow(work, "doc_id long, n_words long, n_tokens long")
