"""Byte-level BPE: encoding by a rank queue, and decoding.

A pre-token is a linked list of symbols. The merge candidates wait in buckets, one
per rank, that hold list positions; two levels of bitmaps over the ranks name the
lowest bucket by find-first-set. Entries whose pair has changed meanwhile are stale
and skipped. A pre-token of n bytes takes O(n log n), however long it is.

Null texts and null ids count as empty. Repeated rows and ties in the key change
nothing, as each row is worked on alone; an empty table gives an empty result. A
column that already bears the output's name is replaced, all others are kept.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from tidelake.llm.memory import enter
from tidelake.llm.pieces import PATTERN, Cache, splitter
from tidelake.llm.tables import small_batches, texts, with_columns

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

# Ranks below one bit of the upper bitmap.
_GROUP_BITS = 8
_GROUP_MASK = (1 << _GROUP_BITS) - 1


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """The ids of one pre-token.

    The queue is kept in local variables, as most pre-tokens need only some ten steps:
    ``buckets`` has a heap of positions for each rank that waits, ``lower`` a bitmap of
    the ranks of each group, and ``upper`` a bitmap of the groups.
    """
    whole = ranks.get(piece)
    if whole is not None:
        return (whole,)
    size = len(piece)
    rank_of = ranks.get
    after = list(range(1, size + 1))
    before = list(range(-1, size - 1))
    pair = [rank_of(piece[i : i + 2]) for i in range(size)]  # of the symbol here with the next one
    pair[-1] = None
    buckets: dict[int, list[int]] = {}
    lower: dict[int, int] = {}
    upper = 0
    fresh = [(rank, i) for i, rank in enumerate(pair) if rank is not None]
    live = len(fresh)  # pairs that may still be merged; without any, all that waits is stale
    while True:
        for rank, i in fresh:
            if rank in buckets:
                heappush(buckets[rank], i)
            else:
                buckets[rank] = [i]
                group = rank >> _GROUP_BITS
                lower[group] = lower.get(group, 0) | 1 << (rank & _GROUP_MASK)
                upper |= 1 << group
        # Find-first-set in both levels, until an entry is not stale.
        while live:
            group = (upper & -upper).bit_length() - 1
            bits = lower[group]
            rank = group << _GROUP_BITS | (bits & -bits).bit_length() - 1
            bucket = buckets[rank]
            i = heappop(bucket)
            if not bucket:
                del buckets[rank]
                bits &= bits - 1
                lower[group] = bits
                if not bits:
                    upper &= upper - 1
            if pair[i] == rank:
                break
        else:
            break
        gone = after[i]
        live -= 1 if pair[gone] is None else 2
        pair[gone] = None
        end = after[i] = after[gone]
        fresh = []
        if end < size:
            before[end] = i
            rank = pair[i] = rank_of(piece[i : after[end]])
            if rank is not None:
                fresh.append((rank, i))
        else:
            pair[i] = None
        left = before[i]
        if left >= 0:
            if pair[left] is not None:
                live -= 1
            rank = pair[left] = rank_of(piece[left:end])
            if rank is not None:
                fresh.append((rank, left))
        live += len(fresh)
    ids, i = [], 0
    while i < size:
        end = after[i]
        ids.append(ranks[piece[i:end]])
        i = end
    return tuple(ids)


class Coder:
    """Encodes texts and decodes ids by one file of ranks."""

    def __init__(self, path: str = RANKS, pattern: str = PATTERN):
        self.ranks = read_ranks(path)
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self._split = splitter(pattern)
        self._ids = Cache(lambda piece: merge(piece.encode("utf-8"), self.ranks))

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self._ids.__getitem__, self._split(text))))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@functools.lru_cache(maxsize=4)
def coder(path: str = RANKS, pattern: str = PATTERN) -> Coder:
    """One coder for each worker process."""
    return Coder(path, pattern)


def _append(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, values], [*batch.schema.names, name])


def _slices(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Few rows at a time, so that long texts do not pile up."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def _without(df: DataFrame, out: str, needed: str) -> DataFrame:
    if out.lower() == needed.lower():
        raise ValueError(f"the output {out} would replace the input")
    return df.drop(out)


def lists(ids: list[list[int]]) -> pa.Array:
    ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
    return pa.ListArray.from_arrays(ends, np.fromiter(chain.from_iterable(ids), np.int32, int(ends[-1])))


def encode(df: DataFrame, text: str = "text", out: str = "ids", path: str = RANKS, pattern: str = PATTERN) -> DataFrame:
    """``df`` with the ids of each whole text."""
    df = _without(df, out, text)
    small_batches(df.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("bpe", coder.cache_clear)
        encode_text = coder(path, pattern).encode
        for batch in batches:
            for part in _slices(batch):
                yield _append(part, out, lists([encode_text(t) for t in texts(part.column(text))]))

    return df.mapInArrow(work, with_columns(df, f"`{out}` array<int>"))


def round_trip(df: DataFrame, text: str = "text", ids: str = "ids", out: str = "decoded", path: str = RANKS, pattern: str = PATTERN) -> DataFrame:
    """``df`` with the ids of each whole text, and the bytes decoded from these; one pass for both."""
    df = _without(_without(df, ids, text), out, text)
    small_batches(df.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("bpe", coder.cache_clear)
        both = coder(path, pattern)
        for batch in batches:
            for part in _slices(batch):
                found = [both.encode(t) for t in texts(part.column(text))]
                decoded = pa.array(map(both.decode, found), pa.binary(), size=part.num_rows)
                yield _append(_append(part, ids, lists(found)), out, decoded)

    return df.mapInArrow(work, with_columns(df, f"`{ids}` array<int>, `{out}` binary"))


def decode(df: DataFrame, ids: str = "ids", out: str = "decoded", path: str = RANKS) -> DataFrame:
    """``df`` with the bytes that each list of ids stands for."""
    df = _without(df, out, ids)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("bpe", coder.cache_clear)
        decode_ids = coder(path).decode
        for batch in batches:
            for part in _slices(batch):
                found = [decode_ids(value.values.to_numpy(zero_copy_only=False).tolist()) if value.is_valid else b"" for value in part.column(ids)]
                yield _append(part, out, pa.array(found, pa.binary()))

    return df.mapInArrow(work, with_columns(df, f"`{out}` binary"))
