"""Passages of at least ``WORDS`` words that also stand in another document.

Words and their hashes are those of `shingles`: runs of bytes other than
``[\\x20\\x09-\\x0D]``, with A-Z lower-cased, so that white space and breaks of lines do
not matter. Every run of ``WORDS`` words is judged by a 64-bit hash, but only few are
looked at: the run's anchor is the one of its strings of ``ANCHOR`` words with the least
hash (the first, if tied). Equal runs have equal anchors, so that only runs whose anchor
is found in a second text are hashed whole and compared, with those of the same anchor.

An anchor found more than ``GROUP`` times is dealt into parts by text. Runs that have no
match in their part are then looked up by hash among all runs of the other parts, those
matched there included, so that none is lost.

A run that repeats within one document alone does not count. Equal texts, which the
caller reduces to one, are for the caller to count whole.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, Window, functions as F

from tidelake.llm.memory import enter
from tidelake.llm.shingles import mix, word_groups
from tidelake.llm.tables import probable, sieve, written

WORDS = 51  # over 50
ANCHOR = 8  # words
LEAST_BYTES = 2 * WORDS - 1
GROUP = 4_096  # anchors in one part
BLOCK = 1 << 18  # runs at a time

_POSITION_BITS = 20
_BASE = 0x9E3779B97F4A7C15


def _run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """The hash of the run of ``size`` words at each word, from runs of 1, 2, 4, ... words."""
    count = len(words) - size + 1
    total, done = np.zeros(count, np.uint64), 0
    part, width = words, 1
    while True:
        if size & width:
            total += part[done : done + count] * np.uint64(pow(_BASE, done, 1 << 64))
            done += width
        if done == size:
            return mix(total)
        part = part[:-width] + part[width:] * np.uint64(pow(_BASE, width, 1 << 64))
        width *= 2


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row, from those of 1, 2, 4, ... values."""
    least, have = values, 1
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    return least


def runs(words: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of texts whose words begin at ``bounds`` (the end is the last), some at a time: each run's
    first word and text, its anchor's first word and hash. No run crosses texts."""
    low = np.uint64((1 << _POSITION_BITS) - 1)
    for at in range(0, len(words) - WORDS + 1, BLOCK):
        part = words[at : at + BLOCK + WORDS - 1]
        anchor = _run_hashes(part, ANCHOR)
        # The position below the hash makes the first of equal ones the least.
        least = _sliding_least(anchor & ~low | np.arange(len(anchor), dtype=np.uint64), WORDS - ANCHOR + 1)
        place = np.arange(len(least))
        text = np.searchsorted(bounds, place + at, "right") - 1
        within = place + at + WORDS <= bounds[text + 1]
        place, text, first = place[within], text[within], (least[within] & low).astype(np.int64)
        yield place + at, text, first + at, anchor[first].view(np.int64)


def _texts(bits: np.ndarray, batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Digests, words and bounds of the texts whose hash is in the sieve, some texts at a time."""
    batch = batch.filter(pa.array(probable(bits, batch.column(2).to_numpy())))
    at = 0
    for words, bounds in word_groups([text.as_buffer().to_pybytes() for text in batch.column(1)]):
        yield batch.column(0).slice(at, len(bounds) - 1), words, bounds
        at += len(bounds) - 1


def _codes(digests: pa.Array) -> np.ndarray:
    """64 bits of each digest."""
    return np.array([int.from_bytes(d[:8], signed=True) for d in digests.to_pylist()], np.int64)


_FOUND_KIND = "key long, text long"


def _anchors(one: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash and text of each anchor, once a place."""
    enter("passages")
    for batch in batches:
        for digests, words, bounds in _texts(one.value, batch):
            codes = _codes(digests)
            for _, text, first, key in runs(words, bounds):
                new = np.diff(first, prepend=-1) != 0
                yield pa.RecordBatch.from_arrays([pa.array(key[new]), pa.array(codes[text[new]])], ["key", "text"])


_MEMBER_KIND = "key long, part int, split boolean, digest binary, place long, hashes array<long>"


def _members(one: Broadcast, known: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each place of a repeated anchor, with the first word and the hashes of its runs."""
    enter("passages")
    bits, hot, dealt = known.value
    for batch in batches:
        for digests, words, bounds in _texts(one.value, batch):
            if len(words) < WORDS:
                continue
            codes, hashes = _codes(digests), _run_hashes(words, WORDS).view(np.int64)
            for place, text, first, key in runs(words, bounds):
                asked = probable(bits, key)
                place, text, first, key = place[asked], text[asked], first[asked], key[asked]
                edge = np.flatnonzero(np.diff(first, prepend=-1))
                offsets = pa.array(np.append(edge, len(key)).astype(np.int32))
                lists = pa.ListArray.from_arrays(offsets, pa.array(hashes[place]))
                place, text, key = place[edge], text[edge], key[edge]
                parts = np.ones(len(key), np.int64)
                if len(hot):
                    at = np.minimum(np.searchsorted(hot, key), len(hot) - 1)
                    parts = np.where(hot[at] == key, dealt[at], 1)
                columns = [
                    pa.array(key),
                    pa.array((codes[text] % parts).astype(np.int32)),
                    pa.array(parts > 1),
                    digests.take(pa.array(text)),
                    pa.array(place - bounds[text]),
                    lists,
                ]
                yield pa.RecordBatch.from_arrays(columns, ["key", "part", "split", "digest", "place", "hashes"])


_SHARED = pa.schema([("digest", pa.binary()), ("start", pa.int64()), ("end", pa.int64()), ("string", pa.int64())])
_SHARED_KIND = "digest binary, start long, end long, string long"


def _shared_rows(members: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of whole groups the words of each text covered by runs that another text has as well.

    Of split groups also the runs: those without a match in their part are open and have a
    row each, with their place; of the others there is one row for each run, without a place.
    """
    rows = pa.Table.from_batches(members).combine_chunks()
    digests, lists = (rows.column(name).combine_chunks() for name in ("digest", "hashes"))
    found, sizes = lists.flatten().to_numpy(), lists.value_lengths().to_numpy()
    member = np.repeat(np.arange(len(sizes)), sizes)
    begin = rows.column("place").to_numpy() - (np.cumsum(sizes) - sizes)
    place = begin[member] + np.arange(len(member))
    code = digests.dictionary_encode().indices.to_numpy()[member]
    order = np.argsort(found, kind="stable")
    edge = np.flatnonzero(np.append(True, np.diff(found[order]) != 0))
    least, most = np.minimum.reduceat(code[order], edge), np.maximum.reduceat(code[order], edge)
    hit = np.zeros(len(found), bool)
    hit[order] = np.repeat(least != most, np.diff(np.append(edge, len(found))))

    def batch(member, start, end, strings):
        return pa.RecordBatch.from_arrays([digests.take(pa.array(member)), *map(pa.array, (start, end)), strings], schema=_SHARED)

    at = np.flatnonzero(hit)
    new = (np.diff(member[at], prepend=-1) != 0) | (np.diff(at, prepend=-2) != 1)
    last = at[np.append(new[1:], True)[: len(new)]]
    at = at[new]
    yield batch(member[at], place[at], place[last] + WORDS, pa.nulls(len(at), pa.int64()))
    split = rows.column("split").to_numpy()[member]
    if split.any():
        at = np.flatnonzero(split & ~hit)
        yield batch(member[at], place[at], place[at] + WORDS, pa.array(found[at]))
        matched = pa.array(np.unique(found[split & hit]))
        yield pa.RecordBatch.from_arrays([*(pa.nulls(len(matched), f.type) for f in list(_SHARED)[:3]), matched], schema=_SHARED)


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key and part to what is covered; held are the rows of one group."""
    held: list[pa.RecordBatch] = []
    group = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, parts = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        cut = int(np.argmax((keys == keys[-1]) & (parts == parts[-1])))  # where the last group begins
        if cut:
            held.append(batch.slice(0, cut))
        if held and (cut or group != (keys[-1], parts[-1])):
            yield from _shared_rows(held)
            held = []
        held.append(batch.slice(cut))
        group = keys[-1], parts[-1]
    if held:
        yield from _shared_rows(held)


def shared(documents: DataFrame, one: Broadcast) -> DataFrame:
    """digest and passages (start and end in words, sorted) of each text that has any.

    ``documents``: digest, text (not null) and h, of which those in the sieve ``one`` are looked at.
    """
    spark = documents.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = documents.filter(F.octet_length("text") >= LEAST_BYTES).select("digest", "text", "h")
    repeated = written(
        found.mapInArrow(functools.partial(_anchors, one), _FOUND_KIND)
        .groupBy("key")
        .agg(F.min("text").alias("a"), F.max("text").alias("b"), F.count(F.lit(1)).alias("n"))
        .filter("a <> b")
        .select("key", F.ceil(F.col("n") / GROUP).alias("parts")),
        "word_anchors",
    )
    # Other anchors that pass the sieve are of one text each and match nothing.
    hot = sorted((row["key"], row["parts"]) for row in repeated.filter("parts > 1").collect())
    keys, parts = np.array(hot, np.int64).reshape(-1, 2).T
    known = spark.sparkContext.broadcast((sieve(repeated.select("key")), keys, parts))
    matched = written(
        found.mapInArrow(functools.partial(_members, one, known), _MEMBER_KIND)
        .repartition(partitions, "key", "part")
        .sortWithinPartitions("key", "part")
        .mapInArrow(_shared, _SHARED_KIND),
        "passages",
    )
    strings = matched.filter("string is not null")
    same = Window.partitionBy("string")  # a run has at most one text open in each part, or a row without place
    opened = (
        strings.withColumn("a", F.min("digest").over(same))
        .withColumn("b", F.max("digest").over(same))
        .withColumn("elsewhere", F.bool_or(F.col("digest").isNull()).over(same))  # matched in another part
        .filter("digest is not null and (a <> b or elsewhere)")
    )
    return (
        matched.filter("string is null")
        .select("digest", "start", "end")
        .union(opened.select("digest", "start", "end"))
        .groupBy("digest")
        .agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("passages"))
    )
