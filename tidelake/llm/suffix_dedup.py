"""Removal of byte strings of a given length that occur more than once.

Sorting every suffix of a corpus is out of reach, so the suffixes sorted are sampled such
that none that matters is missed. Of the 32-byte strings within any 400 bytes the one
with the least hash (the first, if tied) is its anchor; equal 400 bytes have equal
anchors. Only anchors whose string has a second one are looked at further, each with
the 400 bytes after it and the 368 before it, which hold every string it stands for.

The contexts after the anchors of one group are sorted deep-shallow: multikey quicksort
to a shallow depth, then blind tries order the groups that still agree, which as a rule
agree for long. Order and common prefixes give the tree of shared contexts; among those
that share r bytes on the right, neighbours in the order of the reversed left contexts
show the longest match to the left. Two occurrences that agree in l bytes before and r
after, l + r >= 400, cover each other's bytes; overlaps add up.

Equal texts of 400 bytes and more cover each other whole, and only one of them is looked
at further. Equal contexts within a text are found before anything is shuffled. A group
of more than ``GROUP`` anchors is dealt into parts; strings that have no match in their
part are then looked up by hash among all strings of the other parts, those matched
there included, so that none is lost.

Beside the bytes, passages of over 50 words that also stand in another document are
counted (see `passages`): words are short, so that many of these have less than
``LENGTH`` bytes, and nothing of them is removed for it.

Null texts are empty. Rows that repeat a key and a text are documents of their own.
Texts shorter than the length lose nothing. An empty table gives no rows. Columns other
than key and text are left out.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidelake.llm import passages
from tidelake.llm.memory import enter
from tidelake.llm.shingles import mix
from tidelake.llm.tables import keyed, probable, sieve, sifted, written

LENGTH = 400
ANCHOR = 32  # bytes
LEFT = LENGTH - ANCHOR
SHALLOW = 64  # bytes, in chunks of 4
GROUP = 16_384  # anchors in one task, some 16 MB
SEGMENT = 1 << 19  # bytes of a long text at a time

_CHUNK = 4
_POSITION_BITS = 20

_random = np.random.Generator(np.random.PCG64(77))
_letter = _random.integers(1, 1 << 64, 256, np.uint64)
_BASE = 0x9E3779B97F4A7C15
_up = np.full(SEGMENT + 2 * LENGTH, _BASE, np.uint64)
_up[0] = 1
_up = np.multiply.accumulate(_up)
_down = np.full(SEGMENT + 2 * LENGTH, pow(_BASE, -1, 1 << 64), np.uint64)
_down[0] = 1
_down = np.multiply.accumulate(_down)


def _string_hashes(text: np.ndarray, length: int) -> np.ndarray:
    """The hash of the bytes at each position."""
    total = np.zeros(len(text) + 1, np.uint64)
    np.cumsum(_letter[text] * _up[: len(text)], out=total[1:])
    return mix((total[length:] - total[:-length]) * _down[: len(text) - length + 1])


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row, from running minima of blocks."""
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    block = padded.reshape(blocks, width)
    forward = np.minimum.accumulate(block, axis=1).ravel()
    backward = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    size = len(values) - width + 1
    return np.minimum(backward[:size], forward[width - 1 : width - 1 + size])


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors of all strings of ``LENGTH`` bytes."""
    places, keys = [], []
    for at in range(0, max(len(text) - LENGTH + 1, 0), SEGMENT):
        part = np.frombuffer(text, np.uint8, min(SEGMENT + LENGTH - 1, len(text) - at), at)
        found = _string_hashes(part, ANCHOR)
        # The position below the hash makes the first of equal ones the least.
        low = np.uint64((1 << _POSITION_BITS) - 1)
        least = _sliding_least(found & ~low | np.arange(len(found), dtype=np.uint64), LEFT + 1)
        first = np.unique(least & low).astype(np.int64)
        places.append(first + at)
        keys.append(found[first].view(np.int64))
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    place, at = np.unique(np.concatenate(places), return_index=True)
    return place, np.concatenate(keys)[at]


def common(a: bytes, b: bytes) -> int:
    """Bytes in which the beginnings agree."""
    size = min(len(a), len(b))
    a, b = a[:size], b[:size]
    if a == b:
        return size
    return size - ((int.from_bytes(a) ^ int.from_bytes(b)).bit_length() + 7) // 8


class _Branch:
    """Inner node of a blind trie: where its strings first differ, and the children by that byte."""

    __slots__ = ("depth", "children")

    def __init__(self, depth: int, children: dict[int, object]):
        self.depth, self.children = depth, children


def _byte(text: bytes, at: int) -> int:
    return text[at] if at < len(text) else -1


def blind_trie(texts: list[bytes], members: list[int]) -> list[int]:
    """The members in order. A search looks at branching bytes alone, then compares once."""
    root: object = [members[0]]  # a leaf holds all members with the same text
    for member in members[1:]:
        text, node = texts[member], root
        while isinstance(node, _Branch):
            node = node.children.get(_byte(text, node.depth)) or next(iter(node.children.values()))
        other = texts[node[0]]
        agree = common(text, other)
        if agree == len(text) == len(other):
            node.append(member)
            continue
        parent, node = None, root
        while isinstance(node, _Branch) and node.depth < agree:
            parent, node = node, node.children[_byte(text, node.depth)]
        if isinstance(node, _Branch) and node.depth == agree:
            node.children[_byte(text, agree)] = [member]
            continue
        branch = _Branch(agree, {_byte(other, agree): node, _byte(text, agree): [member]})
        if parent is None:
            root = branch
        else:
            parent.children[_byte(text, parent.depth)] = branch
    ordered, stack = [], [root]
    while stack:
        node = stack.pop()
        if isinstance(node, _Branch):
            stack.extend(node.children[key] for key in sorted(node.children, reverse=True))
        else:
            ordered.extend(node)
    return ordered


def deep_shallow(texts: list[bytes], depth: int = 0) -> list[int]:
    """Indices in the order of ``texts``, which agree in the first ``depth`` bytes."""
    ordered: list[int] = []
    stack = [(list(range(len(texts))), depth)]
    while stack:
        members, at = stack.pop()
        if len(members) == 1:
            ordered.extend(members)
            continue
        if at >= SHALLOW:
            ordered.extend(blind_trie(texts, members))
            continue
        chunks = [texts[i][at : at + _CHUNK] for i in members]
        pivot = chunks[len(chunks) // 2]
        less = [i for i, c in zip(members, chunks, strict=True) if c < pivot]
        same = [i for i, c in zip(members, chunks, strict=True) if c == pivot]
        more = [i for i, c in zip(members, chunks, strict=True) if c > pivot]
        if more:
            stack.append((more, at))
        if len(pivot) < _CHUNK:  # they end here and so are equal
            stack.extend(([i], at) for i in same)
        else:
            stack.append((same, at + _CHUNK))
        if less:
            stack.append((less, at))
    return ordered


def matches(lefts: list[bytes], rights: list[bytes]) -> list[list[tuple[int, int]]]:
    """For each anchor of a group the ranges (least, most) of bytes to its left at which a
    string of ``LENGTH`` begins that some other anchor of the group has as well.

    ``lefts`` are reversed; ``rights`` begin with the anchor.
    """
    found: list[list[tuple[int, int]]] = [[] for _ in rights]
    if len(rights) == 2:
        left, right = common(*lefts), common(*rights)
        if left + right >= LENGTH:
            found[0] = found[1] = [(max(0, LENGTH - right), left)]
        return found
    order = deep_shallow(rights, ANCHOR)
    agree = [common(rights[a], rights[b]) for a, b in zip(order, order[1:], strict=False)]
    stack = [(0, len(order), 0)]  # members, and what they share with those around them
    while stack:
        start, end, outer = stack.pop()
        inner = agree[start : end - 1]
        shared = min(inner)
        least, most = max(0, LENGTH - shared), min(LENGTH - outer - 1, LEFT)
        if least <= most:
            by_left = sorted(order[start:end], key=lefts.__getitem__)
            pairs = [common(lefts[a], lefts[b]) for a, b in zip(by_left, by_left[1:], strict=False)]
            for i, before, after in zip(by_left, [-1, *pairs], [*pairs, -1], strict=True):
                if (reach := min(most, max(before, after))) >= least:
                    found[i].append((least, reach))
        cuts = [start, *(start + i + 1 for i, x in enumerate(inner) if x == shared), end]
        stack.extend((a, b, shared) for a, b in zip(cuts, cuts[1:], strict=False) if b - a > 1)
    return found


def _batch(schema: dict[str, pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.values(), strict=True)], list(schema))


_SCAN = {"key": pa.int64(), "digest": pa.binary(), "start": pa.int64(), "end": pa.int64()}
_SCAN_KIND = "key long, digest binary, start long, end long"


def _context(text: bytes, at: int) -> tuple[bytes, bytes]:
    return text[max(0, at - LEFT) : at][::-1], text[at : at + LENGTH]


def _scan_text(digest: bytes, text: bytes) -> Iterator[tuple]:
    """Rows of a text: its anchors, without repeats of one context, and what these cover."""
    places, keys = anchors(text)
    if len(np.unique(keys)) == len(keys):
        yield from ((key, digest, at, None) for at, key in zip(places.tolist(), keys.tolist(), strict=True))
        return
    first: dict[tuple[bytes, bytes], int] = {}
    for at, key in zip(places.tolist(), keys.tolist(), strict=True):
        context = _context(text, at)
        before = first.setdefault(context, at)
        if before == at:
            yield key, digest, at, None
        elif len(context[0]) + len(context[1]) >= LENGTH:
            for place in (before, at):
                yield None, digest, place - len(context[0]), place + len(context[1])


def _scan(bits, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the texts whose hash is in the sieve: of equal texts, as a rule, one."""
    enter("suffix_dedup")
    seen: set[bytes] = set()
    for batch in batches:
        batch = batch.filter(pa.array(probable(bits.value, batch.column(2).to_numpy())))
        rows = []
        for digest, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if digest not in seen:  # equal texts of a task give the same rows
                seen.add(digest)
                rows.extend(_scan_text(digest, text.as_buffer().to_pybytes()))
            if len(rows) > 50_000:
                yield _batch(_SCAN, rows)
                rows = []
        yield _batch(_SCAN, rows)


_MEMBER = {
    "key": pa.int64(), "part": pa.int32(), "split": pa.bool_(), "digest": pa.binary(), "at": pa.int64(),
    "left": pa.binary(), "right": pa.binary(),
}
_MEMBER_KIND = "key long, part int, split boolean, digest binary, at long, left binary, right binary"


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with their repeated anchors to one row for each, with its contexts."""
    for batch in batches:
        rows, size = [], 0
        for digest, text, found in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
            data = text.as_buffer().to_pybytes()
            for anchor in found.as_py():
                left, right = _context(data, anchor["start"])
                rows.append((anchor["key"], anchor["part"], anchor["split"], digest, anchor["start"], left, right))
                size += len(left) + len(right)
            if size > 1 << 22:
                yield _batch(_MEMBER, rows)
                rows, size = [], 0
        yield _batch(_MEMBER, rows)


_MATCH = {"digest": pa.binary(), "start": pa.int64(), "end": pa.int64(), "string": pa.int64()}
_MATCH_KIND = "digest binary, start long, end long, string long"


def _strings(member: tuple, ranges: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and hash of each string of an anchor, and whether it has a match in its part."""
    _, at, left, right = member
    text = np.frombuffer(left[::-1] + right, np.uint8)
    if len(text) < LENGTH:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
    strings = _string_hashes(text, LENGTH).view(np.int64)[: len(left) + 1]
    backs = len(left) - np.arange(len(strings))
    closed = np.zeros(len(strings), bool)
    for least, most in ranges:
        closed |= (backs >= least) & (backs <= most)
    return at - backs, strings, closed


def _match_group(split: bool, members: list[tuple]) -> Iterator[tuple]:
    if len(members) > 1:
        found = matches([m[2] for m in members], [m[3] for m in members])
    else:
        found = [[]]
    matched, size = [], 0
    for member, ranges in zip(members, found, strict=True):
        digest, at = member[:2]
        for least, most in ranges:
            yield digest, at - most, at - least + LENGTH, None
        if split:
            starts, strings, closed = _strings(member, ranges)
            for start, string in zip(starts[~closed].tolist(), strings[~closed].tolist(), strict=True):
                yield digest, start, None, string
            matched.append(strings[closed])
            size += len(matched[-1])
            if size > 1 << 20:  # few differ
                matched = [np.unique(np.concatenate(matched))]
                size = 0
    if matched:
        for string in np.unique(np.concatenate(matched)).tolist():
            yield None, None, None, string


def _match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key and part to what is covered; of split groups also the strings.

    Those without a match in their part are open and have a row each, with their place;
    the others have one row for each string and part, without a place.
    """
    group, members, rows = None, [], []
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(7)]
        for key, part, split, *member in zip(*columns, strict=True):
            if (key, part, split) != group:
                if members:
                    for row in _match_group(group[2], members):
                        rows.append(row)
                        if len(rows) > 50_000:
                            yield _batch(_MATCH, rows)
                            rows = []
                group, members = (key, part, split), []
            members.append(tuple(member))
    if members:
        rows.extend(_match_group(group[2], members))
    yield _batch(_MATCH, rows)


def covered(documents: DataFrame) -> DataFrame:
    """digest, copies, spans (start, end) and passages (in words) of each text that repeats or holds repeated strings.

    ``documents``: doc_id, text (not null), digest.
    """
    spark = documents.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = documents.groupBy("digest").agg(F.min("doc_id").alias("of"), F.count(F.lit(1)).alias("copies"))
    texts = written(texts, "texts")
    hashed = documents.select("digest", "text", F.xxhash64("digest", "doc_id").alias("h"))
    long_enough = hashed.filter(F.octet_length("text") >= LENGTH)
    # Of equal texts, as a rule, only that of the least key is looked at.
    one = spark.sparkContext.broadcast(sieve(texts.select(F.xxhash64("digest", "of").alias("h"))))
    scanned = written(long_enough.mapInArrow(functools.partial(_scan, one), _SCAN_KIND), "anchors")
    found = scanned.filter("key is not null").select("key", "digest", "start")
    place = F.struct("digest", "start")
    repeated = (
        found.groupBy("key")
        .agg(F.min(place).alias("a"), F.max(place).alias("b"), F.count(F.lit(1)).alias("n"))
        .filter("a <> b")
        .select("key", F.ceil(F.col("n") / GROUP).cast("int").alias("parts"))
    )
    members = written(
        found.join(repeated, "key")
        .distinct()
        .withColumn("part", F.pmod(F.xxhash64("digest", "start"), F.col("parts")).cast("int"))
        .groupBy("digest")
        .agg(F.collect_list(F.struct("key", "start", "part", (F.col("parts") > 1).alias("split"))).alias("anchors"))
        .join(texts.select("digest", "of"), "digest")
        .select(F.col("digest").alias("wanted"), F.xxhash64("digest", "of").alias("wanted_h"), "anchors"),
        "members",
    )
    picked = sifted(long_enough, {"h": sieve(members.select("wanted_h"))})  # so that few texts are shuffled
    matched = written(
        picked.join(members, (F.col("digest") == F.col("wanted")) & (F.col("h") == F.col("wanted_h")))
        .dropDuplicates(["digest", "h"])  # rows that repeat a key and a text
        .select("digest", "text", "anchors")
        .mapInArrow(_contexts, _MEMBER_KIND)
        .repartition(partitions, "key", "part")
        .sortWithinPartitions("key", "part")
        .mapInArrow(_match, _MATCH_KIND),
        "matches",
    )
    strings = matched.filter("string is not null").select("digest", "start", "string")
    position = F.struct("digest", "start")
    elsewhere = F.bool_or(F.col("digest").isNull())  # matched in another part
    again = (
        strings.groupBy("string")
        .agg(
            F.min(F.when(F.col("digest").isNotNull(), position)).alias("a"),
            F.max(F.when(F.col("digest").isNotNull(), position)).alias("b"),
            elsewhere.alias("elsewhere"),
        )
        .filter("a <> b or (elsewhere and a is not null)")
        .select("string")
    )
    opened = strings.filter("digest is not null")
    spans = (
        scanned.filter("key is null")
        .select("digest", "start", "end")
        .union(matched.filter("string is null").select("digest", "start", "end"))
        .union(opened.join(again, "string", "left_semi").select("digest", "start", F.col("start") + LENGTH))
        .distinct()
        .groupBy("digest")
        .agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    )
    copied = texts.filter("copies > 1").select("digest", "copies")
    return copied.join(spans, "digest", "full").join(passages.shared(hashed, one), "digest", "full")


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans without overlaps or seams."""
    result: list[tuple[int, int]] = []
    for start, end in spans:
        if result and start <= result[-1][1]:
            result[-1] = result[-1][0], max(end, result[-1][1])
        else:
            result.append((start, end))
    return result


_COUNTS = ["doc_id", "n_bytes", "n_removed", "n_spans", "n_passages", "n_passage_words"]
_REMOVED = dict.fromkeys(_COUNTS, pa.int64()) | {"kept": pa.binary()}
_REMOVED_KIND = "".join(f"{name} long, " for name in _COUNTS) + "kept binary"


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part, rows = batch.slice(at, 512), []
            for key, text, copies, spans, runs in zip(*(part.column(i) for i in range(5)), strict=True):
                data = text.as_buffer().to_pybytes()
                if copies.is_valid and len(data) >= LENGTH:
                    gone = [(0, len(data))]
                else:
                    gone = merged([(s["start"], s["end"]) for s in spans.as_py() or []])
                edges = [0, *(edge for span in gone for edge in span), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                shared = merged([(s["start"], s["end"]) for s in runs.as_py() or []])
                if copies.is_valid and (words := len(data.split())) >= passages.WORDS:
                    shared = [(0, words)]
                counts = len(gone), len(shared), sum(end - start for start, end in shared)
                rows.append((key.as_py(), len(data), len(data) - len(kept), *counts, kept))
            yield _batch(_REMOVED, rows)


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, n_passages, n_passage_words and kept (the remaining bytes) of each document."""
    docs = keyed(df, key, text).select(
        "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
        F.unhex(F.substring(F.sha2(F.coalesce("text", F.lit("")), 256), 1, 32)).alias("digest"),
    )
    marks = written(covered(docs), "spans")
    return (
        docs.join(marks, "digest", "left")
        .select("doc_id", "text", "copies", "spans", "passages")
        .mapInArrow(_removed, _REMOVED_KIND)
    )
