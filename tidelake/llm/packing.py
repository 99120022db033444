"""Packing of documents into windows of tokens, filled with what a BM25 index retrieves.

Each whole text is encoded once. Whole windows of a long document are sequences of their
own; what is left of a document, less than a window, goes to a shard. A document's place
is the least hash of its tokens (a MinHash), which brings documents with like words next
to each other; Spark range-partitions by it, with the hash of the tokens and the row
after it, so that a place that a third of all documents share is spread over shards too.

A task cuts its range into blocks and builds the inverted index of a block. The longest
unused document is the seed of a window. The index scores the others by BM25 with the
words of the seed, and the unused ones that fit are taken, best first; when none fits any
more, the best is cut to fill the window and its rest stays unused. What does not fill a
window at the end of a block joins the next block; at the end of a task it is cut into
sequences of a power of two, which need no padding. All counts of the scores (documents
with a token, mean length) are over all documents.

A null text is empty, and is the end id only. Repeated rows and null keys are documents
like any others. An empty table gives no pieces. Other columns are left out.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer, normalizers, pre_tokenizers

from tidelake.llm.memory import enter
from tidelake.llm.pieces import CACHE_CHARS, LETTERS, NUMBERS, SPACES, is_latin
from tidelake.llm.tables import keyed, slices, written

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1
WINDOW = 2048
# A worker remembers so many short runs: some 200 MB at most.
REMEMBERED = 1_000_000
# Documents that one index holds.
BLOCK = 1_024

# Of an index: ids that one in so many documents hold have a whole row.
COMMON = 16

# Usual values of the saturation of a count and of the weight of length.
_K1, _B = 1.2, 0.75
_SEED = 271_828

_LATIN_WORDS = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^{SPACES}{LETTERS}{NUMBERS}]+"
).findall


# Classes of bytes, for cuts that the tokenizer makes wherever they occur: around each
# digit, and between a letter and a sign other than the apostrophe.
_OTHER, _LETTER, _SIGN, _DIGIT = range(4)
_CLASSES = np.full(256, _OTHER, np.uint8)
_CLASSES[33:127] = _SIGN
_CLASSES[ord("'")] = _OTHER
for _first, _last, _class in ("a", "z", _LETTER), ("A", "Z", _LETTER), ("0", "9", _DIGIT):
    _CLASSES[ord(_first) : ord(_last) + 1] = _class
_CUTS = np.zeros((4, 4), bool)
_CUTS[_DIGIT, :] = _CUTS[:, _DIGIT] = _CUTS[_LETTER, _SIGN] = _CUTS[_SIGN, _LETTER] = True


def cut_apart(column: pa.StringArray) -> pa.StringArray:
    """The texts with a space more at such cuts, so that words repeat as they are."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    classes = _CLASSES[data]
    # Two bytes that begin so are a letter (U+00C0 to U+017F), except for two signs and one
    # capital, which becomes a letter and a sign.
    letters = (data[:-1] >= 0xC3) & (data[:-1] <= 0xC5) & ~((data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7)))
    letters &= ~((data[:-1] == 0xC4) & (data[1:] == 0xB0))
    classes[1:][letters] = _LETTER
    at = np.flatnonzero(_CUTS[classes[:-1], classes[1:]]) + 1
    starts = offsets - offsets[0]
    moved = (starts + np.searchsorted(at, starts)).astype(np.int32)
    more = np.insert(data, at, ord(" "))
    return pa.StringArray.from_buffers(len(column), pa.py_buffer(moved), pa.py_buffer(more))


class WordEncoder:
    """The tokenizer's ids of texts; those of short runs are remembered.

    The tokenizer cuts at white space, whatever stands around it, and lower-cases, so that
    the ids of a text are those of its runs between ASCII white space. Arrow finds the
    runs of many texts and which of them are the same. New runs of Latin script go to the
    tokenizer together, as the last token of each word is marked; others go one by one.
    Texts that hold an added token, which it finds before it lower-cases, go whole.
    """

    def __init__(self, path: str = TOKENIZER, remembered: int = REMEMBERED):
        self._tokenizer = Tokenizer.from_file(path)
        self._added = [token.content for token in self._tokenizer.get_added_tokens_decoder().values()]
        self.size = self._tokenizer.get_vocab_size(with_added_tokens=True)
        if self.size > 1 << 16:
            raise ValueError("ids are kept in 16 bits")
        self._closes = np.array([(self._tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(self.size)])
        # For words of printable ASCII, which it writes as they are.
        self._plain = Tokenizer.from_file(path)
        self._plain.normalizer = normalizers.Sequence([])
        self._plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self._known: dict[str, bytes] = {}
        self._remembered = remembered

    def _ids(self, text: str) -> np.ndarray:
        [encoded] = self._tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(encoded.ids, "<u2")

    def _learn(self, runs: list[str]) -> dict[str, bytes]:
        found, words, mixed, counts = {}, [], [], []
        for run in runs:
            if run.isalpha() and run.isascii():
                words.append(run)
            elif is_latin(lowered := run.lower()):
                mixed.append(run)
                counts.append(len(_LATIN_WORDS(lowered)))
            else:
                found[run] = self._ids(run).tobytes()
        parts = [" ".join(words[at : at + 256]) for at in range(0, len(words), 256)]
        encoded = self._plain.encode_batch_fast(parts, add_special_tokens=False)
        some = [np.array(e.ids, "<u2") for e in encoded] + [self._ids(" ".join(mixed))]
        ids = np.concatenate(some)
        last = np.flatnonzero(self._closes[ids]) + 1
        of = np.cumsum(np.concatenate([np.ones(len(words), np.int64), np.array(counts, np.int64)]))
        if (of[-1] if len(of) else 0) != len(last):
            raise ValueError("the tokenizer does not cut words as expected")
        ends = (np.concatenate([[0], last])[of] * 2).tolist()
        packed = ids.tobytes()
        found.update((run, packed[a:b]) for run, a, b in zip([*words, *mixed], [0, *ends], ends, strict=False))
        return found

    def _run_ids(self, runs: list[str]) -> list[bytes]:
        packed = list(map(self._known.get, runs))
        if None not in packed:
            return packed
        absent = [i for i, ids in enumerate(packed) if ids is None]
        found = self._learn([runs[i] for i in absent])
        for i in absent:
            packed[i] = found[runs[i]]
        if len(self._known) + len(found) > self._remembered:
            self._known.clear()
        self._known.update((run, ids) for run, ids in found.items() if len(run) <= CACHE_CHARS)
        return packed

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts, one after the other, and where each begins and ends."""
        plain = column.fill_null("")
        whole = {}
        for content in self._added:
            for i in np.flatnonzero(pc.match_substring(plain, content)).tolist():
                whole[i] = self._ids(plain[i].as_py())
        runs = pc.ascii_split_whitespace(pc.ascii_lower(cut_apart(plain)))
        same = runs.flatten().dictionary_encode()
        packed = self._run_ids(same.dictionary.to_pylist())
        taken = pa.array(packed, pa.large_binary()).take(same.indices)
        ends = np.frombuffer(taken.buffers()[1], np.int64)[: len(taken) + 1] // 2
        found = np.frombuffer(taken.buffers()[2] or b"", "<u2")[: ends[-1]]
        bounds = ends[np.asarray(runs.offsets) - runs.offsets[0].as_py()]
        if whole:
            parts = [whole.get(i, found[a:b]) for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True))]
            bounds = np.cumsum([0, *map(len, parts)])
            found = np.concatenate(parts)
        return found, bounds


@functools.lru_cache(maxsize=2)
def encoder(path: str = TOKENIZER) -> WordEncoder:
    return WordEncoder(path)


_TOKENS = "doc_id long, n long, whole binary, tail binary, route long"


def tokens(df: DataFrame, key: str = "doc_id", text: str = "text", path: str = TOKENIZER, window: int = WINDOW) -> DataFrame:
    """The ids of each document: whole windows, what is left, and the place of that."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("packing", encoder.cache_clear)
        encode = encoder(path)
        places = np.random.Generator(np.random.PCG64(_SEED)).permutation(encode.size)
        end = np.array([END_ID], "<u2")
        for batch in batches:
            for part in slices(batch, 1):
                ids, bounds = encode(part.column(1))
                counts, wholes, tails, routes = [], [], [], []
                for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                    of = np.concatenate([ids[a:b], end])
                    cut = len(of) // window * window
                    counts.append(len(of))
                    wholes.append(of[:cut].tobytes())
                    tails.append(of[cut:].tobytes())
                    routes.append(int(places[of[cut:]].min()) if cut < len(of) else 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(counts, pa.int64()),
                        pa.array(wholes, pa.binary()),
                        pa.array(tails, pa.binary()),
                        pa.array(routes, pa.int64()),
                    ],
                    ["doc_id", "n", "whole", "tail", "route"],
                )

    return keyed(df, key, text).mapInArrow(work, _TOKENS)


def token_statistics(tails: DataFrame, size: int) -> tuple[np.ndarray, int, int]:
    """How many tails hold each id, how many tails there are, and their ids in all.

    Each task adds up its own; as many rows as the vocabulary has come to the driver.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size + 2, np.int64)
        for batch in batches:
            for tail in batch.column(0):
                ids = np.frombuffer(tail.as_buffer(), "<u2")
                counts[np.unique(ids)] += 1
                counts[size] += 1
                counts[size + 1] += len(ids)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["at", "n"])

    rows = tails.select("tail").mapInArrow(work, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(size + 2, np.int64)
    for row in rows:
        counts[row["at"]] = row["n"]
    return counts[:size], int(counts[size]), int(counts[size + 1])


def inverse_frequencies(held: np.ndarray, documents: int) -> np.ndarray:
    """The weight of each id; none for what more than half of all documents hold."""
    return np.maximum(np.log((documents - held + 0.5) / (held + 0.5)), 0.0)


class Index:
    """The inverted index of a block: for each id the documents that hold it, with BM25 weights.

    What one in ``COMMON`` documents or more hold has a row with the weights of all.
    """

    def __init__(self, documents: list[np.ndarray], weights: np.ndarray, mean: float):
        self.count = len(documents)
        lengths = np.array([len(ids) for ids in documents])
        keys = np.concatenate(documents).astype(np.int64) * self.count + np.repeat(np.arange(self.count), lengths)
        keys, often = np.unique(keys, return_counts=True)
        ids, self._documents = np.divmod(keys, self.count)
        norm = _K1 * (1 - _B + _B * lengths / mean)
        self._scores = weights[ids] * often * (_K1 + 1) / (often + norm[self._documents])
        self._starts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        self._lengths = np.diff(self._starts, append=len(ids))
        of = np.repeat(np.arange(len(self._starts)), self._lengths)
        common = self._lengths * COMMON >= self.count
        self._row = np.where(common, np.cumsum(common) - 1, -1)
        self._rows = np.zeros((int(common.sum()), self.count), np.float32)
        inside = common[of]
        self._rows[self._row[of[inside]], self._documents[inside]] = self._scores[inside]
        # The ids of each document; one that no other document has, or that tells nothing, adds nothing.
        useful = (weights[ids] > 0) & (self._lengths[of] > 1)
        order = np.argsort(self._documents[useful], kind="stable")
        self._terms = of[useful][order]
        self._bounds = np.searchsorted(self._documents[useful][order], np.arange(self.count + 1))

    def scores(self, document: int) -> np.ndarray:
        """The score of each other document of the block for the distinct ids of one."""
        terms = self._terms[self._bounds[document] : self._bounds[document + 1]]
        row = self._row[terms]
        found = self._rows[row[row >= 0]].sum(axis=0)
        rare = terms[row < 0]
        lengths = self._lengths[rare]
        ends = np.cumsum(lengths)
        at = np.repeat(self._starts[rare] - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)
        return found + np.bincount(self._documents[at], self._scores[at], self.count)


# A document that may be packed: its row, and where the ids that are left begin.
Part = tuple[int, int, np.ndarray]


def fill(parts: list[Part], weights: np.ndarray, mean: float, window: int = WINDOW) -> tuple[list[list[Part]], list[Part]]:
    """Full windows of the parts, and the parts that do not fill one more."""
    if sum(len(ids) for _, _, ids in parts) < window:
        return [], parts
    index = Index([ids for _, _, ids in parts], weights, mean)
    left = list(parts)
    lengths = np.array([len(ids) for _, _, ids in parts])
    total, windows = int(lengths.sum()), []
    while total >= window:
        seed = int(np.argmax(lengths))
        chosen, room = [left[seed]], window - int(lengths[seed])
        scores = index.scores(seed)
        lengths[seed] = 0
        # Best first; those without a word of the seed come last, by place.
        ranked = np.argsort(-scores, kind="stable")
        ranked = ranked[lengths[ranked] > 0]
        while room:
            fits = np.flatnonzero(lengths[ranked] <= room)
            if len(fits):
                at = int(ranked[fits[0]])
                chosen.append(left[at])
                room -= int(lengths[at])
                lengths[at] = 0
                ranked = ranked[lengths[ranked] > 0]
            else:
                row, start, ids = left[best := int(ranked[0])]
                chosen.append((row, start, ids[:room]))
                left[best] = (row, start + room, ids[room:])
                lengths[best] -= room
                room = 0
        windows.append(chosen)
        total -= window
    return windows, [part for part, length in zip(left, lengths, strict=True) if length]


def powers(parts: list[Part]) -> list[list[Part]]:
    """The parts as sequences whose lengths are falling powers of two."""
    total, sequences, waiting = sum(len(ids) for _, _, ids in parts), [], list(reversed(parts))
    while total:
        room = 1 << total.bit_length() - 1
        total -= room
        chosen = []
        while room:
            row, start, ids = waiting.pop()
            if len(ids) > room:
                waiting.append((row, start + room, ids[room:]))
                ids = ids[:room]
            chosen.append((row, start, ids))
            room -= len(ids)
        sequences.append(chosen)
    return sequences


_PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
_NAMES = [name.split()[0] for name in _PIECES.split(", ")]
_TYPES = [pa.int64()] * 6 + [pa.binary()]
# Sequences of a task are numbered from here on.
_TASK_BITS = 33


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], _NAMES)


def _wide(ids: np.ndarray) -> bytes:
    return ids.astype("<u4").tobytes()


def _whole_windows(rows: DataFrame, window: int) -> DataFrame:
    """Each whole window of a document is a sequence, with an even number."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << _TASK_BITS
        for batch in batches:
            for doc, n, whole in zip(*batch.columns, strict=True):
                ids, out = np.frombuffer(whole.as_buffer(), "<u2"), []
                for start in range(0, len(ids), window):
                    out.append((doc.as_py(), start, window, n.as_py(), number, 0, _wide(ids[start : start + window])))
                    number += 2
                    if len(out) == 256:
                        yield _batch(out)
                        out = []
                if out:
                    yield _batch(out)

    return rows.select("doc_id", "n", "whole").mapInArrow(work, _PIECES)


def _filled_windows(rows: DataFrame, weights: np.ndarray, mean: float, window: int, block: int) -> DataFrame:
    """Windows of what is left of documents, with odd numbers."""
    shared = rows.sparkSession.sparkContext.broadcast(weights)  # one number for each id of the vocabulary

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("packing index")
        number = (TaskContext.get().partitionId() << _TASK_BITS) + 1
        docs: dict[int, tuple] = {}
        parts: list[Part] = []
        read = 0

        def out(windows: list[list[Part]]) -> Iterator[pa.RecordBatch]:
            nonlocal number
            for at in range(0, len(windows), 64):
                found = []
                for chosen in windows[at : at + 64]:
                    offset = 0
                    for row, start, ids in chosen:
                        doc, n = docs[row]
                        found.append((doc, start, len(ids), n, number, offset, _wide(ids)))
                        offset += len(ids)
                    number += 2
                yield _batch(found)

        for batch in batches:
            for doc, n, tail in zip(*batch.columns, strict=True):
                ids = np.frombuffer(tail.as_py(), "<u2")
                docs[read] = (doc.as_py(), n.as_py())
                parts.append((read, n.as_py() - len(ids), ids))
                read += 1
                if len(parts) >= block:
                    windows, parts = fill(parts, shared.value, mean, window)
                    yield from out(windows)
                    docs = {row: docs[row] for row, _, _ in parts}
        windows, parts = fill(parts, shared.value, mean, window)
        yield from out(windows)
        yield from out(powers(parts))

    return rows.select("doc_id", "n", "tail").mapInArrow(work, _PIECES)


def pack(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    path: str = TOKENIZER,
    window: int = WINDOW,
    block: int = BLOCK,
) -> DataFrame:
    """A row for each piece: doc_id, start, length, doc_tokens, sequence_id, offset and ids.

    ``ids`` are little-endian unsigned 32-bit integers. Sequences are as long as the
    window, or a smaller power of two.
    """
    spark = df.sparkSession
    stored = tokens(df, key, text, path, window).withColumn("place", F.monotonically_increasing_id())
    stored = written(stored, "packing-tokens")  # also fixes the place of rows that are alike
    tails = stored.filter(F.length("tail") > 0)
    size = encoder(path).size
    held, documents, ids = token_statistics(tails, size)
    weights = inverse_frequencies(held, documents)
    order = ["route", "mix", "place"]
    ranged = tails.select("route", F.xxhash64("tail").alias("mix"), "place", "doc_id", "n", "tail")
    ranged = ranged.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order)
    filled = _filled_windows(ranged.sortWithinPartitions(*order), weights, max(ids / max(documents, 1), 1.0), window, block)
    return _whole_windows(stored.filter(F.length("whole") > 0), window).unionByName(filled)
