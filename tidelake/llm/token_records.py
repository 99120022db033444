"""Token ids in files of framed binary records, with an offset index beside them.

Frame: length of the record (8 bytes), masked checksum of these bytes (4), record,
masked checksum of the record (4), newline (1); numbers are little-endian. The mask
turns the CRC-32 by 15 bits and adds a constant, so that checksums of data that hold
checksums stay sound. Record: 1 if the key is null, else 0 (1 byte), the key (8),
bytes of an id (1), the ids.

Files are written by Spark's own writer below the shared folder and hold the records
by ascending key; task and number of a file, both in its name, ascend with the keys. A
file is read as one row, so that it is cut by bytes: after ``BLOCKS_PER_FILE`` blocks of
some ``BLOCK_BYTES``, or of one longer record. The index has one row for each record:
file, offset, length, key, number of ids, their checksum, and the ids before it in all
files. ``read_record`` fetches one record by it.

Null texts are empty, so that only the end id remains. Null keys come first; equal
keys are ordered by a hash of the text and else stand in any order. An empty table
gives no file and an empty index. Other columns are left out.
"""

from __future__ import annotations

import functools
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from tokenizers import Tokenizer

from tidelake.llm.memory import enter
from tidelake.llm.pieces import CACHE_CHARS, LATIN, LETTERS
from tidelake.llm.tables import keyed, slices

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 0
# A worker remembers so many short units, and as many that it met before: some 20 MB, if they are words.
REMEMBERED = 300_000
TEXT_BYTES = 8 << 20  # of texts whose units are looked up at a time
TOGETHER = 20_000  # new units in one call of the tokenizer
BLOCK_BYTES = 2 << 20
BLOCKS_PER_FILE = 8
INDEX = "_index"

_NAMES = ["file", "offset", "length", "doc_id", "n_tokens", "ids_crc32", "before"]
_TYPES = [pa.string(), *[pa.int64()] * 6]
_INDEX_SCHEMA = "file string, offset long, length long, doc_id long, n_tokens long, ids_crc32 long, before long"

# The mask's constant and turn.
_MASK_DELTA = 0xA282EAD8
_MASK_TURN = 15

_LENGTH = struct.Struct("<Q")
_CHECK = struct.Struct("<I")
_HEAD = struct.Struct("<BqB")
_CLOSE = b"\n"


def masked(data: bytes) -> int:
    check = zlib.crc32(data)
    turned = (check >> _MASK_TURN | check << 32 - _MASK_TURN) & 0xFFFFFFFF
    return (turned + _MASK_DELTA) & 0xFFFFFFFF


def frame(record: bytes) -> bytes:
    length = _LENGTH.pack(len(record))
    return b"".join((length, _CHECK.pack(masked(length)), record, _CHECK.pack(masked(record)), _CLOSE))


def frames(content: bytes) -> Iterator[tuple[int, bytes]]:
    """Offset and record of each frame of a file; raises where a checksum is wrong."""
    at = 0
    while at < len(content):
        record, end = unframe(content, at)
        yield at, record
        at = end


def unframe(content, at: int) -> tuple[bytes, int]:
    length = bytes(content[at : at + 8])
    start = at + 12
    stop = start + _LENGTH.unpack(length)[0]
    record = bytes(content[start:stop])
    tail = bytes(content[stop : stop + 5])
    if content[at + 8 : start] != _CHECK.pack(masked(length)) or tail != _CHECK.pack(masked(record)) + _CLOSE:
        raise ValueError(f"damaged record at byte {at}")
    return record, stop + 5


def pack(key: int | None, ids: np.ndarray) -> bytes:
    return _HEAD.pack(key is None, key or 0, ids.itemsize) + ids.tobytes()


def unpack(record: bytes) -> tuple[int | None, np.ndarray]:
    no_key, key, width = _HEAD.unpack_from(record)
    return None if no_key else key, np.frombuffer(record, f"<u{width}", offset=_HEAD.size)


def check_ids(ids: np.ndarray) -> int:
    """CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


# Classes of bytes, for cuts that the tokenizer makes wherever they occur: between letters,
# digits and other signs than the apostrophe, and around white space. Beside white space
# beyond ASCII there are none, as it goes on what is before it or after it.
_OTHER, _LETTER, _SIGN, _DIGIT, _SPACE, _WIDE = range(6)
_CLASSES = np.full(256, _OTHER, np.uint8)
_CLASSES[33:127] = _SIGN
_CLASSES[ord("'")] = _OTHER
for _first, _last, _class in ("a", "z", _LETTER), ("A", "Z", _LETTER), ("0", "9", _DIGIT), ("\t", "\r", _SPACE), (" ", " ", _SPACE):
    _CLASSES[ord(_first) : ord(_last) + 1] = _class
_CUTS = np.zeros((6, 6), bool)
for _a in _LETTER, _SIGN, _DIGIT:
    _CUTS[_a, [_b for _b in (_LETTER, _SIGN, _DIGIT) if _b != _a]] = True
_CUTS[[_OTHER, _LETTER, _SIGN, _DIGIT], _SPACE] = True
# In UTF-8, those of three bytes.
_WIDE_CODES = [
    int.from_bytes(chr(_code).encode(), "big")
    for _code in (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
]


def _wide_spaces(data: np.ndarray) -> Iterator[np.ndarray]:
    """Places of the bytes of white space beyond ASCII."""
    padded = np.append(data, np.zeros(2, np.uint8))
    at = np.flatnonzero((data == 0xC2) | (data - np.uint8(0xE1) <= 2))
    code = padded[at].astype(np.uint32) << 16 | padded[at + 1].astype(np.uint32) << 8 | padded[at + 2]
    two = at[np.isin(code >> 8, [0xC285, 0xC2A0])]
    three = at[np.isin(code, _WIDE_CODES)]
    yield from (two, two + 1, three, three + 1, three + 2)


def units(column: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
    """All texts, cut into units of whole pre-tokens, and where the units of each text begin and end.

    The last white space before a word goes with it if it is a space, else alone; what
    white space is before that is a unit of its own, and so is that at the end of a text.
    """
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    starts = (offsets - offsets[0]).astype(np.int64)
    classes = _CLASSES[data]
    # Two bytes that begin so are a letter (U+00C0 to U+017F), except for two signs.
    letters = (data[:-1] >= 0xC3) & (data[:-1] <= 0xC5) & ~((data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7)))
    classes[1:][letters] = _LETTER
    for wide in _wide_spaces(data):
        classes[wide] = _WIDE
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = _CUTS[classes[:-1], classes[1:]]
    cut[starts] = True
    space = classes == _SPACE
    # The last of white space that a word of the same text follows, and what follows it.
    last = np.flatnonzero(space[:-1] & ~space[1:] & (classes[1:] != _WIDE) & ~cut[1:-1])
    cut[last] = True
    cut[last[data[last] != ord(" ")] + 1] = True
    places = np.flatnonzero(cut)
    found = pa.StringArray.from_buffers(
        max(len(places) - 1, 0), pa.py_buffer(places.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))
    )
    return found, np.searchsorted(places, starts)


# Units of Latin script that go to the tokenizer together. What Python takes for white space there is
# in neither, but for a space at the beginning.
_LATIN = rf"\A[\x00-{LATIN}]*\z"
_WORD = rf"\A [{LETTERS}]+\z"
_MARK = rf"\A ?[^ \t-\r\x1c-\x1f\x{{85}}\x{{a0}}]+\z"


class Encoder:
    """The tokenizer's ids of texts; those of short units are remembered.

    Arrow finds the units of many texts, which of them are the same, and which are known;
    what is remembered are two Arrow columns. New units go to the tokenizer in one text, in
    which it cuts them as before. If they are a space and letters, each begins with a token
    that begins with a space, and no other token holds one; others without white space
    inside are set apart by line breaks, which are tokens of their own. Units beyond Latin
    script go one by one, texts with an added token whole.
    """

    def __init__(self, path: str = TOKENIZER, remembered: int = REMEMBERED):
        self._tokenizer = Tokenizer.from_file(path)
        # The tokenizer finds these in a whole text, before it cuts pre-tokens.
        self._added = [token.content for token in self._tokenizer.get_added_tokens_decoder().values()]
        size = self._tokenizer.get_vocab_size(with_added_tokens=True)
        self.kind = np.dtype("<u2" if max(size - 1, END_ID) < 1 << 16 else "<u4")
        space = self._tokenizer.pre_tokenizer.pre_tokenize_str(" ")[0][0]  # as the vocabulary writes it
        self._opens = np.array([(self._tokenizer.id_to_token(i) or "").startswith(space) for i in range(size)])
        [self._break] = self._ids("\n").tolist()
        self._known = self._before = pa.record_batch([pa.array([], pa.string()), _packs([])], ["unit", "ids"])
        self._remembered = remembered

    def _ids(self, text: str) -> np.ndarray:
        [encoded] = self._tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(encoded.ids, self.kind)

    def _alone(self, pieces: list[str]) -> pa.LargeBinaryArray:
        return _packs([self._ids(piece).tobytes() for piece in pieces])

    def _together(self, pieces: list[str], apart: str) -> pa.LargeBinaryArray:
        joined = apart.join(["", *pieces])
        if any(content in joined for content in self._added):  # at a seam, as no unit holds one
            return self._alone(pieces)
        ids = self._ids(joined)
        starts = np.flatnonzero(ids == self._break if apart else self._opens[ids])
        if len(starts) != len(pieces):
            raise ValueError("the tokenizer does not cut units as expected")
        if apart:
            ids = np.delete(ids, starts)
            starts = starts - np.arange(len(starts))
        ends = np.append(starts, len(ids)) * ids.itemsize
        buffers = [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(ids.tobytes())]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(pieces), buffers)

    def _learn(self, new: list[str]) -> pa.LargeBinaryArray:
        column = pa.array(new, pa.string())
        latin, word, mark = (
            pc.match_substring_regex(column, kind).to_numpy(zero_copy_only=False) for kind in (_LATIN, _WORD, _MARK)
        )
        places, packed = [], [_packs([])]
        for kind, work in (
            (word, lambda some: self._together(some, "")),
            (latin & mark & ~word, lambda some: self._together(some, "\n")),
            (~(latin & mark), self._alone),  # white space is among them
        ):
            at = np.flatnonzero(kind)
            places.append(at)
            for start in range(0, len(at), TOGETHER):
                packed.append(work([new[i] for i in at[start : start + TOGETHER].tolist()]))
        return pa.concat_arrays(packed).take(pa.array(np.argsort(np.concatenate(places))))

    def _packed(self, some: pa.StringArray) -> pa.LargeBinaryArray:
        """The ids of each of these units, which differ."""
        known = pc.index_in(some, value_set=self._known["unit"])
        packed = self._known["ids"].take(known)
        if not known.null_count:
            return packed
        absent = some.filter(known.is_null())
        before = pc.index_in(absent, value_set=self._before["unit"])
        learned = self._learn(absent.filter(before.is_null()).to_pylist())
        found = pc.replace_with_mask(self._before["ids"].take(before), before.is_null(), learned)
        self._remember(pa.record_batch([absent, found], ["unit", "ids"]))
        return pc.replace_with_mask(packed, known.is_null(), found)

    def _remember(self, found: pa.RecordBatch) -> None:
        """What is asked for again is among ``found`` and so is taken over."""
        known = pa.concat_batches([self._known, found.filter(pc.less_equal(pc.utf8_length(found["unit"]), CACHE_CHARS))])
        if len(known) > self._remembered:
            cut = max(self._remembered, len(known) - self._remembered)
            self._before, known = known.slice(cut - self._remembered, self._remembered), known.slice(cut)
        self._known = known

    def __call__(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text with the end id."""
        plain = column.fill_null("")
        whole = {}
        for content in self._added:
            for i in np.flatnonzero(pc.match_substring(plain, content)).tolist():
                whole[i] = self._ids(plain[i].as_py())
        cut, bounds = units(plain)
        same = cut.dictionary_encode()
        taken = self._packed(same.dictionary).take(same.indices)
        ends = np.frombuffer(taken.buffers()[1], np.int64)[: len(taken) + 1] // self.kind.itemsize
        found = np.frombuffer(taken.buffers()[2] or b"", self.kind)[: ends[-1]]
        places = ends[bounds].tolist()
        end = np.array([END_ID], self.kind)
        for i, (a, b) in enumerate(zip(places[:-1], places[1:], strict=True)):
            yield np.concatenate([whole.get(i, found[a:b]), end])


def _packs(ids: list[bytes]) -> pa.LargeBinaryArray:
    return pa.array(ids, pa.large_binary())


def gathered(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """The rows in batches of some ``TEXT_BYTES`` of a column of texts; a longer text is one of its own."""
    waiting, size = [], 0
    for batch in batches:
        for part in slices(batch, column):
            more = part.column(column).nbytes
            if waiting and size + more > TEXT_BYTES:
                yield pa.concat_batches(waiting)
                waiting, size = [], 0
            waiting.append(part)
            size += more
    if waiting:
        yield pa.concat_batches(waiting)


@functools.lru_cache(maxsize=2)
def encoder(path: str = TOKENIZER) -> Encoder:
    return Encoder(path)


def write_records(df: DataFrame, target: str, key: str = "doc_id", text: str = "text", path: str = TOKENIZER) -> None:
    """Encode each whole text and write the records to ``target`` by ascending key."""
    spark = df.sparkSession

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("token_records", encoder.cache_clear)
        encode = encoder(path)
        block, size = [], 0

        def out() -> pa.RecordBatch:
            # The last newline is added by the writer of lines.
            return pa.RecordBatch.from_arrays([pa.array([b"".join(block)[: -len(_CLOSE)]], pa.binary())], ["frames"])

        for part in gathered(batches, 1):
            for k, ids in zip(part.column(0).to_pylist(), encode(part.column(1)), strict=True):
                framed = frame(pack(k, ids))
                if block and size + len(framed) > BLOCK_BYTES:
                    yield out()
                    block, size = [], 0
                block.append(framed)
                size += len(framed)
        if block:
            yield out()

    order = [F.asc_nulls_first("doc_id"), F.asc("tie")]
    (
        keyed(df, key, text)
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
        .mapInArrow(work, "frames binary")
        .select(F.col("frames").cast("string").alias("value"))
        .write.option("lineSep", _CLOSE.decode())
        .option("maxRecordsPerFile", BLOCKS_PER_FILE)
        .text(target)
    )


def scan_records(spark: SparkSession, target: str) -> DataFrame:
    """A row for each record, read from the files: place, key, ids and their checksum.

    Columns: file, offset, length (of the frame), doc_id, n_tokens, ids_crc32,
    before (ids before it in the file).
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0), batch.column(1), strict=True):
                data, name, before, rows = memoryview(content.as_buffer()).cast("B"), file.as_py(), 0, []
                for at, record in frames(data):
                    k, ids = unpack(record)
                    rows.append((name, at, len(record) + 17, k, len(ids), check_ids(ids), before))
                    before += len(ids)
                if rows:
                    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, _NAMES)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(target)
    return files.select("path", "content").mapInArrow(
        work, _INDEX_SCHEMA
    )


def write_index(spark: SparkSession, target: str) -> None:
    """Write the offset index of the files in ``target`` beside them."""
    scan_records(spark, target).write.parquet(f"{target}/{INDEX}")


def read_index(spark: SparkSession, target: str) -> DataFrame:
    """The index with ``start``, the ids before a record in all files.

    The files of each writing task are added up together, and one row for each task in
    one place; the records are joined with that.
    """
    records = spark.read.schema(_INDEX_SCHEMA).parquet(f"{target}/{INDEX}")
    # As numbers: names are not padded beyond five and three digits.
    task, number = (F.regexp_extract("file", r"part-([0-9]+)-[^/]*-c([0-9]+)[^/]*$", i).cast("long") for i in (1, 2))
    files = records.groupBy("file").agg(F.sum("n_tokens").alias("ids")).withColumns({"task": task, "number": number})
    earlier_tasks = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = files.groupBy("task").agg(F.sum("ids").alias("ids"))
    tasks = tasks.select("task", F.coalesce(F.sum("ids").over(earlier_tasks), F.lit(0)).alias("in_tasks"))
    earlier_files = Window.partitionBy("task").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", "task", F.coalesce(F.sum("ids").over(earlier_files), F.lit(0)).alias("in_files"))
    files = files.join(tasks, "task").select("file", (F.col("in_tasks") + F.col("in_files")).alias("earlier"))
    return records.join(files, "file").withColumn("start", F.col("earlier") + F.col("before")).drop("earlier")


def read_record(file: str, offset: int, length: int) -> tuple[int | None, np.ndarray]:
    """Key and ids of one record of a file that this process can open."""
    with open(file.removeprefix("file:"), "rb") as stream:
        stream.seek(offset)
        return unpack(unframe(stream.read(length), 0)[0])

