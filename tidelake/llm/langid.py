"""Language identification by prediction by partial matching.

For each language a context tree over bytes counts which symbol follows the last three,
two, one and no bytes. A symbol is coded in the longest context that has it; every
longer context that is known but lacks it costs an escape (as likely as there are
different symbols in it). The code length of a whole text under the frozen counts, in
whole units of 1/65536 bit, is summed exactly; the language with the shortest code wins,
and the score is its share of the probability at equal priors.

Before that, A-Z are lower-cased and other ASCII characters than letters become spaces,
as digits and punctuation tell no language. Counts are taken over all labelled documents.
All labels are learned, unless ``LANGUAGES`` names a number of the most frequent ones. Of
each the trees keep the most frequent strings of four, at most ``GRAMS`` whatever the
number of labels, and own symbols for the ``SYMBOLS`` - 1 most frequent bytes, the others
sharing one. Only that goes to the driver and to every worker; it grows with the kept
strings: one table of up to ``CELLS`` cells, or else tables of ``BLOCK`` labels each.

Texts that are null or without letters are ``und`` with score 0, as is all if there is
nothing to learn from. Null labels are not learned from. A null key counts as not held
out and is not learned from. Ties go to the label that sorts first. Repeated rows count
each. ``predict`` keeps all columns, ``identify`` leaves others than its own out.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from tidelake.llm.memory import enter
from tidelake.llm.tables import keyed, small_batches, with_columns, written
from tidelake.operators.surrogate_keys import number_rows

ORDER = 3  # bytes of the longest context
LANGUAGES: int | None = None  # all
GRAMS = 100_000
CELLS = 8_000_000
BLOCK = 4  # languages in a table
SYMBOLS = 128
UNIT = 1 << 16  # of a bit
UNKNOWN = "und"
CHUNK_BYTES = 1 << 19

_BITS = 7  # of a symbol
_PAD = b" " * ORDER

_plain = np.full(256, 0x20, np.uint8)
_plain[128:] = np.arange(128, 256)
_plain[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_plain[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)

_letter = regex.compile(r"\p{L}").search


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _windows(values: np.ndarray, bits: int) -> np.ndarray:
    """Each value with the ``ORDER`` before it, packed into one number."""
    size = len(values) - ORDER
    packed = np.zeros(size, np.uint32)
    for k in range(ORDER + 1):
        packed <<= np.uint32(bits)
        packed |= values[k : k + size]
    return packed


def _bounds(texts: list[bytes]) -> np.ndarray:
    """Where each text begins and ends among joined ones, but for the last end."""
    sizes = np.array([len(text) for text in texts])
    starts = np.cumsum(np.r_[0, sizes[:-1] + ORDER])
    return np.ravel(np.column_stack([starts, starts + sizes]))[:-1]


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    if not len(key):
        return key, count
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return key[first], np.add.reduceat(count, first)


def count_grams(df: DataFrame) -> DataFrame:
    """lang, gram (four bytes as a number), n of a DataFrame of lang and text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("langid")
        found: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            by_language: dict[str, list[bytes]] = {}
            for language, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                by_language.setdefault(language, []).append(text.as_buffer().to_pybytes())
            for language, texts in by_language.items():
                grams, size, kept = [], 0, []
                for at, text in enumerate(texts):
                    kept.append(text)
                    size += len(text)
                    if size >= CHUNK_BYTES or at == len(texts) - 1:
                        joined = np.frombuffer(_PAD + _PAD.join(kept), np.uint8)
                        windows = _windows(_plain[joined], 8)
                        # The bytes between two texts are context only.
                        between = np.cumsum([len(t) + ORDER for t in kept[:-1]], dtype=np.int64) - ORDER
                        windows = np.delete(windows, (between[:, None] + np.arange(ORDER)).ravel())
                        grams.append(np.unique(windows, return_counts=True))
                        size, kept = 0, []
                if language in found:
                    grams.append(found[language])
                found[language] = _summed([g for g, _ in grams], [n for _, n in grams])
        for language, (gram, n) in found.items():
            names = pa.array([language] * len(gram), pa.string())
            yield pa.RecordBatch.from_arrays(
                [names, pa.array(gram.astype(np.int64)), pa.array(n.astype(np.int64))], ["lang", "gram", "n"]
            )

    counted = df.select("lang", "text").mapInArrow(work, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _symbols(grams: list[np.ndarray], counts: list[np.ndarray]) -> np.ndarray:
    """The symbol of each byte."""
    by_byte = np.zeros(256, np.int64)
    for gram, n in zip(grams, counts, strict=True):
        np.add.at(by_byte, gram & 255, n)
    own = np.argsort(-by_byte, kind="stable")[: SYMBOLS - 1]
    symbol = np.full(256, SYMBOLS - 1, np.uint8)
    symbol[own] = np.arange(len(own), dtype=np.uint8)
    return symbol


class Model:
    """Frozen statistics of all languages as tables of code lengths.

    ``lengths[k]`` holds, for each string of k + 1 symbols that any language has, the
    code lengths of its last symbol after the others; ``escapes[k]`` what it costs to
    leave each context of k symbols. ``known`` and ``contexts`` are their sorted keys.
    """

    def __init__(self, languages: list[str], grams: list[np.ndarray], counts: list[np.ndarray], symbol: np.ndarray):
        self.languages = languages
        self.symbols = symbol[_plain]
        self.known, self.lengths, self.contexts, self.escapes = [], [], [], []
        coded = []
        for gram in grams:
            packed = np.zeros(len(gram), np.int64)
            for k in range(ORDER + 1):
                packed = packed << _BITS | symbol[gram >> 8 * (ORDER - k) & 255]
            coded.append(packed)
        for k in range(ORDER + 1):
            self._add_order(k, coded, counts)

    def _add_order(self, k: int, coded: list[np.ndarray], counts: list[np.ndarray]) -> None:
        each = [_summed([c & (1 << _BITS * (k + 1)) - 1], [n]) for c, n in zip(coded, counts, strict=True)]
        known = np.unique(np.concatenate([keys for keys, _ in each]))
        context = known >> _BITS
        contexts = np.unique(context)
        lengths = np.empty((len(known), len(each)), np.int32)
        escapes = np.zeros((len(contexts), len(each)), np.int32)
        of_context = np.searchsorted(contexts, context)
        for j, (keys, n) in enumerate(each):
            seen = np.zeros(len(known), np.int64)
            seen[np.searchsorted(known, keys)] = n
            total = np.bincount(of_context, seen, len(contexts))
            different = np.bincount(of_context, seen > 0, len(contexts))
            both = total + different
            leaves = different > 0
            escapes[leaves, j] = np.round(-np.log2(different[leaves] / both[leaves]) * UNIT)
            has = seen > 0
            lengths[has, j] = np.round(-np.log2(seen[has] / both[of_context[has]]) * UNIT)
            shorter = self.code(known[~has] & (1 << _BITS * k) - 1, k - 1)[:, j]
            lengths[~has, j] = escapes[of_context[~has], j] + shorter
        self.known.append(known)
        self.lengths.append(lengths)
        self.contexts.append(contexts)
        self.escapes.append(escapes)

    def code(self, keys: np.ndarray, k: int) -> np.ndarray:
        """Code lengths of the last symbols of strings of k + 1 symbols, by language."""
        if k < 0:  # no statistics are left: all bytes are alike
            return np.full((len(keys), len(self.languages)), 8 * UNIT, np.int32)
        known, contexts = self.known[k], self.contexts[k]
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        result = self.lengths[k][at]
        absent = np.flatnonzero(known[at] != keys)
        if len(absent):
            missing = keys[absent]
            context = missing >> _BITS
            of = np.minimum(np.searchsorted(contexts, context), len(contexts) - 1)
            escape = np.where((contexts[of] == context)[:, None], self.escapes[k][of], 0)
            result[absent] = escape + self.code(missing & (1 << _BITS * k) - 1, k - 1)
        return result

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_places"}

    @functools.cached_property
    def _places(self) -> tuple[np.ndarray, np.ndarray]:
        """Direct tables: from a context to its row, from row and symbol to the code lengths."""
        contexts = self.contexts[ORDER]
        row = np.zeros(1 << _BITS * ORDER, np.int32)  # 0: unknown context
        row[contexts] = np.arange(1, len(contexts) + 1)
        place = np.full((len(contexts) + 1) << _BITS, -1, np.int32)
        known = self.known[ORDER]
        place[row[known >> _BITS].astype(np.int64) << _BITS | known & SYMBOLS - 1] = np.arange(len(known))
        return row, place

    def forget(self) -> None:
        """Drop the direct tables, which are made again when they are needed."""
        self.__dict__.pop("_places", None)

    def lengths_of(self, texts: list[bytes]) -> np.ndarray:
        """Code lengths of whole texts (not empty), by language."""
        row, place = self._places
        joined = np.frombuffer(_PAD + _PAD.join(texts), np.uint8)
        keys = _windows(self.symbols[joined], _BITS)
        at = place[(row[keys >> np.uint32(_BITS)].astype(np.int64) << _BITS) | (keys & np.uint32(SYMBOLS - 1))]
        codes = self.lengths[ORDER].take(at, axis=0, mode="wrap")  # -1 is mended below
        absent = np.flatnonzero(at < 0)
        if len(absent):
            codes[absent] = self.code(keys[absent].astype(np.int64), ORDER)
        return np.add.reduceat(codes, _bounds(texts), axis=0, dtype=np.int64)[::2]

    def best(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Index of the language and score of each text; long texts go in pieces."""
        total = np.zeros((len(texts), len(self.languages)), np.int64)
        pieces, of, size = [], [], 0
        for i, text in enumerate(texts):
            for at in range(0, len(text), CHUNK_BYTES):
                # The bytes before a piece are its context; their own code is taken off again.
                pieces.append(text[max(0, at - ORDER) : at + CHUNK_BYTES])
                of.append(i)
                size += len(pieces[-1])
                if at:
                    total[i] -= self.lengths_of([pieces[-1][:ORDER]])[0]
                if size >= CHUNK_BYTES:
                    np.add.at(total, of, self.lengths_of(pieces))
                    pieces, of, size = [], [], 0
        if pieces:
            np.add.at(total, of, self.lengths_of(pieces))
        index = np.argmin(total, axis=1)
        behind = (total - total[np.arange(len(texts)), index][:, None]) / UNIT
        return index, 1 / np.exp2(-np.minimum(behind, 1000.0)).sum(axis=1)


class Blocks(Model):
    """Statistics of more languages than one table holds, in a table for each ``BLOCK``."""

    def __init__(self, languages: list[str], grams: list[np.ndarray], counts: list[np.ndarray], symbol: np.ndarray):
        self.languages = languages
        self.symbols = symbol[_plain]
        blocks = [slice(at, at + BLOCK) for at in range(0, len(languages), BLOCK)]
        self.blocks = [Model(languages[b], grams[b], counts[b], symbol) for b in blocks]

    def lengths_of(self, texts: list[bytes]) -> np.ndarray:
        joined = np.frombuffer(_PAD + _PAD.join(texts), np.uint8)
        keys, place = np.unique(_windows(self.symbols[joined], _BITS), return_inverse=True)
        keys, bounds = keys.astype(np.int64), _bounds(texts)
        found = [np.add.reduceat(b.code(keys, ORDER)[place], bounds, axis=0, dtype=np.int64)[::2] for b in self.blocks]
        return np.concatenate(found, axis=1)


def frequent(counted: DataFrame, most: int) -> DataFrame:
    """Of each label the ``most`` strings of greatest count, of equal ones the lesser.

    All strings are numbered in one sorted run, in ranges that also cut the strings of one
    label, and a label keeps those that are near its first; so no task holds a whole label.
    """
    numbered = number_rows(counted.withColumn("less", -F.col("n")), ["lang", "less", "gram"], "place")
    first = written(numbered.groupBy("lang").agg(F.min("place").alias("first")), "labels")
    return numbered.join(first, "lang").filter(F.col("place") - F.col("first") < most).select("lang", "gram", "n")


def train(labelled: DataFrame) -> Model | None:
    """The model of a DataFrame of lang and text, from all its rows."""
    small_batches(labelled.sparkSession)
    counted = written(count_grams(labelled.filter("lang is not null and text is not null")), "grams")
    by_size = counted.groupBy("lang").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "lang")
    sizes = (by_size if LANGUAGES is None else by_size.limit(LANGUAGES)).collect()
    languages = sorted(row["lang"] for row in sizes)
    if not languages:
        return None
    if LANGUAGES is not None:
        counted = counted.filter(F.col("lang").isin(languages))
    kept = frequent(counted, GRAMS).toArrow()
    names = kept.column(0).combine_chunks().dictionary_encode()
    of, gram, n = names.indices.to_numpy(), kept.column(1).to_numpy(), kept.column(2).to_numpy()
    order = np.argsort(of, kind="stable")
    bounds = np.searchsorted(of[order], np.arange(len(names.dictionary) + 1))
    rows = {name: order[a:b] for name, a, b in zip(names.dictionary.to_pylist(), bounds[:-1], bounds[1:], strict=True)}
    grams, counts = [gram[rows[name]] for name in languages], [n[rows[name]] for name in languages]
    one_table = len(np.unique(gram)) * len(languages) <= CELLS
    return (Model if one_table else Blocks)(languages, grams, counts, _symbols(grams, counts))


def predict(df: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``df`` with lang_pred and score of each whole text; columns of these names are replaced."""
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)
    kept = df.drop("lang_pred", "score")
    names = kept.columns
    at_text = names.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        enter("langid", (lambda: None) if trees is None else trees.forget)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found, scores, asked, texts = [UNKNOWN] * part.num_rows, [0.0] * part.num_rows, [], []
                for i, value in enumerate(part.column(at_text)):
                    if trees is not None and value.is_valid and _letter(value.as_py()):
                        asked.append(i)
                        texts.append(value.as_buffer().to_pybytes())
                if asked:
                    for i, index, score in zip(asked, *map(np.ndarray.tolist, trees.best(texts)), strict=True):
                        found[i], scores[i] = trees.languages[index], score
                columns = [*part.columns, pa.array(found, pa.string()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, [*names, "lang_pred", "score"])

    return kept.mapInArrow(work, with_columns(kept, "lang_pred string, score double"))


def model_of(documents: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model | None:
    """The model learned from the documents that are not held out."""
    learned = documents.filter(F.crc32(documents[key].cast("string").cast("binary")) % 5 != 0)
    return train(learned.select(learned[lang].alias("lang"), learned[text].alias("text")))


def identify(documents: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred and score, learned from the documents not held out."""
    model = model_of(documents, key, text, lang)
    found = predict(keyed(documents, key, text), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
