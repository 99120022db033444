from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tidelake.llm import packing, tables
from tidelake.llm.queries import op13_retrieval_packing


def library(texts):
    tokenizer = Tokenizer.from_file(packing.TOKENIZER)
    found = tokenizer.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)
    return [[*encoded.ids, packing.END_ID] for encoded in found]


def check(pieces, texts, window=packing.WINDOW):
    """Each id of each text lies in one piece; sequences are gapless, and full or a power of two."""
    wanted = Counter(tuple(ids) for ids in library(texts))
    by_sequence, by_place = defaultdict(list), defaultdict(list)
    for r in pieces:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] > 0
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
        by_place[r["doc_id"]].append((r["start"], ids, r["doc_tokens"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == window or at < window and at & at - 1 == 0
    return by_place, wanted


def whole(by_place, wanted):
    found = Counter()
    for parts in by_place.values():
        at, ids = 0, []
        for start, some, total in sorted(parts):
            assert start == at
            at += len(some)
            ids += some
        assert at == total
        found[tuple(ids)] += 1
    assert found == wanted


CASES = [
    "Hello, it's 42 O'CLOCK  café don't 'S 'll x'y''re",
    "a<|endoftext|> İstanbul ǅ ß <|startoftext|>b",
    "é 中文 \U0001f600 ²½ ٠",
    "\x00\x01 \x1c\x1f\x85 marks \"'s\" '\"' 'd'd",
    "x" * 3000,
    "a.b'c.'s ('word') x1y2'3s é,ü. (Ā) 5×6÷7 Straße; ñ'd \u0301a, 1\u0301 a\u0301,b <|ENDOFTEXT|>",
    " lead  and\ttrail \xa0x\x85y\u2003z ",
]


def test_ids_as_the_library_has_them(spark, odd):
    encode = packing.WordEncoder(remembered=5)
    texts = CASES + [r["text"] or "" for r in odd.collect()] + CASES
    texts += [r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    for _ in range(2):
        ids, bounds = encode(pa.array([None, *texts, None, ""])[1:-1])
        found = [[*ids[a:b].tolist(), packing.END_ID] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        assert found == library([*texts, None])


def test_texts_are_taken_by_bytes():
    batch = pa.RecordBatch.from_arrays([pa.array(["ab", None, "c" * 50, "", "d" * 3, "é"])], ["text"])
    assert [part.num_rows for part in tables.slices(batch, 0, 6)] == [2, 1, 3]


@pytest.mark.parametrize("block", [4, 1024])
def test_each_id_lies_in_one_piece(spark, block):
    draw = random.Random(block)
    texts = [" ".join(draw.choice("abcdefgh") for _ in range(draw.choice([0, 1, 5, 90, 700, 2047, 2048, 5000]))) for _ in range(80)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    whole(*check(packing.pack(df, block=block).collect(), texts))


def test_odd_documents(spark, odd):
    rows = odd.collect()
    pieces = packing.pack(odd).collect()
    by_place, wanted = check(pieces, [r["text"] for r in rows])
    assert sum(r["length"] for r in pieces) == sum(len(ids) * n for ids, n in wanted.items())
    repeated = {key for key, n in Counter(r["doc_id"] for r in rows).items() if n > 1}
    whole({k: v for k, v in by_place.items() if k not in repeated}, Counter(tuple(i) for i, r in zip(library([r["text"] for r in rows]), rows) if r["doc_id"] not in repeated))


def test_empty(spark, empty):
    assert packing.pack(empty).collect() == []


def test_a_window_takes_the_documents_most_like_its_seed():
    # Two topics with their own words; all share some.
    draw = np.random.default_rng(1)
    topics = [np.arange(100, 200), np.arange(300, 400)]
    docs = [(i, 0, np.concatenate([draw.choice(topics[i % 2], 40), np.arange(10)]).astype("<u2")) for i in range(64)]
    held = np.zeros(500, np.int64)
    for _, _, ids in docs:
        held[np.unique(ids)] += 1
    windows, rest = packing.fill(docs, packing.inverse_frequencies(held, len(docs)), 50.0, window=200)
    kinds = [{row % 2 for row, _, _ in chosen} for chosen in windows]
    assert len(windows) == 16 and not rest and sum(len(k) == 1 for k in kinds) >= 15


def test_scores_are_bm25(monkeypatch):
    docs = [np.array(ids, "<u2") for ids in ([1, 1, 2], [2, 3], [3, 3, 3, 4], [5])]
    held = np.bincount(np.concatenate([np.unique(d) for d in docs]), minlength=7)
    weights, mean = packing.inverse_frequencies(held, 4), 2.5
    for common in (1, 100):
        monkeypatch.setattr(packing, "COMMON", common)
        index = packing.Index(docs, weights, mean)
        for q, query in enumerate(docs):
            for i, (d, score) in enumerate(zip(docs, index.scores(q), strict=True)):
                wanted = 0
                for term in set(query.tolist()):
                    f = int((d == term).sum())
                    idf = max(np.log((4 - held[term] + 0.5) / (held[term] + 0.5)), 0)
                    wanted += idf * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * len(d) / mean))
                assert i == q or score == pytest.approx(wanted, rel=1e-6)


def test_the_last_parts_are_cut_into_powers_of_two():
    parts = [(0, 5, np.arange(700)), (1, 0, np.arange(800)), (2, 9, np.arange(3))]
    sequences = packing.powers(parts)
    assert [sum(len(ids) for _, _, ids in s) for s in sequences] == [1024, 256, 128, 64, 16, 8, 4, 2, 1]
    assert [v for s in sequences for _, _, ids in s for v in ids.tolist()] == [*range(700), *range(800), *range(3)]


def test_query_is_the_contract(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    wanted = dict(zip([r["doc_id"] for r in docs], library([r["text"] for r in docs]), strict=True))
    seen = Counter()
    for r in op13_retrieval_packing(spark, sf).collect():
        ids = wanted[r["doc_id"]]
        part = np.array(ids[r["start"] : r["start"] + r["length"]], "<u4")
        assert r["ids_crc32"] == zlib.crc32(part.tobytes()) and r["doc_tokens"] == len(ids)
        seen[r["doc_id"]] += r["length"]
    assert seen == {key: len(ids) for key, ids in wanted.items()}


PARTS = [
    " ", "\n", "\t ", "\xa0", "\x85", "\u2003", "\x1c", "a", "WORD", "É", "Ā", "İ", "ß", "×", "1", "42", "²", "٠", "'s", "'", "''RE", "don't", ",",
    ".'", "(", "<|", "<|endoftext|>", "<|ENDOFTEXT|>", "中文", "\U0001f600", "e\u0301", "\u0301", "\x00", "_", "Σ", "ΑΣ",
]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=12).map("".join), min_size=1, max_size=12))
def test_any_text_is_encoded_as_by_the_library(texts):
    ids, bounds = packing.encoder()(pa.array(texts))
    found = [[*ids[a:b].tolist(), packing.END_ID] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    assert found == library(texts)
