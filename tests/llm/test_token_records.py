from __future__ import annotations

import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tidelake.llm import token_records
from tidelake.session import new_folder


def library():
    tokenizer = Tokenizer.from_file(token_records.TOKENIZER)
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, token_records.END_ID]


def written(spark, df):
    target = new_folder(spark, "records")
    token_records.write_records(df, target)
    token_records.write_index(spark, target)
    return token_records.read_index(spark, target).orderBy("start").collect()


def test_records_hold_the_ids_by_ascending_key(spark, odd):
    extra = spark.createDataFrame([(50, "<|endoftext|> here"), (40, "it's 5\n\n  o'clock")], "doc_id long, text string")
    df = odd.select("doc_id", "text").union(extra)
    encode, index = library(), written(spark, df)
    wanted = sorted((r["doc_id"] is not None, r["doc_id"] or 0, encode(r["text"])) for r in df.collect())
    assert [r["doc_id"] for r in index] == [key if known else None for known, key, _ in wanted]
    start = 0
    for row in index:
        key, ids = token_records.read_record(row["file"], row["offset"], row["length"])
        assert key == row["doc_id"] and len(ids) == row["n_tokens"] and row["start"] == start
        assert (key is not None, key or 0, ids.tolist()) in wanted
        assert row["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def starts(index):
    at = 0
    for row in index:
        assert row["start"] == at
        at += row["n_tokens"]


def test_files_are_cut_by_bytes_and_stay_in_order(spark, monkeypatch):
    monkeypatch.setattr(token_records, "BLOCK_BYTES", 300)
    monkeypatch.setattr(token_records, "BLOCKS_PER_FILE", 2)
    df = spark.range(100).selectExpr("id as doc_id", "repeat(concat('text ', id, ' '), if(id % 10 = 0, 500, 5)) as text")
    index = written(spark, df)
    assert [r["doc_id"] for r in index] == list(range(100))
    starts(index)
    sizes = {}
    for r in index:
        sizes.setdefault(r["file"], []).append(r["length"])
    assert len(sizes) > 10 and all(sum(lengths) <= 2 * max(300, max(lengths)) for lengths in sizes.values())


def test_more_than_a_thousand_files_of_one_task(spark, monkeypatch):
    monkeypatch.setattr(token_records, "BLOCK_BYTES", 1)
    monkeypatch.setattr(token_records, "BLOCKS_PER_FILE", 1)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 1)
    try:
        index = written(spark, spark.range(1100).selectExpr("id as doc_id", "concat('text ', id) as text"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert [r["doc_id"] for r in index] == list(range(1100)) and len({r["file"] for r in index}) == 1100
    starts(index)


def test_one_key_with_two_texts(spark):
    rows = [(1, "a b c"), (1, "d"), (1, "d"), (2, "e f"), (None, "g"), (None, None)]
    index = written(spark, spark.createDataFrame(rows, "doc_id long, text string"))
    assert [r["doc_id"] for r in index] == [None, None, 1, 1, 1, 2]
    starts(index)
    encode = library()
    found = [token_records.read_record(r["file"], r["offset"], r["length"]) for r in index]
    assert sorted(map(str, ((k, ids.tolist()) for k, ids in found))) == sorted(str((k, encode(t))) for k, t in rows)


def test_an_empty_table(spark, empty):
    assert written(spark, empty) == []


def test_damage_is_found():
    good = token_records.frame(b"some record")
    assert [r for _, r in token_records.frames(good * 2)] == [b"some record"] * 2
    for at in range(len(good)):
        bad = bytearray(good)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            list(token_records.frames(bytes(bad)))


def test_new_pre_tokens_go_together(spark):
    texts = ["a bc def ghi", "", "the the  the", "x" * 100 + " y", "Ünï cödé", "中文 text"]
    encode = library()
    for _ in range(2):  # the second time from memory
        found = list(token_records.encoder()(pa.array(texts)))
        assert [ids.tolist() for ids in found] == [encode(t) for t in texts]


def test_what_is_remembered_is_bounded_and_outlives_a_full_memory(monkeypatch):
    encode, plain, learned = token_records.Encoder(remembered=5), library(), []
    learn = encode._learn
    monkeypatch.setattr(encode, "_learn", lambda new: learned.extend(new) or learn(new))
    letters = "abcdefghijklmnopqrstuvwx"
    texts = [f"x the {letters[i]}{letters[i + 1]} {letters[i + 2]}{letters[i]}" for i in range(20)]
    for text in [*texts, " ".join(texts), texts[0]]:
        [ids] = encode(pa.array([text]))
        assert ids.tolist() == plain(text)
        assert len(encode._known) <= 5 and len(encode._before) <= 5
        if text is texts[-1]:  # what each text asks for is learned once
            assert learned.count("x") == learned.count(" the") == 1 and len(learned) > 40


def test_what_is_remembered_is_held_by_arrow_not_in_python_objects():
    encode, rng = token_records.Encoder(), random.Random(3)
    text = "".join(" " + "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=8)) for _ in range(30_000))
    list(encode(pa.array(["a b", text[:50]])))  # what the first call loads
    tracemalloc.start()
    try:
        [ids] = encode(pa.array([text]))
        del ids
        held = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert len(encode._known) > 29_000
    assert held < 1 << 20 and encode._known.nbytes < 40 * len(encode._known)


@pytest.mark.parametrize("together", [1, 3, 20_000])
def test_many_new_units_go_in_several_calls(monkeypatch, together):
    monkeypatch.setattr(token_records, "TOGETHER", together)
    texts = [" alpha beta, gamma's\n\n delta 12 é ж 中文  x", "", "...?! a-b\tc\x1c d\x85 \x00e", " alpha new"]
    encode = token_records.Encoder(remembered=6)
    for _ in range(2):
        assert [ids.tolist() for ids in encode(pa.array(texts))] == list(map(library(), texts))


def test_small_batches_are_put_together_by_bytes(monkeypatch):
    monkeypatch.setattr(token_records, "TEXT_BYTES", 1_000)
    sizes = [10, 0, None, 400, 300, 5_000, 10, 990, 1] + [20] * 100
    texts = [None if n is None else "x" * n for n in sizes]
    column = pa.array(texts)
    batches = [pa.record_batch([pa.array([i]), column.slice(i, 1)], ["doc_id", "text"]) for i in range(len(texts))]
    found = list(token_records.gathered(iter(batches), 1))
    rows = [row for part in found for row in zip(*(c.to_pylist() for c in part.columns), strict=True)]
    assert rows == list(enumerate(texts)) and len(found) < 10
    assert all(part.num_rows == 1 or sum(len(t or "") for t in part.column(1).to_pylist()) <= 1_000 for part in found)
    assert list(token_records.gathered(iter([]), 1)) == []


def test_added_tokens_are_those_of_the_tokenizer_as_loaded(spark):
    texts = ["a<|endoftext|> here", "<|endoftext|>", "a <|endof text|> b", "x <|endoftext|>\n<|endoftext|> y z", "a here", "<| endoftext |>"]
    tokenizer = Tokenizer.from_file(token_records.TOKENIZER)
    wanted = [[*tokenizer.encode(t, add_special_tokens=False).ids, token_records.END_ID] for t in texts]
    assert [ids.tolist() for ids in token_records.Encoder()(pa.array(texts))] == wanted
    index = written(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert [r["n_tokens"] for r in index] == list(map(len, wanted))
    assert [r["ids_crc32"] for r in index] == [zlib.crc32(np.array(ids, "<u4").tobytes()) for ids in wanted]


def test_white_space_beyond_ascii_goes_with_white_space(spark):
    wide = "\x85\xa0\u1680\u2000\u2003\u200a\u2028\u2029\u202f\u205f\u3000\x1c\u200b"
    around = ["", " ", "\n", "  ", "\n ", "a", "é", "1", ",", "'s", "a ", " b", "\t"]
    texts = [f"{before}{space}{after}" for space in wide for before in around for after in around]
    texts += [f"x {a}{b} y" for a in wide for b in wide]
    wanted = list(map(library(), texts))
    assert [ids.tolist() for ids in token_records.Encoder()(pa.array(texts))] == wanted
    assert [ids.tolist() for ids in token_records.Encoder()(pa.array([" ".join(texts)]))] == [library()(" ".join(texts))]


PARTS = [
    " ", "  ", "\n", "\n\n ", "\t", "\r\n", "\xa0", "\x85", "\u2003", "\x1c", "\x0b", "a", "Word", "é", "Ā", "ß", "×", "÷", "1", "42", "²", "٠", "'s", "'",
    "''re", "don't", ",", ".", "--", "(", "<|", "<|endoftext|>", "中文", "\U0001f600", "e\u0301", "\x00", "_", "\u200b",
]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=12).map("".join), min_size=1, max_size=12))
def test_any_text_is_encoded_as_by_the_library(texts):
    encode = library()
    found = token_records.encoder()(pa.array(["x", *texts, None])[1:])
    assert [ids.tolist() for ids in found] == [encode(t) for t in [*texts, ""]]
