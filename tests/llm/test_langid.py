from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm.conftest import ODD_TEXTS

from tidelake.llm import langid

SOUNDS = {"aa": ["ba", "do", "ki", "lu"], "bb": ["sch", "ung", "ver", "ö"], "cc": ["eau", "é", "que", "ou"]}


def sentence(rng, lang, words=12):
    return " ".join("".join(rng.choices(SOUNDS[lang], k=rng.randint(1, 4))) for _ in range(words))


def trees(texts: list[bytes]) -> list[dict[bytes, dict[int, int]]]:
    """Counts of the symbol after each context, by length of the context."""
    counts = [{} for _ in range(langid.ORDER + 1)]
    for text in texts:
        data = b" " * langid.ORDER + bytes(langid._plain[list(text)])
        for i in range(langid.ORDER, len(data)):
            for k in range(langid.ORDER + 1):
                at = counts[k].setdefault(data[i - k : i], {})
                at[data[i]] = at.get(data[i], 0) + 1
    return counts


def code_length(counts, text: bytes) -> float:
    data, total = b" " * langid.ORDER + bytes(langid._plain[list(text)]), 0.0
    for i in range(langid.ORDER, len(data)):
        for k in range(langid.ORDER, -2, -1):
            if k < 0:
                total += 8
                break
            at = counts[k].get(data[i - k : i])
            if at is None:
                continue
            whole = sum(at.values()) + len(at)
            if data[i] in at:
                total -= math.log2(at[data[i]] / whole)
                break
            total -= math.log2(len(at) / whole)
    return total


@pytest.fixture
def corpus(spark):
    rng = random.Random(4)
    rows = [(i, sentence(rng, lang, rng.choice([1, 5, 60])), lang) for i, lang in enumerate(sorted(SOUNDS) * 60)]
    rows += [(500, "no label", None), (501, None, "aa"), (None, "xxxxx", "aa")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_code_lengths_are_those_of_the_definition(spark, corpus):
    model = langid.model_of(corpus)
    assert model.languages == sorted(SOUNDS)
    learned = corpus.filter("crc32(cast(doc_id as string)) % 5 <> 0 and text is not null").collect()
    # Words that are new to some or all trees, and bytes that none has.
    asked = [r["text"] for r in learned[:20]] + ["quarz über 42", "\x00 zzz", "日本語", "a"]
    found = model.lengths_of([t.encode() for t in asked]) / langid.UNIT
    for j, lang in enumerate(model.languages):
        counts = trees([r["text"].encode() for r in learned if r["lang"] == lang])
        for i, text in enumerate(asked):
            assert found[i, j] == pytest.approx(code_length(counts, text.encode()), rel=1e-4, abs=1e-3)


def test_held_out_documents_are_recognised(corpus):
    rows = langid.identify(corpus).join(corpus.select("doc_id", "lang"), "doc_id").filter("lang is not null").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 20 and all(r["lang_pred"] == r["lang"] for r in held if r["doc_id"] < 500)
    assert {r["held_out"] for r in rows} == {True, False}
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_long_texts_go_in_pieces(corpus, monkeypatch):
    model = langid.model_of(corpus)
    text = sentence(random.Random(9), "bb", 500).encode()
    whole = model.best([text, b"ba"])
    total = model.lengths_of([text])
    monkeypatch.setattr(langid, "CHUNK_BYTES", 64)
    assert [x.tolist() for x in model.best([text, b"ba"])] == [x.tolist() for x in whole]
    assert np.array_equal(total, model.lengths_of([text]))


def test_odd_and_empty_tables(odd, empty):
    labelled = odd.withColumn("lang", F.when(F.col("ids") % 2 == 0, "aa").otherwise("bb"))
    rows = langid.identify(labelled).collect()
    assert len(rows) == odd.count()
    found = {r["doc_id"]: r["lang_pred"] for r in rows if r["doc_id"] is not None}
    assert [found[i] for i in (0, 1, 2)] == ["und"] * 3 and all(found[i] in ("aa", "bb") for i in (5, 7, 8, 9))
    assert not [r["held_out"] for r in rows if r["doc_id"] is None][0]
    unlabelled = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {(r["lang_pred"], r["score"]) for r in langid.identify(unlabelled).collect()} == {("und", 0.0)}
    assert langid.identify(labelled.limit(0)).count() == 0
    kept = langid.predict(labelled, langid.model_of(labelled))
    assert kept.columns == ["doc_id", "text", "ids", "digest", "decoded", "lang", "lang_pred", "score"]
    assert sorted(str(r["text"]) for r in kept.collect()) == sorted(map(str, [*ODD_TEXTS, ODD_TEXTS[5]]))


def test_the_model_is_bounded(corpus, monkeypatch):
    monkeypatch.setattr(langid, "GRAMS", 30)
    monkeypatch.setattr(langid, "LANGUAGES", 2)
    model = langid.model_of(corpus)
    assert len(model.languages) == 2 and len(model.known[langid.ORDER]) <= 60


def many(spark, labels):
    """Some large labels and many of one document each, all of which are to be learned."""
    rng = random.Random(8)
    rows = [(sentence(rng, lang, 200), lang) for lang in sorted(SOUNDS) * 20]
    rows += [("".join(rng.choices("abcdefgh", k=90)), f"r{i:03d}") for i in range(labels)]
    return spark.createDataFrame(rows, "text string, lang string")


def test_rare_labels_shrink_no_other(spark, monkeypatch):
    few, all_of = langid.train(many(spark, 0)), langid.train(many(spark, 120))
    assert len(all_of.languages) == 123
    monkeypatch.setattr(langid, "CELLS", 1000)
    blocks = langid.train(many(spark, 120))
    assert isinstance(blocks, langid.Blocks) and not isinstance(all_of, langid.Blocks)
    rows = many(spark, 120).collect()
    texts = [r["text"].encode() for r in rows]
    lengths = blocks.lengths_of(texts)
    assert np.array_equal(lengths, all_of.lengths_of(texts))
    # As without the rare labels, but for bytes that share a symbol.
    first = [all_of.languages.index(lang) for lang in few.languages]
    assert np.array_equal(lengths[:, first], few.lengths_of(texts))
    index, score = blocks.best(texts)
    assert [blocks.languages[i] for i in index] == [r["lang"] for r in rows] and score.min() > 0.5


def test_a_label_keeps_its_strings_beside_others(spark, monkeypatch):
    monkeypatch.setattr(langid, "CELLS", 10_000)
    alone, beside = langid.train(many(spark, 0)), langid.train(many(spark, 40))
    known = np.unique(np.concatenate([b.known[langid.ORDER] for b in beside.blocks]))
    strings = alone.blocks if isinstance(alone, langid.Blocks) else [alone]
    assert len(known) >= max(len(b.known[langid.ORDER]) for b in strings)


def test_a_label_keeps_its_most_frequent_strings(spark):
    rng = random.Random(3)
    # One label with nearly all strings, many equal counts, one label with less than is kept.
    sizes = {"aa": 5000, "bb": 40, "cc": 3}
    rows = [(lang, gram, rng.choice([1, 1, 1, 2, 9])) for lang, size in sizes.items() for gram in range(size)]
    rng.shuffle(rows)
    found = langid.frequent(spark.createDataFrame(rows, "lang string, gram long, n long"), 25).collect()
    wanted = [
        row
        for lang in sizes
        for row in sorted((r for r in rows if r[0] == lang), key=lambda r: (-r[2], r[1]))[:25]
    ]
    assert sorted(map(tuple, found)) == sorted(wanted)


def test_ties_go_to_the_first_label(spark):
    rows = [("ba do ki", "zz"), ("ba do ki", "mm"), ("lu lu", "zz"), ("lu lu", "mm")]
    labelled = spark.createDataFrame(rows, "text string, lang string")
    found = langid.predict(labelled, langid.train(labelled)).collect()
    assert {(r["lang_pred"], r["score"]) for r in found} == {("mm", 0.5)}
