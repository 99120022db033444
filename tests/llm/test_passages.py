from __future__ import annotations

import random

import numpy as np
import pytest

from tidelake.llm import passages, queries, suffix_dedup
from tidelake.llm.shingles import word_groups


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(1, 6))) for _ in range(n))


def expected(texts: list[str | None], size: int) -> list[tuple[int, int]]:
    """Runs and words of each text that lie in ``size`` words which another row has as well."""
    split = [(t or "").encode().lower().split() for t in texts]
    rows: dict[tuple, set[int]] = {}
    for row, text in enumerate(split):
        for i in range(len(text) - size + 1):
            rows.setdefault(tuple(text[i : i + size]), set()).add(row)
    result = []
    for text in split:
        hit = [False] * len(text)
        for i in range(len(text) - size + 1):
            if len(rows[tuple(text[i : i + size])]) > 1:
                hit[i : i + size] = [True] * size
        result.append((sum(h and not (i and hit[i - 1]) for i, h in enumerate(hit)), sum(hit)))
    return result


def corpus():
    rng = random.Random(8)
    planted = [words(rng, n) for n in (50, 51, 52, 59, 70)]
    texts = [words(rng, rng.choice([3, 60, 200])) for _ in range(12)]
    for n in range(30):
        texts.append(f"{words(rng, n % 4 * 30)} {planted[n % 5]}\n{words(rng, n % 3 * 20)} {planted[(n + 2) % 5]}")
    texts += [planted[3].upper(), planted[3].replace(" ", " \t\n"), "é " * 40 + planted[1] + " ü"]
    alone = words(rng, 55)
    texts += [alone + " x " + alone, "na " * 300 + "end", "na " * 80 + "stop", "na " * 50]
    texts += [texts[0], texts[1], texts[1], texts[2], "short", "short", " \t ", "", None, None]
    return texts


def found(spark, texts):
    rows = [(i, t, "x", 0) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, places string, key long").repartition(4)
    return {r["doc_id"]: (r["n_passages"], r["n_passage_words"]) for r in suffix_dedup.remove_repeats(df).collect()}


@pytest.mark.parametrize("group", [16_384, 2])
def test_results_are_those_of_all_runs(spark, monkeypatch, group):
    monkeypatch.setattr(passages, "GROUP", group)
    texts = corpus()
    wanted = expected(texts, passages.WORDS)
    assert found(spark, texts) == dict(enumerate(wanted))
    assert sum(0 < n for n, _ in wanted) > 30 and sum(n == 0 for n, _ in wanted) > 10


def test_the_query_shows_passages_of_less_than_400_bytes(spark, tmp_path):
    rng = random.Random(9)
    passage = words(rng, 55)
    assert len(passage) < suffix_dedup.LENGTH
    texts = [f"{words(rng, 40)} {passage} {words(rng, 40)}" for _ in range(6)] + [words(rng, 140) for _ in range(6)]
    rows = [(i, t, "en", "src0", len(t)) for i, t in enumerate(texts)]
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, kind).write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.op5_suffix_dedup(spark, str(tmp_path)).collect()
    assert all(r["n_removed"] == 0 for r in rows)
    assert {r["doc_id"]: (r["n_passages"], r["n_passage_words"]) for r in rows} == {
        i: (1, 55) if i < 6 else (0, 0) for i in range(12)
    }


def test_blocks_and_long_texts_change_nothing(monkeypatch):
    rng = random.Random(10)
    texts = [words(rng, n).encode() for n in (400, 0, 51, 700, 20)]

    def all_runs():
        result, at = [], 0
        for hashes, bounds in word_groups(texts):
            for place, text, first, key in passages.runs(hashes, bounds):
                begin = bounds[text]
                result += zip(text + at, place - begin, first - begin, key, strict=True)
            at += len(bounds) - 1
        return result

    whole = all_runs()
    assert len(whole) == 350 + 1 + 650
    monkeypatch.setattr(passages, "BLOCK", 64)
    assert all_runs() == whole
    monkeypatch.setattr("tidelake.llm.shingles.BATCH_BYTES", 500)
    assert all_runs() == whole


def test_the_least_of_each_window():
    values = np.random.default_rng(3).integers(0, 50, 200, np.uint64)
    for width in (1, 2, 7, 44):
        assert passages._sliding_least(values, width).tolist() == [min(values[i : i + width]) for i in range(201 - width)]
