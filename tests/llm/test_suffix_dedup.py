from __future__ import annotations

import random

import pytest
from hypothesis import given, settings, strategies as st

from tidelake.llm import suffix_dedup as module


def expected(texts: list[bytes], length: int) -> list[tuple[int, int, bytes]]:
    """Removed bytes, spans and what is kept, from a count of all strings."""
    count: dict[bytes, int] = {}
    for text in texts:
        for i in range(len(text) - length + 1):
            count[text[i : i + length]] = count.get(text[i : i + length], 0) + 1
    result = []
    for text in texts:
        gone = [False] * len(text)
        for i in range(len(text) - length + 1):
            if count[text[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        result.append((sum(gone), spans, bytes(b for b, g in zip(text, gone, strict=True) if not g)))
    return result


def words(rng, n):
    return " ".join(rng.choice("abcdefgh") * rng.randint(1, 3) + str(rng.randrange(10**6)) for _ in range(n))


def corpus():
    rng = random.Random(6)
    passage, other = words(rng, 70), words(rng, 52)
    texts = [words(rng, rng.choice([3, 60, 200])) for _ in range(12)]
    for n in range(24):  # a passage between different neighbours, some of which agree for a while
        texts.append(words(rng, n % 5 * 9) + " same start " * (n % 3) + passage + (" end é" * (n % 4)) + words(rng, n % 7))
    near = words(rng, 150).split()
    for n in range(20):
        copy = list(near)
        for at in rng.sample(range(150), n % 6):
            copy[at] = "changed"
        texts.append(" ".join(copy))
    texts += [other + words(rng, 5) + other, "x" * 1500, "ab" * 700 + "c", "ab" * 500, texts[0], texts[0], texts[2], "short", "short", "", None]
    texts += ["y" * 399, "y" * 399, "z" * 400, "z" * 401]
    return texts


def found(spark, texts):
    rows = [(i, t, "x", 0) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, digest string, start long").repartition(4)
    rows = module.remove_repeats(df).collect()
    assert all(r["n_bytes"] == len((texts[r["doc_id"]] or "").encode()) for r in rows)
    return {r["doc_id"]: (r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in rows}


@pytest.mark.parametrize("group", [2048, 3])
def test_results_are_those_of_all_strings(spark, monkeypatch, group):
    monkeypatch.setattr(module, "GROUP", group)
    texts = corpus()
    wanted = expected([(t or "").encode() for t in texts], module.LENGTH)
    result = found(spark, texts)
    assert result == dict(enumerate(wanted))
    assert sum(0 < n < len((t or "").encode()) for t, (n, _, _) in zip(texts, wanted, strict=True)) > 20


def test_a_string_matched_in_one_part_and_alone_in_another(spark, monkeypatch):
    monkeypatch.setattr(module, "GROUP", 2)
    texts = []
    for seed in range(30):
        rng = random.Random(seed)
        passage = "".join(rng.choices("abcdefgh", k=module.LENGTH))
        texts += [f"{3 * seed + n:03d}A" + words(rng, 4) + c + passage + c + words(rng, 4) for n, c in enumerate("XYZ")]
    wanted = expected([t.encode() for t in texts], module.LENGTH)
    assert all(n == module.LENGTH for n, _, _ in wanted)
    assert found(spark, texts) == dict(enumerate(wanted))


def test_long_texts_go_in_segments(monkeypatch):
    text = words(random.Random(2), 3000).encode()
    whole = module.anchors(text)
    monkeypatch.setattr(module, "SEGMENT", 1000)
    assert [x.tolist() for x in module.anchors(text)] == [x.tolist() for x in whole]


def test_every_string_has_an_anchor_of_its_own():
    rng = random.Random(1)
    text = words(rng, 400).encode()
    places = module.anchors(text)[0]
    for i in range(0, len(text) - module.LENGTH, 7):
        within = [p - i for p in places if i <= p <= i + module.LENGTH - module.ANCHOR]
        alone = module.anchors(text[i : i + module.LENGTH])[0].tolist()
        assert len(alone) == 1 and alone[0] in within


@settings(max_examples=300, deadline=None)
@given(st.lists(st.binary(max_size=40).map(lambda b: bytes(97 + x % 2 for x in b)), min_size=1, max_size=12), st.integers(0, 16))
def test_the_order_is_that_of_a_sort(tails, shared):
    texts = [b"p" * shared + tail for tail in tails]
    assert [texts[i] for i in module.deep_shallow(texts, shared)] == sorted(texts)
    assert [texts[i] for i in module.blind_trie(texts, list(range(len(texts))))] == sorted(texts)


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=9), st.binary(max_size=9))
def test_common_beginnings(a, b):
    size = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    assert module.common(a, b) == size


def test_odd_and_empty_tables(odd, empty):
    rows = module.remove_repeats(odd).collect()
    assert len(rows) == odd.count()
    by = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by[9]["n_removed"] == by[9]["n_bytes"] and by[9]["n_spans"] == 1
    assert bytes(by[10]["kept"]) == b" with an end" and by[0]["n_bytes"] == 0
    assert module.remove_repeats(empty).count() == 0
