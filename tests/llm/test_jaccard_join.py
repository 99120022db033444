from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tests.llm.brute import components, shingles, similar

from tidelake.llm import graph, jaccard_join
from tidelake.llm.shingles import shingle_sets


def copies(seed: int, sizes=(3, 6, 12, 40, 120), each=14) -> list[str]:
    """Texts in groups of near copies with more and more changes, and passages that several share."""
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(30)]
    texts = []
    for size in sizes:
        words = [f"v{rng.randrange(500)}" for _ in range(size)]
        for n in range(each):
            copy = list(words)
            for at in rng.sample(range(size), min(size, n % 5 * size // 60)):
                copy[at] = f"n{rng.randrange(10**6)}"
            if n % 4 == 3:
                copy += passage
            texts.append(" ".join(copy))
    return [*texts, *texts[::9], None, "", "  "]


def table(spark, texts):
    rows = [(1000 - i, t, "x", i) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, digest string, n long").repartition(5)


def check(spark, texts):
    sets = [shingles(t) for t in reversed(texts)]  # by ascending id
    ids = [1000 - i for i in reversed(range(len(texts)))]
    least = components(sets, similar)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.join(table(spark, texts)).collect()}
    assert found == {ids[i]: (len(sets[i]), ids[least[i]]) for i in range(len(ids))}
    return len(set(least))


def test_components_are_those_of_all_pairs(spark):
    assert 20 < check(spark, copies(1)) < 70


def test_large_groups_are_dealt_into_tiles(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "TILE_SETS", 4)
    check(spark, copies(2, sizes=(40, 60), each=30))


def test_frequent_shingles_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "HEAVY", 5)
    check(spark, copies(3))


@pytest.mark.parametrize("few", [0, 2])
def test_parted_components_hold_every_link(spark, monkeypatch, few):
    monkeypatch.setattr(jaccard_join, "TILE_SETS", 4)
    monkeypatch.setattr(jaccard_join, "FEW", few)
    check(spark, copies(5, sizes=(40, 60), each=12))


def test_passages_of_few_sets_do_not_make_one_large_component(spark, monkeypatch):
    # Each text shares one passage with the one before and another with the one after.
    rng = random.Random(6)
    passages = [" ".join(f"p{n}x{i}" for i in range(150)) for n in range(13)]
    texts = [f"{passages[n]} {' '.join(f'w{rng.randrange(10**9)}' for _ in range(300))} {passages[n + 1]}" for n in range(12)]
    texts += [texts[3] + " end", texts[8] + " end"]
    joined, rows = jaccard_join._joined, []

    def counted(units):
        rows.append(units.count())
        return joined(units)

    monkeypatch.setattr(jaccard_join, "TILE_SETS", 4)
    monkeypatch.setattr(jaccard_join, "_joined", counted)
    assert check(spark, texts) == 12
    assert rows == [4]


def test_equal_sets_of_several_tasks_give_a_row_once(spark):
    texts = [" ".join(f"{name}{i}" for i in range(40)) for name in "ab"]
    texts = [texts[0], texts[0] + " end", texts[1]]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 6)], "doc_id long, text string").repartition(9)
    rows = [tuple(r) for r in jaccard_join.shared_rows(docs, np.empty(0, np.uint64)).collect()]
    assert len(rows) <= 2 * len(set(rows)) and len({c for _, c in rows}) == 2


def test_sieves_that_let_everything_through_change_nothing(spark, monkeypatch):
    docs = jaccard_join.keyed(table(spark, copies(4)), "doc_id", "text")
    sets = jaccard_join.scan(docs).filter("digest is not null")
    classes = sets.groupBy("digest", "n").agg({"doc_id": "min"}).withColumnRenamed("min(doc_id)", "doc_id")

    def chains():
        found = jaccard_join.chains(docs, classes, np.empty(0, np.uint64)).collect()
        return sorted((r["class"], r["least"]) for r in found)

    sieved = chains()
    monkeypatch.setattr(jaccard_join, "sifted", lambda df, sieves: df)
    assert len(sieved) > 20 and chains() == sieved


def test_odd_and_empty_tables(odd, empty):
    found = sorted((r["doc_id"] is None, r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.join(odd).collect() if r["doc_id"] is not None)
    of = {(d, n): c for _, d, n, c in found}
    assert of[0, 0] == 0 and of[1, 0] == 1 and of[2, 0] == 2 and of[4, 1] == 4
    assert of[5, 1] == 5 and of[6, 1] == 5 and of[7, 2] == 7
    assert of[9, 4996] == 9 and of[10, 4999] == 9
    assert len(jaccard_join.join(odd).collect()) == odd.count()
    assert jaccard_join.join(empty).count() == 0


def test_null_ids_and_one_id_with_two_texts(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(None, a), (None, a + " z"), (3, a), (3, b), (4, b + " z"), (None, c)]
    found = jaccard_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    as_found = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["n_shingles"], r["component_id"]) for r in found), key=str)
    # The least id of a class that has one; a class of null ids only keeps null.
    assert as_found == sorted(
        [(True, 0, 56, 3), (True, 0, 57, 3), (False, 3, 56, 3), (False, 3, 56, 3), (False, 4, 57, 3), (True, 0, 56, None)], key=str
    )


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab \t\nAB\x1f\xa0", max_size=30), max_size=8))
def test_sets_are_those_of_the_words(texts):
    found = list(shingle_sets([t.encode() for t in texts]))
    assert [len(s) for s in found] == [len(shingles(t)) for t in texts]
    for i, a in enumerate(found):
        assert np.all(a[1:] > a[:-1])
        for j, b in enumerate(found):
            assert len(np.intersect1d(a, b)) == len(shingles(texts[i]) & shingles(texts[j]))


def test_long_texts_and_words(monkeypatch):
    from tidelake.llm import shingles as module

    text = (" ".join(f"w{i}" for i in range(3000)) + " " + "x" * 9000 + " a b c d e").encode()
    whole = next(iter(shingle_sets([text])))
    monkeypatch.setattr(module, "BATCH_BYTES", 500)
    assert np.array_equal(next(iter(shingle_sets([text]))), whole)


@pytest.mark.parametrize("n", range(1, 300))
def test_prefixes_of_linked_sets_share_enough(n):
    # For each size that a linked set may have, with the least overlap the similarity allows.
    for m in range(n, n * 5 // 4 + 1):
        overlap = -(-4 * (n + m) // 9)
        if overlap > n:
            continue
        for a in (n, m):
            rest = a - overlap  # all that is not shared may come first
            assert min(jaccard_join.prefix_size(a) - rest, overlap) >= min(jaccard_join.wanted(n), jaccard_join.wanted(m))
        both = min(jaccard_join.prefix_size(n) - (n - overlap), jaccard_join.prefix_size(m) - (m - overlap))
        assert both >= max(jaccard_join.wanted(n), jaccard_join.wanted(m))


@pytest.mark.parametrize("most", [1 << 26, 1 << 12, 1])
def test_the_tree_finds_all_links(most, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SIGNATURE_BYTES", most)
    rng = np.random.default_rng(3)
    base = [rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (8, 50, 51, 300)]
    sets = []
    for b in base:
        for changes in range(12):
            s = b.copy()
            at = rng.choice(len(s), min(len(s), changes * len(s) // 50), replace=False)
            s[at] = rng.integers(0, 1 << 63, len(at), dtype=np.uint64)
            sets.append(np.unique(s))
    whole = [frozenset(s.tolist()) for s in sets]
    least = components(whole, similar)
    links = jaccard_join.tree_join(sets)
    assert all(similar(whole[i], whole[j]) for i, j in links)
    found = list(range(len(sets)))
    for i, j in links:
        a, b = sorted((found[i], found[j]))
        found = [a if x == b else x for x in found]
    assert found == least


def test_components_of_a_graph(spark):
    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(200, 260)] + [(300, i) for i in range(301, 360)] + [(7, 7)]
    edges += [(rng.randrange(150), rng.randrange(150)) for _ in range(110)]
    found = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "x long, y long")).collect()}
    least = {n: n for e in edges for n in e}
    for _ in range(200):
        for a, b in edges:
            least[a] = least[b] = min(least[a], least[b])
    assert found == {n: c for n, c in least.items() if any(a != b and n in (a, b) for a, b in edges)}
    assert graph.components(spark.createDataFrame([], "x long, y long")).count() == 0
