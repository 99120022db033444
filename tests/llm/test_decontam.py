from __future__ import annotations

import random

from tests.llm.brute import shingles

from tidelake.llm import decontam


def test_results_are_those_of_all_pairs(spark, odd):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    items = [" ".join(rng.choices(vocabulary, k=k)) for k in (1, 2, 4, 5, 6, 9, 20, 33, 60, 150)] + [None, "", "One two three FOUR"]
    texts = [r["text"] for r in odd.collect()]
    for item in items[:10]:
        words = item.split()
        for changes in (0, 1, 2, 4, 8):
            copy = list(words)
            for at in rng.sample(range(len(copy)), min(changes, len(copy))):
                copy[at] = "changed"
            around = rng.choices(vocabulary, k=rng.choice([0, 3, 400]))
            texts.append(" ".join([*around, *copy, *around[:2]]).upper())
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, item_id long")
    bench = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(items)], "item_id long, text string, doc_id long, hash string")
    found = {(r["doc_id"], r["item_id"]): (r["n_shingles"], r["n_shared"]) for r in decontam.contaminated(docs, bench).collect()}
    wanted = {}
    for i, text in enumerate(texts):
        for j, item in enumerate(items):
            a, b = shingles(text), shingles(item)
            if b and 100 * len(a & b) >= 80 * len(b):
                wanted[i, j] = len(b), len(a & b)
    assert found == wanted and len(wanted) > 10
    kept = {r["doc_id"] for r in decontam.clean(docs, bench).collect()}
    assert kept == set(range(len(texts))) - {i for i, _ in wanted}


def test_odd_and_empty_tables(spark, odd, empty):
    bench = spark.createDataFrame([(1, "one two three four five"), (None, "one")], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(odd, bench).collect()}
    assert found == {(5, 1), (6, 1), (None, None)}
    assert {r["doc_id"] for r in decontam.clean(odd, bench).collect()} == {0, 1, 2, 4, 7, 8, 9, 10}
    assert decontam.clean(odd, bench).columns == odd.columns
    assert decontam.contaminated(empty, bench).count() == decontam.contaminated(odd, bench.limit(0)).count() == 0
    assert decontam.clean(odd, bench.limit(0)).count() == odd.count()
