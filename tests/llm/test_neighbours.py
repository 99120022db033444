from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelake.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, label int, block string"


def table(spark, vectors, start=0):
    return spark.createDataFrame([(start + i, v, None, "x") for i, v in enumerate(vectors)], SCHEMA)


def exact(vectors, query, k):
    x = np.array(vectors, np.float32).astype(float)
    scores = np.einsum("ij,j->i", x, x[query])
    order = [i for i in np.lexsort((np.arange(len(x)), -scores)) if i != query][:k]
    return [(i, scores[i]) for i in order]


def found(df, **options):
    rows = neighbours.nearest(df, F.col("vec_id") % 20 == 0, **options).orderBy("query_id", "rank").collect()
    result: dict[int, list] = {}
    for row in rows:
        result.setdefault(row["query_id"], []).append((row["vec_id"], row["score"]))
        assert row["rank"] == len(result[row["query_id"]])
    return result


@pytest.fixture
def vectors():
    rng = np.random.default_rng(11)
    centres = rng.standard_normal((30, 24))
    x = centres[rng.integers(0, 30, 900)] + rng.standard_normal((900, 24)) * 0.7
    return (x * rng.uniform(0.3, 2, (900, 1))).tolist()  # of different lengths


def test_all_is_verified_with_full_confidence(spark, vectors, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 200)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 20)
    result = found(table(spark, vectors), confidence=1.0)
    assert sorted(result) == list(range(0, 900, 20))
    for query, best in result.items():
        wanted = exact(vectors, query, 20)
        assert [i for i, _ in best] == [i for i, _ in wanted]
        assert np.allclose([s for _, s in best], [s for _, s in wanted], rtol=1e-12)


def test_recall_is_that_of_the_confidence(spark, vectors):
    result = found(table(spark, vectors))
    hits = sum(len({i for i, _ in best} & {i for i, _ in exact(vectors, q, 20)}) for q, best in result.items())
    assert hits >= 0.9 * 20 * len(result)


def test_ties_go_to_the_smaller_id(spark):
    result = found(table(spark, [[1.0, 2.0, 3.0]] * 300 + [[3.0, 2.0, 1.0]] * 5))
    assert [i for i, _ in result[0]] == list(range(1, 21))
    assert [i for i, _ in result[20]] == list(range(20))


def test_odd_vectors_take_no_part(spark):
    odd = [None, [], [0.0, 0.0], [1.0, None], [float("nan"), 1.0], [float("inf"), 1.0], [1.0, 1.0], [2.0, 0.5], [1.0, 1.0, 1.0]]
    df = table(spark, odd, start=20).union(spark.createDataFrame([(None, [1.0, 1.0], 1, "y"), (40, [1.0, 0.0], 1, "y"), (60, [0.0], 1, "y")], SCHEMA))
    assert found(df) == {40: [(27, 2.0), (26, 1.0)]}
    assert found(df.limit(0)) == {}


def test_the_chi_square_law():
    sample = (np.random.default_rng(1).standard_normal((200_000, neighbours.DIRECTIONS)) ** 2).sum(axis=1)
    for x in (5.0, 12.0, 20.0):
        assert neighbours.chi_square(x) == pytest.approx((sample <= x).mean(), abs=0.005)
    assert neighbours.chi_square(neighbours.quantile(0.9)) == pytest.approx(0.9)


def test_recall_over_several_cells(spark, vectors, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 60)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 5)
    result = found(table(spark, vectors))
    hits = sum(len({i for i, _ in best} & {i for i, _ in exact(vectors, q, 20)}) for q, best in result.items())
    assert hits >= 0.9 * 20 * len(result)
    for query, best in result.items():
        scores = dict(exact(vectors, query, 900))
        assert len(best) == 20 and all(scores[i] == pytest.approx(s, rel=1e-12) for i, s in best)


def test_copies_of_one_vector_are_all_queries_and_few_candidates(spark, vectors, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 100)
    mixed = [vectors[0] if i % 3 == 0 else v for i, v in enumerate(vectors)]
    df = table(spark, mixed).withColumn("asks", F.col("vec_id") % 20 == 0)
    kept = neighbours._least_twins(df.selectExpr("vec_id id", "size(embedding) length", "xxhash64(embedding) twin"), 20)
    assert kept.filter("id % 3 = 0").count() == 21 and kept.count() == 21 + 600
    result = found(table(spark, mixed), confidence=1.0)
    assert sorted(result) == list(range(0, 900, 20))
    for query, best in result.items():
        assert [i for i, _ in best] == [i for i, _ in exact(mixed, query, 20)]


def test_repeated_ids(spark):
    df = table(spark, [[1.0, 2.0], [2.0, 1.0]], start=20).union(
        spark.createDataFrame([(7, [1.0, 1.0], 1, "")] * 30 + [(20, [1.0, 2.0], 1, "")], SCHEMA)
    )
    # Rows with the query's own id are no candidates; others that repeat are one each.
    assert found(df) == {20: [(21, 4.0)] + [(7, 3.0)] * 19}


def test_cells_hold_all_points_and_split_what_they_can():
    rng = np.random.default_rng(3)
    points = rng.standard_normal((1000, 4))
    top = neighbours.Cells(points, 16)
    cell, n = np.unique(top.cell(points), return_counts=True)
    assert len(cell) == 16 and n.max() <= 70
    same = neighbours.Cells(np.ones((50, 4)), 8)
    assert set(same.cell(points).tolist()) == {0}
    two = neighbours.Cells(np.repeat([[0.0, 1.0], [0.0, 2.0]], [99, 1], axis=0), 8)
    assert two.cell(np.array([[5.0, 1.0], [5.0, 2.0], [5.0, 1.5]])).tolist() == [1, 2, 2]


def test_far_cells_are_not_visited(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 50)
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((20, 16)) * 10
    x = (centres[np.arange(1000) % 20] + rng.standard_normal((1000, 16)) * 0.1)
    x /= np.sqrt((x**2).sum(axis=1, keepdims=True))  # inner products rank as distances do
    asked = []
    searched = neighbours._searched
    monkeypatch.setattr(neighbours, "_searched", lambda c, cells, a, *rest: asked.append((a.count(), cells.count())) or searched(c, cells, a, *rest))
    result = found(table(spark, x.tolist()))
    hits = sum(len({i for i, _ in best} & {i for i, _ in exact(x, q, 20)}) for q, best in result.items())
    assert hits >= 0.9 * 20 * len(result)
    (first, cells), (further, _) = asked
    assert first == 50 * neighbours.FIRST_CELLS and cells >= 16 and further <= 50 * cells / 4
