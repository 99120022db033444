from __future__ import annotations

import math

import numpy as np
import pytest

from tidelake.llm import whitening
from tidelake.llm.queries import op12_whitening

SCHEMA = "vec_id long, embedding array<float>, label int, component int, whitened string"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 1, 2, "x") for i, v in vectors], SCHEMA)


def check(df, vectors, components=16):
    """Against the definition, by an ordinary eigensolver."""
    found = {}
    for r in whitening.whiten(df, components=components).collect():
        found.setdefault(r["vec_id"], {})[r["component"]] = r
    kept = {i: [math.floor(64 * float(np.float32(e))) + 1_000_000 for e in v] for i, v in vectors}
    x = np.array(sorted(set(map(tuple, kept.values()))), dtype=np.int64)
    n, sums = len(x), x.sum(axis=0)
    centred = (n * x - sums) / n
    covariance = centred.T @ centred / n
    e, vec = np.linalg.eigh(covariance)
    e, vec = e[::-1], vec[:, ::-1]
    most = min(components, int((e > 1e-12 * e[0]).sum()))
    assert set(found) == set(kept)
    for i, row in kept.items():
        assert sorted(found[i]) == list(range(1, most + 1))
        deviation = sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums))
        for j, r in found[i].items():
            assert r["n"] == n and r["deviation"] == deviation and r["identity_error"] < 1e-8
            assert r["explained"] == pytest.approx(e[j - 1] / e.sum(), rel=1e-9)
    values = np.array([[found[i][j]["whitened"] for j in range(1, most + 1)] for i in sorted(kept)])
    wanted = np.array([(n * np.array(kept[i]) - sums) / n @ vec[:, :most] / np.sqrt(e[:most]) for i in sorted(kept)])
    for j in range(most):
        alone = all(abs(e[j] - e[k]) > 1e-6 * e[0] for k in range(len(e)) if k != j)
        if alone:
            sign = np.sign(values[:, j] @ wanted[:, j])
            assert np.allclose(values[:, j], sign * wanted[:, j], atol=1e-7)


def test_as_an_eigensolver_has_it(spark):
    draw = np.random.default_rng(3)
    vectors = [(i, (draw.standard_normal(24) * np.linspace(5, 0.5, 24)).tolist()) for i in range(300)]
    check(frame(spark, vectors), vectors)


def test_steep_spectrum_stops_early(spark):
    draw = np.random.default_rng(4)
    vectors = [(i, (draw.standard_normal(60) * 4000.0 * 0.5 ** np.arange(60)).tolist()) for i in range(200)]
    check(frame(spark, vectors), vectors, components=3)
    model = whitening.fit(whitening.scaled(frame(spark, vectors)), 3)
    assert model.steps < 60


def test_equal_deviations_are_found_as_often_as_they_occur(spark):
    vectors = [(2 * k + s, [(1 - 2 * s) * 3.0 if j == k else 0.0 for j in range(20)]) for k in range(20) for s in (0, 1)]
    check(frame(spark, vectors), vectors)


def test_copies_count_once_and_flat_components_go(spark):
    draw = np.random.default_rng(5)
    few = [[*draw.standard_normal(4).tolist(), 1.5, 0.0] for _ in range(12)]
    vectors = [(i, few[i % 12]) for i in range(400)]
    check(frame(spark, vectors), vectors)


def test_odd_vectors_take_no_part(spark):
    draw = np.random.default_rng(6)
    good = [(i, draw.standard_normal(5).tolist()) for i in range(40)] + [(99, [0.0] * 5)]
    odd = [(100, None), (101, []), (102, [1.0, None, 2.0, 3.0, 4.0]), (103, [float("nan")] * 5), (104, [float("inf")] * 5), (105, [1.0])]
    check(frame(spark, good + odd), good)


@pytest.mark.parametrize("vectors", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_nothing_to_whiten(spark, vectors):
    assert whitening.whiten(frame(spark, vectors)).collect() == []


def test_null_and_repeated_ids(spark):
    vectors = [(None, [1.0, 2.0]), (None, [2.0, 1.0]), (5, [3.0, 3.0]), (5, [0.0, 3.0])]
    rows = whitening.whiten(frame(spark, vectors)).collect()
    assert sorted((r["vec_id"] or 0, r["component"]) for r in rows) == [(0, 1)] * 2 + [(0, 2)] * 2 + [(5, 1)] * 2 + [(5, 2)] * 2


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    vectors = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert op12_whitening(spark, sf).count() == 16 * len(vectors)
    check(spark.read.parquet(f"{sf}/embeddings.parquet"), vectors)
