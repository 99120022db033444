"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Components are scaled to whole numbers, x = floor(64 c) + 1000000, and each distinct
vector counts once in the fit: n vectors with sums S. The rows (n x - S) / n, centred
exactly in whole numbers, make a tall matrix X that Spark holds and that is only read in
products. Each step makes one distributed product Xv and, of what that gives row by row,
one product X'u; the step's left vector is not stored, as it is X times a short vector.
Right and left vectors are orthogonalised against all earlier ones, twice. What is left
is a small bidiagonal matrix, whose singular values and vectors give the components and
their deviations.

A step that breaks down goes on with a new direction, so that equal deviations are found
as often as they occur. The steps end before there is one for each dimension only if the
wanted ones have settled and the variance that is not yet in the matrix is less than the
least of them.

Vectors that are null or hold null or non-finite entries take no part, nor do empty ones
and those whose length is not the most frequent (of equally frequent ones the greatest
counts). Components without variance (deviation below ``FLAT`` of the greatest) are left
out, so that a fit of one vector, and an empty table, give no rows. Null and repeated ids
are rows like any others. Other columns are left out. Entries must be below 2**50, and a
deviation that does not fit 64 bits is an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidelake.llm.tables import written

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
FLAT = 1e-9
SETTLED = 1e-13
_SEED = 20_240_229


class Whitening(NamedTuple):
    """A fit: components are the rows of ``directions``, by falling deviation."""

    n: int
    sums: np.ndarray
    directions: np.ndarray
    variances: np.ndarray
    trace: float
    identity_error: float
    steps: int


def scaled(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id and x (whole numbers) of the rows that take part."""
    c = F.col("c")
    rows = df.select(df[key].cast("long").alias("vec_id"), df[vector].cast("array<double>").alias("c"))
    finite = F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    whole = F.transform(c, lambda e: F.floor(e * SCALE) + SHIFT)
    return rows.filter(c.isNotNull() & (F.size(c) > 0) & finite).select("vec_id", whole.alias("x"))


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    """The lists of a column without nulls as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


def _summed(rows: DataFrame, length: int, part: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> np.ndarray:
    """The sum of ``part`` (a flat array) over blocks of rows; each task adds up its own."""
    at = rows.columns.index("x")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                value = part(_matrix(batch.column(at), length))
                total = value if total is None else total + value
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["at", "value"])

    found = rows.mapInArrow(work, f"at long, value {kind}").groupBy("at").agg(F.sum("value").alias("value"))
    # As many rows as the flat array has, however many tasks there were.
    ordered = sorted((row["at"], row["value"]) for row in found.collect())
    return np.array([value for _, value in ordered])


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    return (n * x - sums) / n


def _apart(vector: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    """The vector without its shares in an orthonormal basis; a second pass mends rounding."""
    for _ in range(2 if basis else 0):
        b = np.array(basis)
        vector = vector - b.T @ (b @ vector)
    return vector


class _Steps:
    """The bidiagonalisation: X V = U B, where U = X P is never stored."""

    def __init__(self, product: Callable[[np.ndarray], tuple[float, np.ndarray]], length: int, scale: float):
        self._product, self._length = product, length
        self._tiny = scale * 1e-14  # of the norm of X: below it there is nothing but rounding
        self.v: list[np.ndarray] = []
        self._p: list[np.ndarray] = []
        self._back: list[np.ndarray] = []  # X'u of each left vector
        self.alpha: list[float] = []
        self.beta: list[float] = []
        self._draw = np.random.Generator(np.random.PCG64(_SEED))

    def _fresh(self) -> np.ndarray:
        while True:
            start = _apart(self._draw.standard_normal(self._length), self.v)
            norm = np.linalg.norm(start)
            if norm > 1e-6:
                return start / norm

    def step(self) -> None:
        """One more right vector, with its products Xv and X'u."""
        if not self.v:
            v = self._fresh()
        else:
            rest = _apart(self._back[-1] - self.alpha[-1] * self.v[-1], self.v)
            norm = np.linalg.norm(rest)
            if norm > self._tiny:
                v = rest / norm
                self.beta.append(norm)
            else:
                v = self._fresh()
                self.beta.append(0.0)
        p = v - (self.beta[-1] * self._p[-1] if self.v else 0)
        norm, back = self._product(p)
        for _ in range(2):  # shares in the left vectors, by U'Xp = P'(X'X p)
            shares = np.array([q @ back for q in self._p])
            if not len(shares) or np.abs(shares).max() <= 1e-12 * max(norm, self._tiny):
                break
            p = p - np.array(self._p).T @ shares
            norm, back = self._product(p)
        self.v.append(v)
        if norm > self._tiny:
            self.alpha.append(norm)
            self._p.append(p / norm)
            self._back.append(back / norm)
        else:  # v is in the null space
            self.alpha.append(0.0)
            self._p.append(np.zeros(self._length))
            self._back.append(np.zeros(self._length))

    def solved(self) -> tuple[np.ndarray, np.ndarray, float]:
        """Singular values, right vectors as rows, and how far the next step couples with each."""
        k = len(self.alpha)
        b = np.diag(self.alpha) + np.diag(self.beta[: k - 1], 1)
        left, values, right = np.linalg.svd(b)
        rest = _apart(self._back[-1] - self.alpha[-1] * self.v[-1], self.v)
        return values, right @ np.array(self.v), float(np.linalg.norm(rest)) * np.abs(left[-1])


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the distinct x of ``rows``; None if there is no row or no variance."""
    lengths = rows.groupBy(F.size("x").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).head(1)
    if not lengths:
        return None
    length = lengths[0]["length"]
    distinct = written(rows.filter(F.size("x") == length).select("x").distinct(), "whitening-fit")
    n = distinct.count()
    sums = _summed(distinct, length, lambda x: x.sum(axis=0), "long").astype(np.int64)
    squares = _summed(distinct, length, lambda x: (_centred(x, n, sums) ** 2).sum(axis=0))
    total = float(squares.sum())
    if total <= 0:
        return None

    def product(p: np.ndarray) -> tuple[float, np.ndarray]:
        def part(x: np.ndarray) -> np.ndarray:
            centred = _centred(x, n, sums)
            u = centred @ p
            return np.append(u @ centred, u @ u)

        found = _summed(distinct, length, part)
        return float(np.sqrt(found[-1])), found[:-1]

    steps = _Steps(product, length, np.sqrt(total))
    while len(steps.v) < length:
        steps.step()
        if len(steps.v) < length and len(steps.v) > components:
            values, _, coupling = steps.solved()
            left = total - float((values**2).sum())
            if max(coupling[:components]) <= SETTLED * values[0] and left < values[components - 1] ** 2:
                break
    values, right, _ = steps.solved()
    kept = min(components, int((values > FLAT * values[0]).sum()))
    directions, variances = right[:kept], values[:kept] ** 2 / n

    def covariance(x: np.ndarray) -> np.ndarray:
        w = _centred(x, n, sums) @ directions.T / np.sqrt(variances)
        return (w.T @ w).ravel()

    whitened = _summed(distinct, length, covariance).reshape(kept, kept) / n
    error = float(np.abs(whitened - np.eye(kept)).max())
    return Whitening(n, sums, directions, variances, total / n, error, len(steps.v))


_OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def transform(rows: DataFrame, model: Whitening) -> DataFrame:
    """A row for each vector and component."""
    length, k = len(model.sums), len(model.variances)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                apart = model.n * _matrix(part.column(1), length) - model.sums
                if float(np.abs(apart).max()) ** 2 * length < 2.0**62:
                    deviation = (apart * apart).sum(axis=1)
                else:  # an error where it does not fit
                    deviation = np.array([sum(d * d for d in row) for row in apart.tolist()], np.int64)
                white = apart / model.n @ model.directions.T / np.sqrt(model.variances)
                count = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(np.repeat(np.arange(count), k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), count)),
                        pa.array(np.full(count * k, model.n, np.int64)),
                        pa.array(np.repeat(deviation, k)),
                        pa.array(white.ravel()),
                        pa.array(np.tile(model.variances / model.trace, count)),
                        pa.array(np.full(count * k, model.identity_error)),
                    ],
                    [name.split()[0] for name in _OUT.split(", ")],
                )

    return rows.filter(F.size("x") == length).select("vec_id", "x").mapInArrow(work, _OUT)


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    rows = scaled(df, key, vector)
    model = fit(rows, components)
    if model is None:
        return df.sparkSession.createDataFrame([], _OUT)
    return transform(rows, model)
