"""Embedding whitening: leading components of a covariance by contour integration (FEAST).

Tasks sum the moments of the distinct vectors; only a matrix as wide as a vector leaves
them. Its largest eigenvalues are bracketed by inertia counts, and each bracket becomes a
contour in the complex plane. A quadrature along the contour, of solves of the shifted
matrix, projects a random block onto the eigenvectors inside; Rayleigh-Ritz extracts them;
the projection is repeated until the residuals are at rounding. The inertia at both ends of
a bracket counts the eigenvalues that must be found, so none is missed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.common import arrow_schema, as_batch, pick, written
from shopgrain.llm.registry import register, table

#: Quadrature points on the upper half of a contour; rounds of projection at most.
POINTS, ROUNDS = 8, 40
#: Entries are counted in this many steps to one.
STEPS = 256
#: Eigenvalues nearer than this part of their size share a contour; below this part of the
#: largest, times the width, they are taken as zero.
SAME, ZERO = 1e-5, 1e-15
#: Vectors that one small step of a Python task holds.
STEP_VECTORS = 4096


class MissedEigenvalue(ArithmeticError):
    """A contour doesn't hold as many eigenvalues as the inertia counts there."""


# -- dense, as wide as a vector -------------------------------------------------------


def eigenvalues_above(a: np.ndarray, shift: float) -> int:
    """How many eigenvalues of symmetric ``a`` are above ``shift``: the positive pivots of
    a symmetric factorisation of ``a - shift`` with pivots of one or two rows (inertia)."""
    m = a - shift * np.eye(len(a))
    positive, start, n = 0, 0, len(m)
    share = (1 + np.sqrt(17)) / 8
    while start < n:
        s = m[start:, start:]
        own = np.abs(np.diag(s))
        size = 1
        off = np.abs(s) - np.diag(own)
        far = int(np.argmax(off)) if len(s) > 1 else 0
        i, j = divmod(far, len(s))
        best = int(np.argmax(own))
        if len(s) == 1 or own[best] >= share * off[i, j]:
            order = [best, *[k for k in range(len(s)) if k != best]]
        else:
            size = 2
            order = [i, j, *[k for k in range(len(s)) if k not in (i, j)]]
        s = s[np.ix_(order, order)]
        if size == 1:
            pivot = s[0, 0]
            if pivot == 0:  # all that is left is zero: no eigenvalue above the shift
                return positive
            positive += pivot > 0
            s[1:, 1:] -= np.outer(s[1:, 0], s[0, 1:] / pivot)
        else:  # such a block has a positive and a negative eigenvalue
            positive += 1
            s[2:, 2:] -= s[2:, :2] @ np.linalg.solve(s[:2, :2], s[:2, 2:])
        m[start + size :, start + size :] = s[size:, size:]
        start += size
    return int(positive)


def bracket(a: np.ndarray, place: int, low: float, high: float, width: float) -> tuple[float, float]:
    """An interval of at most ``width`` that holds the eigenvalue at ``place`` from the top
    (from 1), given one that does, by halving and inertia counts."""
    while high - low > width:
        middle = (low + high) / 2
        if middle in (low, high):
            break
        if eigenvalues_above(a, middle) >= place:
            low = middle
        else:
            high = middle
    return low, high


def feast(a: np.ndarray, low: float, high: float, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` eigenvalues of symmetric ``a`` in (low, high), falling, and their unit vectors."""
    size = len(a)
    block = min(size, 2 * wanted + 2)
    nodes, weights = np.polynomial.legendre.leggauss(POINTS)
    angles = np.pi / 2 * (nodes + 1)  # the lower half of the contour is the conjugate of this one
    centre, radius = (low + high) / 2, (high - low) / 2
    steps = radius * np.exp(1j * angles)
    # Residuals are judged against what rounding leaves of a product with the matrix.
    good = 16 * np.finfo(float).eps * size * max(np.abs(a).sum(axis=1).max(), np.finfo(float).tiny)
    y = np.random.default_rng(size).standard_normal((size, block))
    best = None
    for _ in range(ROUNDS):
        projected = np.zeros((size, block))
        for weight, step in zip(weights, steps):
            solved = np.linalg.solve((centre + step) * np.eye(size) - a, y.astype(complex))
            projected += weight / 2 * (step * solved).real
        basis = np.linalg.qr(projected)[0]
        values, turns = np.linalg.eigh(basis.T @ a @ basis)
        y = basis @ turns
        # Directions that the contour has emptied leave noise, which may fall inside with a large residual.
        inside = np.flatnonzero((values > low) & (values < high))
        residuals = np.abs(a @ y[:, inside] - y[:, inside] * values[inside]).max(axis=0)
        chosen = inside[np.sort(np.argsort(residuals, kind="stable")[:wanted])][::-1]
        if len(chosen) < wanted:
            continue
        left = np.sort(residuals)[wanted - 1]
        if best is not None and left >= best[2] / 2 and best[2] <= good:
            if (residuals <= good).sum() != wanted:
                break
            return best[0], best[1]
        if best is None or left < best[2]:
            best = (values[chosen], y[:, chosen], left)
    raise MissedEigenvalue(f"{wanted} eigenvalues are in ({low}, {high}); the contour did not settle on as many")


def leading_components(a: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``most`` largest positive eigenvalues of a covariance, falling, and unit vectors.

    Eigenvalues that rounding can't tell from zero are left out. Vectors of equal eigenvalues
    are any orthogonal ones of their space."""
    size = len(a)
    scale = float(np.abs(a).sum(axis=1).max()) if size else 0.0  # no eigenvalue is larger
    if scale == 0:
        return np.zeros(0), np.zeros((size, 0))
    a = a / scale
    count = min(most, eigenvalues_above(a, size * ZERO))

    def apart(upper: tuple[float, float], lower: tuple[float, float]) -> bool:
        return upper[0] - lower[1] > SAME * upper[1]

    # From the top down to the first one that is apart from the last wanted one.
    ends: list[tuple[float, float]] = []
    while len(ends) < size and (len(ends) <= count or not apart(ends[-2], ends[-1])):
        found = (-size * ZERO, ends[-1][1] if ends else 1.0 + size * ZERO)
        for _ in range(3):  # a small eigenvalue is known as finely as a large one
            found = bracket(a, len(ends) + 1, *found, max(size * ZERO / 100, SAME / 100 * found[1]))
        ends.append(found)
    starts = [0, *[i for i in range(1, len(ends)) if apart(ends[i - 1], ends[i])], len(ends)]
    values, vectors = [], []
    for first, after in zip(starts, starts[1:]):
        if len(values) >= count:
            break
        top, bottom = ends[first][1], ends[after - 1][0]
        room = [top]
        if first:
            room.append(ends[first - 1][0] - top)
        if after < len(ends):
            room.append(bottom - ends[after][1])
        low, high = bottom - min(room) / 3, top + min(room) / 3
        inside = eigenvalues_above(a, low) - eigenvalues_above(a, high)
        if inside != after - first:
            raise MissedEigenvalue(f"{after - first} eigenvalues are bracketed in ({low}, {high}), inertia counts {inside}")
        own, turned = feast(a, low, high, inside)
        values.extend(own.tolist())
        vectors.append(turned)
    if not values:
        return np.zeros(0), np.zeros((size, 0))
    # Contours are solved apart; what rounding left of larger components is taken out of smaller ones.
    chosen, turn = np.linalg.qr(np.column_stack(vectors)[:, :count])
    return np.array(values[:count]) * scale, chosen * np.sign(np.diag(turn))


# -- over all rows ----------------------------------------------------------------------


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id and x, the entries in whole steps, of every row that takes part.

    A null vector, and one with a null or non-finite entry, is dropped, as is an empty one. A
    null id stays null, repeated rows stay. Steps beyond a long are its ends."""
    plain = pick(embeddings, "vec_id", "embedding").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    infinite = F.lit(float("inf"))
    useless = F.exists("embedding", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == infinite))
    rows = plain.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0)).where(~useless)
    return rows.select("vec_id", F.transform("embedding", lambda c: F.floor(c * STEPS)).alias("x"))


def common_width(vectors: DataFrame) -> int:
    """The length of most vectors, the longer one of equally frequent; 0 without rows."""
    by_width = vectors.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width"))
    found = by_width.first()
    return found["width"] if found else 0


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x minus the mean, in double: first by the whole part of the mean, which is exact."""
    whole = [s // n for s in sums]
    rest = np.array([float(Fraction(s, n) - w) for s, w in zip(sums, whole)])
    if np.abs(x).max(initial=0) < 1 << 61:
        return (x - np.array(whole, dtype=np.int64)).astype(np.float64) - rest
    return x.astype(np.float64) - np.array([float(w) for w in whole]) - rest


def _matrices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Small slices of the batches, each with its vectors as the rows of a matrix."""
    for batch in batches:
        for start in range(0, batch.num_rows, STEP_VECTORS):
            step = batch.slice(start, STEP_VECTORS)
            yield step, step.column("x").flatten().to_numpy(zero_copy_only=False).reshape(step.num_rows, width)


def _sum_over(vectors: DataFrame, width: int, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of ``part`` (an upper triangle, flattened) over all steps. A task sends one sum;
    these are added by place."""
    schema = "place int, value double"
    arrow = arrow_schema(vectors.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in _matrices(batches, width):
            found = part(x)
            total = found if total is None else total + found
        if total is not None:
            yield as_batch({"place": np.arange(len(total), dtype=np.int32), "value": total}, arrow)

    rows = vectors.mapInArrow(run, schema).groupBy("place").agg(F.sum("value").alias("value")).orderBy("place")
    return np.array([row["value"] for row in rows.collect()])  # as many rows as the matrix has entries


def _symmetric(values: np.ndarray, width: int) -> np.ndarray:
    found = np.zeros((width, width))
    found[np.triu_indices(width)] = values
    return np.triu(found, 1).T + found


def whiten(embeddings: DataFrame, components: int = 4) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error and eigenvalue.

    One row for each vector that takes part and each component, from 1, the largest
    eigenvalue first. ``n`` distinct vectors are fitted, each once, however often it is
    repeated. ``deviation`` is a decimal of no places, exact. Fewer components come out where
    the covariance has a lower rank; without any variance, or without rows, no rows. Vectors
    of another length than most take no part. Other columns are not read."""
    spark = embeddings.sparkSession
    names = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double"
    schema = f"{names}, identity_error double, eigenvalue double"
    vectors = written(whole_vectors(embeddings), "whole-vectors")
    width = common_width(vectors)
    vectors = vectors.where(F.size("x") == width)
    distinct = written(vectors.select("x").distinct(), "distinct-vectors")
    sums = distinct.select(F.posexplode("x").alias("place", "c")).groupBy("place")
    moments = sums.agg(F.sum(F.col("c").cast("decimal(38,0)")).alias("s"), F.count("*").alias("n")).orderBy("place").collect()
    if not moments:
        return spark.createDataFrame([], schema)
    n, totals = moments[0]["n"], [int(row["s"]) for row in moments]
    upper = np.triu_indices(width)

    def products(x: np.ndarray) -> np.ndarray:
        c = _centred(x, n, totals)
        return (c.T @ c)[upper]

    covariance = _symmetric(_sum_over(distinct, width, products) / n, width)
    values, turned = leading_components(covariance, components)
    found = len(values)
    if not found:
        return spark.createDataFrame([], schema)
    onto = turned / np.sqrt(values)
    few = np.triu_indices(found)

    def whitened_products(x: np.ndarray) -> np.ndarray:
        w = _centred(x, n, totals) @ onto
        return np.concatenate((w.sum(axis=0), (w.T @ w)[few]))

    checked = _sum_over(distinct, width, whitened_products) / n
    mean = checked[:found]
    error = float(np.abs(_symmetric(checked[found:], found) - np.outer(mean, mean) - np.eye(found)).max())
    explained = (values / np.trace(covariance)).tolist()
    arrow = arrow_schema(spark, schema)

    def deviations(x: np.ndarray) -> list[int]:
        most = n * int(max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))) + max(map(abs, totals))
        if width * most * most < 1 << 63:
            d = x * n - np.array(totals, dtype=np.int64)
            return (d * d).sum(axis=1).tolist()
        d = x.astype(object) * n - np.array(totals, dtype=object)
        return (d * d).sum(axis=1).tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from decimal import Decimal

        for step, x in _matrices(batches, width):
            rows = len(x)
            deviation = [Decimal(d) if d < 10**38 else None for d in deviations(x)]
            for place, w in enumerate((_centred(x, n, totals) @ onto).T):
                yield as_batch(
                    {
                        "vec_id": step.column("vec_id"),
                        "component": [place + 1] * rows,
                        "n": [n] * rows,
                        "deviation": deviation,
                        "whitened": w,
                        "explained": [explained[place]] * rows,
                        "identity_error": [error] * rows,
                        "eigenvalue": [float(values[place])] * rows,
                    },
                    arrow,
                )

    return vectors.mapInArrow(run, schema)


@register("op13_embedding_whitening")
def op13_embedding_whitening(spark, folder):
    """``deviation`` is null where it is beyond a long (past some ten million distinct vectors);
    ``deviation_whole`` always holds it."""
    found = whiten(table(spark, folder, "embeddings"))
    return found.select(
        "vec_id", "component", "n", F.expr("try_cast(deviation AS bigint)").alias("deviation"),
        "whitened", "explained", "identity_error", "eigenvalue", F.col("deviation").alias("deviation_whole"),
    )
