from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopgrain.llm import whitening

VECTORS = "vec_id long, embedding array<float>, label int"


def symmetric(values, seed=0):
    turn = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))[0]
    return (turn * np.array(values, dtype=float)) @ turn.T


@pytest.mark.parametrize("width", [1, 2, 3, 9, 64])
def test_inertia_counts_eigenvalues(width):
    rng = np.random.default_rng(width)
    a = symmetric(rng.normal(size=width), width)
    known = np.linalg.eigvalsh(a)
    for shift in rng.normal(size=40):
        assert whitening.eigenvalues_above(a, shift) == (known > shift).sum()
    assert whitening.eigenvalues_above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1
    assert whitening.eigenvalues_above(np.zeros((3, 3)), 0.0) == 0


SPECTRA = {
    "falling": [2.0**-i for i in range(40)],
    "near": [1 + 1e-3 * i for i in range(64)],
    "very near": [5, 3, 1 + 1e-7, 1 + 2e-7, 1, 0.5, 0.1],
    "equal at the cut": [5, 3, 2, 1, 1, 1, 0.5],
    "all equal": [2.0] * 12,
    "low rank": [7, 1e-3, 0, 0, 0, 0],
    "wide": [1e12, 1e6, 10, 1, 0.9, 0.1],
    "one": [3.0],
    "two equal": [3.0, 3.0],
}


@pytest.mark.parametrize("name", SPECTRA)
@pytest.mark.parametrize("scale", [1.0, 1e-9, 1e20])
def test_components_of_known_spectra(name, scale):
    values = np.sort(np.array(SPECTRA[name], dtype=float))[::-1] * scale
    a = symmetric(values, 3)
    a = (a + a.T) / 2
    found, vectors = whitening.leading_components(a, 4)
    count = min(4, int((values > 0).sum()))
    assert len(found) == count and (np.diff(found) <= 0).all()
    assert np.allclose(found, values[:count], rtol=1e-6 if name == "wide" else 1e-9, atol=1e-13 * values[0])
    assert np.abs(vectors.T @ vectors - np.eye(count)).max() < 1e-6
    assert np.abs(a @ vectors - vectors * found).max() < 1e-11 * values[0]


def test_missing_eigenvalues_are_noticed():
    with pytest.raises(whitening.MissedEigenvalue):
        whitening.feast(symmetric([3, 2, 1]), 1.5, 3.5, 1)


def brute(rows, components=4):
    kept = [(i, v) for i, v in rows if v is not None and None not in v and np.isfinite(v).all()]
    x = [[int(np.floor(256 * float(np.float32(c)))) for c in v] for _, v in kept]
    once = sorted(set(map(tuple, x)))
    n, sums = len(once), [sum(c) for c in zip(*once)]
    centred = np.array([[float(Fraction(c) - Fraction(s, n)) for c, s in zip(v, sums)] for v in once])
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    out = {}
    for (i, _), v in zip(kept, x):
        deviation = sum((n * c - s) ** 2 for c, s in zip(v, sums))
        own = np.array([float(Fraction(c) - Fraction(s, n)) for c, s in zip(v, sums)])
        out[i] = (n, deviation, own @ vectors / np.sqrt(values), values / np.trace(cov))
    return out


def compare(spark, rows, found):
    expected = brute(rows)
    held = {}
    for r in found:
        held.setdefault(r["vec_id"], {})[r["component"]] = r
    assert held.keys() == expected.keys()
    signs = None
    for i, (n, deviation, whitened, explained) in expected.items():
        own = [held[i][c] for c in sorted(held[i])]
        assert {r["n"] for r in own} == {n} and {r["deviation"] for r in own} == {deviation}
        mine = np.array([r["whitened"] for r in own])
        if signs is None:
            signs = np.sign(mine * whitened)
        assert np.allclose(mine * signs, whitened, atol=1e-8)
        assert np.allclose([r["explained"] for r in own], explained, rtol=1e-9)
        assert all(r["identity_error"] < 1e-9 for r in own)


@pytest.mark.parametrize("offset", [0.0, 1000.0])
def test_query_columns_equal_brute_force(spark, tmp_path, offset):
    rng = np.random.default_rng(5)
    scale = np.linspace(3, 0.2, 12)
    rows = [(i, [float(np.float32(c)) for c in rng.normal(size=12) * scale + offset]) for i in range(500)]
    rows += [(1000 + i, rows[0][1]) for i in range(300)]  # one vector in more than a third of the rows
    rows += [(2000, None), (2001, [1.0] * 11 + [None]), (2002, [float("nan")] * 12), (2003, [float("inf")] + [0.0] * 11)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS).repartition(7)
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    compare(spark, rows, whitening.op13_embedding_whitening(spark, str(tmp_path)).collect())


def test_awkward_tables(spark):
    def run(*rows):
        df = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)
        return whitening.whiten(df.withColumn("VEC_ID_", F.lit("x")).withColumn("component", F.lit("x"))).collect()

    assert run() == [] and run((1, None)) == [] and run((1, [])) == []
    assert run((1, [1.0, 2.0]), (2, [1.0, 2.0])) == []  # one distinct vector, no variance
    line = run((1, [1.0, 2.0]), (None, [2.0, 4.0]), (1, [1.0, 2.0]), (9, [5.0]))
    assert sorted((r["vec_id"] or 0, r["component"], round(abs(r["whitened"]), 9)) for r in line) == [(0, 1, 1.0), (1, 1, 1.0), (1, 1, 1.0)]
    assert {round(r["explained"], 12) for r in line} == {1.0}


def test_deviation_beyond_a_long_is_kept_as_decimal(spark):
    df = spark.createDataFrame([(1, [1e12, 0.0], 0), (2, [-1e12, 1.0], 0)], "vec_id long, embedding array<double>, label int")
    found = whitening.whiten(df).where("component = 1").collect()
    wide = 2 * 256 * 10**12
    assert {int(r["deviation"]) for r in found} == {wide**2 + 256**2}


def test_the_sample_tables(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    compare(spark, rows, whitening.op13_embedding_whitening(spark, folder).collect())
