import numpy as np
import pytest
from pyspark.sql import functions as F

from shopgrain.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, label int, score double, near string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, 0.0, "x") for i, v in rows], SCHEMA)


def brute(vectors, query, k):
    q = np.array(vectors[query])
    scored = sorted((-float((np.array(v) * q).sum()), i) for i, v in vectors.items() if i != query)
    return [(i, -s) for s, i in scored[:k]]


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


@pytest.mark.parametrize("norms", [False, True])
def test_recall_against_brute_force(spark, norms, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 100)  # several blocks of rows and queries
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 8)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 16)).astype(np.float32)
    x = x * rng.uniform(0.5, 2, size=(1500, 1)).astype(np.float32) if norms else x / np.linalg.norm(x, axis=1, keepdims=True)
    vectors = {i: [float(c) for c in v] for i, v in enumerate(x)}
    got = found(neighbours.nearest(table(spark, vectors.items()), F.col("vec_id") % 20 == 0))
    assert set(got) == set(range(0, 1500, 20))
    hits = 0
    for query, rows in got.items():
        want = brute(vectors, query, 20)
        hits += len({i for i, _ in want} & {i for i, _ in rows})
        assert len(rows) == 20 and all(np.isclose(s, np.dot(np.float64(vectors[i]), vectors[query])) for i, s in rows)
    assert hits / (20 * len(got)) >= 0.9


def test_copies_ties_and_small_tables_are_exact(spark):
    vectors = {i: [1.0, 0.0] for i in range(60)} | {100 + i: [float(i % 3), 1.0] for i in range(9)}
    got = found(neighbours.nearest(table(spark, vectors.items()), F.col("vec_id") % 20 == 0))
    assert got == {q: brute(vectors, q, 20) for q in (0, 20, 40, 100)}
    few = {i: [float(i), 1.0] for i in range(1, 25, 4)} | {40: [1.0, 1.0]}
    assert found(neighbours.nearest(table(spark, few.items()), F.col("vec_id") == 40)) == {40: brute(few, 40, 20)}


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, [1.0]), (None, [1.0, 1.0]), (20, [1.0, 1.0]), (40, [0.0, 0.0])]
    df = table(spark, rows)
    assert found(neighbours.nearest(df, F.col("vec_id") % 20 == 0)) == {20: [(1, 1.0)]}
    assert neighbours.nearest(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []
    assert neighbours.nearest(df.where("vec_id = 1"), F.col("vec_id") % 20 == 0).collect() == []
