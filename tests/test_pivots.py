"""Nearest vectors by pivots, against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from offerloom.operators import candidates, pivots

SCHEMA = "vector_id long, embedding array<double>"


def vectors(spark, x):
    return spark.createDataFrame([(k, list(map(float, row))) for k, row in enumerate(x)], SCHEMA)


def rows(df):
    return sorted((r.query_id, r.vector_id, round(r.distance, 9), r.place) for r in df.collect())


def clustered(n, seed=1):
    rng = np.random.default_rng(seed)
    middles = rng.normal(0, 5, (30, 16))
    return middles[rng.integers(0, 30, n)] + rng.normal(0, 1, (n, 16))


@pytest.mark.parametrize("sizes", [(4096, 512, 256, 256), (64, 3, 20, 4)])
def test_less_than_a_quarter_of_the_pairs(spark, monkeypatch, sizes):
    for name, value in zip(("VECTOR_ROWS", "QUERY_ROWS", "FIRST", "RING_ROWS"), sizes):
        monkeypatch.setattr(pivots, name, value)
    x = clustered(3000)
    x[7::50] = np.round(x[7::50])
    x[100:120] = x[100]  # ties
    v = vectors(spark, x)
    q = v.filter("vector_id % 37 = 0 or vector_id = 105").withColumnRenamed("vector_id", "query_id")
    out = pivots.explained(q, v, 10)
    assert rows(out["result"]) == rows(candidates.nearest(q, v, 10))
    assert 0 < out["n_pairs"] < q.count() * len(x) / 4
    cut = pivots.nearest(q, v, 10, max_distance=9.0)
    assert rows(cut) == rows(candidates.nearest(q, v, 10, max_distance=9.0)) and 0 < cut.count() < 10 * q.count()


def test_vectors_that_cannot_be_told_apart(spark, monkeypatch):
    """Evenly spread in many dimensions, and all the same: nothing can be left out, and nothing is lost."""
    monkeypatch.setattr(pivots, "FIRST", 50)
    rng = np.random.default_rng(2)
    for x in (rng.normal(0, 1, (400, 32)), np.ones((300, 4))):
        v = vectors(spark, x)
        q = v.filter("vector_id % 40 = 0").withColumnRenamed("vector_id", "query_id")
        assert rows(pivots.nearest(q, v, 7)) == rows(candidates.nearest(q, v, 7))


def test_bounds_hold():
    x, q = clustered(500), clustered(40, 3)
    middle = pivots.find_pivots(x[:100], 20)
    cell = pivots.squared(x, middle).argmin(axis=1)
    far = np.sqrt(pivots.squared(x, middle).min(axis=1))
    kinds = sorted({(c, bool(f > np.median(far[cell == c]))) for c, f in zip(cell, far)})
    number = np.array([kinds.index((c, bool(f > np.median(far[cell == c])))) for c, f in zip(cell, far)])
    blocks = pivots.Blocks(middle, np.array([c for c, _ in kinds]), *(np.array([f(far[number == b]) for b in range(len(kinds))]) for f in (np.min, np.max)), np.bincount(number))
    assert (blocks.bounds(q)[:, number] <= np.sqrt(pivots.squared(q, x))).all()


def test_edges(spark):
    v = spark.createDataFrame([(1, [0.0, 1.0]), (2, None), (3, [float("nan"), 0.0]), (4, [None, 0.0]), (5, [3.0, 1.0])], SCHEMA)
    q = v.withColumnRenamed("vector_id", "query_id")
    assert rows(pivots.nearest(q, v, 5)) == [(1, 1, 0.0, 1), (1, 5, 9.0, 2), (5, 1, 9.0, 2), (5, 5, 0.0, 1)]
    assert pivots.nearest(q.limit(0), v, 5).count() == pivots.nearest(q, v.limit(0), 5).count() == 0
    named = v.withColumn("vector_id", F.concat(F.lit("v"), "vector_id"))
    assert {r.vector_id for r in pivots.nearest(q, named, 5).collect()} == {"v1", "v5"}
