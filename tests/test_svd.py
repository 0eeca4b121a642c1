"""The truncated SVD against numpy."""

import numpy as np
import pytest

from ludora.models.svd import triangle, truncated_svd


def _entries(spark, x):
    rows = [(int(a), int(b), float(x[a, b])) for a, b in zip(*np.nonzero(x))]
    return spark.createDataFrame(rows, "row long, t long, weight double").repartition(5)


@pytest.mark.parametrize("shape", [(90, 70), (30, 200), (200, 6)])
def test_singular_values_and_embedding(spark, shape):
    """Sparse, with a hot column; more rows, more columns, and a rank below the number of directions."""
    rng = np.random.default_rng(1)
    x = rng.random(shape) * (rng.random(shape) < 0.15)
    x /= 1 + np.arange(shape[1]) / 4   # title words are that uneven, and more
    x[:, 0] = rng.random(shape[0]) + 1
    rows, s = truncated_svd(_entries(spark, x), 5)
    want = np.linalg.svd(x, compute_uv=False)[:5]
    assert np.abs(s - want).max() < 1e-6
    got = {r.row: r.m for r in rows.collect()}
    emb = np.array([got[k] for k in range(shape[0])])
    u, sv, vt = np.linalg.svd(x, full_matrices=False)
    best = (u[:, :5] * sv[:5]) @ vt[:5]
    # the embedding's Gram matrix is that of the best approximation of rank 5
    assert np.allclose(emb @ emb.T, best @ best.T, atol=1e-4)


def test_rank_one_and_empty(spark):
    x = np.outer(np.arange(1, 8.0), [1.0, 0, 2, 3])
    rows, s = truncated_svd(_entries(spark, x), 3)
    assert s[0] == pytest.approx(np.linalg.norm(x)) and (len(s) == 1 or s[1] < 1e-9)
    assert rows.count() == 7
    none = spark.createDataFrame([], "row long, t long, weight double")
    rows, s = truncated_svd(none, 3)
    assert rows.count() == 0 and len(s) == 0
    assert triangle(spark.createDataFrame([], "m array<double>"), 4).shape == (0, 4)
