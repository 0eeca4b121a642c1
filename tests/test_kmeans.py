"""K-Means with all starts in one pass against single runs in numpy."""

import numpy as np
import pytest

from ludora.models import kmeans as km


def test_all_starts_equal_single_runs(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(c, 0.6, (40, 3)) for c in rng.normal(0, 4, (4, 3))] + [np.zeros((30, 3))])  # repeated rows too
    features = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "app_id long, v array<double>").repartition(5).cache()
    centres = np.array([km.seeded(x, 4, np.random.default_rng(s)) for s in range(3)])
    sums, counts, cost = km.assigned_sums(features, centres)
    for s in range(3):
        d = ((x[:, None] - centres[s]) ** 2).sum(-1)
        near = d.argmin(1)
        assert cost[s] == pytest.approx(d.min(1).sum())
        assert np.allclose(counts[s], np.bincount(near, minlength=4))
        assert np.allclose(sums[s], [x[near == c].sum(0) for c in range(4)])
    best, least = km.kmeans(features, 4, starts=5, tolerance=0.0, iterations=40)

    def alone(c):
        for _ in range(40):
            near = ((x[:, None] - c) ** 2).sum(-1).argmin(1)
            c = np.array([x[near == j].mean(0) if (near == j).any() else c[j] for j in range(4)])
        return ((x[:, None] - c) ** 2).sum(-1).min(1).sum()

    # the block of starts reaches what the best of the same starts reaches alone
    order = sorted((r.v for r in features.selectExpr("v", "xxhash64(v) as h").orderBy("h", "v").collect()), key=lambda v: 0)
    draw = np.random.default_rng(42)
    assert least == pytest.approx(min(alone(km.seeded(np.array(order), 4, draw)) for _ in range(5)))
    got = {r.app_id: r.cluster for r in km.nearest(features, best).collect()}
    assert all(got[i] == ((best - v) ** 2).sum(1).argmin() for i, v in enumerate(x))
    assert km.kmeans(features.limit(0), 4)[1] == 0.0
