"""SK-2 (bucketed split) and RC-2 (joint solves of biases and factors)."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from ludora.models.mf import fit_biased_mf
from ludora.plans.catalog_forms import held_out_with_history
from ludora.sources.sinks import read_split, write_split


def _rows(users=40, items=15):
    rng = random.Random(5)
    # one user and one item hold a third of all rows each
    rows = [("u0", i % items, k) for k, i in enumerate(range(200))] + [(f"u{rng.randrange(users)}", 3, 200 + k) for k in range(200)]
    rows += [(f"u{rng.randrange(users)}", rng.randrange(items), 400 + k) for k in range(200)]
    return [(u, i, k, rng.choice([1, 1, 0, None])) for u, i, k in rows]


def _table(spark, rows):
    return spark.createDataFrame(rows, "author_id string, app_id long, id long, is_positive_encoded int")


def test_split_is_bucketed(spark, tmp_path):
    rows = _rows()
    held = list({r[0]: r for r in rows[500:]}.values())
    train, test = _table(spark, rows[:500]), _table(spark, held)
    root = f"{tmp_path}/split"
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for tables in (write_split(train, test, root, 4), read_split(spark, root, 4)):
            joined = held_out_with_history(**tables)
            assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
            got = sorted(tuple(r) for r in joined.collect())
            assert sorted(map(tuple, tables["train_split"].collect()), key=repr) == sorted(rows[:500], key=repr)
        # a later session knows only the files
        for name in tables:
            spark.sql(f"DROP TABLE {[t.name for t in spark.catalog.listTables() if name in t.name][0]}")
        again = held_out_with_history(**read_split(spark, root, 4))
        assert "Exchange" not in again._jdf.queryExecution().executedPlan().toString()
        assert sorted(tuple(r) for r in again.collect()) == got
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    want = [(u, i, sum(r[0] == u for r in rows[:500]), sum(r[0] == u and r[3] == 1 for r in rows[:500]), p == 1) for u, i, _, p in held]
    assert got == sorted(want) and {r[4] for r in got} == {True, False}


def test_biased_mf_solves_and_falls(spark):
    rows, rank, reg = _rows(), 3, 0.2
    history: list = []
    model = fit_biased_mf(_table(spark, rows), rank, reg, iters=6, tolerance=0.0, history=history)
    assert len(history) >= 4 and all(b <= a + 1e-9 for a, b in zip(history, history[1:], strict=False))
    first: dict = {}
    for u, i, k, p in sorted(rows, key=lambda r: r[2]):
        first.setdefault((u, i), p or 0)
    assert abs(model.mu - np.mean(list(first.values()))) < 1e-12
    p = {r.id: np.array(r.features) for r in model.user_factors.collect()}
    q = {r.id: np.array(r.features) for r in model.item_factors.collect()}
    bu, bi = ({r[0]: r[1] for r in t.collect()} for t in (model.user_bias, model.item_bias))
    assert p.keys() == bu.keys() == {u for u, _ in first} and q.keys() == bi.keys() == {i for _, i in first}
    loss = sum((y - model.mu - bu[u] - bi[i] - p[u] @ q[i]) ** 2 for (u, i), y in first.items())
    loss += reg * sum(float(v @ v) for v in [*p.values(), *q.values()]) + reg * sum(b * b for b in [*bu.values(), *bi.values()])
    assert abs(loss - history[-1]) < 1e-8 * max(1, loss)
    # items were solved last: their equations hold
    for i in q:
        x = np.array([[*p[u], 1.0] for u, j in first if j == i])
        y = np.array([r - model.mu - bu[u] for (u, j), r in first.items() if j == i])
        want = np.linalg.solve(x.T @ x + reg * np.eye(rank + 1), x.T @ y)
        assert np.allclose([*q[i], bi[i]], want, atol=1e-8)
    pairs = spark.createDataFrame([("u0", 3), ("u0", -1), (None, 3)], "author_id string, app_id long")
    scores = {(r.author_id, r.app_id): r.cf_raw for r in model.score_pairs(pairs).collect()}
    assert abs(scores["u0", 3] - (model.mu + bu["u0"] + bi[3] + p["u0"] @ q[3])) < 1e-9 and scores["u0", -1] == scores[None, 3] == 0


def test_biased_mf_of_nothing(spark):
    model = fit_biased_mf(_table(spark, []).where(F.lit(False)), 2)
    assert model.mu == 0 and model.user_factors.count() == model.item_bias.count() == 0
