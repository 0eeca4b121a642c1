"""The factorisation machine against plain numpy."""

import itertools
import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from ludora.models import fm
from ludora.operators.candidates import rank_items
from ludora.session import checkpoint_dir

RANK = 3


@pytest.fixture(scope="module")
def data(spark):
    """A user and an item with a third of all rows each, repeated pairs, items without a title token, an item without reviews."""
    rng = random.Random(6)
    rows = []
    for k in range(240):
        u, a = (0 if k % 3 == 0 else rng.randrange(12)), (1 if k % 3 == 1 else rng.randrange(9))
        rows.append((k, u, a, int((u + a) % 3 > 0) if rng.random() < 0.9 else None))
    train = spark.createDataFrame(rows, "id long, author_id long, app_id long, is_positive_encoded int").repartition(4)
    titles = [(a, t) for a, t in enumerate(["Red Sea", "red sea", "Blue", None, "", "x", "Old Town", "!", "Blue", "Never seen"])]
    return rows, train, titles, spark.createDataFrame(titles, "app_id long, title string")


def pairwise(feats, w0, w, v):
    """The machine's defining formula: weights and the products of all pairs of features."""
    return w0 + sum(w[f] for f in feats) + sum(float(np.dot(v[a], v[b])) for a, b in itertools.combinations(feats, 2))


def table(params):
    rows = params.collect()
    return {r.f: r.w for r in rows}, {r.f: np.array([r[c] for c in fm._factors(RANK)]) for r in rows}, {r.feature: r.f for r in rows}


@pytest.mark.parametrize("with_titles", [False, True])
def test_scores_and_step(spark, data, with_titles):
    """Scores equal the pairwise formula; a step's gradients equal sums over rows and central differences of the loss."""
    _, train, _, items = data
    named = fm.training_rows(train, items if with_titles else None)
    params = fm.initial_params(named, RANK).cache()
    w, v, numbers = table(params)
    rows = {r.row: ([numbers[x] for x in r.features], r.y) for r in named.collect()}
    assert len(rows) == len({(r.author_id, r.app_id) for r in train.collect()})
    assert max(len(f) for f, _ in rows.values()) == (3 if with_titles else 2)
    frame = spark.createDataFrame([(r, y, f) for r, (f, y) in rows.items()], "row long, y double, fs array<long>")
    w0, rate, reg = 0.2, 0.1, 1e-4
    got = {r.row: r.score for r in fm.predicted(frame, params, w0, RANK).collect()}
    assert all(got[r] == pytest.approx(pairwise(f, w0, w, v), abs=1e-12) for r, (f, _) in rows.items())

    def loss(w0, w, v):
        fit = sum((pairwise(f, w0, w, v) - y) ** 2 for f, y in rows.values())
        return 0.5 * (fit + reg * sum(w[x] ** 2 + v[x] @ v[x] for f, _ in rows.values() for x in f))

    new_w, new_v, _ = table(fm.step(frame, params, w0, RANK, rate, reg))
    h = 1e-5
    for f in list(numbers.values())[:12]:
        if f == fm.BIAS:
            g = (loss(w0 + h, w, v) - loss(w0 - h, w, v)) / (2 * h)
        else:
            g = (loss(w0, w | {f: w[f] + h}, v) - loss(w0, w | {f: w[f] - h}, v)) / (2 * h)
        # the first AdaGrad step is the rate in the gradient's direction
        assert new_w[f] - w[f] == pytest.approx(-rate * g / (abs(g) + 1e-8), abs=1e-5)
        for k in range(RANK if f != fm.BIAS else 0):
            d = np.eye(RANK)[k] * h
            g = (loss(w0, w, v | {f: v[f] + d}) - loss(w0, w, v | {f: v[f] - d})) / (2 * h)
            assert new_v[f][k] - v[f][k] == pytest.approx(-rate * g / (abs(g) + 1e-8), abs=1e-4)


def test_fit_falls_and_recommends(spark, data):
    rows, train, titles, items = data
    model = fm.fit_machine(train, items, rank=RANK, epochs=4, batches=2)
    assert len(model.losses) == 4 and all(b < a for a, b in itertools.pairwise(model.losses))
    w, v, numbers = table(model.params)
    token = dict((a, "".join(c for c in (t or "").lower() if c.isalnum())) for a, t in titles)

    def brute(u, a):
        if f"user:{u}" not in numbers or f"item:{a}" not in numbers:
            return 0.0
        feats = [f"user:{u}", f"item:{a}"] + ([f"title:{token[a]}"] if len(token[a]) >= 2 else [])
        return pairwise([numbers[x] for x in feats], w[fm.BIAS], w, v)

    pairs = spark.createDataFrame([(u, a) for u in (0, 3, 99) for a in range(10)], "author_id long, app_id long")
    for r in model.score_pairs(pairs).collect():
        assert r.fm_raw == pytest.approx(brute(r.author_id, r.app_id), abs=1e-9)
    seen = {(u, a) for _, u, a, _ in rows}
    got = fm.fm_recommendations(model, train.select("author_id"), rank_items(items), train, 3).collect()
    for u in range(12):
        want = sorted((a for a in range(10) if (u, a) not in seen), key=lambda a: (-round(brute(u, a), 9), str(a)))[:3]
        assert [r.app_id for r in sorted(got, key=lambda r: r.rank) if r.author_id == u] == want
    again = fm.fit_machine(train, items, rank=RANK, epochs=1, batches=2)
    assert again.losses[0] == pytest.approx(model.losses[0], abs=1e-12)
    assert fm.fit_machine(train.limit(0), items, rank=RANK, epochs=1, batches=1).params.where(F.col("f") >= 0).count() == 0


def test_a_fit_keeps_one_parameter_table_and_rows_stay_whole(spark, data):
    """Tables of past steps leave the disk, and a prediction neither explodes rows nor groups them."""
    _, train, _, items = data
    folder = Path(checkpoint_dir(spark).removeprefix("file:")) / "ludora-written"
    old = set(folder.glob("*-fm-params"))
    model = fm.fit_machine(train.limit(40), items, rank=2, epochs=1, batches=2)
    assert len(set(folder.glob("*-fm-params")) - old) == 1 and model.params.count() > 1
    frame = spark.createDataFrame([(1, 1.0, [0, 1])], "row long, y double, fs array<long>")
    plan = fm.predicted(frame, model.params, 0.0, 2, 2)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Aggregate" not in plan
