"""The blocked scorer against plain numpy."""

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest
from pyspark.sql import functions as F

from ludora.operators import blocked
from ludora.operators.blocked import Base, spread, top_items


def _tables(spark, rng, n_users, n_items, d=4):
    """Vectors with missing ones, repeated ones (ties) and sparse terms; seen pairs."""
    def side(name, n):
        rows = []
        for k in range(n):
            v = None if rng.random() < 0.1 else [float(x) for x in rng.integers(-2, 3, d)]
            t = sorted(rng.choice(30, int(rng.integers(0, 5)), replace=False).tolist())
            rows.append((k, v, t, [float(x) for x in rng.integers(1, 4, len(t))]))
        return rows, spark.createDataFrame(rows, f"{name} long, cf array<double>, cbf_t array<int>, cbf_w array<double>").repartition(3)

    users, u = side("u", n_users)
    items, i = side("i", n_items)
    seen = sorted({(int(a), int(b)) for a, b in zip(rng.integers(0, n_users, 300), rng.integers(0, n_items, 300))} | {(0, k) for k in range(n_items)} | {(1, k) for k in range(n_items) if k != 5})
    return users, u, items, i, seen, spark.createDataFrame(seen, "u long, i long")


def _raw(users, items):
    dot, cos, sparse = (np.zeros((len(users), len(items))) for _ in range(3))
    for a, (_, v, t, w) in enumerate(users):
        for b, (_, x, s, z) in enumerate(items):
            if v and x:
                dot[a, b] = np.dot(v, x)
                cos[a, b] = dot[a, b] / (np.linalg.norm(v) * np.linalg.norm(x) + 1e-8)
            other = dict(zip(s, z))
            sparse[a, b] = sum(c * other.get(k, 0) for k, c in zip(t, w))
    return dot, cos, sparse


def _best(score, ok, k):
    rows = set()
    for a in range(len(score)):
        order = sorted((b for b in range(score.shape[1]) if ok[a, b]), key=lambda b: (-round(score[a, b], 9), b))[:k]
        rows |= {(a, b, r + 1, round(score[a, b], 9)) for r, b in enumerate(order)}
    return rows


@pytest.mark.parametrize("cap", [None, 17])
def test_every_pair_is_scored(spark, monkeypatch, cap):
    monkeypatch.setattr(blocked, "BLOCK_USERS", 20)
    monkeypatch.setattr(blocked, "TILE_USERS", 7)
    monkeypatch.setattr(blocked, "TILE_ITEMS", 11)
    users, u, items, i, seen, s = _tables(spark, np.random.default_rng(8), 45, 60)
    dot, cos, sparse = _raw(users, items)
    ok = np.ones(dot.shape, bool)
    for a, b in seen:
        ok[a, b] = False
    if cap:
        ok &= np.cumsum(ok, axis=1) <= cap
    bases = [Base("cf"), Base("cbf", "sparse")]
    got = top_items(u, i, bases, 5, seen=s, cap=cap).collect()
    for name, want in (("cf", dot), ("cbf", sparse)):
        assert {(r.u, r.i, r.rank, round(r.score, 9)) for r in got if r.label == name} == _best(want, ok, 5)
    ends = {r.u: r for r in spread(u, i, bases, s, cap).collect()}
    for a in range(1, 45):
        for k, want in enumerate((dot, sparse)):
            assert ends[a].lo[k] == pytest.approx(want[a][ok[a]].min()) and ends[a].hi[k] == pytest.approx(want[a][ok[a]].max())
    # scaled combinations get each user's own extremes
    half = top_items(u, i, bases, 4, lambda raw, lo, hi: {"h": (raw["cf"] - lo["cf"]) / np.maximum(hi["cf"] - lo["cf"], 1) + raw["cbf"]}, s, cap, scaled=True).collect()
    lo = np.array([want[ok[a]].min() if ok[a].any() else 0 for a, want in enumerate(dot)])[:, None]
    hi = np.array([want[ok[a]].max() if ok[a].any() else 0 for a, want in enumerate(dot)])[:, None]
    assert {(r.u, r.i, r.rank, round(r.score, 9)) for r in half} == _best((dot - lo) / np.maximum(hi - lo, 1) + sparse, ok, 4)
    cosine = top_items(u, i, [Base("cf", "cosine")], 3, seen=s, cap=cap).collect()
    assert {(r.u, r.i, r.rank, round(r.score, 9)) for r in cosine} == _best(cos, ok, 3)


def test_skipping_by_norm_is_exact(spark, monkeypatch):
    """A single product skips chunks whose norms cannot reach the k-th score, and finds the same items."""
    monkeypatch.setattr(blocked, "TILE_ITEMS", 8)
    users, u, items, i, seen, s = _tables(spark, np.random.default_rng(3), 30, 200)
    dot, _, _ = _raw(users, items)
    ok = np.ones(dot.shape, bool)
    for a, b in seen:
        ok[a, b] = False
    got = top_items(u, i, [Base("cf")], 3, seen=s).collect()
    assert {(r.u, r.i, r.rank, round(r.score, 9)) for r in got} == _best(dot, ok, 3)
    assert top_items(u, i.limit(0), [Base("cf")], 3).collect() == [] == top_items(u.limit(0), i, [Base("cf")], 3).collect()


def test_of_equal_items_only_the_first_travel(spark, monkeypatch):
    """Items without a vector score the same: a block gets as many of them as a user can need, and the results stay."""
    monkeypatch.setattr(blocked, "BLOCK_USERS", 6)
    u = spark.createDataFrame([(k, [0], [1.0]) for k in range(20)], "u long, cbf_t array<int>, cbf_w array<double>")
    i = spark.createDataFrame([(k, [0] if k % 100 == 99 else None, [k / 1000] if k % 100 == 99 else None) for k in range(500)], "i long, cbf_t array<int>, cbf_w array<double>")
    seen = [(0, k) for k in range(30)] + [(1, 1), (1, 499), (2, 99)]
    s = spark.createDataFrame(seen, "u long, i long")
    users = blocked._with_seen(u, s)
    rows = blocked._dealt(users, i, [Base("cbf", "sparse")], None, 8).where("is_item").groupBy("block").count().collect()
    assert max(r["count"] for r in rows) <= 5 + 8 + 30 and min(r["count"] for r in rows) == 5 + 8
    score = np.array([[k / 1000 if k % 100 == 99 else 0.0 for k in range(500)]] * 20)
    ok = np.ones(score.shape, bool)
    for a, b in seen:
        ok[a, b] = False
    got = top_items(u, i, [Base("cbf", "sparse")], 8, seen=s).collect()
    assert {(r.u, r.i, r.rank, round(r.score, 9)) for r in got} == _best(score, ok, 8)
    assert {r.u: r.most for r in got}[1] == 0.399 and {r.least for r in got} == {0.0}


def test_items_travel_once_per_core(spark):
    """Up to 65,536 users a task: 20,000 users are no more blocks than the session has cores."""
    u = spark.range(20000).select(F.col("id").alias("u"), F.array(F.lit(1.0)).alias("cf"))
    i = spark.range(50).select(F.col("id").alias("i"), F.array(F.col("id").cast("double")).alias("cf"))
    dealt = blocked._dealt(blocked._with_seen(u, None), i, [Base("cf")], Base("cf"), 3)
    assert dealt.where("is_item").count() == 50 * min(4, spark.sparkContext.defaultParallelism)


def test_own_parts_bound_a_score(spark, monkeypatch):
    """Scores with own parts of users and items: skipping by the bound finds the same items, a user without a vector too."""
    monkeypatch.setattr(blocked, "TILE_ITEMS", 8)
    rng = np.random.default_rng(5)
    users = [(k, None if k == 3 else [*map(float, rng.normal(0, 0.1, 3)), float(rng.normal()), 1.0]) for k in range(25)]
    items = [(k, None if k % 50 == 7 else [*map(float, rng.normal(0, 0.1, 3)), 1.0, float(rng.normal())]) for k in range(300)]
    u, i = spark.createDataFrame(users, "u long, cf array<double>"), spark.createDataFrame(items, "i long, cf array<double>")
    dot = np.array([[np.dot(v, x) if v and x else 0.0 for _, x in items] for _, v in users])
    got = top_items(u, i, [Base("cf", biased=True)], 4).collect()
    assert {(r.u, r.i, r.rank, round(r.score, 9)) for r in got} == _best(dot, np.ones(dot.shape, bool), 4)


def test_barred_pairs_of_a_tile_are_the_seen_and_the_late_ones():
    seen = [[3, 9, 11], [], [0, 4], [5, 6, 7, 40]]
    rows = pa.table({"seen": pa.array(seen, pa.list_(pa.int32()))})
    keys = np.array([0, 3, 5, 6, 11, 12])
    for cap in (None, 4):
        allowed = blocked._Allowed(rows, cap)
        for users in (np.array([0, 2, 3]), np.array([1]), np.arange(4)):
            row, at = allowed.barred(users, keys)
            limit = [100 if cap is None else [k for k in range(50) if k not in s][cap - 1] + 1 for s in seen]
            want = {(r, c) for r, u in enumerate(users) for c, k in enumerate(keys) if k in seen[u] or k >= limit[u]}
            assert set(zip(row.tolist(), at.tolist(), strict=True)) == want


def test_a_chunk_larger_than_k_keeps_ties_in_key_order_and_ends():
    score = np.array([[0.0] * 30 + [1.0, 1.0, 0.5], [2.0, 1.0, 3.0] + [0.0] * 30])
    top = blocked._Top(2, 4)
    top.add(np.arange(2), score, (np.array([1, 0]), np.array([2, 0])), np.arange(33))
    assert top.items.tolist() == [[30, 31, 32, 1], [0, 1, 3, 4]]
    assert top.least.tolist() == [0.0, 0.0] and top.most.tolist() == [1.0, 2.0]


def test_items_are_written_once_and_not_shuffled(spark):
    """The plan of a task's rows holds no items: a block reads them from a written table, in order."""
    u = spark.range(3000).select(F.col("id").alias("u"), F.array(F.lit(1.0)).alias("cf"))
    i = spark.range(2500).select(F.col("id").alias("i"), F.array(F.col("id").cast("double")).alias("cf"))
    dealt = blocked._dealt(blocked._with_seen(u, None), i, [Base("cf")], Base("cf"), 3)
    plan = dealt._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and "Generate" not in plan
    rows = dealt.where("is_item").collect()
    for block in {r.block for r in rows}:
        assert [r.key for r in rows if r.block == block] == list(range(2499, -1, -1))


@pytest.mark.parametrize("scaled", [True, False])
def test_weighted_sums_find_the_same_pairs_as_whole_matrices(spark, monkeypatch, scaled):
    """Labels that are affine in the base scores, also with negative weights and a logistic function over them, ties included."""
    monkeypatch.setattr(blocked, "TILE_ITEMS", 16)
    users, u, items, i, seen, s = _tables(spark, np.random.default_rng(11), 45, 120)
    dot, cos, sparse = _raw(users, items)
    ok = np.ones(dot.shape, bool)
    for a, b in seen:
        ok[a, b] = False
    bases = [Base("cf"), Base("cbf", "sparse")]

    def linear(raw, lo, hi):
        cf = (raw["cf"] - lo["cf"]) / np.where(hi["cf"] > lo["cf"], hi["cf"] - lo["cf"], 1.0) if scaled else raw["cf"]
        return {"one": 2.0 * cf + 1.0, "two": 0.3 * cf + 0.7 * raw["cbf"], "less": 5.0 - raw["cbf"], "odds": 3.0 * cf - raw["cbf"]}

    def combine(raw, lo, hi):
        z = linear(raw, lo, hi)
        return {**z, "odds": 1.0 / (1.0 + np.exp(-z["odds"]))}

    got = top_items(u, i, bases, 4, combine, s, scaled=scaled, linear=linear, logistic=("odds",), ends=("odds",)).collect()
    lo, hi = ({"cf": np.array([end(want[ok[a]]) if ok[a].any() else 0 for a, want in enumerate(dot)])[:, None]} for end in (np.min, np.max))
    for label, score in combine({"cf": dot, "cbf": sparse}, lo, hi).items():
        rows = [r for r in got if r.label == label]
        assert {(r.u, r.i, r.rank, round(r.score, 9)) for r in rows} == _best(score, ok, 4)
        for r in rows:
            ends = (pytest.approx(score[r.u][ok[r.u]].min()), pytest.approx(score[r.u][ok[r.u]].max())) if label == "odds" else (None, None)
            assert (r.least, r.most) == ends


@pytest.mark.parametrize("kind", ["random", "close", "equal", "huge"])
@pytest.mark.parametrize("cap", [None, 900])
def test_a_single_dot_is_screened_in_single_precision(monkeypatch, kind, cap):
    """All pairs are looked at in single precision, few in double; the best are those of double precision."""
    rng = np.random.default_rng(5)
    n, m, d, k = 60, 2500, 6, 7
    u, v = rng.normal(size=(n, d)), rng.normal(size=(m, d))
    if kind == "close":  # scores differ by less than single precision holds, around the rounding to 9 digits
        u, v = np.abs(u) + 1, np.ones((m, d)) + rng.integers(0, 40, (m, d)) * 3e-10
    if kind == "equal":
        v = v[rng.integers(0, 3, m)]
    if kind == "huge":
        u[: n // 2] *= 1e25
        v *= 1e12
    v = v[np.argsort(-np.linalg.norm(v, axis=1), kind="stable")]
    key, known_u, known_v = rng.permutation(m), rng.random(n) > 0.1, rng.random(m) > 0.02
    seen = [rng.choice(m, int(rng.integers(0, 40)), replace=False) for _ in range(n)]
    seen[3] = np.setdiff1d(np.arange(m), [4, 9])  # fewer than k are left
    vector = pa.list_(pa.float64())
    listed = lambda x, known: pa.array([r.tolist() if ok else None for r, ok in zip(x, known)], vector)

    def side(item, keys, vectors, seen):
        size = len(keys)
        return pa.table({"block": pa.array([0] * size, pa.int32()), "is_item": pa.array([item] * size), "pos": pa.array([0.0] * size), "key": pa.array(keys, pa.int64()),
                         "cf": vectors, "seen": pa.array(seen, pa.list_(pa.int32())), "lo": pa.nulls(size, vector), "hi": pa.nulls(size, vector)}).combine_chunks()

    items = side(True, key.tolist(), listed(v, known_v), [None] * m)
    rows = [*side(False, list(range(n)), listed(u, known_u), [x.tolist() for x in seen]).to_batches(), *(x for a in range(0, m, 500) for x in items.slice(a, 500).combine_chunks().to_batches())]
    scored, raw = [], blocked._raw
    monkeypatch.setattr(blocked, "_raw", lambda *given: (scored.append(len(given[2]) * len(given[3])), raw(*given))[1])
    monkeypatch.setattr(blocked, "_dealt", lambda users, items, bases, order, k, run, schema: run)
    monkeypatch.setattr(blocked, "_with_seen", lambda users, seen: users)
    monkeypatch.setattr(blocked, "written", lambda df, label: df)
    got = pa.Table.from_batches(list(top_items(None, None, [Base("cf")], k, cap=cap)(iter(rows))))
    # near or equal scores are all scored again, and single precision cannot hold huge ones
    assert kind != "random" or sum(scored) < n * m / 2
    score = np.einsum("ad,bd->ab", u * known_u[:, None], v * known_v[:, None])
    want = {}
    for a in range(n):
        left = set(np.setdiff1d(np.arange(m), seen[a])[:cap].tolist())
        order = sorted((b for b in range(m) if int(key[b]) in left), key=lambda b: (-round(score[a, b], 9), key[b]))[:k]
        want[a] = [(int(key[b]), score[a, b]) for b in order]
    if kind == "huge":  # the last digits of such scores are noise
        for a in range(n):
            assert got.filter(pa.compute.equal(got["u"], a))["score"].to_pylist() == pytest.approx([s for _, s in want[a]], rel=1e-9)
        return
    assert {(r["u"], r["rank"], r["i"]) for r in got.to_pylist()} == {(a, x + 1, i) for a in want for x, (i, _) in enumerate(want[a])}
    for r in got.to_pylist():
        assert r["score"] == pytest.approx(want[r["u"]][r["rank"] - 1][1], rel=1e-12, abs=1e-12)
