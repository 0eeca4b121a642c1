"""A user holding a third of all rows: results stay exact, plans stay split-able."""

import numpy as np
from pyspark.sql import functions as F

from ludora.models.cbf import cbf_top_k, fit_cbf
from ludora.operators.candidates import candidate_pool, rank_items
from ludora.operators.split import flag_holdout


def _skewed(spark, n=3000):
    # user 0 owns every third row; the rest spread over 500 users
    return spark.range(n).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500 + 1).cast("long").alias("author_id"),
        ((F.col("id") * 7) % 1500).alias("app_id"),   # the hot user sees 500 of 1500 items
        F.concat(F.lit("title "), (F.col("id") % 37).cast("string")).alias("title"),
        F.when(F.col("id") % 4 == 0, 0).otherwise(1).alias("is_positive_encoded"))


def test_holdout_hot_user(spark):
    df = _skewed(spark)
    flagged = flag_holdout(df)
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan          # map-side partial aggregation of the hot key
    assert "Window" not in plan            # no per-user window holding the hot user in one task
    tests = {r.author_id: r.id for r in flagged.where("is_test").collect()}
    assert tests[0] == 2997                # the hot user's last id
    assert flagged.where("is_test").count() == flagged.select("author_id").distinct().count()


def test_candidates_and_topk_hot_user(spark):
    df = _skewed(spark)
    items = df.select("app_id", "title").distinct()
    ranked = rank_items(items)
    seen = df.select("author_id", "app_id")
    users = spark.createDataFrame([(0,), (1,)], "author_id long")
    pool = candidate_pool(users, ranked, seen, cap=50)
    counts = {r.author_id: r["count"] for r in pool.groupBy("author_id").count().collect()}
    assert counts == {0: 50, 1: 50}
    hot_seen = {r.app_id for r in seen.where("author_id = 0").collect()}
    assert not hot_seen & {r.app_id for r in pool.where("author_id = 0").collect()}
    model = fit_cbf(df, items, stop_words=())
    top = cbf_top_k(model, users, ranked, seen, 10).collect()
    assert sorted(r.author_id for r in top) == [0] * 10 + [1] * 10
    assert not any(r.author_id == 0 and r.app_id in hot_seen for r in top)


def test_numbers_and_quantiles_without_exchange_reuse(spark):
    """400,000 rows, 90 % of them one value, more than the range sampler reads, and no reused exchange."""
    from ludora.operators.profile import exact_quantiles
    from ludora.operators.split import dense_index
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        df = spark.range(400_000).select(F.col("id"), F.when(F.col("id") % 10 > 0, F.lit(7.0)).otherwise((F.col("id") * 37 % 400_009).cast("double")).alias("v"))
        values = np.array([r.v for r in df.select("v").collect()])
        got = exact_quantiles(df, "v", (0.01, 0.05, 0.5, 0.99)).first()
        assert np.allclose(list(got), np.quantile(values, (0.01, 0.05, 0.5, 0.99)))
        idx = dense_index(df, "id").agg(F.countDistinct("idx"), F.min("idx"), F.max("idx"), F.sum((F.col("id") != F.col("idx")).cast("int"))).first()
        assert tuple(idx) == (400_000, 0, 399_999, 0)
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_shared_folder_is_required_off_local_masters():
    import pytest

    from ludora.session import checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError):
        checkpoint_dir(Session())


def test_integrate_with_one_game_holding_most_reviews(spark):
    """JN-1: the same rows as a right outer join, without one: the skewed side is that of an inner join, which AQE splits."""
    from ludora.operators.clean import integrate
    from ludora.sources.fixtures import GAMES_COLUMNS
    reviews = spark.range(2000).select(
        "id", F.when(F.col("id") % 10 > 0, F.lit(7)).otherwise(F.col("id") % 40).cast("long").alias("app_id"), F.lit("t").alias("content"),
        (F.col("id") % 50).alias("author_id"), F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.lit("Positive")).alias("is_positive"))
    reviews = reviews.unionByName(reviews.limit(3).withColumn("app_id", F.lit(None).cast("long")))
    games = spark.range(60).select(F.when(F.col("id") == 59, F.lit(None)).otherwise(F.col("id")).alias("app_id"), *(F.lit(1).alias(c) for c in GAMES_COLUMNS[1:]))
    games = games.unionByName(games.where("app_id in (7, 50)"))
    got = integrate(reviews, games)
    want = reviews.join(games, "app_id", "right").select(got.columns[0], games["app_id"], *got.columns[2:])
    bag = lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
    assert bag(got) == bag(want)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "RightOuter" not in plan and "LeftAnti" in plan and "Inner" in plan


def test_cbf_with_one_word_in_most_titles(spark):
    """JN-11: a word of 90 % of the titles; the top-k equals brute force, and scoring has no join on terms."""
    rng = np.random.default_rng(5)
    games = [(k, ("game " if k % 10 else "") + " ".join(f"w{x}" for x in rng.integers(0, 12, 2))) for k in range(120)]
    likes = sorted({(int(u), int(a)) for u, a in zip(rng.integers(0, 30, 150), rng.integers(0, 120, 150))})
    items = spark.createDataFrame(games, "app_id long, title string")
    train = spark.createDataFrame([(n, u, a, 1) for n, (u, a) in enumerate(likes)], "id long, author_id long, app_id long, is_positive_encoded int")
    model = fit_cbf(train, items, stop_words=(), dedup_titles=False)
    vec = {}
    for r in model.vectors.collect():
        vec.setdefault(r.title, {})[r.term] = r.weight
    top = cbf_top_k(model, train.select("author_id").distinct(), rank_items(items), train, 6, normalize=False)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "term" not in plan.replace("determin", "")
    got = {}
    for r in top.orderBy("rank").collect():
        got.setdefault(r.author_id, []).append(r.app_id)
    title = dict(games)
    for u in got:
        mine = [a for x, a in likes if x == u]
        score = {a: sum(vec[title[m]].get(t, 0) * w for m in mine for t, w in vec[t_].items()) for a, t_ in games if a not in mine}
        assert got[u] == sorted(score, key=lambda a: (-round(score[a], 9), str(a)))[:6]
