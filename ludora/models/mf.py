"""Matrix factorisation recommenders (RC-1 and RC-3 on Spark ALS, RC-2 by joint solves of biases and factors).

The factor tables stay distributed DataFrames: scoring joins candidate rows
to user and item factors and takes the dot product with array functions,
so nothing of size users x factors passes through the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import dot
from ..operators.clean import dedup_first
from ..operators.split import dense_index
from ..session import checkpoint_dir, release, written


@dataclass
class MFModel:
    users: DataFrame          # (author_id, u)
    items: DataFrame          # (app_id, i)
    user_factors: DataFrame   # (u, pf)
    item_factors: DataFrame   # (i, qf)
    mu: float = 0.0
    user_bias: DataFrame | None = None   # (author_id, bu)
    item_bias: DataFrame | None = None   # (app_id, bi)
    rank: int = 0

    def score_pairs(self, pairs: DataFrame, out: str = "cf_raw") -> DataFrame:
        """Raw prediction per (author_id, app_id); unknown user or item -> 0 (RC-19)."""
        uf = self.users.join(self.user_factors, F.col("u") == F.col("id")).select("author_id", F.col("features").alias("pf"))
        itf = self.items.join(self.item_factors, F.col("i") == F.col("id")).select("app_id", F.col("features").alias("qf"))
        s = pairs.join(uf, "author_id", "left").join(itf, "app_id", "left")
        known = F.col("pf").isNotNull() & F.col("qf").isNotNull()
        val = dot(F.col("pf").cast("array<double>"), F.col("qf").cast("array<double>"))
        if self.user_bias is not None:
            s = s.join(self.user_bias, "author_id", "left").join(self.item_bias, "app_id", "left")
            val = F.lit(self.mu) + F.coalesce("bu", F.lit(0.0)) + F.coalesce("bi", F.lit(0.0)) + F.coalesce(val, F.lit(0.0))
            known = F.col("bu").isNotNull() & F.col("bi").isNotNull()
            s = s.withColumn(out, F.when(known, val).otherwise(F.lit(0.0))).drop("bu", "bi")
        else:
            s = s.withColumn(out, F.when(known, val).otherwise(F.lit(0.0)))
        return s.drop("pf", "qf")

    def vectors(self, out: str = "cf") -> tuple[DataFrame, DataFrame]:
        """(author_id, out) and (app_id, out): arrays whose dot product is the raw prediction."""
        uf = self.users.join(self.user_factors, F.col("u") == F.col("id")).select("author_id", F.col("features").cast("array<double>").alias("v"))
        itf = self.items.join(self.item_factors, F.col("i") == F.col("id")).select("app_id", F.col("features").cast("array<double>").alias("v"))
        if self.user_bias is None:
            return uf.withColumnRenamed("v", out), itf.withColumnRenamed("v", out)
        one = F.array(F.lit(1.0))
        # known: both biases; without factors their product is zero
        none = F.array_repeat(F.lit(0.0), self.rank)
        users = self.user_bias.join(uf, "author_id", "left").select("author_id", F.concat(F.coalesce("v", none), F.array("bu"), one).alias(out))
        items = self.item_bias.join(itf, "app_id", "left").select("app_id", F.concat(F.coalesce("v", none), one, F.array(F.col("bi") + F.lit(self.mu))).alias(out))
        return users, items


def _ratings(train: DataFrame) -> DataFrame:
    """Dedup (user, item) keeping the earliest row (ST-2), label as rating."""
    d = dedup_first(train, ["author_id", "app_id"], ["id"])
    return d.select("author_id", "app_id", F.coalesce(F.col("is_positive_encoded"), F.lit(0)).cast("double").alias("r"))


def _als(ratings: DataFrame, users, items, rank, reg, iters, seed):
    checkpoint_dir(ratings.sparkSession)  # ALS cuts lineage there
    release(ratings.sparkSession)
    data = (ratings.join(users, "author_id").join(items, "app_id")
            .select(F.col("u").cast("int"), F.col("i").cast("int"), "r"))
    # a checkpoint deletes the shuffles of the rounds before it; between two of them all rounds' factors stay on disk
    als = ALS(rank=rank, maxIter=iters, regParam=reg, userCol="u", itemCol="i", ratingCol="r", checkpointInterval=1,
              seed=seed, implicitPrefs=False, nonnegative=False, coldStartStrategy="nan")
    return als.fit(data)


def fit_mf(train: DataFrame, rank: int = 20, reg: float = 0.01, iters: int = 15, seed: int = 42) -> MFModel:
    """RC-1: ratings = is_positive_encoded of every deduped train pair."""
    # written: both indexes and the fit read it, and the dedup's shuffle leaves the disk before the fit
    r = written(_ratings(train), "ratings")
    users = dense_index(r, "author_id", index_col="u")
    items = dense_index(r, "app_id", index_col="i")
    m = _als(r, users, items, rank, reg, iters, seed)
    return MFModel(users, items, m.userFactors, m.itemFactors, rank=rank)


def _half_step(ratings: DataFrame, key: str, other: str, fixed: DataFrame, mu: float, rank: int, reg: float) -> DataFrame:
    """(key, v, loss, norm): every `key`'s factors and bias, the exact minimum of the objective while the other side stays.

    With the other side's vector x = [q, 1] and the target y = r - mu - b, the normal equations of [p, bias]
    are sums of products: one grouped aggregate, combined in the tasks first, so a
    hot key is one row per task.  Only the small systems are solved in numpy, a batch at a time.
    """
    d = rank + 1
    upper = [(a, b) for a in range(d) for b in range(a, d)]
    x = [*(F.col("v")[j] for j in range(rank)), F.lit(1.0)]
    y = F.col("r") - F.lit(mu) - F.col("v")[rank]
    rows = ratings.join(fixed.select(other, "v"), other).select(key, *(c.alias(f"x{j}") for j, c in enumerate(x)), y.alias("y"))
    of = [F.sum(F.col(f"x{a}") * F.col(f"x{b}")) for a, b in upper] + [F.sum(F.col(f"x{a}") * F.col("y")) for a in range(d)] + [F.sum(F.col("y") * F.col("y"))]
    sums = rows.groupBy(key).agg(*(c.alias(f"s{j}") for j, c in enumerate(of))).select(key, F.array(*(f"s{j}" for j in range(len(of)))).alias("sums"))

    def solve(batches):
        for batch in batches:
            got = batch.column("sums").flatten().to_numpy().reshape(batch.num_rows, -1)
            left = np.zeros((len(got), d, d))
            for j, (a, b) in enumerate(upper):
                left[:, a, b] = left[:, b, a] = got[:, j]
            left += reg * np.eye(d)
            right = got[:, len(upper): len(upper) + d]
            v = np.linalg.solve(left, right[:, :, None])[:, :, 0]
            yield pa.RecordBatch.from_pydict({key: batch.column(key), "v": pa.array(list(v), pa.list_(pa.float64())),
                                              "loss": pa.array(got[:, -1] - (v * right).sum(axis=1)), "norm": pa.array((v * v).sum(axis=1))})

    return sums.mapInArrow(solve, f"{key} {dict(sums.dtypes)[key]}, v array<double>, loss double, norm double")


def fit_biased_mf(train: DataFrame, rank: int = 10, reg: float = 0.1, iters: int = 10, seed: int = 42,
                  tolerance: float = 1e-4, history: list | None = None) -> MFModel:
    """RC-2: mu + b_u + b_i + p_u.q_i, biases and factors solved together.

    Alternates exact solves of all users' and of all items' [factors, bias] under the squared error with the L2 term
    `reg`, so the objective falls with each half step; it comes with the solves and goes to `history`.  Stops
    after `iters` rounds or when a round gains less than the share `tolerance`.  Each side is a written table.
    """
    ratings = written(_ratings(train), "ratings")
    mu = ratings.select(F.avg("r")).first()[0] or 0.0
    noise = [F.xxhash64("app_id", F.lit(j), F.lit(seed)) / F.lit(2.0**63) * 0.1 for j in range(rank)]
    items = written(ratings.select("app_id").distinct().select("app_id", F.array(*noise, F.lit(0.0)).alias("v")), "items")
    users, before, other = None, None, 0.0
    other = items.select(F.sum(F.aggregate("v", F.lit(0.0), lambda a, z: a + z * z))).first()[0] or 0.0
    for _ in range(iters):
        users = written(_half_step(ratings, "author_id", "app_id", items, mu, rank, reg), "users")
        first, own = _objective(users, reg, other)
        items = written(_half_step(ratings, "app_id", "author_id", users, mu, rank, reg), "items")
        second, other = _objective(items, reg, own)
        if history is not None:
            history += [first, second]
        if before is not None and before - second <= tolerance * before:
            break
        before = second
    factors = F.slice("v", 1, rank).alias("features")
    return MFModel(users.select("author_id", F.col("author_id").alias("u")), items.select("app_id", F.col("app_id").alias("i")),
                   users.select(F.col("author_id").alias("id"), factors), items.select(F.col("app_id").alias("id"), factors), mu,
                   users.select("author_id", F.col("v")[rank].alias("bu")), items.select("app_id", F.col("v")[rank].alias("bi")), rank)


def _objective(solved: DataFrame, reg: float, other: float) -> tuple[float, float]:
    """The objective after a half step and the sum of squares of the solved side."""
    loss, norm = solved.agg(F.sum("loss"), F.sum("norm")).first()
    return (loss or 0.0) + reg * other, norm or 0.0


def cf_recommendations(model: MFModel, users: DataFrame, ranked_items: DataFrame, seen: DataFrame,
                       titles: DataFrame, n: int = 10) -> DataFrame:
    """RC-3: top-n unseen items by CF score with their titles (JN-7 + SL-4 + JN-5).

    Items come in order of falling norm, so most chunks cannot reach a user's n-th score and are skipped.
    """
    from ..operators.blocked import Base, top_items

    of_users, of_items = model.vectors("cf")
    u = written(dense_index(users, "author_id", index_col="u").join(of_users, "author_id", "left"), "rc3-users")
    i = ranked_items.select("app_id", F.col("item_rank").alias("i"))
    known = seen.select("author_id", "app_id").distinct().join(u.select("author_id", "u"), "author_id").join(i, "app_id").select("u", "i")
    top = top_items(u, i.join(of_items, "app_id", "left"), [Base("cf", biased=model.user_bias is not None)], n, seen=known)
    t = titles.select("app_id", "title").dropDuplicates(["app_id"])
    return (top.join(u.select("u", "author_id"), "u").join(i, "i").join(t, "app_id", "left")
            .select("author_id", "rank", "app_id", F.coalesce("title", F.lit("Title Missing")).alias("title"), "score"))
