"""Factorisation machine over any number of one-hot fields (RC-6, RC-7), trained as DataFrame jobs.

The parameters are a table: a row per feature with its weight, its factors
and the sums of squared gradients of both (AdaGrad).  A step joins a mini-batch's rows
to the parameters of one field after the other, which adds to sums that a row carries, gets a row's prediction
by the identity  sum over pairs <v_i, v_j> x_i x_j = (|sum v_i x_i|^2 - sum |v_i x_i|^2) / 2,
and sums the gradients per feature, in the tasks first, so a feature that a third of all rows hold costs a row per
task there.  A row is never exploded into its features before that, nor put together again.  The global weight is the feature BIAS of that table; only it and the loss reach the driver.

Loss: squared error plus an L2 term for each occurrence of a feature.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_text_compact
from ..functions.vectors import dot
from ..operators.clean import dedup_first
from ..operators.split import dense_index
from ..session import discard, release, written

#: Number of the feature that every row has: the global weight.
BIAS = -1
_TINY = 1e-8


def _factors(rank: int) -> list[str]:
    return [f"v{k}" for k in range(rank)]


def training_rows(train: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """(row, y, features) of each (user, item) pair, its first row by id (ST-2).

    features are texts `field:value`: the user, the item and, with `items`
    (app_id, title), the item's compact title if it is a token (FN-2, TF-12).
    """
    pairs = dedup_first(train, ["author_id", "app_id"], ["id"])
    fields = [F.concat(F.lit("user:"), F.col("author_id").cast("string")), F.concat(F.lit("item:"), F.col("app_id").cast("string"))]
    if items is not None:
        pairs = pairs.drop("title").join(item_titles(items), "app_id", "left")
        fields.append(F.concat(F.lit("title:"), "token"))
    return pairs.select(F.xxhash64("author_id", "app_id").alias("row"), F.coalesce("is_positive_encoded", F.lit(0)).cast("double").alias("y"),
                        F.filter(F.array(*fields), lambda x: x.isNotNull()).alias("features"))


def item_titles(items: DataFrame) -> DataFrame:
    """(app_id, token): compact titles of at least two characters, the first title in order of an item that has several."""
    token = clean_text_compact("title")
    one = items.groupBy("app_id").agg(F.min("title").alias("title"))
    return one.select("app_id", F.when(F.length(token) >= 2, token).alias("token"))


@dataclass
class FMModel:
    params: DataFrame                 # (feature, f, w, v0.., gw, gv0..), one row per feature and BIAS
    rank: int
    titles: DataFrame | None = None   # (app_id, token) if titles are a field
    losses: list = field(default_factory=list)   # mean squared error of each epoch, before its steps

    def _field(self, name: str, key: str) -> DataFrame:
        rows = self.params.where(F.col("feature").startswith(f"{name}:"))
        return rows.select(F.substring("feature", len(name) + 2, 1 << 30).alias(key), F.col("w").alias(f"w_{name}"), F.array(*_factors(self.rank)).alias(f"v_{name}"))

    def vectors(self, out: str = "fm") -> tuple[DataFrame, DataFrame]:
        """(author_id, out) and (app_id, out) as text ids: arrays whose dot product is the raw score.

        An item's fields act together: its vector is the sum of their factors, its
        own part their weights and the products among them.
        """
        w0 = self.params.where(F.col("f") == BIAS).first()["w"]
        one = F.array(F.lit(1.0))
        users = self._field("user", "author_id").select("author_id", F.concat("v_user", F.array("w_user"), one).alias(out))
        items = self._field("item", "app_id").withColumn("own", F.col("w_item") + F.lit(float(w0)))
        if self.titles is not None:
            tokens = self.titles.select(F.col("app_id").cast("string").alias("app_id"), "token")
            items = items.join(tokens, "app_id", "left").join(self._field("title", "token"), "token", "left")
            both = F.zip_with("v_item", "v_title", lambda a, b: a + b)
            items = items.withColumn("own", F.col("own") + F.coalesce(F.col("w_title") + dot(F.col("v_item"), F.col("v_title")), F.lit(0.0)))
            items = items.withColumn("v_item", F.coalesce(both, "v_item"))
        return users, items.select("app_id", F.concat("v_item", one, F.array("own")).alias(out))

    def score_pairs(self, pairs: DataFrame, out: str = "fm_raw") -> DataFrame:
        """Raw score per (author_id, app_id); unknown user or item -> 0 (RC-19)."""
        users, items = self.vectors("_u")[0], self.vectors("_i")[1]
        keyed = pairs.withColumn("_author", F.col("author_id").cast("string")).withColumn("_app", F.col("app_id").cast("string"))
        s = (keyed.join(users.withColumnRenamed("author_id", "_author"), "_author", "left")
             .join(items.withColumnRenamed("app_id", "_app"), "_app", "left"))
        return s.withColumn(out, F.coalesce(dot(F.col("_u"), F.col("_i")), F.lit(0.0))).drop("_u", "_i", "_author", "_app")


def initial_params(rows: DataFrame, rank: int, scale: float = 0.1, seed: int = 42) -> DataFrame:
    """One row per feature: weight zero, factors normal with deviation `scale` (from hashes, so reruns agree)."""
    features = dense_index(rows.select(F.explode("features").alias("feature")), "feature", index_col="f")

    def uniform(k: int) -> Column:
        return (F.pmod(F.xxhash64("feature", F.lit(k), F.lit(seed)), F.lit(1 << 30)) + 0.5) / float(1 << 30)

    normal = [(scale * F.sqrt(-2.0 * F.log(uniform(2 * k))) * F.cos(2.0 * math.pi * uniform(2 * k + 1))).alias(v) for k, v in enumerate(_factors(rank))]
    zero = [F.lit(0.0).alias(c) for c in ("gw", *(f"g{v}" for v in _factors(rank)), "sse", "n")]
    spark = rows.sparkSession
    bias = spark.createDataFrame([("", BIAS)], "feature string, f long").select("feature", "f", F.lit(0.0).alias("w"), *(F.lit(0.0).alias(v) for v in _factors(rank)), *zero)
    return features.select("feature", "f", F.lit(0.0).alias("w"), *normal, *zero).unionByName(bias)


def predicted(rows: DataFrame, params: DataFrame, w0: float, rank: int, width: int | None = None) -> DataFrame:
    """(row, y, fs, s, score): features by number, the sum of their factors, and the machine's score. `width` is the largest number of features of a row (looked up without it)."""
    if width is None:
        width = rows.agg(F.max(F.size("fs"))).first()[0] or 0
    factors = _factors(rank)
    # lin: sum of weights; q: of squares; s_v..: of factors
    of = {"lin": F.col("w"), "q": sum((F.col(v) * F.col(v) for v in factors), F.lit(0.0)), **{f"s_{v}": F.col(v) for v in factors}}
    known = params.select("f", *(c.alias(f"_{name}") for name, c in of.items()))
    sums = rows.select("row", "y", "fs", *(F.lit(0.0).alias(name) for name in of))
    for k in range(width):
        met = sums.withColumn("f", F.get("fs", F.lit(k))).join(known, "f", "left")
        sums = met.select("row", "y", "fs", *(F.when(F.col("_lin").isNull(), F.col(name)).otherwise(F.col(name) + F.col(f"_{name}")).alias(name) for name in of))
    pair = 0.5 * (sum((F.col(f"s_{v}") * F.col(f"s_{v}") for v in factors), F.lit(0.0)) - F.col("q"))
    return sums.select("row", "y", "fs", *(f"s_{v}" for v in factors), (F.lit(w0) + F.col("lin") + pair).alias("score"))


def step(rows: DataFrame, params: DataFrame, w0: float, rank: int, rate: float, reg: float, width: int | None = None) -> DataFrame:
    """The parameter table after one step on `rows`: gradients summed per feature, each scaled by its own history."""
    factors = _factors(rank)
    errors = predicted(rows, params, w0, rank, width).withColumn("e", F.col("score") - F.col("y"))
    each = errors.select("e", *(f"s_{v}" for v in factors), F.explode(F.concat("fs", F.array(F.lit(BIAS).cast("long")))).alias("f"))
    sums = each.groupBy("f").agg(F.sum("e").alias("_e"), F.sum(F.col("e") * F.col("e")).alias("_sse"), F.count(F.lit(1)).cast("double").alias("_n"),
                                 *(F.sum(F.col("e") * F.col(f"s_{v}")).alias(f"_{v}") for v in factors))
    joined = params.drop("sse", "n").join(sums, "f", "left")
    none = F.col("_n").isNull()
    decay = F.when(F.col("f") == BIAS, 0.0).otherwise(reg) * F.col("_n")
    # of the error's sum over the other features of the row: their factors' sum less the feature's own
    grads = {"w": F.col("_e") + decay * F.col("w")} | {v: F.when(F.col("f") == BIAS, 0.0).otherwise(F.col(f"_{v}") - F.col(v) * F.col("_e") + decay * F.col(v)) for v in factors}
    out = ["feature", "f"]
    for c, g in grads.items():
        seen = F.col(f"g{c}") + g * g
        out += [F.when(none, F.col(c)).otherwise(F.col(c) - rate * g / (F.sqrt(seen) + _TINY)).alias(c), F.when(none, F.col(f"g{c}")).otherwise(seen).alias(f"g{c}")]
    return joined.select(*out, F.coalesce("_sse", F.lit(0.0)).alias("sse"), F.coalesce("_n", F.lit(0.0)).alias("n"))


def fit_machine(train: DataFrame, items: DataFrame | None = None, rank: int = 8, rate: float = 0.1, reg: float = 1e-4,
                epochs: int = 6, batches: int = 2, seed: int = 42) -> FMModel:
    """RC-6 (user and item) or, with `items`, RC-7 (and title): mini-batch AdaGrad over the parameter table."""
    named = training_rows(train, items)
    params = written(initial_params(named, rank, seed=seed), "fm-params")
    numbered = named.select("row", "y", F.explode("features").alias("feature")).join(params.select("feature", "f"), "feature")
    # equal order in all rows: the feature of a place is of one field, as their texts sort by field
    rows = written(numbered.groupBy("row", "y").agg(F.sort_array(F.collect_list("f")).alias("fs")), "fm-rows")
    width = rows.agg(F.max(F.size("fs"))).first()[0] or 0
    losses, w0 = [], 0.0
    for epoch in range(epochs):
        sse = n = 0.0
        for b in range(batches):
            part = rows.where(F.pmod(F.xxhash64("row", F.lit(seed + epoch)), F.lit(batches)) == b)
            before, params = params, written(step(part, params, w0, rank, rate, reg, width), "fm-params")
            discard(before)
            bias = params.where(F.col("f") == BIAS).first()
            w0, sse, n = bias["w"], sse + bias["sse"], n + bias["n"]
        # an epoch's shuffles leave the disk
        release(train.sparkSession)
        losses.append(sse / n if n else 0.0)
    return FMModel(params, rank, None if items is None else written(item_titles(items), "fm-titles"), losses)


def fm_recommendations(model: FMModel, users: DataFrame, ranked_items: DataFrame, seen: DataFrame, n: int = 10) -> DataFrame:
    """(author_id, rank, app_id, score): the machine's best n unseen items of each user, over all items."""
    from ..operators.blocked import Base, top_items

    of_users, of_items = model.vectors("fm")
    keyed = lambda df, key, vectors: df.withColumn("_key", F.col(key).cast("string")).join(vectors.withColumnRenamed(key, "_key"), "_key", "left").drop("_key")
    u = written(keyed(dense_index(users, "author_id", index_col="u"), "author_id", of_users), "fm-users")
    i = written(keyed(ranked_items.select("app_id", F.col("item_rank").alias("i")), "app_id", of_items), "fm-items")
    known = seen.select("author_id", "app_id").distinct().join(u.select("author_id", "u"), "author_id").join(i.select("app_id", "i"), "app_id").select("u", "i")
    top = top_items(u, i, [Base("fm", biased=True)], n, seen=known)
    return top.join(u.select("u", "author_id"), "u").join(i.select("i", "app_id"), "i").select("author_id", "rank", "app_id", "score")
