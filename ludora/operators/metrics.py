"""Ranking metrics (EV-1 .. EV-13) as one grouped job per table.

Predictions are long rows (model, author_id, app_id, rank).  The K list is
a literal array exploded per row (no join), hits come from one left join
with the ground truth on (author_id, app_id), and every metric is a
conditional aggregate over (model, author_id, k).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_KS = (5, 10, 20)


def ground_truth(test: DataFrame) -> DataFrame:
    """EV-1: positive test items per user (long form)."""
    return (test.where(F.col("is_positive_encoded") == 1)
            .select("author_id", "app_id").distinct())


def order_predictions(preds: DataFrame) -> DataFrame:
    """EV-2: ranked list by `rank` if present, else by score desc."""
    if "rank" in preds.columns:
        order = [F.col("rank").asc(), F.col("app_id").cast("string").asc()]
    else:
        order = [F.col("score").desc(), F.col("app_id").cast("string").asc()]
    w = Window.partitionBy("model", "author_id").orderBy(*order)
    return preds.withColumn("pos", F.row_number().over(w))


def idcg(m):
    """Ideal DCG for m relevant items: sum_{i=1..m} 1/log2(i+1)."""
    return F.when(m > 0, F.aggregate(F.sequence(F.lit(1), m), F.lit(0.0),
                                     lambda acc, i: acc + F.lit(1.0) / F.log2(i + 1))
                  ).otherwise(F.lit(0.0))


def per_user_metrics(preds: DataFrame, truth: DataFrame, ks=DEFAULT_KS,
                     users: DataFrame | None = None, models=None) -> DataFrame:
    """EV-3..EV-9: (model, user_id, k, precision, recall, f1, ndcg).

    users=None -> policy A (EV-8): users that have both predictions and at
    least one positive test item.  users=<DataFrame> -> policy B (EV-9):
    every listed user for every model; no predictions or no positives
    count as 0.
    """
    ranked = order_predictions(preds)
    n_true = truth.groupBy("author_id").agg(F.count(F.lit(1)).alias("n_true"))
    t = truth.select("author_id", "app_id", F.lit(1).alias("hit"))
    rows = (ranked.join(t, ["author_id", "app_id"], "left")
            .withColumn("hit", F.coalesce(F.col("hit"), F.lit(0)))
            .withColumn("k", F.explode(F.array(*[F.lit(int(k)) for k in ks])))
            .where(F.col("pos") <= F.col("k")))
    agg = rows.groupBy("model", "author_id", "k").agg(
        F.count(F.lit(1)).alias("n_top"),
        F.sum("hit").alias("hits"),
        F.sum(F.col("hit") / F.log2(F.col("pos") + 1)).alias("dcg"),
    )
    if users is None:
        base = agg.join(n_true, "author_id")
    else:
        model_list = models if models is not None else [
            r[0] for r in preds.select("model").distinct().orderBy("model").collect()]
        grid = (users.select("author_id")
                .withColumn("model", F.explode(F.array(*[F.lit(m) for m in model_list])))
                .withColumn("k", F.explode(F.array(*[F.lit(int(k)) for k in ks]))))
        base = (grid.join(agg, ["model", "author_id", "k"], "left")
                .join(n_true, "author_id", "left"))
    n_top = F.coalesce(F.col("n_top"), F.lit(0))
    hits = F.coalesce(F.col("hits"), F.lit(0)).cast("double")
    nt = F.coalesce(F.col("n_true"), F.lit(0))
    prec = hits / F.greatest(n_top, F.lit(1))
    rec = F.when(nt > 0, hits / nt).otherwise(F.lit(0.0))
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(F.lit(0.0))
    ideal = idcg(F.least(F.col("k"), nt))
    ndcg = F.when(ideal > 0, F.coalesce(F.col("dcg"), F.lit(0.0)) / ideal).otherwise(F.lit(0.0))
    return base.select(
        "model", F.col("author_id").alias("user_id"), F.col("k").cast("int").alias("k"),
        prec.alias("precision"), rec.alias("recall"), f1.alias("f1"), ndcg.alias("ndcg"))


def summary(per_user: DataFrame) -> DataFrame:
    """EV-10: mean F1 / nDCG (and P, R) by (model, k)."""
    return per_user.groupBy("model", "k").agg(
        F.avg("precision").alias("precision"), F.avg("recall").alias("recall"),
        F.avg("f1").alias("f1"), F.avg("ndcg").alias("ndcg"))


def leaderboard(summ: DataFrame, metric: str = "f1", k: int = 10) -> DataFrame:
    """EV-11: models at K=k (else the smallest K), sorted by the metric desc."""
    ks = summ.select("k").distinct()
    target = F.coalesce(
        ks.where(F.col("k") == k).select(F.max("k")).scalar(),
        ks.select(F.min("k")).scalar())
    return (summ.where(F.col("k") == target)
            .select("model", "k", F.col(metric).alias("value"))
            .withColumn("place", F.row_number().over(
                Window.partitionBy("k").orderBy(F.col("value").desc(), "model"))))


def metric_by_k(summ: DataFrame, metric: str, ks=DEFAULT_KS) -> DataFrame:
    """EV-12: one row per model, one column per K (missing -> null)."""
    return (summ.groupBy("model").pivot("k", [int(k) for k in ks]).agg(F.first(metric))
            .select("model", *[F.col(str(k)).alias(f"{metric}_at_{k}") for k in ks]))


def coverage(preds: DataFrame, items: DataFrame) -> DataFrame:
    """EV-13: distinct recommended items / catalogue size, per model."""
    n_items = items.select(F.count_distinct("app_id")).scalar()
    return preds.groupBy("model").agg(
        F.count_distinct("app_id").alias("n_recommended"),
        (F.count_distinct("app_id") / n_items).alias("coverage"))


def preview(preds: DataFrame, users: DataFrame, n: int = 5) -> DataFrame:
    """SL-8: for sampled users, the first n items of each model as an ordered list."""
    top = preds.join(users.select("author_id"), "author_id", "left_semi").where(F.col("rank") <= n)
    return top.groupBy("model", "author_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "app_id"))), lambda s: s["app_id"]).alias("top"))
