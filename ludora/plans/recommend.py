"""Recommendation pipelines: CBF top-K over all unseen items, evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..models.cbf import cbf_top_k
from ..operators import metrics
from .stages import stages


def cbf_predictions(spark: SparkSession, sf_dir: str, k: int = 20) -> DataFrame:
    """RC-4 + SL-4 for every test user, candidates = all items - train items."""
    st = stages(spark, sf_dir)
    from .compare import fit_all   # fitted tables written once per stage set
    model = fit_all(st, which=("cbf",))["cbf"]
    users = st.test.select("author_id").distinct()
    top = cbf_top_k(model, users, st.ranked_items, st.train.select("author_id", "app_id"), k)
    return top.select(F.lit("CBF").alias("model"), "author_id", "app_id",
                      F.col("rank").cast("int").alias("rank"), "score")


def cbf_evaluation(spark: SparkSession, sf_dir: str, k: int = 20, ks=metrics.DEFAULT_KS):
    st = stages(spark, sf_dir)
    preds = cbf_predictions(spark, sf_dir, k)
    per_user = metrics.per_user_metrics(preds, metrics.ground_truth(st.test), ks)
    return per_user, metrics.summary(per_user)
