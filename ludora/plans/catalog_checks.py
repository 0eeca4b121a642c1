"""Registered queries with an oracle for operators that otherwise only run on fitted models."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.vectors import cosine
from ..operators import metrics
from ..sources.tables import table
from . import recommend
from .catalog import _cbf_sql, register, rnd
from .sql import metrics_ctes
from .stages import stages

#: The content-based lists and the same lists read from their end: two models with known scores.
_TWO = """two AS (SELECT model, author_id, app_id, rank FROM preds
 UNION ALL SELECT 'CBF reversed', author_id, app_id, 21 - rank FROM preds), """
_SUMMARY = """, summ AS (SELECT model, k, avg(f1) AS f1, avg(ndcg) AS ndcg FROM pu2 GROUP BY model, k)"""


def _two(s, sf):
    preds = recommend.cbf_predictions(s, sf).select("model", "author_id", "app_id", "rank")
    return preds.unionByName(preds.withColumn("model", F.lit("CBF reversed")).withColumn("rank", 21 - F.col("rank")))


def _per_user(s, sf):
    """Policy B: every test user counts for every model."""
    test = stages(s, sf).test
    return metrics.per_user_metrics(_two(s, sf), metrics.ground_truth(test), users=test.select("author_id").distinct())


@register("ev9_cbf_every_test_user", _cbf_sql("""SELECT model, user_id, k, round(precision, 9) AS precision,
 round(recall, 9) AS recall, round(f1, 9) AS f1, round(ndcg, 9) AS ndcg FROM pu2""", _TWO + metrics_ctes("two", "test_users")))
def q_ev9(s, sf):
    return _per_user(s, sf).select("model", "user_id", "k", *rnd("precision", "recall", "f1", "ndcg"))


@register("ev11_cbf_leaderboard", _cbf_sql("""SELECT model, k, round(ndcg, 9) AS value,
 CAST(row_number() OVER (ORDER BY ndcg DESC, model) AS INT) AS place FROM summ WHERE k = 10""",
                                           _TWO + metrics_ctes("two", "test_users") + _SUMMARY))
def q_ev11_cbf(s, sf):
    return metrics.leaderboard(metrics.summary(_per_user(s, sf)), "ndcg", 10).select("model", "k", *rnd("value"), "place")


@register("ev12_cbf_f1_by_k", _cbf_sql("""SELECT model, round(max(f1) FILTER (k = 5), 9) AS f1_at_5,
 round(max(f1) FILTER (k = 10), 9) AS f1_at_10, round(max(f1) FILTER (k = 20), 9) AS f1_at_20 FROM summ GROUP BY model""",
                                       _TWO + metrics_ctes("two", "test_users") + _SUMMARY))
def q_ev12_cbf(s, sf):
    by_k = metrics.metric_by_k(metrics.summary(_per_user(s, sf)), "f1")
    return by_k.select("model", *rnd("f1_at_5", "f1_at_10", "f1_at_20"))


@register("fn10_cosine_next_embedding", """SELECT a.vec_id, round(
 list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e)) + 1e-8), 6) AS cosine
 FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings) a
 JOIN (SELECT vec_id - 1 AS vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings) b ON a.vec_id = b.vec_id""")
def q_fn10(s, sf):
    rows = table(s, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e"))
    later = rows.select((F.col("vec_id") - 1).alias("vec_id"), F.col("e").alias("e_next"))
    return rows.join(later, "vec_id").select("vec_id", F.round(cosine(F.col("e"), F.col("e_next")), 6).alias("cosine"))
