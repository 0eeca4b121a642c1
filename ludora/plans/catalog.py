"""Registry of named queries: Spark callable + DuckDB oracle SQL.

`QUERIES[name] = (fn(spark, sf_dir) -> DataFrame, sql or None)`.  Doubles
derived from sums are rounded to 9 digits on both sides so the order of
floating-point additions cannot change a value hash.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean
from ..sources import fixtures
from . import base, recommend
from .sql import metrics_ctes, with_
from .stages import stages

QUERIES: dict = {}
R = 9


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = (fn, sql)
        return fn
    return deco


def rnd(*cols):
    return [F.round(F.col(c), R).alias(c) for c in cols]


# --- integration and cleaning -------------------------------------------------

@register("jn1_merged", with_(["merged"], "SELECT * FROM merged"))
def q_merged(spark, sf):
    return fixtures.merged(spark, sf)


@register("pl2_preprocessed", with_(["pre"], """SELECT * EXCLUDE (user_reviews, price_final, positive_ratio),
 round(user_reviews, 9) AS user_reviews, round(price_final, 9) AS price_final,
 round(positive_ratio, 9) AS positive_ratio FROM pre"""))
def q_preprocessed(spark, sf):
    df = base.preprocessed(spark, sf)
    return df.select(*[c for c in df.columns if c not in clean.SCALE_COLUMNS],
                     *rnd(*clean.SCALE_COLUMNS))


@register("ag40_preprocess_audit", with_(["merged"], """SELECT *, rows_before - rows_after AS removed FROM (
 SELECT 1 AS step_no, 'dedup_id' AS step, n0 AS rows_before, n1 AS rows_after FROM c
 UNION ALL SELECT 2, 'drop_null_content', n1, n2 FROM c
 UNION ALL SELECT 3, 'positive_ratio_0_100', n2, n3 FROM c
 UNION ALL SELECT 4, 'price_final_ge_0', n3, n4 FROM c)""", extra="""
f AS (SELECT row_number() OVER (PARTITION BY id ORDER BY app_id ASC NULLS FIRST, author_id ASC NULLS FIRST,
  is_positive ASC NULLS FIRST, content ASC NULLS FIRST) = 1 AS k1, content IS NOT NULL AS k2,
  coalesce(positive_ratio, 0) BETWEEN 0 AND 100 AS k3, coalesce(price_final, 0) >= 0 AS k4 FROM merged),
c AS (SELECT count(*) AS n0, count_if(k1) AS n1, count_if(k1 AND k2) AS n2, count_if(k1 AND k2 AND k3) AS n3,
  count_if(k1 AND k2 AND k3 AND k4) AS n4 FROM f)"""))
def q_audit(spark, sf):
    return clean.preprocess_audit(fixtures.merged(spark, sf))


# --- split --------------------------------------------------------------------

@register("wn1_holdout_test", with_(["test"], "SELECT * FROM test"))
def q_holdout_test(spark, sf):
    return stages(spark, sf).test


@register("wn1_holdout_train", with_(["train"], "SELECT * FROM train"))
def q_holdout_train(spark, sf):
    return stages(spark, sf).train


# --- content-based recommender, flagship chain ------------------------------------

_CBF_PREDS = """cbf_raw AS (SELECT u.author_id, i.app_id, coalesce(z.raw, 0.0) AS raw
 FROM test_users u CROSS JOIN universe i
 LEFT JOIN cbf_nz z ON z.author_id = u.author_id AND z.app_id = i.app_id
 WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.author_id = u.author_id AND s.app_id = i.app_id)),
cbf_norm AS (SELECT author_id, app_id, CASE WHEN max(raw) OVER (PARTITION BY author_id) > 0
 THEN raw / max(raw) OVER (PARTITION BY author_id) ELSE raw END AS score FROM cbf_raw),
cbf_ranked AS (SELECT *, row_number() OVER (PARTITION BY author_id ORDER BY round(score, 9) DESC,
 CAST(app_id AS VARCHAR) ASC) AS rank FROM cbf_norm),
preds AS (SELECT 'CBF' AS model, author_id, app_id, CAST(rank AS INT) AS rank, score
 FROM cbf_ranked WHERE rank <= 20)"""

_CBF_DEPS = ["test_users", "universe", "seen", "cbf_nz", "truth", "ks"]


def _cbf_sql(select: str, extra: str = "") -> str:
    return with_(_CBF_DEPS, select, extra=_CBF_PREDS + ("," + extra if extra else ""))


@register("sl4_cbf_top20", _cbf_sql("SELECT model, author_id, app_id, rank, round(score, 9) AS score FROM preds"))
def q_cbf_top20(spark, sf):
    return recommend.cbf_predictions(spark, sf, 20).select(
        "model", "author_id", "app_id", "rank", *rnd("score"))


@register("ev7_cbf_per_user", _cbf_sql("""SELECT model, user_id, k, round(precision, 9) AS precision,
 round(recall, 9) AS recall, round(f1, 9) AS f1, round(ndcg, 9) AS ndcg FROM pu2""", metrics_ctes("preds")))
def q_cbf_per_user(spark, sf):
    per_user, _ = recommend.cbf_evaluation(spark, sf)
    return per_user.select("model", "user_id", "k", *rnd("precision", "recall", "f1", "ndcg"))


@register("ev10_cbf_summary", _cbf_sql("""SELECT model, k, round(avg(precision), 9) AS precision,
 round(avg(recall), 9) AS recall, round(avg(f1), 9) AS f1, round(avg(ndcg), 9) AS ndcg
 FROM pu2 GROUP BY model, k""", metrics_ctes("preds")))
def q_cbf_summary(spark, sf):
    _, summ = recommend.cbf_evaluation(spark, sf)
    return summ.select("model", "k", *rnd("precision", "recall", "f1", "ndcg"))
from . import catalog_profile  # noqa: E402,F401
from . import catalog_more  # noqa: E402,F401
from . import catalog_extra  # noqa: E402,F401
from . import catalog_models  # noqa: E402,F401
from . import catalog_tfidf  # noqa: E402,F401
from . import catalog_checks  # noqa: E402,F401
from . import catalog_forms  # noqa: E402,F401
