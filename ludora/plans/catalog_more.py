"""Registered queries: text functions, TF-IDF, split/index/candidate windows,
CBF variants, cold start, metric tables and the full model comparisons."""

from __future__ import annotations


from pyspark.sql import functions as F

from ..functions import text as TX
from ..models.cbf import fit_cbf
from ..operators import metrics, scoring
from ..operators.candidates import candidate_pool
from ..operators.split import dense_index, first_users
from ..sources import fixtures
from ..sources.tables import table
from . import compare, recommend
from .catalog import register, rnd
from .sql import WORD_RE, with_
from .stages import stages


# --- scalar text functions -------------------------------------------------------

@register("fn1_clean_text", with_(["games"], """SELECT app_id,
 regexp_replace(lower(coalesce(title, '')), '[^a-z0-9 ]', '', 'g') AS clean_title FROM games"""))
def q_fn1(s, sf):
    return fixtures.games(s, sf).select("app_id", TX.clean_text("title").alias("clean_title"))


@register("fn2_clean_text_compact", with_(["games"], """SELECT app_id,
 regexp_replace(lower(coalesce(title, '')), '[^a-z0-9]', '', 'g') AS token FROM games"""))
def q_fn2(s, sf):
    return fixtures.games(s, sf).select("app_id", TX.clean_text_compact("title").alias("token"))


@register("fn3_whitespace_token_counts", """SELECT doc_id,
 CAST(len(list_filter(regexp_split_to_array(trim(coalesce(text, '')), '\\s+'), lambda t: t <> '')) AS INT) AS n_tokens
 FROM documents""")
def q_fn3(s, sf):
    d = table(s, sf, "documents")
    return d.select("doc_id", F.size(TX.whitespace_tokens("text")).alias("n_tokens"))


@register("fn5_title_bigrams", with_(["games"], """SELECT app_id, CAST(len(g) AS INT) AS n_grams, g AS grams FROM (
 SELECT app_id, CASE WHEN len(t) >= 2 THEN list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))
 ELSE t END AS g FROM (SELECT app_id, regexp_extract_all(lower(coalesce(title, '')), '""" + WORD_RE + """') AS t FROM games))"""))
def q_fn5(s, sf):
    g = fixtures.games(s, sf).select("app_id", TX.with_bigrams(TX.word_tokens("title")).alias("grams"))
    return g.select("app_id", F.size("grams").alias("n_grams"), "grams")


@register("fn6_text_length_prefix", """SELECT doc_id, CAST(char_length(text) AS INT) AS n_chars_text,
 substring(text, 1, 100) AS prefix FROM documents""")
def q_fn6(s, sf):
    d = table(s, sf, "documents")
    return d.select("doc_id", F.char_length("text").alias("n_chars_text"), F.substring("text", 1, 100).alias("prefix"))


# --- TF-IDF -------------------------------------------------------------------------

@register("tf2_title_tfidf", with_(["rep_vec"], "SELECT title, term, round(weight, 9) AS weight FROM rep_vec"))
def q_tf2(s, sf):
    st = stages(s, sf)
    return fit_cbf(st.train, st.items).vectors.select("title", "term", *rnd("weight"))


# --- split, indexes, candidate cap ------------------------------------------------

@register("sl7_first_test_users", with_(["test_users"], """SELECT author_id FROM test_users
 ORDER BY CAST(author_id AS VARCHAR) LIMIT 300"""))
def q_sl7(s, sf):
    return first_users(stages(s, sf).test, 300)


@register("wn6_user_index_first_appearance", with_(["inter"], """SELECT author_id,
 row_number() OVER (ORDER BY first_id, author_id) - 1 AS idx FROM
 (SELECT author_id, min(id) AS first_id FROM inter WHERE author_id IS NOT NULL GROUP BY author_id)"""))
def q_wn6(s, sf):
    return dense_index(stages(s, sf).interactions, "author_id", order="id")


@register("wn7_item_index_sorted", with_(["inter"], """SELECT app_id, row_number() OVER (ORDER BY app_id) - 1 AS idx
 FROM (SELECT DISTINCT app_id FROM inter WHERE app_id IS NOT NULL)"""))
def q_wn7(s, sf):
    return dense_index(stages(s, sf).interactions, "app_id")


@register("wn8_candidate_cap", with_(["train", "test_users"], """SELECT author_id, count(*) AS n_candidates,
 min(CAST(app_id AS VARCHAR)) AS first_item, max(CAST(app_id AS VARCHAR)) AS last_item FROM (
 SELECT u.author_id, i.app_id, row_number() OVER (PARTITION BY u.author_id ORDER BY CAST(i.app_id AS VARCHAR)) AS rn
 FROM test_users u
 CROSS JOIN (SELECT DISTINCT app_id FROM train) i
 WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.author_id = u.author_id AND t.app_id = i.app_id))
 WHERE rn <= 2000 GROUP BY author_id"""))
def q_wn8(s, sf):
    st = stages(s, sf)
    users = first_users(st.test, None)
    pool = candidate_pool(users, st.train_ranked_items, st.train.select("author_id", "app_id"), cap=2000)
    # ranks are the string order, and numbers need no sort to be aggregated
    ends = pool.groupBy("author_id").agg(F.count(F.lit(1)).alias("n_candidates"), F.min("item_rank").alias("lo"), F.max("item_rank").alias("hi"))
    names = st.train_ranked_items.select("item_rank", F.col("app_id").cast("string").alias("name"))
    first, last = (names.select(F.col("item_rank").alias(end), F.col("name").alias(item)) for end, item in (("lo", "first_item"), ("hi", "last_item")))
    return ends.join(first, "lo").join(last, "hi").select("author_id", "n_candidates", "first_item", "last_item")


# --- per-user tables --------------------------------------------------------------

@register("ag36_user_item_lists", with_(["train"], """SELECT author_id, list_sort(list(app_id)) AS items,
 list_sort(list(DISTINCT app_id)) AS item_set FROM train GROUP BY author_id"""))
def q_ag36(s, sf):
    t = stages(s, sf).train
    return t.groupBy("author_id").agg(F.array_sort(F.collect_list("app_id")).alias("items"),
                                      F.array_sort(F.collect_set("app_id")).alias("item_set"))


@register("ag37_global_mean_rating", with_(["train"], """SELECT round(avg(is_positive_encoded), 9) AS mu,
 count(*) AS n_rows FROM train"""))
def q_ag37(s, sf):
    t = stages(s, sf).train
    return t.agg(F.round(F.avg("is_positive_encoded"), 9).alias("mu"), F.count(F.lit(1)).alias("n_rows"))


@register("ag39_split_user_overlap", with_(["train", "test"], """SELECT
 (SELECT count(DISTINCT author_id) FROM train) AS train_users,
 (SELECT count(DISTINCT author_id) FROM test) AS test_users,
 (SELECT count(*) FROM (SELECT author_id FROM train INTERSECT SELECT author_id FROM test)) AS both_users"""))
def q_ag39(s, sf):
    st = stages(s, sf)
    tr = st.train.select("author_id").distinct()
    te = st.test.select("author_id").distinct()
    return s.range(1).select(
        tr.select(F.count(F.lit(1))).scalar().alias("train_users"),
        te.select(F.count(F.lit(1))).scalar().alias("test_users"),
        tr.intersect(te).select(F.count(F.lit(1))).scalar().alias("both_users"))


@register("rc20_unknown_test_users", with_(["train", "test_users"], """SELECT u.author_id,
 'no_train_history' AS status FROM test_users u WHERE u.author_id NOT IN (SELECT author_id FROM train)"""))
def q_rc20(s, sf):
    st = stages(s, sf)
    unknown = st.test.select("author_id").distinct().join(st.train.select("author_id"), "author_id", "left_anti")
    return unknown.withColumn("status", F.lit("no_train_history"))


@register("rc21_taste_titles", with_(["train"], """SELECT author_id, n_liked_titles,
 array_to_string(list_slice(titles, 1, 3), ', ') AS first_titles FROM (
 SELECT author_id, CAST(count(DISTINCT title) AS INT) AS n_liked_titles, list_sort(list(DISTINCT title)) AS titles
 FROM train WHERE is_positive_encoded = 1 AND title IS NOT NULL GROUP BY author_id)"""))
def q_rc21(s, sf):
    t = stages(s, sf).train.where((F.col("is_positive_encoded") == 1) & F.col("title").isNotNull())
    g = t.groupBy("author_id").agg(F.array_sort(F.collect_set("title")).alias("titles"))
    return g.select("author_id", F.size("titles").alias("n_liked_titles"),
                    F.concat_ws(", ", F.slice("titles", 1, 3)).alias("first_titles"))


@register("rc5_cbf_mean_similarity", with_(["test", "cbf_prof", "rep", "rep_vec", "likes"], """SELECT t.author_id, t.app_id,
 round(coalesce(s.sim, 0.0) / CASE WHEN coalesce(n.n_liked, 0) > 0 THEN n.n_liked ELSE 1 END, 9) AS cbf_mean
 FROM test t
 LEFT JOIN (SELECT p.author_id, r.app_id, sum(p.pw * v.weight) AS sim FROM cbf_prof p
   JOIN rep_vec v ON p.term = v.term JOIN rep r ON r.title = v.title GROUP BY p.author_id, r.app_id) s
   ON s.author_id = t.author_id AND s.app_id = t.app_id
 LEFT JOIN (SELECT l.author_id, count(*) AS n_liked FROM likes l JOIN rep r ON l.app_id = r.app_id GROUP BY l.author_id) n
   ON n.author_id = t.author_id"""))
def q_rc5(s, sf):
    st = stages(s, sf)
    m = fit_cbf(st.train, st.items)
    sc = m.score_pairs(st.test.select("author_id", "app_id"), "sim").join(m.n_liked(), "author_id", "left")
    nl = F.coalesce(F.col("n_liked"), F.lit(0))
    return sc.select("author_id", "app_id",
                     F.round(F.col("sim") / F.when(nl > 0, nl).otherwise(F.lit(1)), 9).alias("cbf_mean"))


# --- metric tables over the CBF predictions ------------------------------------------

from .catalog import _cbf_sql  # noqa: E402


@register("ev13_cbf_coverage", _cbf_sql("""SELECT model, count(DISTINCT app_id) AS n_recommended,
 round(count(DISTINCT app_id) * 1.0 / (SELECT count(DISTINCT app_id) FROM universe), 9) AS coverage
 FROM preds GROUP BY model"""))
def q_ev13(s, sf):
    preds = recommend.cbf_predictions(s, sf)
    cov = metrics.coverage(preds, stages(s, sf).interactions)
    return cov.select("model", "n_recommended", *rnd("coverage"))


@register("ag38_cbf_score_variance", _cbf_sql("""SELECT model, author_id, round(var_pop(score), 9) AS score_var,
 var_pop(score) = 0 AS flat FROM preds GROUP BY model, author_id"""))
def q_ag38(s, sf):
    v = scoring.score_variance(recommend.cbf_predictions(s, sf))
    return v.select("model", "author_id", F.round("score_var", 9).alias("score_var"), "flat")


# --- full pipelines (fitted models: rows-only check) ----------------------------------

@register("ev15_summary_7_models")
def q_ev15(s, sf):
    _, _, summ = compare.ev15(s, sf)
    return summ


@register("ev16_summary_6_models")
def q_ev16(s, sf):
    _, _, summ = compare.ev16(s, sf)
    return summ


@register("ev15_predictions_7_models")
def q_ev15p(s, sf):
    preds, _, _ = compare.ev15(s, sf)
    return preds


@register("ev12_f1_by_k_7_models")
def q_ev12(s, sf):
    _, _, summ = compare.ev15(s, sf)
    return metrics.metric_by_k(summ, "f1")


@register("ev11_leaderboard_ndcg")
def q_ev11(s, sf):
    _, _, summ = compare.ev15(s, sf)
    return metrics.leaderboard(summ, "ndcg", 10)
