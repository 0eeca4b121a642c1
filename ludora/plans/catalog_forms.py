"""Registered queries: further forms of the profile, source, split and evaluation operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean, metrics
from ..operators import profile as P
from ..operators.split import first_users
from ..sources import fixtures
from ..sources.csv import alternative_layout, normalise_null_tokens
from ..sources.tables import table
from . import recommend
from .catalog import _cbf_sql, register, rnd
from .catalog_profile import _bucket_q, _bucket_sql, _hist_q, _hist_sql
from .sql import with_
from .stages import stages

# Edges and labels of the comparison report's text lengths.
_SHORT_EDGES, _SHORT_LABELS = (None, 10, 50, 200, None), ("very short", "short", "medium", "long")


@register("sc2_null_tokens_documents", "SELECT doc_id, CASE WHEN text NOT IN ('', ' ', 'NA', 'N/A', 'null', 'None') THEN sha256(text) END AS text_sha256, "
          "CASE WHEN lang NOT IN ('', ' ', 'NA', 'N/A', 'null', 'None') THEN lang END AS lang, "
          "CASE WHEN source NOT IN ('', ' ', 'NA', 'N/A', 'null', 'None') THEN source END AS source FROM documents")
def q_sc2(s, sf):
    d = normalise_null_tokens(table(s, sf, "documents").select("doc_id", "text", "lang", "source"))
    return d.select("doc_id", F.sha2("text", 256).alias("text_sha256"), "lang", "source")


@register("sc6_alternative_layout", with_(["reviews"], "SELECT is_positive, author_id, app_id FROM reviews"))
def q_sc6(s, sf):
    other = fixtures.reviews(s, sf).select(F.col("is_positive").alias("Labeling"), F.col("author_id").alias("username"), F.col("app_id").alias("game id"))
    return alternative_layout(other)


@register("fi3_positive_values", with_(["games"], "SELECT app_id, user_reviews, price_final FROM games WHERE user_reviews > 0 AND price_final > 0"))
def q_fi3(s, sf):
    return fixtures.games(s, sf).where((F.col("user_reviews") > 0) & (F.col("price_final") > 0)).select("app_id", "user_reviews", "price_final")


@register("ag5_most_reviewed_games", with_(["reviews"], """SELECT app_id, count(*) AS count FROM reviews WHERE app_id IS NOT NULL
 GROUP BY app_id ORDER BY count DESC, app_id LIMIT 10"""))
def q_ag5(s, sf):
    return P.value_counts(fixtures.reviews(s, sf), "app_id", n=10, share_of=None)


@register("ag11_paid_price_stats", with_(["games"], """SELECT count(*) AS n_paid, round(avg(price_final), 9) AS mean_price, round(median(price_final), 9) AS median_price,
 min(price_final) AS min_price, max(price_final) AS max_price, count_if(discount > 0) AS n_discounted FROM games WHERE price_final > 0"""))
def q_ag11(s, sf):
    paid = fixtures.games(s, sf).where(F.col("price_final") > 0)
    median = P.exact_quantiles(paid, "price_final", (0.5,)).select("q50").scalar()
    return paid.agg(F.count(F.lit(1)).alias("n_paid"), F.round(F.avg("price_final"), 9).alias("mean_price"), F.min("price_final").alias("min_price"),
                    F.max("price_final").alias("max_price"), F.count_if(F.col("discount") > 0).alias("n_discounted")).withColumn("median_price", F.round(median, 9))


@register("ag15_text_length_four_buckets", with_(["reviews"], _bucket_sql(
    "(SELECT char_length(content) AS len FROM reviews WHERE content IS NOT NULL)", "len", _SHORT_EDGES, _SHORT_LABELS,
    total="(SELECT count(*) FROM reviews WHERE content IS NOT NULL)")))
def q_ag15(s, sf):
    r = fixtures.reviews(s, sf).where(F.col("content").isNotNull())
    return _bucket_q(r, F.char_length("content"), _SHORT_EDGES, _SHORT_LABELS)


_h30 = _hist_sql("games", "price_final", 30)


@register("ag18_price_histogram_30", with_(["games"], _h30[0], extra=_h30[1]))
def q_ag18(s, sf):
    return _hist_q(fixtures.games(s, sf), F.col("price_final"), 30)


_hlog = _hist_sql("pos", "log10(user_reviews)", 50)


@register("ag19_log_positive_reviews_histogram", with_(["games"], _hlog[0], extra="pos AS (SELECT user_reviews FROM games WHERE user_reviews > 0),\n" + _hlog[1]))
def q_ag19(s, sf):
    return _hist_q(fixtures.games(s, sf).where(F.col("user_reviews") > 0), F.log10("user_reviews"), 50)


@register("ag28_positive_share_stats", with_(["reviews"], """SELECT count(*) AS n_games, round(avg(pct), 9) AS mean_pct, round(median(pct), 9) AS median_pct,
 round(stddev_samp(pct), 9) AS std_pct, round(min(pct), 9) AS min_pct, round(max(pct), 9) AS max_pct FROM (
 SELECT app_id, avg(CASE WHEN is_positive = 'Positive' THEN 100.0 ELSE 0.0 END) AS pct FROM reviews WHERE app_id IS NOT NULL GROUP BY app_id)"""))
def q_ag28(s, sf):
    share = F.avg(F.when(F.col("is_positive") == "Positive", 100.0).otherwise(0.0))
    per = fixtures.reviews(s, sf).where(F.col("app_id").isNotNull()).groupBy("app_id").agg(share.alias("pct"))
    median = P.exact_quantiles(per, "pct", (0.5,)).select("q50").scalar()
    out = per.agg(F.count(F.lit(1)).alias("n_games"), *(F.round(f("pct"), 9).alias(f"{n}_pct") for f, n in ((F.avg, "mean"), (F.stddev_samp, "std"), (F.min, "min"), (F.max, "max"))))
    return out.withColumn("median_pct", F.round(median, 9))


@register("ag31_release_summary", with_(["games"], """SELECT count(y) AS valid_dates, round(count(y) * 100.0 / count(*), 9) AS valid_pct,
 CAST(min(y) AS INT) AS first_year, CAST(max(y) AS INT) AS last_year, round(count(y) * 1.0 / count(DISTINCT y), 9) AS mean_per_year
 FROM (SELECT year(date_release) AS y FROM games)"""))
def q_ag31(s, sf):
    y = fixtures.games(s, sf).select(F.year("date_release").alias("y"))
    return y.agg(F.count("y").alias("valid_dates"), F.round(F.count("y") * 100.0 / F.count(F.lit(1)), 9).alias("valid_pct"), F.min("y").alias("first_year"),
                 F.max("y").alias("last_year"), F.round(F.count("y") * 1.0 / F.count_distinct("y"), 9).alias("mean_per_year"))


@register("ag41_rating_side_by_side", with_(["merged"], """SELECT coalesce(a.rating, b.rating) AS rating, coalesce(a.n, 0) AS n_games,
 round(coalesce(a.n, 0) * 100.0 / (SELECT count(*) FROM games), 9) AS games_pct, coalesce(b.n, 0) AS n_merged,
 round(coalesce(b.n, 0) * 100.0 / (SELECT count(*) FROM merged), 9) AS merged_pct FROM
 (SELECT rating, count(*) AS n FROM games WHERE rating IS NOT NULL GROUP BY 1) a FULL OUTER JOIN
 (SELECT rating, count(*) AS n FROM merged WHERE rating IS NOT NULL GROUP BY 1) b ON a.rating = b.rating"""))
def q_ag41(s, sf):
    a, b = (P.value_counts(df, "rating").select("rating", F.col("count").alias(f"n_{n}"), F.col("share_pct").alias(f"{n}_pct"))
            for df, n in ((fixtures.games(s, sf), "games"), (fixtures.merged(s, sf), "merged")))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return a.join(b, "rating", "full").select("rating", zero("n_games").alias("n_games"), F.round(zero("games_pct"), 9).alias("games_pct"),
                                              zero("n_merged").alias("n_merged"), F.round(zero("merged_pct"), 9).alias("merged_pct"))


@register("tf14_standardised_games", with_(["games"], """SELECT app_id, round((user_reviews - (SELECT avg(user_reviews) FROM games)) / (SELECT stddev_pop(user_reviews) FROM games), 6) AS user_reviews,
 round((price_final - (SELECT avg(price_final) FROM games)) / (SELECT stddev_pop(price_final) FROM games), 6) AS price_final FROM games"""))
def q_tf14(s, sf):
    g = clean.standardize(fixtures.games(s, sf).select("app_id", "user_reviews", "price_final"), ("user_reviews", "price_final"))
    return g.select("app_id", F.round("user_reviews", 6).alias("user_reviews"), F.round("price_final", 6).alias("price_final"))


@register("st2_first_interaction_per_pair", with_(["inter"], """SELECT id, author_id, app_id, is_positive_encoded FROM (SELECT *, row_number() OVER
 (PARTITION BY author_id, app_id ORDER BY id) AS rn FROM inter) WHERE rn = 1"""))
def q_st2(s, sf):
    return clean.dedup_first(stages(s, sf).interactions, ["author_id", "app_id"], ["id"]).select("id", "author_id", "app_id", "is_positive_encoded")


@register("ev2_predictions_in_order", with_(["train"], """SELECT 'Popularity' AS model, t.author_id, t.app_id, p.score,
 CAST(row_number() OVER (PARTITION BY t.author_id ORDER BY p.score DESC, CAST(t.app_id AS VARCHAR)) AS INT) AS pos
 FROM (SELECT DISTINCT author_id, app_id FROM train) t JOIN (SELECT app_id, CAST(count(*) AS DOUBLE) AS score FROM train GROUP BY app_id) p ON p.app_id = t.app_id"""))
def q_ev2(s, sf):
    """EV-2: predictions without a rank are ordered by their score (here the popularity of a user's own items)."""
    train = stages(s, sf).train
    score = train.groupBy("app_id").agg(F.count(F.lit(1)).cast("double").alias("score"))
    preds = train.select("author_id", "app_id").distinct().join(score, "app_id").select(F.lit("Popularity").alias("model"), "author_id", "app_id", "score")
    return metrics.order_predictions(preds)


@register("sl8_preview_first_users", _cbf_sql("""SELECT model, author_id, string_agg(CAST(app_id AS VARCHAR), ',' ORDER BY rank) AS top FROM preds
 WHERE rank <= 5 AND author_id IN (SELECT author_id FROM test_users ORDER BY CAST(author_id AS VARCHAR) LIMIT 10) GROUP BY model, author_id"""))
def q_sl8(s, sf):
    """SL-8: the limit on users and ranks is the feature, a preview."""
    shown = metrics.preview(recommend.cbf_predictions(s, sf, 20), first_users(stages(s, sf).test, 10), 5)
    return shown.select("model", "author_id", F.array_join(F.transform("top", lambda x: x.cast("string")), ",").alias("top"))


@register("rc21_all_rated_titles", with_(["inter"], """SELECT author_id, count(*) AS n_titles, string_agg(title, ',' ORDER BY title) AS titles
 FROM (SELECT DISTINCT author_id, title FROM inter WHERE title IS NOT NULL) GROUP BY author_id"""))
def q_rc21(s, sf):
    """RC-21 over all rated items; a user's list holds each title once, so it is no longer than the catalogue."""
    t = stages(s, sf).interactions.where(F.col("title").isNotNull()).select("author_id", "title").distinct()
    lists = t.groupBy("author_id").agg(F.sort_array(F.collect_list("title")).alias("titles"))
    return lists.select("author_id", F.size("titles").cast("long").alias("n_titles"), F.array_join("titles", ",").alias("titles"))


@register("sk2_held_out_with_history", with_(["train", "test"], """SELECT t.author_id, t.app_id, coalesce(n.n_train, 0) AS n_train,
 coalesce(n.n_train_positive, 0) AS n_train_positive, coalesce(t.is_positive_encoded, 0) = 1 AS held_out_positive
 FROM test t LEFT JOIN (SELECT author_id, count(*) AS n_train, count_if(is_positive_encoded = 1) AS n_train_positive
 FROM train GROUP BY author_id) n ON n.author_id = t.author_id"""))
def q_sk2(s, sf):
    """SK-2: the held-out row of each user beside the user's history, read from the bucketed split without an exchange."""
    return held_out_with_history(**stages(s, sf).split)


def held_out_with_history(train_split, test_split, test_positive):
    """A row per test row; a user has one (WN-1), so the author alone finds its positive: all joins follow the buckets."""
    history = train_split.groupBy("author_id").agg(F.count(F.lit(1)).alias("n_train"), F.count_if(F.col("is_positive_encoded") == 1).alias("n_train_positive"))
    positive = test_positive.select("author_id", F.col("app_id").alias("positive_app"))
    return (test_split.select("author_id", "app_id").join(history, "author_id", "left").join(positive, "author_id", "left")
            .select("author_id", "app_id", F.coalesce("n_train", F.lit(0)).alias("n_train"), F.coalesce("n_train_positive", F.lit(0)).alias("n_train_positive"),
                    F.coalesce(F.col("positive_app") == F.col("app_id"), F.lit(False)).alias("held_out_positive")))
