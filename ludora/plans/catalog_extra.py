"""Registered queries: labels and filters, joins, sorts, hybrid combinations
fed with deterministic scores (popularity as the CF input, `sql*`)."""

from __future__ import annotations


from pyspark.sql import functions as F

from ..models import hybrid
from ..models.cbf import fit_cbf
from ..operators import clean
from ..operators.blocked import Base, spread, top_items
from ..operators.scoring import top_k
from ..operators.split import first_users
from ..session import written
from ..sources import fixtures
from ..sources.csv import with_surrogate_id
from . import compare
from .catalog import register, rnd
from .sql import with_
from .stages import stages


@register("pr2_pr3_label_encodings", with_(["reviews"], """SELECT id, app_id, author_id,
 CASE WHEN is_positive = 'Positive' THEN 1 ELSE 0 END AS label_binary,
 CASE WHEN is_positive = 'Positive' THEN 1 WHEN is_positive = 'Negative' THEN 0 END AS label_encoded FROM reviews"""))
def q_labels(s, sf):
    r = fixtures.reviews(s, sf)
    return r.select("id", "app_id", "author_id", clean.binary_label().alias("label_binary"),
                    clean.encode_label().alias("label_encoded"))


@register("pr9_fi4_platform_count_2000_2024", with_(["games"], """SELECT app_id,
 CAST(win AS INT) + CAST(mac AS INT) + CAST(linux AS INT) + CAST(steam_deck AS INT) AS platform_count,
 CAST(year(date_release) AS INT) AS year FROM games WHERE year(date_release) BETWEEN 2000 AND 2024"""))
def q_pr9(s, sf):
    g = fixtures.games(s, sf)
    pc = sum(F.col(p).cast("int") for p in ("win", "mac", "linux", "steam_deck"))
    return (g.select("app_id", pc.alias("platform_count"), F.year("date_release").alias("year"))
            .where(F.col("year").between(2000, 2024)))


@register("fi7_active_users_min2", with_(["inter"], """SELECT * FROM inter WHERE author_id IN (
 SELECT author_id FROM inter GROUP BY author_id HAVING count(*) >= 2)"""))
def q_fi7(s, sf):
    return clean.min_interactions(stages(s, sf).interactions, 2)


@register("fi6_ev1_test_positives", with_(["truth"], "SELECT author_id, app_id FROM truth"))
def q_fi6(s, sf):
    from ..operators.metrics import ground_truth
    return ground_truth(stages(s, sf).test)


@register("jn12_first_row_top_titles", with_(["merged"], """SELECT t.title, t.n_reviews, f.app_id AS first_app_id
 FROM (SELECT title, count(*) AS n_reviews FROM merged WHERE id IS NOT NULL AND title IS NOT NULL GROUP BY title
       ORDER BY n_reviews DESC, title ASC LIMIT 10) t
 JOIN (SELECT title, min(app_id) AS app_id FROM games GROUP BY title) f ON f.title = t.title"""))
def q_jn12(s, sf):
    m = fixtures.merged(s, sf)
    top = (m.where(F.col("id").isNotNull() & F.col("title").isNotNull()).groupBy("title")
           .agg(F.count(F.lit(1)).alias("n_reviews")).orderBy(F.col("n_reviews").desc(), "title").limit(10))
    first = fixtures.games(s, sf).groupBy("title").agg(F.min("app_id").alias("first_app_id"))
    return top.join(first, "title")


@register("jn2_jn5_titles_lookup", with_(["test", "games"], """SELECT t.author_id, t.app_id,
 coalesce(g.title, 'Title Missing') AS title FROM test t LEFT JOIN games g ON g.app_id = t.app_id"""))
def q_jn2(s, sf):
    titles = fixtures.games(s, sf).select("app_id", F.col("title").alias("t"))
    return (stages(s, sf).test.select("author_id", "app_id").join(titles, "app_id", "left")
            .select("author_id", "app_id", F.coalesce("t", F.lit("Title Missing")).alias("title")))


@register("st8_sorted_item_keys", with_(["universe"], """SELECT CAST(app_id AS VARCHAR) AS item,
 row_number() OVER (ORDER BY CAST(app_id AS VARCHAR)) - 1 AS item_rank FROM universe"""))
def q_st8(s, sf):
    r = stages(s, sf).ranked_items
    return r.select(F.col("app_id").cast("string").alias("item"), "item_rank")


@register("sc7_surrogate_review_id", with_(["reviews"], """SELECT author_id, app_id, is_positive,
 row_number() OVER (ORDER BY author_id, app_id, is_positive) - 1 AS rid
 FROM reviews"""))
def q_sc7(s, sf):
    r = fixtures.reviews(s, sf).select("author_id", "app_id", "is_positive")
    return with_surrogate_id(r, ["author_id", "app_id", "is_positive"], "rid")


# --- hybrid combinations with deterministic inputs (sql*) ---------------------------

_GRID = """grid AS (SELECT u.author_id, i.app_id FROM test_users u CROSS JOIN (SELECT DISTINCT app_id FROM train) i
 WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.author_id = u.author_id AND t.app_id = i.app_id)),
pop AS (SELECT app_id, CAST(count(*) AS DOUBLE) AS pop FROM train WHERE is_positive_encoded = 1 GROUP BY app_id),
sc AS (SELECT g.author_id, g.app_id, coalesce(p.pop, 0.0) AS cf_raw, coalesce(z.raw, 0.0) AS cbf_raw
 FROM grid g LEFT JOIN pop p ON p.app_id = g.app_id
 LEFT JOIN cbf_nz z ON z.author_id = g.author_id AND z.app_id = g.app_id),
nm AS (SELECT *,
 CASE WHEN max(cf_raw) OVER w > min(cf_raw) OVER w THEN (cf_raw - min(cf_raw) OVER w) / (max(cf_raw) OVER w - min(cf_raw) OVER w) ELSE cf_raw END AS cf,
 CASE WHEN max(cbf_raw) OVER w > 0 THEN cbf_raw / max(cbf_raw) OVER w ELSE cbf_raw END AS cbf
 FROM sc WINDOW w AS (PARTITION BY author_id)),
h AS (SELECT *, 0.3 * cf + 0.7 * cbf AS h03,
 0.5 * CASE WHEN max(cf) OVER w <> min(cf) OVER w THEN (cf - min(cf) OVER w) / (max(cf) OVER w - min(cf) OVER w + 1e-9) ELSE cf END
 + 0.5 * CASE WHEN max(cbf) OVER w <> min(cbf) OVER w THEN (cbf - min(cbf) OVER w) / (max(cbf) OVER w - min(cbf) OVER w + 1e-9) ELSE cbf END AS h05,
 (cf + cbf) / 2.0 AS hmean
 FROM nm WINDOW w AS (PARTITION BY author_id)),
lg AS (SELECT 'Hybrid_0.3_0.7' AS model, author_id, app_id, h03 AS score FROM h
 UNION ALL SELECT 'Hybrid_0.5_0.5_renorm', author_id, app_id, h05 FROM h
 UNION ALL SELECT 'Mean_stacker', author_id, app_id, hmean FROM h),
rk AS (SELECT *, row_number() OVER (PARTITION BY model, author_id ORDER BY round(score, 9) DESC,
 CAST(app_id AS VARCHAR)) AS rank FROM lg)"""


def _popularity_and_cbf(s, sf):
    """Every test user and train item with the vectors of popularity (the same for all users) and CBF."""
    st = stages(s, sf)
    pop = (st.train.where(F.col("is_positive_encoded") == 1).groupBy("app_id")
           .agg(F.count(F.lit(1)).cast("double").alias("pop")))
    u, i, seen, bases = compare.blocked_tables(st, first_users(st.test, None), st.train_ranked_items, {"cbf": fit_cbf(st.train, st.items)})
    i = i.join(pop, "app_id", "left").withColumn("cf", F.array(F.coalesce("pop", F.lit(0.0))))
    return u.withColumn("cf", F.array(F.lit(1.0))), i, seen, [Base("cf"), *bases]


@register("rc11_rc13_rc18_hybrids_popularity_cf", with_(["test_users", "train", "cbf_nz"], """SELECT model, author_id,
 app_id, CAST(rank AS INT) AS rank, round(score, 9) AS score FROM rk WHERE rank <= 20""", extra=_GRID))
def q_hybrids(s, sf):
    u, i, seen, bases = _popularity_and_cbf(s, sf)

    def combine(raw, lo, hi):
        n = compare.normalise(raw, lo, hi)
        return {"Hybrid_0.3_0.7": hybrid.weighted_scores(n["cf"], n["cbf"], 0.3),
                "Hybrid_0.5_0.5_renorm": compare.half_renormalised(n, lo, hi),
                "Mean_stacker": hybrid.stacked_scores([n["cf"], n["cbf"]], None)}

    top = top_items(u, i, bases, 20, combine, seen, scaled=True, linear=combine, ends=())
    named = top.join(u.select("u", "author_id"), "u").join(i.select("i", "app_id"), "i")
    return named.select(F.col("label").alias("model"), "author_id", "app_id", "rank", *rnd("score"))


@register("rc12_raw_hybrid_components", with_(["test_users", "train", "cbf_nz"], """SELECT r.author_id, r.app_id, t.title,
 CAST(r.rank AS INT) AS rank, round(r.cf_raw, 9) AS cf_score, round(r.cbf, 9) AS cbf_score, round(r.hybrid, 9) AS hybrid_score
 FROM (SELECT *, 0.3 * cf_raw + 0.7 * cbf AS hybrid, row_number() OVER (PARTITION BY author_id
  ORDER BY round(0.3 * cf_raw + 0.7 * cbf, 9) DESC, CAST(app_id AS VARCHAR)) AS rank FROM nm) r
 LEFT JOIN (SELECT app_id, min(title) AS title FROM inter GROUP BY app_id) t ON t.app_id = r.app_id WHERE r.rank <= 10""",
                                               extra=_GRID))
def q_rc12(s, sf):
    """RC-12: the CF score enters as it is; both components stay beside the hybrid score."""
    u, i, seen, bases = _popularity_and_cbf(s, sf)
    ends = written(spread(u, i, bases, seen), "spread")
    top = top_items(u, i, bases, 10, lambda raw, lo, hi: {"h": hybrid.weighted_scores(raw["cf"], compare.max_norm(raw["cbf"], hi["cbf"]), 0.3)},
                    seen, scaled=True, extremes=ends)
    rows = top.join(u.select("u", "author_id"), "u").join(i.select("i", "app_id", "pop"), "i").join(ends, "u")
    rows = fit_cbf(stages(s, sf).train, stages(s, sf).items).score_pairs(rows, "cbf_raw")
    most = F.col("hi")[1]
    titles = stages(s, sf).interactions.groupBy("app_id").agg(F.min("title").alias("title"))
    return rows.join(titles, "app_id", "left").select(
        "author_id", "app_id", "title", "rank", F.round(F.coalesce("pop", F.lit(0.0)), 9).alias("cf_score"),
        F.round(F.when(most > 0, F.col("cbf_raw") / most).otherwise(F.col("cbf_raw")), 9).alias("cbf_score"), F.round("score", 9).alias("hybrid_score"))


@register("sl5_demote_seen_top5", with_(["test_users", "train", "cbf_nz"], """SELECT author_id, app_id, CAST(rank AS INT) AS rank,
 seen FROM (SELECT c.author_id, c.app_id, c.seen, row_number() OVER (PARTITION BY c.author_id
 ORDER BY CAST(c.seen AS INT), round(coalesce(z.raw, 0.0), 9) DESC, CAST(c.app_id AS VARCHAR)) AS rank
 FROM (SELECT u.author_id, i.app_id, EXISTS (SELECT 1 FROM train t WHERE t.author_id = u.author_id AND t.app_id = i.app_id) AS seen
   FROM test_users u
   CROSS JOIN (SELECT DISTINCT app_id FROM train) i) c
 LEFT JOIN cbf_nz z ON z.author_id = c.author_id AND z.app_id = c.app_id) WHERE rank <= 5"""))
def q_sl5(s, sf):
    """Unseen items by score in blocks; the seen ones, which rank after all others, are few a user and only needed by who has fewer than five unseen."""
    st = stages(s, sf)
    model = fit_cbf(st.train, st.items)
    u, i, seen, bases = compare.blocked_tables(st, st.test.select("author_id").distinct(), st.train_ranked_items, {"cbf": model})
    names = u.select("u", "author_id")
    top = top_items(u, i, bases, 5, seen=seen).select("u", "i", "score")
    short = u.select("u").join(top.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n >= 5"), "u", "left_anti")
    back = seen.join(short, "u").join(names, "u").join(i.select("i", "app_id"), "i").select("author_id", "app_id")
    unseen = top.join(names, "u").join(i.select("i", "app_id"), "i").select("author_id", "app_id", "score", F.lit(False).alias("seen"))
    both = unseen.unionByName(model.score_pairs(back, "score").withColumn("seen", F.lit(True)))
    return top_k(both, 5, demote=F.col("seen")).select("author_id", "app_id", F.col("rank").cast("int"), "seen")
