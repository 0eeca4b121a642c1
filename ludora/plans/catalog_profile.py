"""Registered profiling queries (AG-*) over the fixture views, with oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile as P
from ..sources import fixtures
from .catalog import register, rnd
from .sql import with_

NUMS = ("positive_ratio", "user_reviews", "price_final", "price_original", "discount")
PLATFORMS = ("win", "mac", "linux", "steam_deck")


# Bucket edges of the reference's profiling reports (the labels are ours)
# (review volume, price, text length, reviewer activity, positive-ratio cut).
_REV_EDGES = (10, 100, 1000, 10000, 100000, None)
_REV_LABELS = ("10-99", "100-999", "1k-9.9k", "10k-99.9k", "100k+")
_PRICE_EDGES = (0.01, 5, 10, 20, 40, None)
_PRICE_LABELS = ("0.01-4.99", "5-9.99", "10-19.99", "20-39.99", "40+")
_LEN_EDGES = (None, 10, 50, 200, 1000, None)
_LEN_LABELS = ("<10", "10-49", "50-199", "200-999", "1000+")
_ACT_EDGES = (1, 2, 6, 11, None)
_ACT_LABELS = ("1", "2-5", "6-10", ">10")
_CUT_EDGES = (0, 20, 40, 60, 80, 100)
_CUT_LABELS = ("0-20", "20-40", "40-60", "60-80", "80-100")


def _games(s, sf):
    return fixtures.games(s, sf)


def _reviews(s, sf):
    return fixtures.reviews(s, sf)


def _merged(s, sf):
    return fixtures.merged(s, sf)


def _r(x):
    return f"round({x}, 9)"


@register("ag1_shape_merged", with_(["merged"], "SELECT count(*) AS n_rows, 17 AS n_cols FROM merged"))
def q_shape(s, sf):
    return P.shape(_merged(s, sf))


_NULL_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count_if({c} IS NULL) AS null_count, count(*) AS n FROM merged"
    for c in fixtures.MERGED_COLUMNS)


@register("ag2_nulls_merged", with_(["merged"], f"""SELECT column_name, null_count,
 round(null_count * 100.0 / n, 2) AS null_pct FROM ({_NULL_SQL}) WHERE null_count > 0"""))
def q_nulls(s, sf):
    return P.null_counts(_merged(s, sf))


_DESC_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count({c}) AS count, {_r(f'avg({c})')} AS mean,
 {_r(f'stddev_samp({c})')} AS std, CAST(min({c}) AS DOUBLE) AS min,
 {_r(f'quantile_cont({c}, 0.25)')} AS p25, {_r(f'quantile_cont({c}, 0.5)')} AS p50,
 {_r(f'quantile_cont({c}, 0.75)')} AS p75, CAST(max({c}) AS DOUBLE) AS max FROM merged"""
    for c in NUMS)


@register("ag4_describe_merged", with_(["merged"], _DESC_SQL))
def q_describe(s, sf):
    d = P.describe(_merged(s, sf), NUMS)
    return d.select("column_name", "count", "min", "max", *rnd("mean", "std", "p25", "p50", "p75"))


@register("ag6_rating_counts", with_(["merged"], """SELECT rating, count(*) AS count,
 round(count(*) * 100.0 / (SELECT count(*) FROM merged), 9) AS share_pct
 FROM merged WHERE rating IS NOT NULL GROUP BY rating"""))
def q_rating_counts(s, sf):
    return P.value_counts(_merged(s, sf), "rating").select("rating", "count", *rnd("share_pct"))


@register("ag6_sentiment_share", with_(["reviews"], """SELECT is_positive, count(*) AS count,
 round(count(*) * 100.0 / (SELECT count(*) FROM reviews), 9) AS share_pct
 FROM reviews WHERE is_positive IS NOT NULL GROUP BY is_positive"""))
def q_sentiment(s, sf):
    return P.value_counts(_reviews(s, sf), "is_positive").select("is_positive", "count", *rnd("share_pct"))


@register("ag7_year_counts", with_(["merged"], """SELECT CAST(year(date_release) AS INT) AS year, count(*) AS count
 FROM merged WHERE date_release IS NOT NULL GROUP BY 1"""))
def q_year_counts(s, sf):
    return (P.value_counts(_merged(s, sf), F.year("date_release").alias("year"), share_of=None)
            .withColumnRenamed("value", "year"))


@register("ag8_user_reviews_stats", with_(["games"], """SELECT round(avg(user_reviews), 9) AS mean,
 CAST(min(user_reviews) AS DOUBLE) AS min, CAST(max(user_reviews) AS DOUBLE) AS max,
 round(stddev_samp(user_reviews), 9) AS std, round(median(user_reviews), 9) AS median FROM games"""))
def q_stats(s, sf):
    return P.scalar_stats(_games(s, sf), "user_reviews").select("min", "max", *rnd("mean", "std", "median"))


def _per_key_sql(key):
    return with_(["reviews"], f"""SELECT count(*) AS n_keys, round(avg(n), 9) AS mean_rows, min(n) AS min_rows,
 max(n) AS max_rows, round(stddev_samp(n), 9) AS std_rows, round(median(n), 9) AS median_rows
 FROM (SELECT {key}, count(*) AS n FROM reviews WHERE {key} IS NOT NULL GROUP BY {key})""")


@register("ag9_reviews_per_game", _per_key_sql("app_id"))
def q_per_game(s, sf):
    return P.per_key_count_stats(_reviews(s, sf), "app_id").select(
        "n_keys", "min_rows", "max_rows", *rnd("mean_rows", "std_rows", "median_rows"))


@register("ag9_reviews_per_author", _per_key_sql("author_id"))
def q_per_author(s, sf):
    return P.per_key_count_stats(_reviews(s, sf), "author_id").select(
        "n_keys", "min_rows", "max_rows", *rnd("mean_rows", "std_rows", "median_rows"))


@register("ag11_free_paid", with_(["games"], """SELECT count_if(price_final = 0) AS n_free,
 count_if(price_final > 0) AS n_paid, round(count_if(price_final = 0) * 100.0 / count(*), 9) AS free_pct,
 round(avg(price_final) FILTER (WHERE price_final > 0), 9) AS paid_mean,
 max(price_final) FILTER (WHERE price_final > 0) AS paid_max,
 count_if(discount > 0) AS n_discounted, round(count_if(discount > 0) * 100.0 / count(*), 9) AS discounted_pct
 FROM games"""))
def q_free_paid(s, sf):
    g = _games(s, sf)
    paid = F.col("price_final") > 0
    out = g.agg(
        F.count_if(F.col("price_final") == 0).alias("n_free"), F.count_if(paid).alias("n_paid"),
        (F.count_if(F.col("price_final") == 0) * 100.0 / F.count(F.lit(1))).alias("free_pct"),
        F.avg(F.when(paid, F.col("price_final"))).alias("paid_mean"),
        F.max(F.when(paid, F.col("price_final"))).alias("paid_max"),
        F.count_if(F.col("discount") > 0).alias("n_discounted"),
        (F.count_if(F.col("discount") > 0) * 100.0 / F.count(F.lit(1))).alias("discounted_pct"))
    return out.select("n_free", "n_paid", "paid_max", "n_discounted", *rnd("free_pct", "paid_mean", "discounted_pct"))


_PLAT_SQL = " UNION ALL ".join(
    f"SELECT '{p}' AS platform, count_if({p}) AS n_supported, round(count_if({p}) * 100.0 / count(*), 9) AS share_pct FROM games"
    for p in PLATFORMS)


@register("ag12_platform_support", with_(["games"], _PLAT_SQL))
def q_platforms(s, sf):
    g = _games(s, sf)
    one = g.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(p)).alias(p) for p in PLATFORMS])
    return (one.unpivot(["_n"], list(PLATFORMS), "platform", "n_supported")
            .select("platform", "n_supported", F.round(F.col("n_supported") * 100.0 / F.col("_n"), 9).alias("share_pct")))


@register("ag13_platform_count", with_(["games"], """SELECT platform_count, count(*) AS count,
 round(count(*) * 100.0 / (SELECT count(*) FROM games), 9) AS share_pct FROM (SELECT
 CAST(win AS INT) + CAST(mac AS INT) + CAST(linux AS INT) + CAST(steam_deck AS INT) AS platform_count FROM games)
 GROUP BY platform_count"""))
def q_platform_count(s, sf):
    g = _games(s, sf)
    pc = sum(F.col(p).cast("int") for p in PLATFORMS)
    return P.value_counts(g.select(pc.alias("platform_count")), "platform_count").select(
        "platform_count", "count", *rnd("share_pct"))


def _bucket_sql(src, value, edges, labels, closed="left", total=None):
    cases = []
    for i in range(len(edges) - 1):
        lo, hi = edges[i], edges[i + 1]
        if closed == "left":
            cond = [f"{value} >= {lo}" if lo is not None else "true"]
            if hi is not None:
                cond.append(f"{value} < {hi}")
        else:
            cond = [(f"{value} >= {lo}" if i == 0 else f"{value} > {lo}") if lo is not None else "true"]
            if hi is not None:
                cond.append(f"{value} <= {hi}")
        cases.append(f"WHEN {' AND '.join(cond)} THEN {i}")
    b = "SELECT * FROM (VALUES " + ", ".join(f"({i}, '{lab}')" for i, lab in enumerate(labels)) + ") t(bucket_no, bucket)"
    total = total or f"(SELECT count(*) FROM {src})"
    return f"""SELECT CAST(b.bucket_no AS INT) AS bucket_no, b.bucket, coalesce(c.count, 0) AS count,
 round(coalesce(c.count, 0) * 100.0 / {total}, 9) AS share_pct
 FROM ({b}) b LEFT JOIN (SELECT bucket_no, count(*) AS count FROM (SELECT CASE {' '.join(cases)} END AS bucket_no
 FROM {src}) WHERE bucket_no IS NOT NULL GROUP BY bucket_no) c ON b.bucket_no = c.bucket_no"""


def _bucket_q(df, value, edges, labels, closed="left"):
    return P.bucket_counts(df, value, edges, labels, closed).select("bucket_no", "bucket", "count", *rnd("share_pct"))




@register("ag14_review_volume_buckets", with_(["games"], _bucket_sql("games", "user_reviews", _REV_EDGES, _REV_LABELS)))
def q_rev_buckets(s, sf):
    return _bucket_q(_games(s, sf), F.col("user_reviews"), _REV_EDGES, _REV_LABELS)




@register("ag14_price_buckets", with_(["games"], _bucket_sql("games", "price_final", _PRICE_EDGES, _PRICE_LABELS)))
def q_price_buckets(s, sf):
    return _bucket_q(_games(s, sf), F.col("price_final"), _PRICE_EDGES, _PRICE_LABELS)




@register("ag15_text_length_buckets", with_(["reviews"], _bucket_sql(
    "(SELECT char_length(content) AS len FROM reviews WHERE content IS NOT NULL)", "len", _LEN_EDGES, _LEN_LABELS,
    total="(SELECT count(*) FROM reviews WHERE content IS NOT NULL)")))
def q_len_buckets(s, sf):
    r = _reviews(s, sf).where(F.col("content").isNotNull())
    return _bucket_q(r, F.char_length("content"), _LEN_EDGES, _LEN_LABELS)




@register("ag16_reviewer_activity", with_(["reviews"], _bucket_sql(
    "(SELECT author_id, count(*) AS n FROM reviews WHERE author_id IS NOT NULL GROUP BY author_id)", "n",
    _ACT_EDGES, _ACT_LABELS)))
def q_activity(s, sf):
    per = _reviews(s, sf).where(F.col("author_id").isNotNull()).groupBy("author_id").agg(F.count(F.lit(1)).alias("n"))
    return _bucket_q(per, F.col("n"), _ACT_EDGES, _ACT_LABELS)




@register("ag17_ratio_cut", with_(["games"], _bucket_sql("games", "positive_ratio", _CUT_EDGES, _CUT_LABELS, "right")))
def q_cut(s, sf):
    return _bucket_q(_games(s, sf), F.col("positive_ratio"), _CUT_EDGES, _CUT_LABELS, "right")


def _hist_sql(src, value, bins):
    return f"""SELECT CAST(g.bin AS INT) AS bin, round(m.lo + g.bin * m.w, 9) AS bin_lo,
 round(m.lo + (g.bin + 1) * m.w, 9) AS bin_hi, coalesce(c.count, 0) AS count
 FROM range({bins}) g(bin)
 CROSS JOIN (SELECT min(x) AS lo, max(x) AS hi, (max(x) - min(x)) / {bins} AS w FROM v) m
 LEFT JOIN (SELECT b, count(*) AS count FROM (SELECT CASE WHEN m2.hi > m2.lo THEN
   least(floor((x - m2.lo) / ((m2.hi - m2.lo) / {bins})), {bins - 1}) ELSE 0 END AS b
   FROM v, (SELECT min(x) AS lo, max(x) AS hi FROM v) m2) GROUP BY b) c ON c.b = g.bin""", \
        f"v AS (SELECT CAST({value} AS DOUBLE) AS x FROM {src} WHERE {value} IS NOT NULL)"


def _hist_q(df, value, bins):
    return P.histogram(df, value, bins).select("bin", "count", *rnd("bin_lo", "bin_hi"))


_h = _hist_sql("games", "positive_ratio", 50)


@register("ag18_ratio_histogram", with_(["games"], _h[0], extra=_h[1]))
def q_hist(s, sf):
    return _hist_q(_games(s, sf), F.col("positive_ratio"), 50)


_h2 = _hist_sql("games", "log10(user_reviews + 1)", 50)


@register("ag19_log_reviews_histogram", with_(["games"], _h2[0], extra=_h2[1]))
def q_log_hist(s, sf):
    return _hist_q(_games(s, sf), F.log10(F.col("user_reviews") + 1), 50)


_h3 = _hist_sql("lens", "len", 50)


@register("ag20_length_histogram_p99", with_(["reviews"], _h3[0], extra="""lens0 AS (SELECT char_length(content) AS len
 FROM reviews WHERE content IS NOT NULL),
lens AS (SELECT len FROM lens0 WHERE len <= (SELECT quantile_cont(len, 0.99) FROM lens0)),
""" + _h3[1]))
def q_len_hist(s, sf):
    r = _reviews(s, sf).where(F.col("content").isNotNull()).select(F.char_length("content").alias("len"))
    p99 = P.exact_quantiles(r, "len", (0.99,)).select("q99").scalar()
    return _hist_q(r.where(F.col("len") <= p99), F.col("len"), 50)


@register("ag21_scatter_bins", with_(["games"], """SELECT CAST(binx AS INT) AS bin_x, CAST(biny AS INT) AS bin_y, count(*) AS count
 FROM (SELECT CASE WHEN m.x1 > m.x0 THEN least(floor((x - m.x0) / ((m.x1 - m.x0) / 20)), 19) ELSE 0 END AS binx,
  CASE WHEN m.y1 > m.y0 THEN least(floor((y - m.y0) / ((m.y1 - m.y0) / 20)), 19) ELSE 0 END AS biny
  FROM (SELECT log10(user_reviews + 1) AS x, CAST(positive_ratio AS DOUBLE) AS y FROM games) v,
  (SELECT min(log10(user_reviews + 1)) AS x0, max(log10(user_reviews + 1)) AS x1,
   CAST(min(positive_ratio) AS DOUBLE) AS y0, CAST(max(positive_ratio) AS DOUBLE) AS y1 FROM games) m)
 GROUP BY 1, 2"""))
def q_scatter(s, sf):
    return P.hist2d(_games(s, sf), F.log10(F.col("user_reviews") + 1), F.col("positive_ratio"), 20, 20)


@register("ag22_mode_length", with_(["reviews"], """SELECT len AS mode, count FROM (SELECT char_length(content) AS len,
 count(*) AS count FROM reviews WHERE content IS NOT NULL GROUP BY 1) ORDER BY count DESC, len ASC LIMIT 1"""))
def q_mode(s, sf):
    r = _reviews(s, sf).select(F.char_length("content").alias("len"))
    return P.mode(r, "len")


@register("ag23_shortest_longest", with_(["reviews"], """SELECT
 arg_min(id, (char_length(content), id)) AS shortest_id, min(char_length(content)) AS shortest_len,
 arg_max(id, (char_length(content), -id)) AS longest_id, max(char_length(content)) AS longest_len
 FROM reviews WHERE content IS NOT NULL"""))
def q_short_long(s, sf):
    r = _reviews(s, sf).where(F.col("content").isNotNull()).withColumn("len", F.char_length("content"))
    return r.agg(F.min_by("id", F.struct("len", "id")).alias("shortest_id"), F.min("len").alias("shortest_len"),
                 F.max_by("id", F.struct(F.col("len"), -F.col("id"))).alias("longest_id"),
                 F.max("len").alias("longest_len"))


@register("ag24_ranges", with_(["games"], """SELECT min(app_id) AS min_app_id, max(app_id) AS max_app_id,
 CAST(min(year(date_release)) AS INT) AS min_year, CAST(max(year(date_release)) AS INT) AS max_year FROM games"""))
def q_ranges(s, sf):
    g = _games(s, sf)
    return g.agg(F.min("app_id").alias("min_app_id"), F.max("app_id").alias("max_app_id"),
                 F.min(F.year("date_release")).alias("min_year"), F.max(F.year("date_release")).alias("max_year"))


@register("ag25_duplicates_reviews", with_(["reviews"], """SELECT sum(n) AS n_rows,
 sum(n) - (SELECT count(*) FROM (SELECT DISTINCT * FROM reviews)) AS full_row_duplicates,
 sum(n) - count_if(id IS NOT NULL) AS key_duplicates,
 sum(CASE WHEN id IS NOT NULL AND n > 1 THEN n ELSE 0 END) AS rows_with_repeated_key,
 count_if(id IS NOT NULL AND n > 1) AS repeated_keys
 FROM (SELECT id, count(*) AS n FROM reviews GROUP BY id)""".replace("sum(n) AS", "CAST(sum(n) AS BIGINT) AS")
    .replace("sum(n) - (", "CAST(sum(n) AS BIGINT) - (").replace("sum(n) - count_if", "CAST(sum(n) AS BIGINT) - count_if")
    .replace("sum(CASE", "CAST(sum(CASE").replace("ELSE 0 END) AS rows", "ELSE 0 END) AS BIGINT) AS rows")))
def q_dups(s, sf):
    return P.duplicate_counts(_reviews(s, sf), "id")


@register("ag28_positive_share_extremes", with_(["reviews"], """SELECT * FROM (
 SELECT 'top' AS side, CAST(row_number() OVER (ORDER BY pct DESC, app_id) AS INT) AS place, app_id, n_reviews, round(pct, 9) AS positive_pct FROM g
 UNION ALL
 SELECT 'bottom', CAST(row_number() OVER (ORDER BY pct ASC, app_id) AS INT), app_id, n_reviews, round(pct, 9) FROM g)
 WHERE place <= 10""", extra="""g AS (SELECT app_id, count(*) AS n_reviews,
 avg(CASE WHEN is_positive = 'Positive' THEN 100.0 ELSE 0.0 END) AS pct FROM reviews WHERE app_id IS NOT NULL GROUP BY app_id)"""))
def q_pos_share(s, sf):
    r = _reviews(s, sf)
    g = (r.where(F.col("app_id").isNotNull()).groupBy("app_id")
         .agg(F.count(F.lit(1)).alias("n_reviews"),
              F.avg(F.when(F.col("is_positive") == "Positive", 100.0).otherwise(0.0)).alias("pct")))
    top = g.orderBy(F.col("pct").desc(), "app_id").limit(10)
    bot = g.orderBy(F.col("pct").asc(), "app_id").limit(10)
    from pyspark.sql import Window
    def place(df, side, asc):
        w = Window.orderBy(F.col("pct").asc() if asc else F.col("pct").desc(), "app_id")
        return df.select(F.lit(side).alias("side"), F.row_number().over(w).alias("place"),
                         "app_id", "n_reviews", F.round("pct", 9).alias("positive_pct"))
    return place(top, "top", False).unionByName(place(bot, "bottom", True))


@register("ag29_top_games_sentiment", with_(["reviews"], """SELECT app_id, n_reviews, n_pos, n_neg,
 round(CASE WHEN n_pos + n_neg > 0 THEN n_pos * 100.0 / (n_pos + n_neg) END, 9) AS pos_pct FROM (
 SELECT app_id, count(*) AS n_reviews, count_if(is_positive = 'Positive') AS n_pos,
 count_if(is_positive = 'Negative') AS n_neg FROM reviews WHERE app_id IS NOT NULL GROUP BY app_id
 ORDER BY n_reviews DESC, app_id ASC LIMIT 20)"""))
def q_top_games(s, sf):
    r = _reviews(s, sf).where(F.col("app_id").isNotNull())
    g = (r.groupBy("app_id").agg(F.count(F.lit(1)).alias("n_reviews"),
                                 F.count_if(F.col("is_positive") == "Positive").alias("n_pos"),
                                 F.count_if(F.col("is_positive") == "Negative").alias("n_neg"))
         .orderBy(F.col("n_reviews").desc(), "app_id").limit(20))
    tot = F.col("n_pos") + F.col("n_neg")
    return g.withColumn("pos_pct", F.round(F.when(tot > 0, F.col("n_pos") * 100.0 / tot), 9))


@register("ag30_class_balance", with_(["reviews"], """SELECT max(n) AS max_class, min(n) AS min_class,
 round(max(n) * 1.0 / min(n), 9) AS ratio,
 CASE WHEN max(n) * 1.0 / min(n) < 1.2 THEN 'balanced' WHEN max(n) * 1.0 / min(n) < 2.0 THEN 'mild'
 ELSE 'imbalanced' END AS band
 FROM (SELECT is_positive, count(*) AS n FROM reviews WHERE is_positive IS NOT NULL GROUP BY 1)"""))
def q_balance(s, sf):
    vc = P.value_counts(_reviews(s, sf), "is_positive", share_of=None)
    ratio = F.max("count") * 1.0 / F.min("count")
    return vc.agg(F.max("count").alias("max_class"), F.min("count").alias("min_class"),
                  F.round(ratio, 9).alias("ratio"),
                  F.when(ratio < 1.2, "balanced").when(ratio < 2.0, "mild").otherwise("imbalanced").alias("band"))


@register("ag31_releases_per_year", with_(["games"], """SELECT CAST(year(date_release) AS INT) AS year, count(*) AS n_games,
 round(avg(positive_ratio), 9) AS mean_positive_ratio FROM games
 WHERE date_release IS NOT NULL AND year(date_release) BETWEEN 2000 AND 2024 GROUP BY 1"""))
def q_years(s, sf):
    g = _games(s, sf).where(F.col("date_release").isNotNull()).withColumn("year", F.year("date_release"))
    return (g.where(F.col("year").between(2000, 2024)).groupBy("year")
            .agg(F.count(F.lit(1)).alias("n_games"), F.round(F.avg("positive_ratio"), 9).alias("mean_positive_ratio")))


@register("sl2_top5_years", with_(["games"], """SELECT CAST(year(date_release) AS INT) AS year, count(*) AS n_games
 FROM games WHERE date_release IS NOT NULL GROUP BY 1 ORDER BY n_games DESC, year ASC LIMIT 5"""))
def q_top_years(s, sf):
    g = _games(s, sf).where(F.col("date_release").isNotNull())
    return (g.groupBy(F.year("date_release").alias("year")).agg(F.count(F.lit(1)).alias("n_games"))
            .orderBy(F.col("n_games").desc(), "year").limit(5))


@register("ag32_integration_check", with_(["merged"], """SELECT
 (SELECT count(*) FROM reviews) AS review_rows,
 count_if(id IS NOT NULL) AS review_rows_kept, count_if(id IS NULL) AS rows_without_review,
 round(count_if(id IS NOT NULL) * 100.0 / (SELECT count(*) FROM reviews), 9) AS preserved_pct,
 (SELECT count(*) FROM reviews) - count_if(id IS NOT NULL) AS reviews_lost,
 count(DISTINCT app_id) = (SELECT count(*) FROM games) AS all_games_preserved FROM merged"""))
def q_integration(s, sf):
    n_rev = F.lit(_reviews(s, sf).count())
    n_games = F.lit(_games(s, sf).count())
    m = _merged(s, sf)
    kept = F.count_if(F.col("id").isNotNull())
    return m.agg(n_rev.alias("review_rows"), kept.alias("review_rows_kept"),
                 F.count_if(F.col("id").isNull()).alias("rows_without_review"),
                 F.round(kept * 100.0 / n_rev, 9).alias("preserved_pct"),
                 (n_rev - kept).alias("reviews_lost"),
                 (F.count_distinct("app_id") == n_games).alias("all_games_preserved"))


@register("ag33_before_after_means", with_(["merged"], """SELECT 
 round(g.pr, 9) AS games_positive_ratio, round(m.pr, 9) AS merged_positive_ratio, round(abs(g.pr - m.pr), 9) AS diff_positive_ratio,
 round(g.ur, 9) AS games_user_reviews, round(m.ur, 9) AS merged_user_reviews, round(abs(g.ur - m.ur), 9) AS diff_user_reviews
 FROM (SELECT avg(positive_ratio) AS pr, avg(user_reviews) AS ur FROM games) g,
 (SELECT avg(positive_ratio) AS pr, avg(user_reviews) AS ur FROM merged) m"""))
def q_before_after(s, sf):
    row = _games(s, sf).agg(F.avg("positive_ratio").alias("pr"), F.avg("user_reviews").alias("ur")).first()
    g = {"pr": F.lit(row["pr"]), "ur": F.lit(row["ur"])}
    m = _merged(s, sf)
    out = m.agg(F.avg("positive_ratio").alias("mpr"), F.avg("user_reviews").alias("mur"))
    return out.select(F.round(g["pr"], 9).alias("games_positive_ratio"), F.round("mpr", 9).alias("merged_positive_ratio"),
                      F.round(F.abs(g["pr"] - F.col("mpr")), 9).alias("diff_positive_ratio"),
                      F.round(g["ur"], 9).alias("games_user_reviews"), F.round("mur", 9).alias("merged_user_reviews"),
                      F.round(F.abs(g["ur"] - F.col("mur")), 9).alias("diff_user_reviews"))


@register("ag35_word_frequency", with_(["reviews"], """SELECT word, count(*) AS count FROM (
 SELECT unnest(regexp_split_to_array(trim(lower(content)), '\\s+')) AS word FROM reviews WHERE content IS NOT NULL)
 WHERE char_length(word) >= 3 GROUP BY word ORDER BY count DESC, word ASC LIMIT 20"""))
def q_words(s, sf):
    return P.word_frequency(_reviews(s, sf), "content", 20)


@register("ag41_sentiment_side_by_side", with_(["merged"], """SELECT coalesce(a.is_positive, b.is_positive) AS is_positive,
 coalesce(a.n, 0) AS n_reviews, coalesce(b.n, 0) AS n_merged FROM
 (SELECT is_positive, count(*) AS n FROM reviews WHERE is_positive IS NOT NULL GROUP BY 1) a FULL OUTER JOIN
 (SELECT is_positive, count(*) AS n FROM merged WHERE is_positive IS NOT NULL GROUP BY 1) b ON a.is_positive = b.is_positive"""))
def q_side(s, sf):
    a = P.value_counts(_reviews(s, sf), "is_positive", share_of=None).withColumnRenamed("count", "n_reviews")
    b = P.value_counts(_merged(s, sf), "is_positive", share_of=None).withColumnRenamed("count", "n_merged")
    return (a.join(b, "is_positive", "full")
            .select("is_positive", F.coalesce("n_reviews", F.lit(0)).alias("n_reviews"),
                    F.coalesce("n_merged", F.lit(0)).alias("n_merged")))


def _nulls_sql(table, cols):
    return " UNION ALL ".join(
        f"SELECT '{table}' AS \"table\", '{c}' AS column_name, count_if({c} IS NULL) AS null_count, "
        f"round(count_if({c} IS NULL) * 100.0 / count(*), 2) AS null_pct FROM {table}" for c in cols)


@register("ag42_nulls_three_tables", with_(["merged"], "SELECT * FROM (" + " UNION ALL ".join([
    _nulls_sql("games", fixtures.GAMES_COLUMNS), _nulls_sql("reviews", fixtures.REVIEWS_COLUMNS),
    _nulls_sql("merged", fixtures.MERGED_COLUMNS)]) + ")"))
def q_nulls3(s, sf):
    parts = [P.null_counts(_games(s, sf), only_positive=False, table="games"),
             P.null_counts(_reviews(s, sf), only_positive=False, table="reviews"),
             P.null_counts(_merged(s, sf), only_positive=False, table="merged")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
