"""Registered TF-IDF variants (TF-1, TF-3, TF-4, TF-5) and AG-3 / AG-10."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.stopwords import ENGLISH_STOP_WORDS, sql_list
from ..functions.text import clean_text_compact, drop_stop_words, with_bigrams, word_tokens
from ..models.cbf import representatives
from ..operators import profile as P
from ..operators.tfidf import tfidf
from ..sources import fixtures
from .catalog import register, rnd
from .sql import WORD_RE, with_
from .stages import stages


def _tfidf_sql(docs: str, tokens: str, cap: int | None, stop: bool) -> str:
    """SQL text of the relational TF-IDF over CTE `docs(title, mult)`."""
    where = f"WHERE term NOT IN ({sql_list()})" if stop else ""
    vocab = (f"AND term IN (SELECT term FROM (SELECT term, sum(tf * mult) AS tot FROM tf0 GROUP BY term)"
             f" ORDER BY tot DESC, term ASC LIMIT {cap})") if cap else ""
    return f"""d AS ({docs}),
toks AS (SELECT title, mult, term FROM (SELECT title, mult, unnest({tokens}) AS term FROM d) {where}),
tf0 AS (SELECT title, mult, term, count(*) AS tf FROM toks GROUP BY title, mult, term),
tf AS (SELECT * FROM tf0 WHERE true {vocab}),
dfq AS (SELECT term, sum(mult) AS df FROM tf GROUP BY term),
w AS (SELECT tf.title, tf.term, tf.tf * (ln((1 + n.n) / (1 + dfq.df)) + 1) AS w
 FROM tf JOIN dfq ON tf.term = dfq.term, (SELECT sum(mult) AS n FROM d) n)"""


_BODY = "SELECT title, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY title)), 9) AS weight FROM w"
_WORDS = f"regexp_extract_all(lower(title), '{WORD_RE}')"
_BIGRAMS = (f"CASE WHEN len({_WORDS}) >= 2 THEN list_concat({_WORDS}, list_transform(range(1, len({_WORDS})),"
            f" lambda i: {_WORDS}[i] || ' ' || {_WORDS}[i + 1])) ELSE {_WORDS} END")
_REP_DOCS = "SELECT title, 1 AS mult FROM rep"
_ITEM_DOCS = "SELECT title, count(*) AS mult FROM items GROUP BY title"


def _docs(s, sf, dedup):
    st = stages(s, sf)
    return representatives(st.items, dedup).groupBy("title").agg(F.count(F.lit(1)).alias("mult"))


def _out(v):
    return v.select("title", "term", *rnd("weight"))


@register("tf1_title_tfidf_stopwords", with_(["rep"], _BODY, extra=_tfidf_sql(_REP_DOCS, _WORDS, None, True)))
def q_tf1(s, sf):
    toks = drop_stop_words(word_tokens("title"), ENGLISH_STOP_WORDS)
    return _out(tfidf(_docs(s, sf, True), "title", toks, None, "mult"))


@register("tf3_title_tfidf_all_items", with_(["items"], _BODY, extra=_tfidf_sql(_ITEM_DOCS, _WORDS, None, False)))
def q_tf3(s, sf):
    return _out(tfidf(_docs(s, sf, False), "title", word_tokens("title"), None, "mult"))


@register("tf4_title_tfidf_bigrams_5000", with_(["items"], _BODY, extra=_tfidf_sql(_ITEM_DOCS, _BIGRAMS, 5000, False)))
def q_tf4(s, sf):
    return _out(tfidf(_docs(s, sf, False), "title", with_bigrams(word_tokens("title")), 5000, "mult"))


@register("tf5_title_tfidf_compact_token", with_(["items"], _BODY, extra=_tfidf_sql(
    _ITEM_DOCS, "list_filter([regexp_replace(lower(title), '[^a-z0-9]', '', 'g')], lambda t: length(t) > 1)", None, False)))
def q_tf5(s, sf):
    tok = F.filter(F.array(clean_text_compact("title")), lambda t: F.length(t) > 1)
    return _out(tfidf(_docs(s, sf, False), "title", tok, None, "mult"))


@register("ag3_null_pattern_merged", with_(["merged"], """SELECT id IS NULL AS id_null, content IS NULL AS content_null,
 author_id IS NULL AS author_id_null, is_positive IS NULL AS is_positive_null, count(*) AS n_rows
 FROM merged GROUP BY 1, 2, 3, 4"""))
def q_ag3(s, sf):
    return P.null_pattern(fixtures.merged(s, sf), ["id", "content", "author_id", "is_positive"])


@register("ag10_distinct_counts", with_(["reviews"], """SELECT count(DISTINCT app_id) AS n_games,
 count(DISTINCT author_id) AS n_authors, count(DISTINCT id) AS n_ids,
 round(count(*) * 1.0 / count(DISTINCT app_id), 9) AS rows_per_game,
 round(count(*) * 1.0 / count(DISTINCT author_id), 9) AS rows_per_author FROM reviews"""))
def q_ag10(s, sf):
    r = fixtures.reviews(s, sf)
    return r.agg(F.count_distinct("app_id").alias("n_games"), F.count_distinct("author_id").alias("n_authors"),
                 F.count_distinct("id").alias("n_ids"),
                 F.round(F.count(F.lit(1)) / F.count_distinct("app_id"), 9).alias("rows_per_game"),
                 F.round(F.count(F.lit(1)) / F.count_distinct("author_id"), 9).alias("rows_per_author"))


@register("tf6_cosine_test_vs_train_items", with_(["train", "test", "rep", "rep_vec"], """SELECT p.author_id,
 p.test_app, p.train_app, round(coalesce(c.cosine, 0.0), 9) AS cosine FROM p
 LEFT JOIN (SELECT p.test_app, p.train_app, sum(a.weight * b.weight) AS cosine
   FROM (SELECT DISTINCT test_app, train_app FROM p) p
   JOIN rep ra ON ra.app_id = p.test_app JOIN rep_vec a ON a.title = ra.title
   JOIN rep rb ON rb.app_id = p.train_app JOIN rep_vec b ON b.title = rb.title AND b.term = a.term
   GROUP BY p.test_app, p.train_app) c ON c.test_app = p.test_app AND c.train_app = p.train_app""",
    extra="""p AS (SELECT DISTINCT t.author_id, t.app_id AS test_app, r.app_id AS train_app
 FROM test t JOIN train r ON r.author_id = t.author_id)"""))
def q_tf6(s, sf):
    from ..models.cbf import fit_cbf
    from ..operators.tfidf import cosine_pairs
    st = stages(s, sf)
    m = fit_cbf(st.train, st.items)
    app_vec = m.item_title.join(m.vectors, "title").select("app_id", "term", "weight")
    pairs = (st.test.select("author_id", F.col("app_id").alias("test_app"))
             .join(st.train.select("author_id", F.col("app_id").alias("train_app")), "author_id").distinct())
    cos = cosine_pairs(pairs, app_vec, "test_app", "train_app", "app_id")
    return pairs.join(cos, ["test_app", "train_app"], "left").select(
        "author_id", "test_app", "train_app", F.round(F.coalesce("cosine", F.lit(0.0)), 9).alias("cosine"))


@register("fn4_word_token_counts", f"""SELECT doc_id,
 CAST(len(regexp_extract_all(lower(coalesce(text, '')), '{WORD_RE}')) AS INT) AS n_words FROM documents""")
def q_fn4(s, sf):
    from ..sources.tables import table
    d = table(s, sf, "documents")
    return d.select("doc_id", F.size(word_tokens("text")).alias("n_words"))
