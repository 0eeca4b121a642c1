"""DuckDB oracle SQL: named common table expressions and a `with_()` helper.

Each oracle query is `WITH <needed CTEs> <body>`; the CTE bodies restate
the fixture views and the shared stages (cleaning, split, TF-IDF) in
plain SQL so every check runs from the base tables.
"""

from __future__ import annotations

from ..functions.stopwords import sql_list
from ..sources.fixtures import FIXTURE_RATINGS, GAMES_SQL, MERGED_SQL, REVIEWS_SQL

WORD_RE = r"[\p{L}\p{N}_]{2,}"
RATINGS = FIXTURE_RATINGS
_ORDER = "app_id ASC NULLS FIRST, author_id ASC NULLS FIRST, is_positive ASC NULLS FIRST, content ASC NULLS FIRST"
_ONEHOT = ", ".join(f"coalesce(rating = '{r}', false) AS \"rating_{r}\"" for r in RATINGS)

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "games": ((), GAMES_SQL),
    "reviews": ((), REVIEWS_SQL),
    "merged": (("games", "reviews"), MERGED_SQL),
    "dedup": (("merged",), f"""SELECT * EXCLUDE (rn) FROM (SELECT m.*, row_number() OVER
 (PARTITION BY id ORDER BY {_ORDER}) AS rn FROM merged m) WHERE rn = 1"""),
    "cleaned": (("dedup",), f"""SELECT id, app_id, content, author_id, is_positive, title,
 try_cast(date_release AS DATE) AS date_release,
 coalesce(try_cast(win AS BOOLEAN), false) AS win, coalesce(try_cast(mac AS BOOLEAN), false) AS mac,
 coalesce(try_cast(linux AS BOOLEAN), false) AS linux, coalesce(try_cast(steam_deck AS BOOLEAN), false) AS steam_deck,
 coalesce(positive_ratio, 0) AS positive_ratio, CAST(coalesce(user_reviews, 0) AS INT) AS user_reviews,
 coalesce(price_final, 0) AS price_final, coalesce(price_original, 0) AS price_original,
 coalesce(discount, 0) AS discount,
 CASE WHEN is_positive = 'Positive' THEN 1 WHEN is_positive = 'Negative' THEN 0 END AS is_positive_encoded,
 {_ONEHOT}, rating IS NULL AS rating_nan
 FROM dedup WHERE content IS NOT NULL
 AND coalesce(positive_ratio, 0) BETWEEN 0 AND 100 AND coalesce(price_final, 0) >= 0"""),
    "bounds": (("cleaned",), """SELECT min(user_reviews) AS mn_ur, max(user_reviews) AS mx_ur,
 min(price_final) AS mn_pf, max(price_final) AS mx_pf, min(positive_ratio) AS mn_pr, max(positive_ratio) AS mx_pr
 FROM cleaned"""),
    "pre": (("cleaned", "bounds"), """SELECT c.* EXCLUDE (user_reviews, price_final, positive_ratio),
 CASE WHEN mx_ur > mn_ur THEN (user_reviews - mn_ur) / CAST(mx_ur - mn_ur AS DOUBLE) ELSE CAST(user_reviews AS DOUBLE) - mn_ur END AS user_reviews,
 CASE WHEN mx_pf > mn_pf THEN (price_final - mn_pf) / (mx_pf - mn_pf) ELSE price_final - mn_pf END AS price_final,
 CASE WHEN mx_pr > mn_pr THEN (positive_ratio - mn_pr) / CAST(mx_pr - mn_pr AS DOUBLE) ELSE CAST(positive_ratio AS DOUBLE) - mn_pr END AS positive_ratio
 FROM cleaned c, bounds"""),
    "inter": (("cleaned",), "SELECT id, author_id, app_id, title, is_positive_encoded FROM cleaned"),
    "lastid": (("inter",), "SELECT author_id, max(id) AS last_id FROM inter GROUP BY author_id"),
    "flagged": (("inter", "lastid"), """SELECT i.*, i.id = l.last_id AS is_test
 FROM inter i JOIN lastid l ON i.author_id = l.author_id"""),
    "train": (("flagged",), "SELECT * EXCLUDE (is_test) FROM flagged WHERE NOT is_test"),
    "test": (("flagged",), "SELECT * EXCLUDE (is_test) FROM flagged WHERE is_test"),
    "universe": (("inter",), "SELECT DISTINCT app_id FROM inter"),
    "seen": (("train",), "SELECT DISTINCT author_id, app_id FROM train"),
    "test_users": (("test",), "SELECT DISTINCT author_id FROM test"),
    "truth": (("test",), "SELECT DISTINCT author_id, app_id FROM test WHERE is_positive_encoded = 1"),
    "items": (("inter",), "SELECT DISTINCT app_id, coalesce(title, '') AS title FROM inter"),
    "rep": (("items",), "SELECT min(app_id) AS app_id, title FROM items GROUP BY title"),
    "rep_toks": (("rep",), f"""SELECT title, term FROM (SELECT title,
 unnest(regexp_extract_all(lower(title), '{WORD_RE}')) AS term FROM rep)
 WHERE term NOT IN ({sql_list()})"""),
    "rep_tf": (("rep_toks",), "SELECT title, term, count(*) AS tf FROM rep_toks GROUP BY title, term"),
    "rep_vocab": (("rep_tf",), """SELECT term FROM (SELECT term, sum(tf) AS tot FROM rep_tf GROUP BY term)
 ORDER BY tot DESC, term ASC LIMIT 5000"""),
    "rep_tf5k": (("rep_tf", "rep_vocab"), "SELECT * FROM rep_tf WHERE term IN (SELECT term FROM rep_vocab)"),
    "rep_w": (("rep_tf5k", "rep"), """SELECT t.title, t.term,
 t.tf * (ln((1 + n.n) / (1 + d.df)) + 1) AS w
 FROM rep_tf5k t JOIN (SELECT term, count(*) AS df FROM rep_tf5k GROUP BY term) d ON t.term = d.term,
 (SELECT count(*) AS n FROM rep) n"""),
    "rep_vec": (("rep_w",), "SELECT title, term, w / sqrt(sum(w * w) OVER (PARTITION BY title)) AS weight FROM rep_w"),
    "likes": (("train",), "SELECT author_id, app_id FROM train WHERE is_positive_encoded = 1"),
    "cbf_prof": (("likes", "rep", "rep_vec"), """SELECT l.author_id, v.term, sum(v.weight) AS pw
 FROM likes l JOIN rep r ON l.app_id = r.app_id JOIN rep_vec v ON r.title = v.title
 GROUP BY l.author_id, v.term"""),
    "cbf_nz": (("cbf_prof", "rep", "rep_vec"), """SELECT p.author_id, r.app_id, sum(p.pw * v.weight) AS raw
 FROM cbf_prof p JOIN rep_vec v ON p.term = v.term JOIN rep r ON r.title = v.title
 GROUP BY p.author_id, r.app_id"""),
    "ks": ((), "SELECT unnest([5, 10, 20]) AS k"),
}


def with_(names, body: str, extra: str | None = None) -> str:
    """WITH clause holding `names` (plus their dependencies, in order) and
    the query's own `extra` CTE text, followed by `body`."""
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    parts = [f"{n} AS (\n{CTES[n][1]}\n)" for n in order]
    if extra:
        parts.append(extra.strip().rstrip(","))
    return "WITH " + ",\n".join(parts) + "\n" + body


def metrics_ctes(preds_cte: str, policy_users: str | None = None) -> str:
    """SQL text of EV-3..EV-9 over a CTE `preds(model, author_id, app_id, rank)`.

    Returns a SELECT producing per-user rows (model, user_id, k, precision,
    recall, f1, ndcg); policy A when policy_users is None.
    """
    base = f"""hits AS (SELECT p.model, p.author_id, p.rank,
 CASE WHEN t.app_id IS NULL THEN 0 ELSE 1 END AS hit
 FROM {preds_cte} p LEFT JOIN truth t ON p.author_id = t.author_id AND p.app_id = t.app_id),
ntrue AS (SELECT author_id, count(*) AS n_true FROM truth GROUP BY author_id),
agg AS (SELECT h.model, h.author_id, ks.k, count(*) AS n_top, sum(hit) AS hits,
 sum(hit / log2(h.rank + 1)) AS dcg FROM hits h JOIN ks ON h.rank <= ks.k GROUP BY h.model, h.author_id, ks.k)"""
    if policy_users is None:
        src = "SELECT a.*, n.n_true FROM agg a JOIN ntrue n ON a.author_id = n.author_id"
    else:
        src = f"""SELECT g.model, g.author_id, g.k, a.n_top, a.hits, a.dcg, n.n_true
 FROM (SELECT m.model, u.author_id, ks.k FROM (SELECT DISTINCT model FROM {preds_cte}) m, {policy_users} u, ks) g
 LEFT JOIN agg a ON a.model = g.model AND a.author_id = g.author_id AND a.k = g.k
 LEFT JOIN ntrue n ON n.author_id = g.author_id"""
    return base + f""",
src AS ({src}),
pu AS (SELECT model, author_id AS user_id, CAST(k AS INT) AS k,
 CAST(coalesce(hits, 0) AS DOUBLE) / greatest(coalesce(n_top, 0), 1) AS precision,
 CASE WHEN coalesce(n_true, 0) > 0 THEN CAST(coalesce(hits, 0) AS DOUBLE) / n_true ELSE 0.0 END AS recall,
 CASE WHEN least(k, coalesce(n_true, 0)) > 0 THEN coalesce(dcg, 0.0) /
   list_sum(list_transform(range(1, least(k, coalesce(n_true, 0)) + 1), lambda i: 1.0 / log2(i + 1)))
   ELSE 0.0 END AS ndcg
 FROM src),
pu2 AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
 ELSE 0.0 END AS f1 FROM pu)"""
