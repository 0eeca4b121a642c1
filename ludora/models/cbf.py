"""Content-based recommender over title TF-IDF (RC-4, RC-5, RC-19, RC-21).

Score of candidate j for user u = sum over the user's liked items i of
cos(i, j).  Vectors have unit norm, so that sum is the dot product of j
with the user's profile (the sum of liked vectors) -- PO-2: no item x item
matrix is ever built.  Work is done per distinct title and expanded to
items at the end (PO-5).

`dedup_titles=True` follows the reference: the catalogue is deduplicated by
title value, so only the first app of each title (smallest app_id) carries
a vector; other apps with that title score 0 and likes on them are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stopwords import ENGLISH_STOP_WORDS
from ..functions.text import drop_stop_words, word_tokens
from ..operators.split import dense_index
from ..operators.tfidf import tfidf
from ..session import written


@dataclass
class CBFModel:
    item_title: DataFrame   # (app_id, title): apps that carry a vector
    vectors: DataFrame      # (title, term, weight)
    likes: DataFrame        # (author_id, app_id): positive train rows, duplicates kept

    def profiles(self) -> DataFrame:
        """(author_id, term, pw): sum of liked vectors; mean via n_liked (RC-5)."""
        liked = self.likes.join(self.item_title, "app_id")
        per_title = liked.groupBy("author_id", "title").agg(F.count(F.lit(1)).alias("_c"))
        return (per_title.join(self.vectors, "title")
                .groupBy("author_id", "term")
                .agg(F.sum(F.col("_c") * F.col("weight")).alias("pw")))

    def n_liked(self) -> DataFrame:
        return (self.likes.join(self.item_title.select("app_id"), "app_id", "left_semi")
                .groupBy("author_id").agg(F.count(F.lit(1)).alias("n_liked")))

    def score_pairs(self, pairs: DataFrame, out: str = "cbf_raw") -> DataFrame:
        """Raw similarity sums for listed (author_id, app_id) rows; cold -> 0.

        Scores are computed once per distinct (user, title) -- items sharing
        a title share the score (PO-5) -- and joined back to the rows.
        """
        pt = pairs.select("author_id", "app_id").distinct().join(self.item_title, "app_id")
        ut = pt.select("author_id", "title").distinct()
        sims = (ut.join(self.vectors, "title")
                .join(self.profiles(), ["author_id", "term"])
                .groupBy("author_id", "title")
                .agg(F.sum(F.col("weight") * F.col("pw")).alias(out)))
        scored = pt.join(sims, ["author_id", "title"]).select("author_id", "app_id", out)
        return (pairs.join(scored, ["author_id", "app_id"], "left")
                .withColumn(out, F.coalesce(F.col(out), F.lit(0.0))))

    def sparse_vectors(self, out: str = "cbf") -> tuple[DataFrame, DataFrame]:
        """(author_id, out_t, out_w) and (app_id, out_t, out_w): numbered terms and weights, for the blocked scorer."""
        terms = dense_index(self.vectors, "term", index_col="t")

        def packed(rows, key, weight):
            lists = rows.join(terms, "term").groupBy(key).agg(F.sort_array(F.collect_list(F.struct(F.col("t").cast("int").alias("t"), F.col(weight).alias("w")))).alias("x"))
            return lists.select(key, F.col("x.t").alias(f"{out}_t"), F.col("x.w").alias(f"{out}_w"))

        # an app that stands for several titles has the sum of their vectors
        apps = self.item_title.join(self.vectors, "title").groupBy("app_id", "term").agg(F.sum("weight").alias("weight"))
        return packed(self.profiles(), "author_id", "pw"), packed(apps, "app_id", "weight")


def representatives(items: DataFrame, dedup_titles: bool = True) -> DataFrame:
    """(app_id, title) items that carry a vector; null title -> ''."""
    it = items.select("app_id", F.coalesce(F.col("title"), F.lit("")).alias("title")).distinct()
    if not dedup_titles:
        return it
    return it.groupBy("title").agg(F.min("app_id").alias("app_id")).select("app_id", "title")


def fit_cbf(train: DataFrame, items: DataFrame, max_features: int | None = None,
            stop_words=ENGLISH_STOP_WORDS, dedup_titles: bool = True) -> CBFModel:
    """RC-4 fit: title TF-IDF (TF-1/TF-2) + the positive train rows."""
    # written: a filter on the tokens would otherwise move below the grouping and split the title of every review
    item_title = written(representatives(items, dedup_titles), "cbf-titles")
    docs = item_title.groupBy("title").agg(F.count(F.lit(1)).alias("mult"))
    tokens = word_tokens("title")
    if stop_words:
        tokens = drop_stop_words(tokens, stop_words)
    vectors = tfidf(docs, "title", tokens, max_features=max_features, mult="mult")
    likes = train.where(F.col("is_positive_encoded") == 1).select("author_id", "app_id")
    return CBFModel(item_title, vectors, likes)


def cbf_top_k(model: CBFModel, users: DataFrame, ranked_items: DataFrame, seen: DataFrame,
              k: int, normalize: bool = True) -> DataFrame:
    """Exact top-k over *all* unseen items; ties break by app_id string order.

    Users' profiles meet the items' vectors block by block, by the terms that a
    chunk of items uses, so a term that most titles hold is a column of a block's
    product and never a join key that all users and titles pass through.
    Scores are divided by the user's maximum over the unseen items (WN-5).
    -> (author_id, app_id, score, rank)
    """
    from ..operators.blocked import Base, top_items

    of_users, of_items = model.sparse_vectors("cbf")
    u = written(dense_index(users, "author_id", index_col="u").join(of_users, "author_id", "left"), "cbf-users")
    i = written(ranked_items.select("app_id", F.col("item_rank").alias("i")).join(of_items, "app_id", "left"), "cbf-items")
    known = seen.select("author_id", "app_id").distinct().join(u.select("author_id", "u"), "author_id").join(i.select("app_id", "i"), "app_id").select("u", "i")
    top = top_items(u, i, [Base("cbf", "sparse")], k, seen=known)
    score = F.when(F.col("most") > 0, F.col("score") / F.col("most")).otherwise(F.col("score")) if normalize else F.col("score")
    return top.join(u.select("u", "author_id"), "u").join(i.select("i", "app_id"), "i").select("author_id", "app_id", score.alias("score"), "rank")
