"""Title-embedding recommender (TF-7, RC-8).

TF-IDF over unigrams + bigrams (5000 features, default tokens) of every
item's title, truncated SVD by distributed subspace iteration (`svd.py`),
item embedding = U * S = X * V.  A user
is the mean of the embeddings of its distinct liked items; the score is
the cosine with a +1e-8 denominator, as FN-10.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import with_bigrams, word_tokens
from ..functions.vectors import cosine
from ..operators.split import dense_index
from ..operators.tfidf import tfidf
from ..session import written
from .svd import truncated_svd


@dataclass
class EmbedModel:
    item_emb: DataFrame   # (app_id, emb array<double>)
    likes: DataFrame      # (author_id, app_id) distinct positive train items

    def user_emb(self) -> DataFrame:
        e = self.likes.join(self.item_emb, "app_id")
        # mean of vectors: explode positions, average per (user, dim), re-assemble in order
        pos = e.select("author_id", F.posexplode("emb").alias("d", "x"))
        per = pos.groupBy("author_id", "d").agg(F.avg("x").alias("x"))
        return per.groupBy("author_id").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("d", "x"))), lambda s: s["x"]).alias("uemb"))

    def vectors(self, out: str = "we") -> tuple[DataFrame, DataFrame]:
        """(author_id, out) and (app_id, out), scored by their cosine."""
        return self.user_emb().withColumnRenamed("uemb", out), self.item_emb.withColumnRenamed("emb", out)

    def score_pairs(self, pairs: DataFrame, out: str = "we_raw") -> DataFrame:
        s = pairs.join(self.user_emb(), "author_id", "left").join(self.item_emb, "app_id", "left")
        val = F.when(F.col("uemb").isNotNull() & F.col("emb").isNotNull(), cosine(F.col("uemb"), F.col("emb")))
        return s.withColumn(out, F.coalesce(val, F.lit(0.0))).drop("uemb", "emb")


def fit_embed(train: DataFrame, items: DataFrame, n_components: int = 30,
              max_features: int | None = None, seed: int = 42) -> EmbedModel:
    it = items.select("app_id", F.coalesce(F.col("title"), F.lit("")).alias("title")).distinct()
    docs = it.groupBy("title").agg(F.count(F.lit(1)).alias("mult"))
    vec = tfidf(docs, "title", with_bigrams(word_tokens("title")), max_features=max_features, mult="mult")
    terms = dense_index(vec, "term", index_col="t")
    titles = dense_index(docs, "title", index_col="row")
    n_feat = terms.select(F.count(F.lit(1))).first()[0]
    k = max(1, min(n_components, n_feat - 1))
    rows, s = truncated_svd(vec.join(terms, "term").join(titles, "title"), k, seed)
    emb_rows = rows.withColumnRenamed("m", "emb").join(titles, "row").select("title", "emb")
    zero = F.array_repeat(F.lit(0.0), len(s))
    item_emb = written(it.join(emb_rows, "title", "left").select("app_id", F.coalesce("emb", zero).alias("emb")), "title-embeddings")
    likes = train.where(F.col("is_positive_encoded") == 1).select("author_id", "app_id").distinct()
    return EmbedModel(item_emb, likes)
