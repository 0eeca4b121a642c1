"""Word2Vec title recommender with clusters and a zero-score fallback
(TF-8, TF-9, TF-10, RC-9, RC-10).

Titles are cleaned (FN-1) and split on whitespace; Spark ML's skip-gram
Word2Vec gives word vectors and `Word2VecModel.transform` the mean vector
per title (zeros when no word is known).  Sum of cosines to the liked
items is the dot product with the sum of the liked *unit* vectors, so the
score is one dot product per candidate.  Candidates are the items the user
has not rated positively (T-7); when all scores are 0 the user gets
pseudo-random unrated items (seeded hash order) flagged `is_fallback`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import Word2Vec
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import clean_text, whitespace_tokens
from ..functions.vectors import l2_norm
from ..operators.split import dense_index
from ..session import written
from .kmeans import kmeans, nearest

#: Titles of a part that Word2Vec trains on its own.
PART_TITLES = 5000


@dataclass
class W2VModel:
    items: DataFrame   # (app_id, title, unit array<double>, cluster int)
    likes: DataFrame   # (author_id, app_id) positive ratings, duplicates kept


def fit_w2v(ratings: DataFrame, items: DataFrame, dim: int = 30, window: int = 3,
            n_clusters: int = 5, n_init: int = 10, seed: int = 42) -> W2VModel:
    rated = items.join(ratings.select("app_id").distinct(), "app_id", "left_semi")
    docs = rated.select("app_id", "title", whitespace_tokens(clean_text("title")).alias("tokens"))
    n = docs.count()
    # parts train apart and are averaged after each iteration; titles are many before there is more than one
    parts = max(1, -(-n // PART_TITLES))
    w2v = Word2Vec(vectorSize=dim, windowSize=window, minCount=1, seed=seed, numPartitions=parts,
                   inputCol="tokens", outputCol="vec").fit(docs.repartition(parts, "app_id"))
    vecs = written(w2v.transform(docs).select("app_id", "title", vector_to_array("vec").alias("v")), "w2v-titles")
    centres, _ = kmeans(vecs, max(1, min(n_clusters, n)), n_init, seed)
    clustered = nearest(vecs, centres)
    norm = l2_norm(F.col("v"))
    unit = F.when(norm > 0, F.transform("v", lambda x: x / norm)).otherwise(F.transform("v", lambda x: x * 0.0))
    out = clustered.select("app_id", "title", unit.alias("unit"), F.col("cluster").cast("int"))
    likes = ratings.where(F.col("rating") == 1).select("author_id", "app_id")
    return W2VModel(out, likes)


def w2v_recommend(model: W2VModel, users: DataFrame, ranked_items: DataFrame, n: int = 5,
                  seed: int = 42) -> DataFrame:
    """Top-n per requested user with positive ratings (others get no rows, as the reference).

    Every product is taken in blocks.  A user all of whose scores are zero gets n
    unrated items from a pseudo-random place of the catalogue on (RC-10).
    """
    from ..operators.blocked import Base, top_items

    liked = model.likes.join(users.select("author_id").distinct(), "author_id", "left_semi")
    # a sum a dimension: a user's partial profile is one row, not one a dimension
    dim = model.items.agg(F.max(F.size("unit"))).first()[0] or 0
    sums = (liked.join(model.items.select("app_id", "unit"), "app_id").where("unit is not null")
            .groupBy("author_id").agg(F.count(F.lit(1)), *(F.sum(F.get("unit", F.lit(d))).alias(f"x{d}") for d in range(dim))))
    prof = sums.select("author_id", F.array(*(f"x{d}" for d in range(dim))).cast("array<double>").alias("v"))
    u = written(dense_index(prof, "author_id", index_col="u").join(prof, "author_id"), "w2v-users")
    known = ranked_items.join(model.items.select("app_id"), "app_id", "left_semi")
    i = written(dense_index(known, "item_rank", index_col="i").join(known, "item_rank").select("app_id", "i"), "w2v-items")
    rated = written(model.likes.distinct().join(u.select("author_id", "u"), "author_id").join(i, "app_id").select("u", "i"), "w2v-rated")
    vectors = i.join(model.items.select("app_id", F.col("unit").alias("v")), "app_id")
    top = written(top_items(u, vectors, [Base("v")], n, lambda raw, lo, hi: raw, rated), "w2v-top")
    flat = (F.col("least") == 0) & (F.col("most") == 0)
    normal = top.where(~flat).select("u", "i", F.when(F.col("most") > 0, F.col("score") / F.col("most")).otherwise(F.col("score")).alias("score"), F.lit(False).alias("is_fallback"), "rank")
    n_items = i.select(F.count(F.lit(1))).scalar()
    n_rated = rated.groupBy("u").agg(F.count(F.lit(1)).alias("n_rated"))
    start = F.pmod(F.xxhash64(F.lit(seed), "u"), n_items)
    width = F.least(F.coalesce("n_rated", F.lit(0)) + F.lit(n), n_items)
    tried = (top.where(flat).select("u").distinct().join(n_rated, "u", "left")
             .select("u", start.alias("start"), F.explode(F.sequence(F.lit(0).cast("long"), width - 1)).alias("step"))
             .select("u", "step", F.pmod(F.col("start") + F.col("step"), n_items).alias("i")).join(rated, ["u", "i"], "left_anti"))
    fallback = tried.withColumn("rank", F.row_number().over(Window.partitionBy("u").orderBy("step"))).where(F.col("rank") <= n)
    both = normal.unionByName(fallback.select("u", "i", F.lit(0.0).alias("score"), F.lit(True).alias("is_fallback"), "rank"))
    return (both.join(u.select("u", "author_id"), "u").join(i, "i").join(model.items.drop("unit"), "app_id")
            .select("author_id", "app_id", "title", "cluster", "score", "is_fallback", "rank"))
