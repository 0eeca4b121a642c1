"""Relational TF-IDF and cosine (TF-1 .. TF-6).

A document is a row (doc key, token array).  Weights follow the common
library default: raw term count, idf = ln((1 + n) / (1 + df)) + 1, rows
scaled to unit L2 norm.  Documents may carry a multiplicity `mult` (how
many items share the same text): n and df then count items, while the
vector is computed once per distinct text (PO-5), which keeps hot texts
from multiplying the work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def tfidf(docs: DataFrame, key: str, tokens: Column, max_features: int | None = None,
          mult: str | None = None) -> DataFrame:
    """-> (key, term, weight) with unit-norm rows; empty documents have no rows."""
    m = F.col(mult) if mult else F.lit(1)
    d = docs.select(key, m.cast("long").alias("_m"), tokens.alias("_t"))
    n_docs = d.select(F.sum("_m")).scalar()
    tf = (d.select(key, "_m", F.explode("_t").alias("term"))
          .groupBy(key, "_m", "term").agg(F.count(F.lit(1)).alias("tf")))
    if max_features is not None:  # a named feature of TF-2 / TF-4: the most frequent terms
        vocab = (tf.groupBy("term").agg(F.sum(F.col("tf") * F.col("_m")).alias("_tot"))
                 .orderBy(F.col("_tot").desc(), F.col("term").asc()).limit(max_features)
                 .select("term"))
        tf = tf.join(F.broadcast(vocab), "term", "left_semi")
    dfreq = tf.groupBy("term").agg(F.sum("_m").alias("df"))
    idf = dfreq.select("term", (F.log((F.lit(1) + n_docs) / (F.lit(1) + F.col("df"))) + 1).alias("idf"))
    w = tf.join(idf, "term").select(key, "term", (F.col("tf") * F.col("idf")).alias("_w"))
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(key)))
    return w.select(key, "term", (F.col("_w") / norm).alias("weight"))


def cosine_pairs(pairs: DataFrame, vectors: DataFrame, left: str, right: str,
                 key: str) -> DataFrame:
    """TF-6 for listed pairs: sum of weight products over shared terms.

    Joins each side's terms on (pair, term); never enumerates all pairs of
    documents sharing a term.  Pairs without a shared term get 0.
    """
    lv = vectors.select(F.col(key).alias(left), "term", F.col("weight").alias("_wl"))
    rv = vectors.select(F.col(key).alias(right), "term", F.col("weight").alias("_wr"))
    p = pairs.select(left, right).distinct()
    sims = (p.join(lv, left).join(rv, [right, "term"])
            .groupBy(left, right).agg(F.sum(F.col("_wl") * F.col("_wr")).alias("cosine")))
    return (p.join(sims, [left, right], "left")
            .withColumn("cosine", F.coalesce(F.col("cosine"), F.lit(0.0))))
