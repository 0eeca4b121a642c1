"""Factorisation-machine input over user, item and title features (TF-11,
TF-12, RC-7).

Features: one-hot user, one-hot item, and the TF-IDF of the compact title
token (FN-2).  A compact title is a single token, so its L2-normalised
TF-IDF row is a one-hot of the title: all three blocks are one-hot
encodings, assembled into one sparse vector.  The reference stops at this
matrix and its dimension summary; `fit=True` additionally trains Spark's
FMRegressor (its factors are held by the driver, so use it only when the
feature count is bounded).
"""

from __future__ import annotations

from pyspark.ml.linalg import VectorUDT
from pyspark.ml.regression import FMRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..functions.text import clean_text_compact
from ..operators.split import dense_index

BLOCKS = ("author", "app", "title")


def _one_hot(entries: str, size: int) -> Column:
    """Sparse vector with ones at the sorted places `entries`.

    It is read from its text by the schema of vectors: Spark's encoder and assembler would list
    every feature by name in the column's metadata, on the driver.
    """
    ones = F.transform(entries, lambda _: F.lit(1.0))
    vector = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(size).cast("int").alias("size"), F.col(entries).cast("array<int>").alias("indices"), ones.alias("values"))
    read = F.from_json(F.to_json(F.struct(vector.alias("v"))), StructType([StructField("v", VectorUDT())]))
    return read["v"].alias("features", metadata={"ml_attr": {"num_attrs": size}})


def build_features(interactions: DataFrame, items: DataFrame):
    """-> (training rows with `features` + `label`, dimension summary row).

    Each block is a distributed dense index joined to the rows; only the three
    block sizes reach the driver, and the column's metadata holds the number of
    features, not their names.  A block is exactly as wide as its index; a row without a
    value has no entry in it (an unknown item has no title, and titles of fewer than two
    characters are no token).
    """
    token = clean_text_compact("title")
    df = (interactions.select("author_id", "app_id", "is_positive_encoded")
          .join(items.select("app_id", "title").dropDuplicates(["app_id"]), "app_id", "left")
          .withColumn("author", F.col("author_id").cast("string")).withColumn("app", F.col("app_id").cast("string"))
          .withColumn("title", F.when(F.length(token) >= 2, token)))
    n_rows, sizes, out = df.count(), [], df
    for block in BLOCKS:
        index = dense_index(df, block, index_col=f"{block}_ix")
        sizes.append(index.count())
        out = out.join(index, block, "left")
    spark, ends = df.sparkSession, [sum(sizes[:k]) for k in range(len(sizes))]
    entries = F.filter(F.array(*(F.col(f"{block}_ix") + F.lit(end) for block, end in zip(BLOCKS, ends, strict=True))), lambda x: x.isNotNull())
    out = out.withColumn("_entries", entries).withColumn("label", F.coalesce("is_positive_encoded", F.lit(0)).cast("double"))
    out = out.withColumn("features", _one_hot("_entries", sum(sizes)))
    summary = spark.createDataFrame(
        [(n_rows, *sizes, sum(sizes))],
        "n_rows long, n_user_features long, n_item_features long, n_title_features long, n_features long")
    return out.select("author_id", "app_id", "features", "label"), summary


def fit_fm(features: DataFrame, factor_size: int = 8, step: float = 0.05, max_iter: int = 50, seed: int = 42):
    fm = FMRegressor(featuresCol="features", labelCol="label", factorSize=factor_size, stepSize=step,
                     maxIter=max_iter, seed=seed, solver="adamW")
    return fm.fit(features)
