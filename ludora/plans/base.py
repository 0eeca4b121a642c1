"""Shared building blocks of the pipelines: fixture -> preprocessed -> split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean
from ..operators.split import temporal_holdout
from ..sources import fixtures


def preprocessed(spark: SparkSession, sf_dir: str, ratings=None) -> DataFrame:
    """PL-2 over the fixture; `ratings` None derives the one-hot levels from the data."""
    # a document's text is many times a review's other columns: it comes back after the dedup
    first = clean.preprocess(fixtures.merged(spark, sf_dir, documents_only_marked=True), ratings)
    return fixtures.with_documents(spark, sf_dir, first)


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluation rows: id, author_id, app_id, title, is_positive_encoded.

    Only the columns the recommenders read are kept, so the scan prunes the
    rest; the min-max scaling of PL-2 does not change any of these.
    """
    # Only whether a review has text matters here, so the text itself never
    # crosses a join or the dedup shuffle: ordering by the null flag keeps the same row
    # for every output column (content sorts nulls first, as the flag does).
    m = fixtures.merged(spark, sf_dir, texts_only_marked=True).select(
        "id", "author_id", "app_id", "title", "is_positive", "positive_ratio", "price_final",
        F.col("content").isNotNull().alias("has_content"))
    df = clean.dedup_first(m, ["id"], ("app_id", "author_id", "is_positive", "has_content"))
    df = df.where(F.col("has_content"))
    df = df.where(F.coalesce(F.col("positive_ratio"), F.lit(0)).between(0, 100)
                  & (F.coalesce(F.col("price_final"), F.lit(0.0)) >= 0))
    return df.select("id", "author_id", "app_id", "title",
                     clean.encode_label("is_positive").alias("is_positive_encoded"))


def split(spark: SparkSession, sf_dir: str):
    return temporal_holdout(interactions(spark, sf_dir))
