"""Explicit schemas for the raw CSV layouts and the column guard (SC-5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

GAMES_SCHEMA = T.StructType([
    T.StructField("app_id", T.LongType(), False),
    T.StructField("title", T.StringType()),
    T.StructField("date_release", T.StringType()),
    T.StructField("win", T.StringType()),
    T.StructField("mac", T.StringType()),
    T.StructField("linux", T.StringType()),
    T.StructField("steam_deck", T.StringType()),
    T.StructField("rating", T.StringType()),
    T.StructField("positive_ratio", T.StringType()),
    T.StructField("user_reviews", T.StringType()),
    T.StructField("price_final", T.StringType()),
    T.StructField("price_original", T.StringType()),
    T.StructField("discount", T.StringType()),
])

REVIEWS_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("app_id", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("author_id", T.StringType()),
    T.StructField("is_positive", T.StringType()),
])

# Evaluation inputs keep ids as strings so 17-digit author ids never pass
# through a double (SC-3).
INTERACTIONS_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("author_id", T.StringType()),
    T.StructField("app_id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("is_positive_encoded", T.IntegerType()),
])

PREDICTIONS_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("author_id", T.StringType()),
    T.StructField("app_id", T.StringType()),
    T.StructField("rank", T.IntegerType()),
    T.StructField("score", T.DoubleType()),
])

INTERACTION_COLUMNS = ("author_id", "app_id", "title", "is_positive_encoded")

# Second review layout (SC-6): Labeling, username, game id.
ALT_REVIEW_RENAMES = {"Labeling": "is_positive", "username": "author_id", "game id": "app_id"}


def require_columns(df: DataFrame, required) -> DataFrame:
    """SC-5: raise ValueError naming the missing columns, else return df."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"Missing columns: {missing}")
    return df
