"""Profile bundle (PL-3) and integration comparison report (PL-4, SK-3, ST-7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import profile as P
from ..sources import fixtures
from ..sources.sinks import report_lines


def schema_diff(a: DataFrame, b: DataFrame, name_a: str = "a", name_b: str = "b") -> DataFrame:
    """ST-7: columns only in a, only in b, and common (set algebra on names)."""
    ca, cb = list(a.columns), list(b.columns)
    rows = ([(c, f"only_{name_a}") for c in ca if c not in cb]
            + [(c, f"only_{name_b}") for c in cb if c not in ca]
            + [(c, "common") for c in ca if c in cb])
    return a.sparkSession.createDataFrame(rows, "column_name string, membership string")


def profile(df: DataFrame, kind: str) -> dict[str, DataFrame]:
    """PL-3: the profiling tables of one table kind (games / reviews / merged)."""
    out = {"shape": P.shape(df), "nulls": P.null_counts(df), "schema": P.schema_profile(df),
           "dtypes": P.dtype_distribution(df)}
    if kind in ("games", "merged"):
        nums = [c for c in ("positive_ratio", "user_reviews", "price_final", "price_original", "discount")
                if c in df.columns]
        out["describe"] = P.describe(df, nums)
        out["rating_counts"] = P.value_counts(df, "rating")
        out["year_counts"] = P.value_counts(df, F.year("date_release").alias("year"), share_of=None)
        out["ratio_histogram"] = P.histogram(df, F.col("positive_ratio"), 50)
        out["log_reviews_histogram"] = P.histogram(df, F.log10(F.col("user_reviews") + 1), 50)
        out["scatter_bins"] = P.hist2d(df, F.log10(F.col("user_reviews") + 1), F.col("positive_ratio"), 20, 20)
    if kind in ("reviews", "merged"):
        out["sentiment"] = P.value_counts(df, "is_positive")
        out["per_game"] = P.per_key_count_stats(df.where(F.col("id").isNotNull()), "app_id")
        out["per_author"] = P.per_key_count_stats(df, "author_id")
        out["words"] = P.word_frequency(df.where(F.col("content").isNotNull()), "content", 20)
        out["duplicates"] = P.duplicate_counts(df, "id")
    if kind == "reviews":
        lens = df.where(F.col("content").isNotNull()).select(F.char_length("content").alias("len"))
        out["length_mode"] = P.mode(lens, "len")
        out["length_histogram"] = P.histogram(lens, F.col("len"), 50)
    return out


def integration_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PL-4: before/after numbers of the integration as text lines (SK-3)."""
    g, r, m = fixtures.games(spark, sf_dir), fixtures.reviews(spark, sf_dir), fixtures.merged(spark, sf_dir)
    n_cols = {f"{n}_cols": F.lit(len(df.columns)) for n, df in (("games", g), ("review", r), ("merged", m))}
    of = lambda c, v: F.count_if(F.col(c) == v)
    kept = F.count_if(F.col("id").isNotNull())
    # one aggregate per table; the three one-row results meet as literals
    before = g.agg(F.count(F.lit(1)).alias("games_rows"), F.avg("positive_ratio").alias("g_ratio"), F.avg("user_reviews").alias("g_reviews")).first().asDict()
    before |= r.agg(F.count(F.lit(1)).alias("review_rows"), of("is_positive", "Positive").alias("r_pos"), of("is_positive", "Negative").alias("r_neg"),
                    F.count_if(F.col("content").isNull()).alias("r_null")).first().asDict()
    row = m.agg(F.count(F.lit(1)).alias("merged_rows"), kept.alias("kept"), F.count_if(F.col("id").isNull()).alias("no_review"),
                (F.count_if(F.col("id").isNull()) * 100.0 / F.count(F.lit(1))).alias("no_review_pct"),
                F.count_distinct(F.when(F.col("id").isNotNull(), F.col("app_id"))).alias("games_with_reviews"),
                F.avg("positive_ratio").alias("m_ratio"), F.avg("user_reviews").alias("m_reviews"),
                of("is_positive", "Positive").alias("m_pos"), of("is_positive", "Negative").alias("m_neg"),
                F.count_if(F.col("id").isNotNull() & F.col("content").isNull()).alias("m_null"))
    row = row.withColumns({c: F.lit(v) for c, v in before.items()} | n_cols).withColumn("preserved_pct", F.col("kept") * 100.0 / F.col("review_rows"))
    template = [
        ("games: %d rows x %d cols", ["games_rows", "games_cols"]),
        ("reviews: %d rows x %d cols", ["review_rows", "review_cols"]),
        ("merged: %d rows x %d cols", ["merged_rows", "merged_cols"]),
        ("games with reviews: %d", ["games_with_reviews"]),
        ("review rows after join: %d", ["kept"]),
        ("merged rows without review: %d (%.2f%%)", ["no_review", "no_review_pct"]),
        ("review preservation: %.2f%%", ["preserved_pct"]),
        ("mean positive ratio: %.6f in games, %.6f merged", ["g_ratio", "m_ratio"]),
        ("mean user reviews: %.6f in games, %.6f merged", ["g_reviews", "m_reviews"]),
        ("positive / negative: %d / %d in reviews, %d / %d merged", ["r_pos", "r_neg", "m_pos", "m_neg"]),
        ("reviews without text: %d in reviews, %d merged", ["r_null", "m_null"]),
    ]
    return report_lines(row, template)
