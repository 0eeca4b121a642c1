"""Score normalisation, alignment and top-K (WN-2..5, JN-9, SL-4, SL-5).

Per-user windows here run over candidate rows, whose number per user is
bounded by the candidate cap (or the catalogue), never by a user's history.
Consecutive windows share `partitionBy(user)`, so Spark plans one exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TIE_DIGITS = 9


def _w(by):
    return Window.partitionBy(*by)


def minmax_per_user(df: DataFrame, col: str, by=("author_id",), eps: float = 0.0,
                    out: str | None = None) -> DataFrame:
    """WN-3 / WN-4: (s - min) / (max - min [+ eps]) when max > min, else raw."""
    mn = F.min(col).over(_w(by))
    mx = F.max(col).over(_w(by))
    expr = F.when(mx > mn, (F.col(col) - mn) / (mx - mn + F.lit(eps))).otherwise(F.col(col))
    return df.withColumn(out or col, expr)


def max_norm_per_user(df: DataFrame, col: str, by=("author_id",), out: str | None = None) -> DataFrame:
    """WN-5: s / max when max > 0, else raw."""
    mx = F.max(col).over(_w(by))
    return df.withColumn(out or col, F.when(mx > 0, F.col(col) / mx).otherwise(F.col(col)))


def align(grid: DataFrame, scores: DataFrame, keys=("author_id", "app_id"),
          col: str = "score") -> DataFrame:
    """JN-9: every candidate gets the model's score, missing -> 0."""
    return (grid.join(scores.select(*keys, col), list(keys), "left")
            .withColumn(col, F.coalesce(F.col(col), F.lit(0.0))))


def tie_key(score: Column) -> Column:
    """Rounded score: float noise must not decide ranks among equal scores."""
    return F.round(score, TIE_DIGITS)


def top_k(df: DataFrame, k: int, score: str = "score", by=("author_id",),
          item: str = "app_id", rank_col: str = "rank", demote: Column | None = None) -> DataFrame:
    """SL-4 / SL-5 / WN-2: 1-based rank by (score desc, item string asc), keep <= k.

    `row_number() <= k` lets Spark insert a partial per-partition group
    limit before the shuffle, so a user with many candidates ships k rows
    per map task.  `demote` (SL-5) ranks flagged rows after all others.
    """
    order = [tie_key(F.col(score)).desc(), F.col(item).cast("string").asc()]
    if demote is not None:
        order.insert(0, demote.cast("int").asc())
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def score_variance(preds: DataFrame, by=("model", "author_id"), score: str = "score") -> DataFrame:
    """AG-38: population variance of scores per (model, user); 0 -> flat ranking."""
    return (preds.groupBy(*by).agg(F.var_pop(score).alias("score_var"))
            .withColumn("flat", F.col("score_var") == 0))
