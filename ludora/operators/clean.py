"""Integration and cleaning (JN-1, PL-2 and the PR-*/FI-*/ST-* operators).

All steps are column expressions or one shuffle each; nothing is collected
except the bounded list of distinct ratings the one-hot encoding needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from ..sources.fixtures import MERGED_COLUMNS

NUMERIC_FILL = ("positive_ratio", "user_reviews", "price_final", "price_original", "discount")
BOOL_COLUMNS = ("win", "mac", "linux", "steam_deck")
SCALE_COLUMNS = ("user_reviews", "price_final", "positive_ratio")
# Fixed value: extra tokens read as missing in CSV profiling (SC-2).
NULL_TOKENS = ("", " ", "NA", "N/A", "null", "None")
MAX_ONE_HOT_LEVELS = 1000
DEDUP_ORDER = ("app_id", "author_id", "is_positive", "content")


def integrate(reviews: DataFrame, games: DataFrame) -> DataFrame:
    """JN-1: right outer join on app_id; every game kept, orphan reviews dropped.

    The matches are an inner join and the games without a review an anti
    join: an outer join cannot split the side that it does not preserve, so
    a game that holds most reviews would be one task.  AQE splits the inner join's
    skewed side, and the anti join only sees each reviewed key once per task.
    """
    r, g = reviews.alias("r"), games.alias("g")
    tail = [F.col(f"g.{c}") for c in MERGED_COLUMNS[5:]]
    met = r.join(g, F.col("r.app_id") == F.col("g.app_id")).select(
        F.col("r.id"), F.col("g.app_id"), *(F.col(f"r.{c}") for c in ("content", "author_id", "is_positive")), *tail)
    reviewed = reviews.select(F.col("app_id").alias("_reviewed")).distinct()
    types = reviews.schema
    rest = g.join(reviewed, F.col("g.app_id") == F.col("_reviewed"), "left_anti").select(
        F.lit(None).cast(types["id"].dataType).alias("id"), F.col("g.app_id"),
        *(F.lit(None).cast(types[c].dataType).alias(c) for c in ("content", "author_id", "is_positive")), *tail)
    return met.unionByName(rest)


def null_tokens_to_null(c: str, tokens=NULL_TOKENS) -> Column:
    """SC-2: treat the given string tokens as missing."""
    return F.when(F.col(c).isin(list(tokens)), F.lit(None)).otherwise(F.col(c)).alias(c)


def binary_label(c: str = "is_positive") -> Column:
    """PR-2: 1 when 'Positive', else 0 (null included)."""
    return F.when(F.col(c) == "Positive", F.lit(1)).otherwise(F.lit(0))


def encode_label(c: str = "is_positive") -> Column:
    """PR-3: Positive -> 1, Negative -> 0, anything else -> null."""
    return (F.when(F.col(c) == "Positive", F.lit(1))
            .when(F.col(c) == "Negative", F.lit(0)))


def parse_bool(c: str) -> Column:
    """PR-6: boolean parse, null or unparsable -> false."""
    return F.coalesce(F.expr(f"try_cast(`{c}` AS BOOLEAN)"), F.lit(False)).alias(c)


def parse_date(c: str) -> Column:
    """PR-5: date parse, invalid -> null."""
    return F.expr(f"try_cast(`{c}` AS DATE)").alias(c)


def dedup_first(df: DataFrame, keys, order) -> DataFrame:
    """ST-1/ST-2/ST-3: keep the first row per key under a declared order.

    Null keys form one group, as in pandas drop_duplicates.  A window keeps
    the whole row; the partition key is the dedup key, so one hot key
    costs one sorted (spillable) partition, never a driver collect.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def rating_levels(df: DataFrame, c: str = "rating") -> list[str]:
    """Distinct non-null levels, sorted; bounded collect with a size check."""
    rows = (df.where(F.col(c).isNotNull()).select(c).distinct()
            .orderBy(c).limit(MAX_ONE_HOT_LEVELS + 1).collect())
    if len(rows) > MAX_ONE_HOT_LEVELS:
        raise ValueError(f"{c} has more than {MAX_ONE_HOT_LEVELS} levels; not a one-hot column")
    return [r[0] for r in rows]


def one_hot(df: DataFrame, c: str = "rating", levels=None, prefix: str | None = None) -> DataFrame:
    """PR-8: pandas get_dummies(dummy_na=True): one boolean column per level + `_nan`."""
    prefix = prefix or c
    levels = rating_levels(df, c) if levels is None else list(levels)
    cols = [(F.coalesce(F.col(c) == F.lit(v), F.lit(False))).alias(f"{prefix}_{v}") for v in levels]
    cols.append(F.col(c).isNull().alias(f"{prefix}_nan"))
    return df.select(*[x for x in df.columns if x != c], *cols)


def min_max_scale(df: DataFrame, columns) -> DataFrame:
    """TF-13: (x - min) / (max - min) per column; a constant column becomes 0.

    Fit / transform: one aggregate job returns the 2 x len(columns) bounds
    (a single row), which enter the projection as literals, so the scaling
    stays a narrow projection and the input plan runs once for the fit.
    """
    bounds = df.agg(*[F.min(c).alias(f"mn_{c}") for c in columns],
                    *[F.max(c).alias(f"mx_{c}") for c in columns]).first()
    out = df
    for c in columns:
        mn, mx = F.lit(bounds[f"mn_{c}"]), F.lit(bounds[f"mx_{c}"])
        out = out.withColumn(c, F.when(mx > mn, (F.col(c) - mn) / (mx - mn))
                             .otherwise(F.col(c).cast("double") - mn))
    return out


def standardize(df: DataFrame, columns) -> DataFrame:
    """TF-14: (x - mean) / population std; constant column -> 0."""
    stats = df.agg(*[F.avg(c).alias(f"mu_{c}") for c in columns],
                   *[F.stddev_pop(c).alias(f"sd_{c}") for c in columns]).first()
    out = df
    for c in columns:
        mu, sd = F.lit(stats[f"mu_{c}"]), F.lit(stats[f"sd_{c}"])
        out = out.withColumn(c, F.when(sd > 0, (F.col(c) - mu) / sd).otherwise(F.lit(0.0)))
    return out


def preprocess(merged: DataFrame, rating_values=None) -> DataFrame:
    """PL-2 in the reference's order.

    dedup id -> drop null content -> fill numeric 0 -> parse dates -> parse
    booleans -> int cast -> label encode -> one-hot rating -> range filters
    -> min-max scale (fitted after the filters).  The rows that the first two steps
    leave are written once.
    """
    df = dedup_first(merged, ["id"], DEDUP_ORDER)
    # written: the rating levels, the bounds and the result are three readers of the dedup
    df = written(df.where(F.col("content").isNotNull()), "first-reviews")
    df = df.fillna(0, subset=[c for c in NUMERIC_FILL if c in df.columns])
    df = df.withColumn("date_release", parse_date("date_release"))
    for c in BOOL_COLUMNS:
        df = df.withColumn(c, parse_bool(c))
    df = df.withColumn("user_reviews", F.col("user_reviews").cast("int"))
    df = df.withColumn("is_positive_encoded", encode_label("is_positive"))
    df = one_hot(df, "rating", rating_values)
    df = df.where(F.col("positive_ratio").between(0, 100) & (F.col("price_final") >= 0))
    return min_max_scale(df, SCALE_COLUMNS)


def preprocess_audit(merged: DataFrame) -> DataFrame:
    """AG-40: rows before/after each cleaning step, in one aggregate job.

    Each row gets flags for the steps it survives; one conditional `agg`
    counts them.  The dedup flag comes from the same window as ST-1.
    """
    w = Window.partitionBy("id").orderBy(*[F.col(c).asc_nulls_first() for c in DEDUP_ORDER])
    flags = merged.select(
        (F.row_number().over(w) == 1).alias("keep_dedup"),
        F.col("content").isNotNull().alias("has_content"),
        F.coalesce(F.col("positive_ratio"), F.lit(0)).between(0, 100).alias("ratio_ok"),
        (F.coalesce(F.col("price_final"), F.lit(0.0)) >= 0).alias("price_ok"),
    )
    s1 = F.col("keep_dedup")
    s2 = s1 & F.col("has_content")
    s3 = s2 & F.col("ratio_ok")
    s4 = s3 & F.col("price_ok")
    counts = flags.agg(
        F.count(F.lit(1)).alias("n0"), F.count_if(s1).alias("n1"), F.count_if(s2).alias("n2"),
        F.count_if(s3).alias("n3"), F.count_if(s4).alias("n4"),
    )
    steps = F.array(
        F.struct(F.lit(1).alias("step_no"), F.lit("dedup_id").alias("step"), F.col("n0").alias("rows_before"), F.col("n1").alias("rows_after")),
        *[F.struct(F.lit(i).alias("step_no"), F.lit(name).alias("step"),
                   F.col(f"n{i - 1}").alias("rows_before"), F.col(f"n{i}").alias("rows_after"))
          for i, name in ((2, "drop_null_content"), (3, "positive_ratio_0_100"), (4, "price_final_ge_0"))],
    )
    return (counts.select(F.inline(steps))
            .withColumn("removed", F.col("rows_before") - F.col("rows_after")))


def range_filter_report(df: DataFrame) -> DataFrame:
    """FI-2 with removed-row counts in one pass."""
    ok_ratio = F.col("positive_ratio").between(0, 100)
    ok_price = F.col("price_final") >= 0
    return df.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(~ok_ratio).alias("removed_ratio"),
        F.count_if(ok_ratio & ~ok_price).alias("removed_price"),
        F.count_if(ok_ratio & ok_price).alias("rows_after"),
    )


def interactions(preprocessed: DataFrame) -> DataFrame:
    """Evaluation input: the columns the recommenders read (plus id)."""
    return preprocessed.select("id", "author_id", "app_id", "title", "is_positive_encoded")


def min_interactions(df: DataFrame, min_count: int, user: str = "author_id") -> DataFrame:
    """FI-7: keep users with at least `min_count` rows (partial agg + semi join)."""
    active = df.groupBy(user).count().where(F.col("count") >= min_count).select(user)
    return df.join(active, user, "left_semi")
