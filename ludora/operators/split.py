"""Splitting, indexing and deterministic sampling (WN-1, WN-6, WN-7, SL-6..8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written


def _order_key(c: str, id_order: str) -> Column:
    if id_order == "string":
        return F.col(c).cast("string")
    if id_order == "numeric":
        return F.col(c)
    raise ValueError("id_order must be 'numeric' or 'string'")


def flag_holdout(df: DataFrame, user: str = "author_id", order: str = "id",
                 id_order: str = "numeric") -> DataFrame:
    """WN-1: add `is_test`: the last row per user (by `order`) is test.

    Single-row users therefore land in test.  The last key per user comes
    from a grouped max (map-side partial aggregation) joined back on the
    user, so a user holding a third of all rows is split by AQE's skew
    join instead of being sorted in one window task.  `order` must be
    unique per user (review ids are, after ST-1).
    """
    key = _order_key(order, id_order)
    last = df.groupBy(user).agg(F.max(key).alias("_last"))
    return (df.join(last, user)
            .withColumn("is_test", key == F.col("_last"))
            .drop("_last"))


def temporal_holdout(df: DataFrame, user: str = "author_id", order: str = "id",
                     id_order: str = "numeric"):
    flagged = flag_holdout(df, user, order, id_order)
    train = flagged.where(~F.col("is_test")).drop("is_test")
    test = flagged.where(F.col("is_test")).drop("is_test")
    return train, test


def number_rows(df: DataFrame, sort_cols, index_col: str = "idx") -> DataFrame:
    """`df` with a contiguous 0-based row number in the order of `sort_cols`.

    Rows are range partitioned and written once with their partition's
    number: row numbers inside a partition and the prefix sum of the
    partitions' counts (one row per partition) must come from the same
    partitioning, which two runs of a sampled range exchange do not promise.
    Rows with equal sort columns get different numbers, in the order of their
    other columns' hash.
    """
    n_parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ties = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    parted = written(df.withColumn("_tie", ties).repartitionByRange(n_parts, *sort_cols, "_tie")
                     .withColumn("_pid", F.spark_partition_id()), "numbered")
    counts = parted.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    local = F.row_number().over(Window.partitionBy("_pid").orderBy(*sort_cols, "_tie")) - 1
    return (parted.withColumn("_local", local).join(F.broadcast(offsets), "_pid")
            .withColumn(index_col, (F.col("_off") + F.col("_local")).cast("long"))
            .select(*df.columns, index_col))


def dense_index(df: DataFrame, key: str, order=None, index_col: str = "idx") -> DataFrame:
    """WN-6 / WN-7: contiguous 0-based index over distinct keys.

    `order` (default: the key) is the declared order; first appearance is
    expressed as order by the minimum of a time column.  No single-task global window.
    """
    if order is None:
        keyed = df.select(key).where(F.col(key).isNotNull()).distinct()
        return number_rows(keyed, [key], index_col)
    keyed = (df.where(F.col(key).isNotNull()).groupBy(key)
             .agg(F.min(order).alias("_first")))
    return number_rows(keyed, ["_first", key], index_col).select(key, index_col)


def hash_sample(df: DataFrame, n: int, seed: int = 42, key_cols=None) -> DataFrame:
    """SL-6: deterministic sample of n rows: order by a seeded hash, take n.

    The limit is the feature (a sample of size n); TakeOrdered keeps at
    most n rows per partition before the final merge.
    """
    cols = key_cols or df.columns
    h = F.xxhash64(F.lit(seed), *[F.col(c) for c in cols])
    return df.withColumn("_h", h).orderBy("_h", *cols).limit(n).drop("_h")


def first_users(test: DataFrame, n: int | None, user: str = "author_id") -> DataFrame:
    """SL-7: first n distinct users in sorted (string) order; all when n is None."""
    users = test.select(user).where(F.col(user).isNotNull()).distinct()
    if n is None or n < 0:
        return users
    return users.orderBy(F.col(user).cast("string")).limit(n)
