"""Profiling aggregates (AG-1 .. AG-42).

Rules used throughout:
* one `agg` per table where possible (PO-1), map-side partial aggregation;
* group keys that are null are dropped (pandas value_counts / groupby);
* ties in top-n break by key ascending (T-19);
* exact quantiles come from the counts of distinct values and their prefix
  sums, so neither a task nor an aggregate holds all rows of a column or of
  one value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written



def exact_quantiles(df: DataFrame, col: str, qs) -> DataFrame:
    """One row: q_<p> columns with linear interpolation (pandas / quantile_cont)."""
    names = ["q" + str(int(round(q * 100))) for q in qs]
    got = quantiles_by_column(df, [col], qs)
    return got.agg(*[F.max(n).alias(n) for n in names])


def shape(df: DataFrame) -> DataFrame:
    """AG-1: rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_cols"))


def null_counts(df: DataFrame, cols=None, only_positive: bool = True, table: str | None = None) -> DataFrame:
    """AG-2: (column_name, null_count, null_pct 2 dp); sort by count desc to display."""
    cols = list(cols or df.columns)
    one = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in cols])
    long = one.unpivot(["_n"], cols, "column_name", "null_count")
    out = long.select("column_name", "null_count",
                      F.round(F.col("null_count") * 100.0 / F.col("_n"), 2).alias("null_pct"))
    if only_positive:
        out = out.where(F.col("null_count") > 0)
    if table:
        out = out.withColumn("table", F.lit(table))
    return out


def null_pattern(df: DataFrame, cols) -> DataFrame:
    """AG-3: compact null pattern: one row per combination of null flags."""
    return (df.groupBy(*[F.col(c).isNull().alias(f"{c}_null") for c in cols])
            .agg(F.count(F.lit(1)).alias("n_rows")))


def quantiles_by_column(df: DataFrame, cols, qs) -> DataFrame:
    """Exact linear-interpolated quantiles of several columns.

    Values are unpivoted and counted per (column_name, value) -- a partial
    aggregate, so a value that fills most of a column is one row per task.
    The distinct values are range partitioned and written once; prefix sums
    of their counts, inside a partition and over partitions, give each value its
    range of positions, and the values at the needed positions are kept.
    -> (column_name, q<p>...)
    """
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("v")) for c in cols])).alias("s"))
    long = long.select(F.col("s.c").alias("column_name"), F.col("s.v").alias("_v"))
    long = long.where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    n_parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = long.groupBy("column_name", "_v").agg(F.count(F.lit(1)).alias("_c"))
    parted = written(counted.repartitionByRange(n_parts, "column_name", "_v")
                     .withColumn("_pid", F.spark_partition_id()), "values")
    # one row per partition and column: a column's rows in earlier partitions
    sums = parted.groupBy("column_name", "_pid").agg(F.sum("_c").alias("_s"))
    before = Window.partitionBy("column_name").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("column_name", "_pid", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_off"),
                       F.sum("_s").over(Window.partitionBy("column_name")).alias("_n"))
    inside = Window.partitionBy("_pid", "column_name").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    pos = (parted.withColumn("_upto", F.sum("_c").over(inside))
           .join(F.broadcast(sums), ["column_name", "_pid"])
           .withColumn("_hi", F.col("_off") + F.col("_upto")).withColumn("_lo", F.col("_hi") - F.col("_c")))

    def at(p: Column) -> Column:
        return (F.col("_lo") <= p) & (p < F.col("_hi"))

    outs, keep = [], F.lit(False)
    for q in qs:
        h = (F.col("_n") - 1) * F.lit(float(q))
        keep = keep | at(F.floor(h)) | at(F.ceil(h))
        lo = F.max(F.when(at(F.floor(h)), F.col("_v")))
        hi = F.max(F.when(at(F.ceil(h)), F.col("_v")))
        outs.append((lo + (hi - lo) * F.max(h - F.floor(h))).alias("q" + str(int(round(q * 100)))))
    return pos.where(keep).groupBy("column_name").agg(*outs)


def describe(df: DataFrame, cols) -> DataFrame:
    """AG-4: count, mean, std (ddof 1), min, q25/q50/q75 (linear), max per column.

    One aggregate for the moments and one sort for all quantiles.
    """
    one = df.agg(*[F.struct(F.count(c).alias("count"), F.avg(c).alias("mean"),
                            F.stddev_samp(c).alias("std"), F.min(c).cast("double").alias("min"),
                            F.max(c).cast("double").alias("max")).alias(c) for c in cols])
    moments = (one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("m"))
                                              for c in cols])).alias("s"))
               .select("s.column_name", "s.m.*"))
    q = quantiles_by_column(df, cols, (0.25, 0.5, 0.75))
    return (moments.join(q, "column_name", "left")
            .select("column_name", "count", "mean", "std", "min",
                    F.col("q25").alias("p25"), F.col("q50").alias("p50"), F.col("q75").alias("p75"), "max"))


def value_counts(df: DataFrame, col, n: int | None = None, share_of: str | None = "rows",
                 sort: str = "count") -> DataFrame:
    """AG-5/6/7: counts per value (nulls excluded) with share in percent.

    share_of='rows' divides by all rows (AG-6), 'nonnull' by non-null rows.
    sort='count' -> desc with key tie-break; 'key' -> by key (AG-7).
    """
    c = F.col(col) if isinstance(col, str) else col
    name = col if isinstance(col, str) else "value"
    counts = (df.where(c.isNotNull()).groupBy(c.alias(name))
              .agg(F.count(F.lit(1)).alias("count")))
    if share_of:
        denom = (df.select(F.count(F.lit(1))) if share_of == "rows"
                 else df.select(F.count(c))).scalar()
        counts = counts.withColumn("share_pct", F.col("count") * 100.0 / denom)
    if n is not None:
        order = ([F.col("count").desc(), F.col(name).asc()] if sort == "count" else [F.col(name).asc()])
        counts = counts.orderBy(*order).limit(n)
    return counts


def scalar_stats(df: DataFrame, col: str, prefix: str = "") -> DataFrame:
    """AG-8: mean, median (exact), min, max, std of one column."""
    med = exact_quantiles(df, col, (0.5,))
    base = df.agg(F.avg(col).alias(f"{prefix}mean"), F.min(col).cast("double").alias(f"{prefix}min"),
                  F.max(col).cast("double").alias(f"{prefix}max"),
                  F.stddev_samp(col).alias(f"{prefix}std"))
    return base.select("*", med.select("q50").scalar().alias(f"{prefix}median"))


def per_key_count_stats(df: DataFrame, key: str) -> DataFrame:
    """AG-9 / AG-10: stats over rows per key + distinct keys and mean rows per key."""
    per = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    base = per.agg(F.count(F.lit(1)).alias("n_keys"), F.avg("n").alias("mean_rows"),
                   F.min("n").alias("min_rows"), F.max("n").alias("max_rows"),
                   F.stddev_samp("n").alias("std_rows"))
    return base.select("*", exact_quantiles(per, "n", (0.5,)).select("q50").scalar().alias("median_rows"))


def bucket_counts(df: DataFrame, value: Column, edges, labels=None, closed: str = "left",
                  include_lowest: bool = True, total: str = "rows") -> DataFrame:
    """AG-14/15/16/17: counts per bucket; empty buckets kept (bucket table).

    closed='left': [lo, hi); closed='right': (lo, hi] with the lowest edge
    included (pandas cut include_lowest).  Values outside every bucket are
    not counted.  Edges may use None for an open end.
    """
    n_b = len(edges) - 1
    labels = labels or [f"{edges[i]}-{edges[i + 1]}" for i in range(n_b)]
    expr = None
    for i in range(n_b):
        lo, hi = edges[i], edges[i + 1]
        if closed == "left":
            cond = F.lit(True) if lo is None else value >= lo
            if hi is not None:
                cond = cond & (value < hi)
        else:
            cond = F.lit(True) if lo is None else ((value >= lo) if (i == 0 and include_lowest) else (value > lo))
            if hi is not None:
                cond = cond & (value <= hi)
        expr = (F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i)))
    counts = (df.select(expr.alias("bucket_no")).where(F.col("bucket_no").isNotNull())
              .groupBy("bucket_no").agg(F.count(F.lit(1)).alias("count")))
    spark = df.sparkSession
    buckets = spark.createDataFrame([(i, labels[i]) for i in range(n_b)], "bucket_no int, bucket string")
    denom = df.select(F.count(F.lit(1))).scalar()
    return (F.broadcast(buckets).join(counts, "bucket_no", "left")
            .select("bucket_no", "bucket", F.coalesce(F.col("count"), F.lit(0)).alias("count"))
            .withColumn("share_pct", F.col("count") * 100.0 / denom))


def histogram(df: DataFrame, value: Column, bins: int) -> DataFrame:
    """AG-18: equal-width bins between min and max, last bin closed; zeros kept."""
    v = df.select(value.cast("double").alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x"))
    mm = v.agg(F.min("_x").alias("lo"), F.max("_x").alias("hi")).first()
    lo, hi = F.lit(mm["lo"]), F.lit(mm["hi"])
    width = (hi - lo) / bins
    b = F.when(hi > lo, F.least(F.floor((F.col("_x") - lo) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    counts = v.select(b.cast("int").alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (F.broadcast(grid).join(counts, "bin", "left")
            .select("bin", (lo + F.col("bin") * width).alias("bin_lo"),
                    (lo + (F.col("bin") + 1) * width).alias("bin_hi"),
                    F.coalesce(F.col("count"), F.lit(0)).alias("count")))


def hist2d(df: DataFrame, x: Column, y: Column, bins_x: int, bins_y: int) -> DataFrame:
    """AG-21: bounded 2-D binning of a scatter (non-empty cells only)."""
    v = df.select(x.cast("double").alias("_x"), y.cast("double").alias("_y")).dropna()
    row = v.agg(F.min("_x").alias("x0"), F.max("_x").alias("x1"),
                F.min("_y").alias("y0"), F.max("_y").alias("y1")).first()
    mm = {k: F.lit(row[k]) for k in ("x0", "x1", "y0", "y1")}

    def b(c, lo, hi, n):
        return F.when(hi > lo, F.least(F.floor((F.col(c) - lo) / ((hi - lo) / n)), F.lit(n - 1))).otherwise(F.lit(0))

    return (v.select(b("_x", mm["x0"], mm["x1"], bins_x).cast("int").alias("bin_x"),
                     b("_y", mm["y0"], mm["y1"], bins_y).cast("int").alias("bin_y"))
            .groupBy("bin_x", "bin_y").agg(F.count(F.lit(1)).alias("count")))


def mode(df: DataFrame, col: str) -> DataFrame:
    """AG-22: most frequent value (smallest on ties) and its count."""
    vc = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    return vc.agg(F.min_by(F.struct(F.col(col).alias("mode"), F.col("count")),
                           F.struct(-F.col("count"), F.col(col))).alias("m")).select("m.*")


def word_frequency(df: DataFrame, col: str, n: int = 20, min_len: int = 3) -> DataFrame:
    """AG-35: top-n lower-cased whitespace tokens longer than min_len-1 chars."""
    # Tokens shorter than min_len (>= 1) are dropped, so the empty tokens a
    # plain split leaves at the edges need no separate filter pass.
    toks = df.select(F.explode(F.split(F.lower(F.col(col)), r"\s+")).alias("word"))
    return (toks.where(F.char_length("word") >= max(min_len, 1)).groupBy("word")
            .agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), F.col("word").asc()).limit(n))


def duplicate_counts(df: DataFrame, key: str) -> DataFrame:
    """AG-25/26/27: full-row duplicates, key duplicates, rows whose key repeats."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    full_distinct = df.distinct().select(F.count(F.lit(1))).scalar()
    return per_key.agg(
        F.sum("n").alias("n_rows"),
        (F.sum("n") - full_distinct).alias("full_row_duplicates"),
        (F.sum("n") - F.count_if(F.col(key).isNotNull())).alias("key_duplicates"),
        F.sum(F.when(F.col(key).isNotNull() & (F.col("n") > 1), F.col("n")).otherwise(0)).alias("rows_with_repeated_key"),
        F.count_if(F.col(key).isNotNull() & (F.col("n") > 1)).alias("repeated_keys"),
    )


def text_columns(df: DataFrame, n: int = 5) -> list[str]:
    """FI-8: the first n string columns, in schema order."""
    return [name for name, t in df.dtypes if t == "string"][:n]


def schema_profile(df: DataFrame) -> DataFrame:
    """AG-34: (column_name, dtype, position) plus the dtype distribution via groupBy."""
    rows = [(c, t, i) for i, (c, t) in enumerate(df.dtypes)]
    return df.sparkSession.createDataFrame(rows, "column_name string, dtype string, position int")


def dtype_distribution(df: DataFrame) -> DataFrame:
    return schema_profile(df).groupBy("dtype").agg(F.count(F.lit(1)).alias("n_columns"))
