"""Sinks (SK-1 .. SK-3): table writes and the text summary report."""

from __future__ import annotations

from zlib import crc32

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str) -> None:
    """SK-1: header CSV without an index column (one folder of part files)."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_split(train: DataFrame, test: DataFrame, root: str, buckets: int = 64) -> dict[str, DataFrame]:
    """SK-2: the canonical split written once (train, test, test positives), bucketed and sorted by author.

    Joins and aggregates of these tables by author_id read them without an exchange.
    Rows are dealt by the hash that names the buckets, so a task writes one bucket; AQE splits
    the tasks of a bucket with a hot author, which then has several files.
    `read_split` opens the tables in a later session, given the same number of buckets.
    """
    positives = test.where(F.col("is_positive_encoded") == 1).select("author_id", "app_id")
    for name, df in (("train_split", train), ("test_split", test), ("test_positive", positives)):
        (df.hint("rebalance", buckets, "author_id").write.mode("overwrite").format("parquet").option("path", f"{root}/{name}")
         .bucketBy(buckets, "author_id").sortBy("author_id").saveAsTable(_split_table(root, name)))
    return read_split(train.sparkSession, root, buckets)


def read_split(spark: SparkSession, root: str, buckets: int = 64) -> dict[str, DataFrame]:
    """The tables of `write_split` by name, with their buckets; columns are those of the files."""
    out = {}
    for name in ("train_split", "test_split", "test_positive"):
        table = _split_table(root, name)
        if not spark.catalog.tableExists(table):
            fields = spark.read.parquet(f"{root}/{name}").schema.fields
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
            spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (author_id) SORTED BY (author_id) "
                      f"INTO {buckets} BUCKETS LOCATION '{root}/{name}'")
        out[name] = spark.table(table)
    return out


def _split_table(root: str, name: str) -> str:
    return f"ludora_{name}_{crc32(root.encode()):08x}"


def report_lines(row_df: DataFrame, template) -> DataFrame:
    """SK-3: one-row DataFrame of numbers -> text lines via format_string."""
    return row_df.select(F.explode(F.array(*[F.format_string(fmt, *[F.col(c) for c in cols])
                                             for fmt, cols in template])).alias("value"))


def write_report(lines: DataFrame, path: str) -> None:
    lines.coalesce(1).write.mode("overwrite").text(path)
