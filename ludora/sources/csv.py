"""CSV ingest (SC-1 .. SC-4, SC-6 .. SC-8).

Reads use explicit schemas (no inference pass over the data), ids stay
strings until a checked cast, and null tokens are normalised with column
expressions so the scan stays one pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clean import NULL_TOKENS
from ..operators.split import number_rows
from .schemas import ALT_REVIEW_RENAMES, require_columns

REPLACEMENT_CHAR = "�"


def read_csv(spark: SparkSession, path: str, schema: T.StructType, encoding: str = "UTF-8") -> DataFrame:
    """SC-1 / SC-3: header CSV, quoted fields may span lines, explicit schema."""
    return (spark.read.schema(schema).option("header", True).option("multiLine", True)
            .option("escape", '"').option("encoding", encoding).csv(path))


def normalise_null_tokens(df: DataFrame, tokens=NULL_TOKENS) -> DataFrame:
    """SC-2: '', ' ', NA, N/A, null, None -> NULL in every string column."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            c = F.when(c.isin(list(tokens)), F.lit(None)).otherwise(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def typed(df: DataFrame, types: dict) -> DataFrame:
    """PR-4 on dirty input: try_cast, so a bad value becomes NULL, not an error."""
    return df.select(*[(F.expr(f"try_cast(`{c}` AS {types[c]})") if c in types else F.col(f"`{c}`")).alias(c)
                       for c in df.columns])


def read_csv_with_fallback(spark: SparkSession, path: str, schema: T.StructType,
                           fallback: str = "MS949") -> DataFrame:
    """SC-4: UTF-8 first; if the decode produced U+FFFD, re-read with the fallback.

    Spark substitutes U+FFFD instead of raising, so the check is a count of
    rows holding the replacement character (one pass, short-circuited).
    MS949 needs spark.sql.legacy.javaCharsets=true on Spark 4.
    """
    df = read_csv(spark, path, schema)
    strings = [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]
    if not strings:
        return df
    bad = F.lit(False)
    for c in strings:
        bad = bad | F.coalesce(F.instr(F.col(f"`{c}`"), REPLACEMENT_CHAR) > 0, F.lit(False))
    if df.where(bad).limit(1).count() == 0:
        return df
    return read_csv(spark, path, schema, encoding=fallback)


def alternative_layout(df: DataFrame) -> DataFrame:
    """SC-6: `Labeling, username, game id` -> is_positive, author_id, app_id."""
    return df.withColumnsRenamed({k: v for k, v in ALT_REVIEW_RENAMES.items() if k in df.columns})


def with_surrogate_id(df: DataFrame, order_cols, id_col: str = "id") -> DataFrame:
    """SC-7: contiguous 0-based id of every row in a declared order; equal rows get different ids."""
    if id_col in df.columns:
        return df
    return number_rows(df, list(order_cols), id_col)


def require_nonempty(df: DataFrame, what: str) -> DataFrame:
    """SC-8: stop with a message when a required input is empty."""
    if df.limit(1).isEmpty():
        raise ValueError(f"no {what}: nothing to do")
    return df


def load_interactions(spark: SparkSession, path: str) -> DataFrame:
    """Evaluation input (SC-3 + SC-5 + SC-7): ids as strings, required columns checked."""
    from .schemas import INTERACTION_COLUMNS
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    require_columns(df, INTERACTION_COLUMNS)
    df = df.withColumn("is_positive_encoded", F.expr("try_cast(is_positive_encoded AS INT)"))
    return with_surrogate_id(df, ["author_id", "app_id"])
