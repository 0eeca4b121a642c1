"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ludora.session import checkpoint_dir, discard, release  # noqa: F401

#: Stands for a null id where ids are compared: later than every real id.
NO_ID = np.iinfo(np.int64).max

#: A word is a run of bytes other than space and the five ASCII controls 0x09-0x0D.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once into the shared folder and read it back.

    Cuts the lineage like a reliable checkpoint, but as compressed Parquet, so
    a lost executor costs a re-read and nothing is computed twice.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/ludora-llm/{uuid.uuid4().hex}-{label}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def crc_fold(column: str, folds: int) -> Column:
    """Remainder of the CRC-32 of the id as text; a null id falls into fold 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % folds, F.lit(0))


def binary_values(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def long_values(column: pa.Array, null: int) -> np.ndarray:
    return column.fill_null(null).to_numpy(zero_copy_only=False).astype(np.int64)


def mix64(x: np.ndarray) -> np.ndarray:
    """Mixes unsigned 64-bit lanes; the high bits depend on all others."""
    x = x * np.uint64(0x9E6C63D0876A9A47)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD2B74407B1CE6E93)
    return x
