"""Session helpers.

The library never creates a session behind the caller's back; `get_spark`
is for scripts, tests and the bench.  `checkpoint_dir` reads the cluster's
``spark.checkpoint.dir`` and only falls back to a scratch folder when the
setting is absent (local tests).
"""

from __future__ import annotations

import gc
import os
import re
import tempfile
import time
import uuid

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "ludora") -> SparkSession:
    """Session for scripts, tests and the bench; what the launcher has set stays as it is.

    A master, shuffle partitions and driver memory are only set when given
    (argument or environment) or, without any launcher, for a local run.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    given = SparkConf()
    master = master or os.environ.get("LUDORA_MASTER") or (None if given.contains("spark.master") else "local[8]")
    if master:
        builder = builder.master(master)
    if master and master.startswith("local"):
        builder = builder.config("spark.driver.memory", os.environ.get("LUDORA_DRIVER_MEMORY", "16g"))
        shuffle_partitions = shuffle_partitions or 8
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts: the cluster's setting; on a local master a scratch folder when unset."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise RuntimeError(f"spark.checkpoint.dir is not set and the master is {master}: "
                           "executors need a folder that they share")
    local = tempfile.mkdtemp(prefix="ludora-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return local


def written(df: DataFrame, label: str) -> DataFrame:
    """`df` written once into the shared folder and read back: all its readers see the same rows."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/ludora-written/{uuid.uuid4().hex}-{label}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete written tables that nothing reads any more: what was made of them must be written itself."""
    for table in tables:
        files = table.inputFiles()
        if files:
            context = table.sparkSession.sparkContext
            folder = context._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
            folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def release(spark: SparkSession) -> None:
    """Let Spark's context cleaner drop the shuffle files of finished phases.

    The cleaner acts when the driver's references are collected; a driver with
    little garbage would keep those files until the session ends.  The second round
    gets what only the first has set free (plans that hold their exchanges).
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)
