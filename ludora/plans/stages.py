"""Materialised pipeline stages (SK-2: the canonical split written once, reused).

`Stages(spark, sf_dir)` builds interactions, the holdout flags and the
ranked item universe once, writes each as parquet under the cluster's
checkpoint folder (a reliable, shared location; lineage is cut there), and
serves every later query from those files.  Reading back parquet also
gives AQE real sizes for its broadcast and skew decisions.
"""

from __future__ import annotations

import os
import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.candidates import rank_items
from ..operators.split import flag_holdout
from ..session import checkpoint_dir
from ..sources.sinks import write_split
from . import base

_CACHE: dict = {}


def materialize(df: DataFrame, name: str, root: str) -> DataFrame:
    path = os.path.join(root, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


class Stages:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.root = os.path.join(checkpoint_dir(spark), "ludora-stages", uuid.uuid4().hex)

    @cached_property
    def interactions(self) -> DataFrame:
        return materialize(base.interactions(self.spark, self.sf_dir), "interactions", self.root)

    @cached_property
    def flagged(self) -> DataFrame:
        return materialize(flag_holdout(self.interactions), "flagged", self.root)

    @property
    def train(self) -> DataFrame:
        return self.flagged.where(~F.col("is_test")).drop("is_test")

    @property
    def test(self) -> DataFrame:
        return self.flagged.where(F.col("is_test")).drop("is_test")

    @cached_property
    def split(self) -> dict[str, DataFrame]:
        """SK-2: train_split, test_split and test_positive as tables with a bucket per shuffle partition."""
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return write_split(self.train, self.test, os.path.join(self.root, "split"), buckets)

    @property
    def items(self) -> DataFrame:
        """(app_id, title) of every reviewed item (the evaluation universe)."""
        return self.interactions.select("app_id", "title").distinct()

    @cached_property
    def ranked_items(self) -> DataFrame:
        return materialize(rank_items(self.interactions.select("app_id")), "ranked_items", self.root)

    @cached_property
    def train_ranked_items(self) -> DataFrame:
        return materialize(rank_items(self.train.select("app_id")), "train_ranked_items", self.root)


def stages(spark: SparkSession, sf_dir: str) -> Stages:
    """One Stages per (session, folder): queries of a run share the split."""
    key = (id(spark), spark.sparkContext.applicationId, sf_dir)
    if key not in _CACHE:
        _CACHE[key] = Stages(spark, sf_dir)
    return _CACHE[key]
