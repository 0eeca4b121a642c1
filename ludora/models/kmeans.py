"""K-Means with several starts in one pass over the data (TF-10).

The centres of all starts are one block: a step reads the written features once,
assigns each row to its nearest centre of every start, and sums rows per
centre in the tasks.  What travels is one small array per task, reduced by a few
tasks; only the centres are on the driver.  Starts are seeded by k-means++ on a
bounded sample.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows (with the smallest hashes) from which the first centres are drawn.
SAMPLE_ROWS = 2000
REDUCERS = 16


def _points(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of points to the centres of one start."""
    return np.maximum((points * points).sum(1)[:, None] - 2 * points @ centres.T + (centres * centres).sum(1), 0.0)


def seeded(sample: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k-means++: each further centre is drawn by its squared distance to those chosen."""
    centres = [sample[rng.integers(len(sample))]]
    while len(centres) < k:
        d = _distances(sample, np.array(centres)).min(axis=1)
        centres.append(sample[rng.choice(len(sample), p=d / d.sum())] if d.sum() > 0 else sample[rng.integers(len(sample))])
    return np.array(centres)


def assigned_sums(features: DataFrame, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For all starts at once: (sums of the rows of each centre, their counts, the costs)."""
    starts, k, width = centres.shape
    size = starts * k * (width + 1) + starts

    def run(batches):
        total = np.zeros(size)
        sums, counts, cost = total[: starts * k * width].reshape(starts, k, width), total[starts * k * width: -starts].reshape(starts, k), total[-starts:]
        for batch in batches:
            points = _points(batch.column("v"), width)
            for s in range(starts):
                d = _distances(points, centres[s])
                nearest = d.argmin(axis=1)
                cost[s] += d[np.arange(len(d)), nearest].sum()
                one = np.zeros((k, len(points)))
                one[nearest, np.arange(len(points))] = 1.0
                sums[s] += one @ points
                counts[s] += one.sum(axis=1)
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["x"])

    def add(batches):
        total = np.zeros(size)
        for batch in batches:
            total += _points(batch.column("x"), size).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["x"])

    few = features.select("v").mapInArrow(run, "x array<double>").repartition(REDUCERS).mapInArrow(add, "x array<double>")
    total = np.sum([r.x for r in few.collect()], axis=0)
    return total[: starts * k * width].reshape(starts, k, width), total[starts * k * width: -starts].reshape(starts, k), total[-starts:]


def kmeans(features: DataFrame, k: int, starts: int = 10, seed: int = 42, iterations: int = 20, tolerance: float = 1e-4) -> tuple[np.ndarray, float]:
    """(centres, cost) of the best of `starts` runs over `features` (v array<double>, written).

    All starts step together until no cost falls by more than `tolerance` of itself.  A centre without rows stays where it is.
    """
    # the order is that of the rows' own values, so reruns and other partitionings draw the same sample
    sample = np.array([r.v for r in features.select("v").orderBy(F.xxhash64("v"), "v").limit(SAMPLE_ROWS).collect()])
    if not len(sample):
        return np.zeros((0, 0)), 0.0
    rng = np.random.default_rng(seed)
    centres = np.array([seeded(sample, k, rng) for _ in range(starts)])
    last = np.full(starts, np.inf)
    for _ in range(iterations):
        sums, counts, cost = assigned_sums(features, centres)
        best = centres[cost.argmin()], float(cost.min())
        if (last - cost <= tolerance * np.maximum(cost, 1e-300)).all():
            break
        last = cost
        centres = np.where(counts[..., None] > 0, sums / np.maximum(counts, 1.0)[..., None], centres)
    return best


def nearest(rows: DataFrame, centres: np.ndarray, out: str = "cluster") -> DataFrame:
    """`rows` with the number of the nearest centre to v; only the vectors go to Python."""

    @F.arrow_udf("int")
    def run(v: pa.Array) -> pa.Array:
        return pa.array(_distances(_points(v, centres.shape[1]), centres).argmin(axis=1).astype(np.int32))

    return rows.withColumn(out, run("v"))
