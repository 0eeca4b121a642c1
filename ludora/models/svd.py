"""Truncated SVD of a sparse table by randomised subspace iteration (TF-7).

The matrix is a table of entries (row, t, weight).  A product with a tall table of
short vectors is a join and a grouped sum, combined in the tasks first.  A table's
columns are made orthonormal by TSQR: each task reduces its rows to a small
triangle, a few tasks reduce the triangles, and only those reach the driver; the rows
then get the inverse in Arrow batches.  Nothing of the size of a side of the
matrix leaves the tasks.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written

#: Tasks that reduce the triangles of all tasks.
REDUCERS = 16


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def product(entries: DataFrame, by: str, over: str, vectors: DataFrame, width: int) -> DataFrame:
    """(by, m): for each `by`, the sum over its entries of weight times the vector m of `over`."""
    sums = entries.join(vectors, over).groupBy(by).agg(*(F.sum(F.col("weight") * F.col("m")[k]).alias(f"s{k}") for k in range(width)))
    return sums.select(by, F.array(*(f"s{k}" for k in range(width))).alias("m"))


def triangle(table: DataFrame, width: int) -> np.ndarray:
    """R of the QR factorisation of all rows' vectors m (TSQR)."""

    def reduce(name: str):
        def run(batches):
            r = np.zeros((0, width))
            for batch in batches:
                r = np.linalg.qr(np.concatenate([r, _matrix(batch.column(name), width)]), mode="r")
            if len(r):
                yield pa.RecordBatch.from_arrays([pa.array(r.tolist(), pa.list_(pa.float64()))], ["r"])
        return run

    each = table.select("m").mapInArrow(reduce("m"), "r array<double>")
    few = each.repartition(REDUCERS).mapInArrow(reduce("r"), "r array<double>")
    rows = [x.r for x in few.collect()]
    return np.linalg.qr(np.array(rows), mode="r") if rows else np.zeros((0, width))


def times(table: DataFrame, key: str, matrix: np.ndarray) -> DataFrame:
    """(key, m): every row's vector times a small matrix."""
    width, out = matrix.shape

    def run(batches):
        for batch in batches:
            m = _matrix(batch.column("m"), width) @ matrix
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1) * out, pa.int32()), pa.array(m.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(key), lists], [key, "m"])

    return table.select(key, "m").mapInArrow(run, f"{key} long, m array<double>")


def _orthonormal(table: DataFrame, key: str, width: int) -> tuple[DataFrame, np.ndarray]:
    """The table with orthonormal columns (of its numeric rank), and the singular values of what it was."""
    _, s, vt = np.linalg.svd(triangle(table, width), full_matrices=False)
    rank = int((s > s[0] * 1e-12).sum()) if len(s) and s[0] > 0 else 0
    return times(table, key, vt[:rank].T / s[:rank]), s[:rank]


def truncated_svd(entries: DataFrame, k: int, seed: int = 42, iterations: int = 30, tolerance: float = 1e-9) -> tuple[DataFrame, np.ndarray]:
    """((row, m): left vectors times singular values, the singular values), both for the `k` largest at most.

    Iterates on 2k + 10 directions until the singular values stand still.  Rows
    without entries are not in the result.
    """
    entries = written(entries.select("row", "t", "weight"), "svd-entries")
    width = 2 * k + 10

    def uniform(j: int):
        return (F.pmod(F.xxhash64("t", F.lit(j), F.lit(seed)), F.lit(1 << 30)) + 0.5) / float(1 << 30)

    normal = F.array(*(F.sqrt(-2.0 * F.log(uniform(2 * j))) * F.cos(2.0 * math.pi * uniform(2 * j + 1)) for j in range(width)))
    start = entries.select("t").distinct().withColumn("m", normal)
    y = written(product(entries, "row", "t", start, width), "svd-rows")
    last = np.zeros(0)
    for _ in range(iterations):
        q, _ = _orthonormal(y, "row", width)
        q = written(q, "svd-q")
        width = min(width, len((q.first() or {"m": []})["m"]))
        if not width:
            return entries.select("row", F.array().cast("array<double>").alias("m")).limit(0), np.zeros(0)
        z = written(product(entries, "t", "row", q, width), "svd-terms")
        w, _ = _orthonormal(z, "t", width)
        w = written(w, "svd-w")
        width = len(w.first()["m"])
        y = written(product(entries, "row", "t", w, width), "svd-rows")
        now = np.linalg.svd(triangle(y, width), compute_uv=False)[:k]
        if len(now) == len(last) and np.abs(now - last).max() <= tolerance * now[0]:
            break
        last = now
    _, s, vt = np.linalg.svd(triangle(y, width), full_matrices=False)
    rank = min(k, len(s))
    # signs are free: the largest part of each right vector is positive
    vt = vt[:rank] * np.sign(vt[np.arange(rank), np.abs(vt[:rank]).argmax(axis=1)])[:, None]
    return times(y, "row", vt.T), s[:rank]
