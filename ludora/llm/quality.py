"""Operator 3: document quality by a byte-level convolutional network in numpy.

Filters of WIDTH bytes slide over the whole document.  Their outputs are
max-pooled over chunks of two BLOCKs that overlap by one, a rectified linear
layer turns a chunk's maxima into a logit, and the mean logit of all chunks is
the document's.  A filter over one-hot bytes is a table look-up per byte, so a
pass costs WIDTH additions of a row of filter weights.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludora.llm.common import binary_values, crc_fold, text_of

WIDTH, FILTERS, BLOCK = 6, 16, 512
#: Bound of the fit: labelled rows of each class, chunks of each, and passes over them.
SAMPLE_ROWS, SAMPLE_CHUNKS, EPOCHS = 1200, 4, 12
#: Bytes that the network reads at a time.
PIECE = 128 * BLOCK


@dataclass
class ByteCNN:
    """Weights: table[w, byte, filter], a bias and an output weight per filter, the output's bias."""

    table: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    shift: float

    def maxima(self, data: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """Largest response of each filter in each block; `data` has WIDTH - 1 more bytes than places."""
        n = len(data) - WIDTH + 1
        total = self.table[0][data[:n]]
        for w in range(1, WIDTH):
            total += self.table[w][data[w: w + n]]
        return np.maximum.reduceat(total, firsts, axis=0)

    def logits(self, maxima: np.ndarray) -> np.ndarray:
        return np.maximum(maxima + self.bias, 0) @ self.out + self.shift

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Probability of label 1 of each text; an empty text is one chunk of padding."""
        held, blocks = [], []
        counts = np.zeros(len(texts), dtype=np.int64)
        size = 0

        def flush():
            nonlocal held, size
            data = np.frombuffer(b"".join(held), np.uint8)
            firsts, at = [], 0
            for h in held:
                firsts += range(at, at + len(h) - WIDTH + 1, BLOCK)
                at += len(h)
            # places whose window runs into the next piece belong to no block: they are cut off
            ends = np.cumsum([len(h) for h in held]) - WIDTH + 1
            bounds = np.sort(np.concatenate((firsts, ends)).astype(np.int64))
            got = self.maxima(data, bounds[bounds < len(data) - WIDTH + 1])
            blocks.append(got[np.isin(bounds[bounds < len(data) - WIDTH + 1], firsts)])
            held, size = [], 0

        for i, text in enumerate(texts):
            for a in range(0, max(1, len(text)), PIECE):
                piece = text[a: a + PIECE + WIDTH - 1]
                places = max(1, min(PIECE, len(text) - a))
                held.append(piece.ljust(places + WIDTH - 1, b"\0"))
                counts[i] += -(-places // BLOCK)
                size += places
                if size >= 4 * PIECE:
                    flush()
        if held:
            flush()
        if not len(texts):
            return np.zeros(0)
        blocks = np.concatenate(blocks)
        ends = np.cumsum(counts)
        first = ends - counts
        # a chunk is two neighbouring blocks of a document, or its only one
        chunks = np.maximum(blocks, np.concatenate((blocks[1:], blocks[-1:])))
        alone = np.flatnonzero(counts == 1)
        chunks[first[alone]] = blocks[first[alone]]
        logit = self.logits(chunks)
        logit[ends[counts > 1] - 1] = 0
        mean = np.add.reduceat(logit, first) / np.maximum(counts - 1, 1)
        return 1 / (1 + np.exp(-np.clip(mean, -30, 30)))


def train(chunks: np.ndarray, labels: np.ndarray, weights: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> ByteCNN:
    """Fit by Adam on weighted log loss; `chunks` has rows of 2 * BLOCK + WIDTH - 1 bytes."""
    rng = np.random.default_rng(seed)
    params = [rng.normal(0, 0.1, (WIDTH, 256, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32), rng.normal(0, 0.3, FILTERS).astype(np.float32), np.zeros(1, np.float32)]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    places = chunks.shape[1] - WIDTH + 1
    for epoch in range(epochs):
        for rows in np.array_split(rng.permutation(len(chunks)), max(1, len(chunks) // 64)):
            table, bias, out, shift = params
            data = chunks[rows]
            total = table[0][data[:, :places]]
            for w in range(1, WIDTH):
                total += table[w][data[:, w: w + places]]
            where = total.argmax(axis=1)
            top = np.take_along_axis(total, where[:, None, :], axis=1)[:, 0, :] + bias
            active = np.maximum(top, 0)
            p = 1 / (1 + np.exp(-np.clip(active @ out + shift[0], -30, 30)))
            error = ((p - labels[rows]) * weights[rows] / weights[rows].sum()).astype(np.float32)
            back = error[:, None] * out * (top > 0)
            grad = [np.zeros_like(table), back.sum(axis=0), active.T @ error, np.array([error.sum()], np.float32)]
            column = np.broadcast_to(np.arange(FILTERS), where.shape)
            for w in range(WIDTH):
                np.add.at(grad[0][w], (np.take_along_axis(data, where + w, axis=1), column), back)
            step += 1
            rate = 0.02 * (1 - epoch / epochs)
            for k, (p_, g) in enumerate(zip(params, grad, strict=True)):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                params[k] = p_ - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return ByteCNN(params[0], params[1], params[2], float(params[3][0]))


def fit_quality(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0) -> ByteCNN:
    """Fit on at most SAMPLE_ROWS labelled rows per class outside fold `held_out`, SAMPLE_CHUNKS chunks of each.

    The sample is the rows with the smallest hashes of their ids; its classes are
    weighted to their shares among all labelled rows of the other folds.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & (crc_fold("doc_id", folds) != held_out)).groupBy("doc_id").agg(F.max("quality").alias("label"))
    shares = {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    length = 2 * BLOCK + WIDTH - 1
    rows, values, weights = [], [], []
    for label, n in sorted(shares.items()):
        ids = known.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS).select("doc_id")
        text = F.col("text").cast("string").cast("binary")
        size = F.octet_length(text)
        # evenly spread over the whole text, cut in the executors
        parts = F.least(F.lit(SAMPLE_CHUNKS), F.floor(size / (2 * BLOCK)) + 1)
        start = F.when(parts > 1, F.floor((size - 2 * BLOCK) * F.col("part") / (parts - 1))).otherwise(0)
        cut = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(ids), "doc_id").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SAMPLE_CHUNKS - 1)))).where(F.col("part") < parts)
        got = cut.select("doc_id", "part", F.substring(text, start.cast("int") + 1, length).alias("chunk")).collect()
        got = sorted((r.doc_id, r.part, bytes(r.chunk)) for r in got if r.chunk)
        rows += [g[2].ljust(length, b"\0") for g in got]
        values += [label] * len(got)
        weights += [n / max(1, len(got))] * len(got)
    if len(set(values)) < 2:  # nothing to tell apart: the only label seen, or one half
        return ByteCNN(np.zeros((WIDTH, 256, FILTERS), np.float32), np.zeros(FILTERS, np.float32), np.zeros(FILTERS, np.float32), 0.0 if not values else 4.0 * (2 * values[0] - 1))
    chunks = np.frombuffer(b"".join(rows), np.uint8).reshape(-1, length)
    return train(chunks, np.array(values, np.float32), np.array(weights, np.float32))


def quality_scores(docs: DataFrame, model: ByteCNN, folds: int = 5, held_out: int = 0, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score (probability of label 1), predicted, for every row and its whole text.

    Null text counts as empty; empty texts are scored as one chunk of padding.
    A null id is in fold 0.  Repeated rows get a row each.  Other columns are ignored.
    """

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "score": pa.array(model.score(binary_values(batch.column("text"))), pa.float64())})

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", (crc_fold("doc_id", folds) == held_out).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
