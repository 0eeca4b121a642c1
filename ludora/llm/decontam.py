"""Operator 6: benchmark items inside documents, by size-partitioned MinHash containment.

A short item in a long document has a tiny Jaccard similarity with it, so the
sketch is asymmetric (containment MinHash): of an item's shingles only the
smallest under a hash are kept, and each is looked up among *all* shingles of
the document, whatever its length.  A kept shingle is in the document with the
probability of the containment.  Items are partitioned by their number of
shingles; a class's sketch is as large as keeps the chance of missing an item at
the threshold below MISS (small items are kept whole), and a document meets
only the classes that its own size can contain.  Each hit is verified with the
shingles themselves.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludora.llm.common import binary_values, materialise, mix64, text_of
from ludora.llm.substring import sequence_hashes, word_bounds, word_hashes

#: Chance that the sketch of an item misses a document at the threshold.
MISS = 1e-9
#: Bytes of item texts that are broadcast at a time.
BLOCK_BYTES = 8 << 20


def _shingles(words: list[bytes], size: int) -> set[bytes]:
    return {b" ".join(words[k: k + size]) for k in range(len(words) - size + 1)}


def _hashes(data: bytes, size: int) -> np.ndarray:
    raw = np.frombuffer(data + b" ", np.uint8)
    first, end = word_bounds(raw)
    return sequence_hashes(word_hashes(raw, first, end), size)


class _Class:
    """Items of one shingle length and one power of two of shingles: hash -> items, as sorted arrays."""

    def __init__(self, size: int, level: int, threshold: float):
        self.size, self.least = size, math.ceil(threshold * (1 << level))
        self.keep = math.ceil(math.log(MISS) / math.log(max(1 - threshold, 1e-3)))
        self.pairs: list[tuple[int, int]] = []

    def add(self, item: int, text: bytes) -> None:
        hashes = np.unique(_hashes(text, self.size))
        # a second, independent order, so that the sketch is no accident of the first hash
        sketch = hashes[np.argsort(mix64(hashes), kind="stable")[: self.keep]]
        self.pairs += [(h, item) for h in sketch.tolist()]

    def close(self) -> bool:
        self.pairs.sort()
        self.hash = np.array([p[0] for p in self.pairs], dtype=np.uint64)
        self.item = np.array([p[1] for p in self.pairs])
        self.maybe = np.zeros(1 << 16, dtype=bool)
        self.maybe[self.hash >> np.uint64(48)] = True
        return bool(self.pairs)

    def hits(self, hashes: np.ndarray) -> np.ndarray:
        near = np.unique(hashes[self.maybe[hashes >> np.uint64(48)]])
        a, b = np.searchsorted(self.hash, near), np.searchsorted(self.hash, near, side="right")
        return np.unique(np.concatenate([self.item[x:y] for x, y in zip(a, b, strict=True)])) if len(near) else np.zeros(0, int)


class _Finder:
    """Finds the items of one block in a document's text."""

    def __init__(self, items: list[tuple[int | None, bytes]], words: int, threshold: float):
        self.words, self.threshold = words, threshold
        texts = [t.split() for _, t in items]
        self.size = [min(words, len(w)) for w in texts]
        self.shingles = [_shingles(w, s) if s else set() for w, s in zip(texts, self.size, strict=True)]
        classes: dict[tuple[int, int], _Class] = {}
        for k, (_, text) in enumerate(items):
            if self.shingles[k]:
                name = self.size[k], len(self.shingles[k]).bit_length() - 1
                classes.setdefault(name, _Class(*name, threshold)).add(k, text)
        self.classes = [c for c in classes.values() if c.close()]

    def __call__(self, text: bytes) -> list[tuple[int, int, int]]:
        """(place of the item, its shingles, those found) of each item that the text contains."""
        text = text.lower()
        of = {size: _hashes(text, size) for size in {c.size for c in self.classes}}
        near = {int(k) for c in self.classes if len(of[c.size]) >= c.least for k in c.hits(of[c.size])}
        own: dict[int, set[bytes]] = {}
        out = []
        for k in sorted(near):
            size = self.size[k]
            if size not in own:
                own[size] = _shingles(text.split(), size)
            n = len(self.shingles[k] & own[size])
            if n >= self.threshold * len(self.shingles[k]):
                out.append((k, len(self.shingles[k]), n))
        return out


def _search(items: list[tuple[int | None, bytes]], words: int, threshold: float):
    def search(batches):
        find = _Finder(items, words, threshold)
        for batch in batches:
            out = [(i, items[k][0], n, m) for i, text in zip(batch.column("doc_id").to_pylist(), binary_values(batch.column("text")), strict=True) for k, n, m in find(text)]
            yield pa.RecordBatch.from_pydict({c: pa.array([x[k] for x in out], pa.int64()) for k, c in enumerate(("doc_id", "item_id", "n_shingles", "n_found"))})

    return search


def _keep_clean(items: list[tuple[int | None, bytes]], words: int, threshold: float):
    def keep(batches):
        find = _Finder(items, words, threshold)
        for batch in batches:
            yield batch.filter(pa.array([not find(text) for text in binary_values(batch.column("text"))], pa.bool_()))

    return keep


def _blocks(items: DataFrame):
    """Items in blocks of at most BLOCK_BYTES (or one item), read one at a time by the driver."""
    held, size = [], 0
    for row in items.toLocalIterator():
        held.append((row.item_id, bytes(row.text)))
        size += len(row.text)
        if size >= BLOCK_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def contained_items(docs: DataFrame, items: DataFrame, words: int = 5, threshold: float = 0.8) -> DataFrame:
    """Pairs (doc_id, item_id) where the document has at least `threshold` of the item's shingles.

    Shingles are sets of `words` consecutive words, A-Z lower-cased; an item of
    fewer words is one shingle.  Also returns n_shingles, n_found, containment.

    Null or empty items are never found, null or empty documents contain none.
    Null ids are returned as they are; rows that repeat an id or a text are each
    searched, repeated items each reported.  Other columns are ignored.  Items go
    to the tasks in blocks of BLOCK_BYTES, one pass over the documents each.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    schema = "doc_id long, item_id long, n_shingles long, n_found long"
    out = None
    for block in _blocks(_lowered(items)):
        found = rows.mapInArrow(_search(block, words, threshold), schema)
        out = found if out is None else materialise(out.unionByName(found), "found")
    out = spark.createDataFrame([], schema) if out is None else out
    return out.withColumn("containment", F.col("n_found") / F.col("n_shingles"))


def decontaminate(docs: DataFrame, items: DataFrame, words: int = 5, threshold: float = 0.8) -> DataFrame:
    """Rows of `docs`, with all their columns, whose text contains no item (as `contained_items` finds them)."""
    for block in _blocks(_lowered(items)):
        docs = docs.mapInArrow(_keep_clean(block, words, threshold), docs.schema)
    return docs


def _lowered(items: DataFrame) -> DataFrame:
    lower = F.translate(text_of(), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return items.select(F.col("item_id").cast("long").alias("item_id"), lower.cast("binary").alias("text"))
