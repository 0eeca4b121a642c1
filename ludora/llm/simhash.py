"""Operator 4: SimHash near-duplicates with BK-trees over shards of fingerprints.

Fingerprints within `radius` bits differ in at most `radius` of `radius + 2`
blocks, so they agree in two blocks at least: those two blocks name a shard, and
every link lies inside one.  Each shard's fingerprints form a BK-tree (a child
hangs under its parent by their integer Hamming distance); a search follows
only edges within the radius.  A shard above TREE_NODES is cut into trees of
that size, and each tree goes to all query blocks of its shard, so that neither
a tree nor a task grows with the corpus.  The trees reach the queries by their
shard key: a broadcast through the driver would collect all fingerprints there.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludora.llm.common import binary_values, materialise, text_of
from ludora.llm.components import components

SEED = 42
#: Fingerprints of a tree at most.
TREE_NODES = 4096
#: Fingerprints of a bucket (many small shards) about.
BUCKET_ROWS = 40_000
#: From here on, nodes stand for fingerprints of which no document has an id.
UNNAMED = 1 << 62


def fingerprint(text: bytes, words: int = 3) -> int:
    """SimHash of a text's word shingles; zero without words."""
    parts = text.lower().split()  # bytes: only A-Z change, only the six ASCII gaps part
    if not parts:
        return 0
    size = min(words, len(parts))
    shingles = map(b" ".join, zip(*(parts[k:] for k in range(size)), strict=False))
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), dtype="<u8")
    ones = sum(np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64) for h in np.array_split(hashes, len(hashes) // 100_000 + 1))
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id and fingerprint (64 bits as a signed long) of each row."""

    def sign(batches):
        for batch in batches:
            values = np.array([fingerprint(t, words) for t in binary_values(batch.column("text"))], dtype=np.uint64)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "fp": pa.array(values.view(np.int64))})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(sign, "doc_id long, fp long")


class BKTree:
    """Fingerprints, each under its parent's edge of their Hamming distance."""

    def __init__(self):
        self.values: list[int] = []
        self.edges: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        at = 0
        if self.values:
            while True:
                distance = (self.values[at] ^ value).bit_count()
                if distance == 0:
                    return
                below = self.edges[at].get(distance)
                if below is None:
                    self.edges[at][distance] = len(self.values)
                    break
                at = below
        self.values.append(value)
        self.edges.append({})

    def near(self, value: int, radius: int) -> list[int]:
        """Places of all nodes within `radius` bits."""
        found, todo = [], [0] if self.values else []
        while todo:
            at = todo.pop()
            distance = (self.values[at] ^ value).bit_count()
            if distance <= radius:
                found.append(at)
            edges = self.edges[at]
            if len(edges) <= 2 * radius:
                todo += [k for d, k in edges.items() if distance - radius <= d <= distance + radius]
            else:
                todo += [edges[d] for d in range(distance - radius, distance + radius + 1) if d in edges]
        return found


def _links(radius: int):
    """Links that connect what a bucket's cells hold: per cell a forest, never all pairs."""

    def cell(values: list[int], nodes: list[int], in_tree: list[bool], own: bool, out: list):
        tree, place = BKTree(), []
        for k, there in enumerate(in_tree):
            if there:
                tree.add(values[k])
                place.append(k)
        parent = list(range(len(values)))

        def root(k):
            while parent[k] != k:
                parent[k] = parent[parent[k]]
                k = parent[k]
            return k

        for k in range(len(values)):
            if own or not in_tree[k]:
                for at in tree.near(values[k], radius):
                    a, b = root(k), root(place[at])
                    if a != b:
                        a, b = (a, b) if nodes[a] < nodes[b] else (b, a)
                        parent[b] = a
                        out.append((nodes[a], nodes[b]))

    def links(table):
        columns = {c: table.column(c).to_numpy() for c in table.column_names}
        order = np.lexsort([columns[c] for c in ("upper", "lower", "shard", "combo")])
        names = [columns[c][order] for c in ("combo", "shard", "lower", "upper")]
        change = np.flatnonzero(np.any([x[1:] != x[:-1] for x in names], axis=0)) + 1
        bounds = np.concatenate(([0], change, [len(order)]))
        many = np.flatnonzero(np.diff(bounds) > 1)
        out: list[tuple[int, int]] = []
        for a, b in zip(bounds[many].tolist(), bounds[many + 1].tolist(), strict=True):
            rows = order[a:b]
            lower, upper = int(names[2][a]), int(names[3][a])
            cell((columns["fp"][rows].view(np.uint64)).tolist(), columns["node"][rows].tolist(), (columns["part"][rows] == lower).tolist(), lower == upper, out)
        return pa.table({"a": pa.array([x[0] for x in out], pa.int64()), "b": pa.array([x[1] for x in out], pa.int64())})

    return links


def _masks(radius: int) -> list[int]:
    """Two of `radius + 2` blocks of the 64 bits, as signed masks."""
    edges = np.linspace(0, 64, radius + 3).astype(int).tolist()
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    masks = [x | y for x, y in combinations(blocks, 2)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def fingerprint_links(points: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) of nodes that connect all fingerprints (node, fp) within `radius` bits of each other."""
    keys = F.explode(F.array(*(F.struct(F.lit(i).alias("combo"), F.col("fp").bitwiseAND(m).alias("shard")) for i, m in enumerate(_masks(radius)))))
    rows = points.select("node", "fp", keys.alias("k")).select("node", "fp", "k.combo", "k.shard")
    large = rows.groupBy("combo", "shard").count().where(F.col("count") > TREE_NODES)
    parts = F.coalesce(F.ceil(F.col("count") / TREE_NODES), F.lit(1)).cast("int")
    rows = rows.join(large, ["combo", "shard"], "left").withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    n_buckets = points.count() * len(_masks(radius)) // BUCKET_ROWS + 1
    rows = rows.select("node", "fp", "combo", "shard", "part", F.least("part", "other").alias("lower"), F.greatest("part", "other").alias("upper"))
    cell = F.pmod(F.xxhash64("combo", "shard", "lower", "upper"), F.lit(n_buckets))
    return rows.withColumn("bucket", cell).groupBy("bucket").applyInArrow(_links(radius), "a long, b long")


def simhash_components(docs: DataFrame, words: int = 3, radius: int = 2) -> DataFrame:
    """Near-duplicate components by SimHash: doc_id, fingerprint (16 hex digits), component_id.

    A fingerprint's bit is 1 if it is set in over half of the XXH64 hashes of the
    text's `words`-word shingles (A-Z lower-cased, repeats included; a shorter text
    is one shingle).  Fingerprints that differ in at most `radius` bits are linked;
    component_id is the smallest doc_id that can be reached.

    Null, empty and blank texts have fingerprint zero and are linked like any
    other.  Rows that repeat an id or a text get a row each.  A null doc_id never
    names a component that has another id; a component of null ids only has a
    null component_id.  Ids must be below 2^62.  Other columns are ignored.
    """
    signed = materialise(fingerprints(docs, words), "fingerprints")
    points = materialise(signed.groupBy("fp").agg(F.min("doc_id").alias("node")).select("fp", F.coalesce("node", F.shiftrightunsigned("fp", 2).bitwiseOR(F.lit(UNNAMED))).alias("node")), "points")
    roots = components(fingerprint_links(points, radius))
    named = points.join(roots, "node", "left").select("fp", F.coalesce("root", "node").alias("root"))
    component = F.when(F.col("root") < UNNAMED, F.col("root")).alias("component_id")
    return signed.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), component)
