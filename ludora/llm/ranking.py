"""Operator 12: ranked lexical search with pair-bound MaxScore.

A first pass over the documents writes a forward row per document: its length
and the frequencies of the terms that the items of a block use.  The statistics of
the ranking (documents, terms, document frequencies) are aggregates of
that table and cover all documents.  The second pass takes the rows in blocks.  A
block's index is made before any item is asked: per term its documents, integer
impacts and their maximum; per pair of terms that stand next to each other in an item's order of
weights, the intersection of both lists with the maximum of the summed
impacts.  An item is then ranked by MaxScore: terms whose combined bound stays below
the score of the k-th document so far only complete documents that other terms have
found.  The bound of several terms is the least over all ways to cover them
by single maxima and pair maxima, so it is never above the sum of
independent maxima.  All skips are strict, so ties and scores are exact.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ludora.llm.common import NO_ID, binary_values, long_values, materialise

TOP = 20
#: Text of the items that travel to the tasks at once; more items are asked in several passes.
ITEM_BYTES = 4 << 20
#: Documents and postings of a block's index.
BLOCK_DOCS, BLOCK_POSTINGS = 1 << 14, 1 << 21
#: Bytes between terms become spaces, A-Z become a-z, bytes above 0x7F stay.
_GAPS = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_TABLE = bytes(0x20 if b in _GAPS else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def forward_rows(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs) of every document with a term; only terms of the vocabulary are listed."""

    def run(batches):
        for batch in batches:
            ids, out = long_values(batch.column("doc_id"), NO_ID), ([], [], [], [])
            for doc, text in zip(ids.tolist(), binary_values(batch.column("text")), strict=True):
                words = terms_of(text)
                if words:
                    counts = Counter(words)
                    known = [(vocabulary[w], counts[w]) for w in counts.keys() & vocabulary.keys()]
                    for values, x in zip(out, (doc, len(words), [k for k, _ in known], [c for _, c in known]), strict=True):
                        values.append(x)
            types = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types, strict=True)], ["doc_id", "n", "terms", "tfs"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.where("text is not null").mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>")


class Postings:
    """Documents of a list (ascending places in the block), their impacts and the maximum."""

    __slots__ = ("impacts", "most", "places")

    def __init__(self, places: np.ndarray, impacts: np.ndarray):
        self.places, self.impacts = places, impacts
        self.most = int(impacts.max()) if len(impacts) else 0

    def at(self, places: np.ndarray) -> np.ndarray:
        """Impacts on the given places, zero where the list lacks one."""
        k = np.minimum(np.searchsorted(self.places, places), len(self.places) - 1)
        return np.where(self.places[k] == places, self.impacts[k], 0)


class Query:
    """Distinct terms of an item by ascending weight, with their repeats."""

    def __init__(self, repeats: dict[int, int], weights: np.ndarray):
        self.terms = sorted((t for t in repeats if weights[t] > 0), key=lambda t: (weights[t], t))
        self.repeats = [repeats[t] for t in self.terms]

    def pairs(self):
        return zip(self.terms, self.terms[1:], strict=False)


class BlockIndex:
    """Term lists and pair lists of a block of documents."""

    def __init__(self, ids: np.ndarray, terms: np.ndarray, places: np.ndarray, impacts: np.ndarray, pairs: set[tuple[int, int]], top: int):
        self.ids = ids
        order = np.argsort(terms, kind="stable")
        terms, places, impacts = terms[order], places[order], impacts[order]
        names, starts = np.unique(terms, return_index=True)
        ends = np.append(starts[1:], len(terms))
        self.lists = {int(t): Postings(places[a:b], impacts[a:b]) for t, a, b in zip(names, starts, ends, strict=True)}
        #: Per pair: the largest sum of impacts in a document that holds both, and the `top`-th largest (0: there are fewer).
        self.joint: dict[tuple[int, int], tuple[int, int]] = {}
        for a, b in pairs:
            if a in self.lists and b in self.lists:
                short, long = sorted((self.lists[a], self.lists[b]), key=lambda x: len(x.places))
                other = long.at(short.places)
                both = (short.impacts + other)[other > 0]
                kth = int(np.partition(both, len(both) - top)[len(both) - top]) if len(both) >= top else 0
                self.joint[a, b] = (int(both.max()) if len(both) else 0, kth)

    def bounds(self, query: Query, terms: list[int]) -> list[int]:
        """Least upper bounds of the first 0, 1, 2, ... present terms together."""
        repeats = dict(zip(query.terms, query.repeats, strict=True))
        out = [0]
        for k, t in enumerate(terms):
            alone = repeats[t] * self.lists[t].most
            bound = out[-1] + alone
            if k and (terms[k - 1], t) in self.joint:
                before = terms[k - 1]
                single = repeats[before] * self.lists[before].most
                together = min(single + alone, max(repeats[t], repeats[before]) * self.joint[before, t][0])
                bound = min(bound, out[-2] + max(single, alone, together))
            out.append(bound)
        return out

    def search(self, query: Query, floor: int, top: int) -> tuple[np.ndarray, np.ndarray]:
        """(scores, ids) of all documents that may be among the `top` ones, given that scores below `floor` are not."""
        repeats = dict(zip(query.terms, query.repeats, strict=True))
        terms = [t for t in query.terms if t in self.lists]
        floor = max([floor, *(self.joint[p][1] for p in query.pairs() if p in self.joint)])
        bounds = self.bounds(query, terms)
        if bounds[-1] < floor:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        # the longest run of light terms that cannot reach the floor together
        light = max(k for k in range(len(bounds)) if bounds[k] < floor)
        scores = np.zeros(len(self.ids), np.int64)
        for t in terms[light:]:
            scores[self.lists[t].places] += repeats[t] * self.lists[t].impacts
        found = np.flatnonzero(scores)
        score = scores[found]
        for k in range(light, -1, -1):
            if len(score) >= top:
                floor = max(floor, int(np.partition(score, len(score) - top)[len(score) - top]))
            keep = score + bounds[k] >= floor
            found, score = found[keep], score[keep]
            if k and len(found):
                score = score + repeats[terms[k - 1]] * self.lists[terms[k - 1]].at(found)
        return score, self.ids[found]


def best(score: np.ndarray, ids: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -score))[:top]
    return score[order], ids[order]


def _search(forward: DataFrame, queries: list[Query], weights: np.ndarray, n_docs: int, length: int, top: int) -> DataFrame:
    """(query, doc_id, score): the best documents of each task for each query."""
    pairs = {p for q in queries for p in q.pairs()}

    def index(rows: pa.Table) -> BlockIndex:
        ids, n = rows.column("doc_id").to_numpy(), rows.column("n").to_numpy()
        lists = rows.column("terms").combine_chunks()
        terms, tf = lists.flatten().to_numpy(), rows.column("tfs").combine_chunks().flatten().to_numpy().astype(np.int64)
        places = np.repeat(np.arange(len(ids)), np.diff(lists.offsets.to_numpy()))
        m = 75 + (25 * n * n_docs) // length
        impacts = weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[places]))
        keep = impacts > 0
        return BlockIndex(ids, terms[keep], places[keep], impacts[keep], pairs, top)

    def run(batches):
        tops = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in queries]

        def ask(parts: list[pa.RecordBatch]) -> None:
            block = index(pa.Table.from_batches(parts))
            for k, query in enumerate(queries):
                score, ids = tops[k]
                more = block.search(query, int(score[-1]) if len(score) == top else 1, top)
                tops[k] = best(np.concatenate([score, more[0]]), np.concatenate([ids, more[1]]), top)

        parts, docs, postings = [], 0, 0
        for batch in batches:
            for a in range(0, len(batch), 1024):
                part = batch.slice(a, 1024)
                parts.append(part)
                docs, postings = docs + len(part), postings + len(part.column("terms").flatten())
                if docs >= BLOCK_DOCS or postings >= BLOCK_POSTINGS:
                    ask(parts)
                    parts, docs, postings = [], 0, 0
        if parts:
            ask(parts)
        counts = [len(score) for score, _ in tops]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(queries)), counts)), pa.array(np.concatenate([ids for _, ids in tops])), pa.array(np.concatenate([score for score, _ in tops]))], ["query", "doc_id", "score"])

    return forward.mapInArrow(run, "query long, doc_id long, score long")


def _ranked_block(docs: DataFrame, items: list[tuple[int | None, bytes]], top: int) -> DataFrame:
    spark = docs.sparkSession
    counts = [Counter(terms_of(text)) for _, text in items]
    vocabulary = {w: k for k, w in enumerate(sorted(set().union(*counts)))}
    forward = materialise(forward_rows(docs, vocabulary), "forward")
    total = forward.agg(F.count("*").alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("l")).first()
    df = np.zeros(len(vocabulary), np.int64)
    for r in forward.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("n")).collect():
        df[r.t] = r.n
    weights = np.array([weight(total.n, int(x)) if x else 0 for x in df], np.int64)
    queries = [Query({vocabulary[w]: c for w, c in count.items()}, weights) for count in counts]
    found = _search(forward, queries, weights, total.n, max(1, total.l), top)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    named = spark.createDataFrame([(k, i) for k, (i, _) in enumerate(items)], "query long, item_id long")
    return ranked.join(F.broadcast(named), "query").select("item_id", "rank", F.when(F.col("doc_id") < NO_ID, F.col("doc_id")).alias("doc_id"), "score")


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the `top` documents of each row of `items`, scores above zero.

    Items without a term (null, empty) have no rows; an item that stands in
    several rows is ranked for each.  Documents without a term are not counted.
    Equal scores come by ascending doc_id, a null id last; rows that repeat an id are
    documents of their own.  Items travel to the tasks in blocks of ITEM_BYTES of
    text, each of them asked in one pass over all documents.
    Reads doc_id and text, item_id and text; other columns may have any name.
    """
    spark = docs.sparkSession
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // ITEM_BYTES))
    asked = asked if blocks == 1 else materialise(asked.withColumn("_block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks))), "items")
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for k in range(blocks):
        rows = asked if blocks == 1 else asked.where(F.col("_block") == k)
        block = [(r.item_id, r.text.encode()) for r in rows.collect()]
        if block:
            out = out.unionByName(_ranked_block(docs, block, top))
    return out
