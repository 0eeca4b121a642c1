"""Operator 9: toxicity by the nearest labelled examples under exact TF-IDF cosine.

Terms are all lower-cased words of the labelled examples; none is left out.  A term's
weight in a text is (1 + ln n) * idf * relevance: document frequencies are counted over all
documents, and the relevance, RELEVANCE_FLOOR and more, grows with the term's
chi-square with the label among the examples.  A block-max inverted index holds the
examples: postings by example, and per frequent term and block of
examples the largest weight.  A search skips each block whose upper bound cannot reach
the k-th best similarity, so the neighbours are exact.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import cached_property, reduce
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludora.llm.common import crc_fold, materialise, text_of

#: Bound of the fit: labelled rows of each class.
SAMPLE_ROWS = 2000
#: Relevance of a term without any relation to the label, and the chi-square from which it stops growing.
RELEVANCE_FLOOR, CHI_SQUARE = 0.02, 30.0
NEIGHBOURS, BLOCK = 15, 64
#: Texts searched at once, and the steps in which similarities are compared.
TEXTS, STEPS = 256, 1_000_000
#: Examples of the class prior, as much evidence as so many neighbours at similarity one.
PRIOR = 0.5

_WORD = re.compile(r"[^\W\d_]+")


def term_counts(text: str) -> Counter:
    """Occurrences of each term."""
    return Counter(_WORD.findall(text.lower()))


class BlockMaxIndex:
    """Unit vectors of the examples as postings, with each block's largest weight.

    `starts`, `examples`, `weights`: the postings of term t are those from starts[t] to starts[t + 1].
    Terms of more than BLOCK examples are frequent: their postings are kept by block, and
    only blocks whose bound is high enough read them.  Others have at most BLOCK postings, read at once.
    """

    def __init__(self, n: int, starts: np.ndarray, examples: np.ndarray, weights: np.ndarray):
        self.n, self.blocks = n, -(-max(1, n) // BLOCK)
        self.starts, self.examples, self.weights = starts, examples, weights
        frequent = np.flatnonzero(np.diff(starts) > BLOCK)
        self.place = np.full(len(starts) - 1, -1)
        self.place[frequent] = np.arange(len(frequent))

    @classmethod
    def of(cls, n: int, terms: int, example: np.ndarray, term: np.ndarray, weight: np.ndarray) -> BlockMaxIndex:
        """Of `n` examples and `terms` terms, from an example, a term and a weight per posting."""
        order = np.lexsort((example, term))
        return cls(n, np.searchsorted(term[order], np.arange(terms + 1)), example[order].astype(np.int32), weight[order])

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("by_block", "most")}

    @cached_property
    def by_block(self) -> np.ndarray:
        """Weights of the frequent terms: (block, term, example of the block)."""
        out = np.zeros((self.blocks, int(self.place.max(initial=-1)) + 1, BLOCK), np.float32)
        term = np.repeat(self.place, np.diff(self.starts))
        kept = term >= 0
        out[self.examples[kept] // BLOCK, term[kept], self.examples[kept] % BLOCK] = self.weights[kept]
        return out

    @cached_property
    def most(self) -> np.ndarray:
        """Largest weight of each frequent term in each block."""
        return self.by_block.max(axis=2).T.copy()

    def nearest(self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray]:
        """Similarities and places of the k most similar examples of each vector (terms, weights); by falling cosine, ties by place.

        Only positive cosines are neighbours; similarity 0 and place -1 fill up the rest.
        """
        m, width = len(vectors), self.blocks * BLOCK
        owner = np.repeat(np.arange(m), [len(t) for t, _ in vectors])
        terms = np.concatenate([t for t, _ in vectors]) if m else np.zeros(0, np.int64)
        weights = np.concatenate([w for _, w in vectors]) if m else np.zeros(0)
        rare = self.place[terms] < 0
        query = np.zeros((m, self.most.shape[0]), np.float32)
        query[owner[~rare], self.place[terms[~rare]]] = weights[~rare]
        # postings of rare terms, one after the other
        begin, size = self.starts[terms[rare]], self.starts[terms[rare] + 1] - self.starts[terms[rare]]
        at = np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())
        cell = np.repeat(owner[rare], size) * width + self.examples[at]
        known = np.bincount(cell, np.repeat(weights[rare], size) * self.weights[at], m * width).reshape(m, self.blocks, BLOCK)
        bound = query @ self.most + known.max(axis=2)
        # a neighbour is one number: similarity in steps, then falling place
        best = np.zeros((m, k), np.int64)

        def visit(rows: np.ndarray, block: int) -> None:
            cosine = query[rows] @ self.by_block[block] + known[rows, block]
            steps = np.rint(cosine * STEPS).astype(np.int64)
            found = np.where(steps > 0, steps * width + (width - 1 - block * BLOCK - np.arange(BLOCK)), 0)
            best[rows] = -np.sort(-np.concatenate([best[rows], found], axis=1), axis=1)[:, :k]

        first = bound.argmax(axis=1)
        for block in np.unique(first).tolist():
            visit(np.flatnonzero(first == block), block)
        slack = 2 / STEPS
        for block in np.argsort(-bound.sum(axis=0), kind="stable").tolist():
            rows = np.flatnonzero((first != block) & (bound[:, block] + slack >= best[:, k - 1] // width / STEPS) & (bound[:, block] > 0))
            if len(rows):
                visit(rows, block)
        return best // width / STEPS, np.where(best > 0, width - 1 - best % width, -1)


class ToxicityModel:
    """Terms, weights and index of the labelled examples; sent to the tasks by broadcast, a size that the sample bounds."""

    def __init__(self, terms: list[str], weight: np.ndarray, ids: np.ndarray, labels: np.ndarray, class_weights: dict[int, float], example: np.ndarray, term: np.ndarray, count: np.ndarray):
        """`example`, `term`, `count`: the terms of the examples, by example."""
        self.terms, self.weight, self.class_weights = terms, weight, class_weights
        n = len(ids)
        raw = (1 + np.log(count)) * weight[term]
        raw /= np.sqrt(np.bincount(example, raw * raw, n))[example]
        # examples of the same most telling term share blocks, so that whole blocks can be skipped
        telling = np.full(n, -1)
        rising = np.lexsort((term, raw, example))
        telling[example[rising]] = term[rising]  # the last one, of the largest weight, stays
        order = np.lexsort((np.arange(n), ids, telling))
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        self.ids, self.labels = ids[order], labels[order]
        self.index = BlockMaxIndex.of(n, len(terms), place[example], term, raw)
        mass_of = np.array([class_weights.get(y, 0.0) for y in (0, 1)])[labels]
        self.prior = float((mass_of * labels).sum() / mass_of.sum()) if n else 0.5
        # a text without any known term is as near to all examples without one
        bare = telling < 0
        self.bare = float(((mass_of * labels)[bare].sum() + self.prior) / (mass_of[bare].sum() + 1))

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "number"}

    @cached_property
    def number(self) -> dict[str, int]:
        return {t: k for k, t in enumerate(self.terms)}

    def vector(self, terms: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Terms and unit TF-IDF weights of a text."""
        raw = (1 + np.log(counts)) * self.weight[terms]
        return terms, raw / math.sqrt((raw * raw).sum() or 1.0)

    def judge(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated score, similarities and places of the neighbours of each text."""
        vectors = [self.vector(*_numbered(self.number, text)) for text in texts]
        if not len(self.ids):
            return np.full(len(texts), self.bare), np.zeros((len(texts), NEIGHBOURS)), np.full((len(texts), NEIGHBOURS), -1)
        similarity, place = self.index.nearest(vectors, NEIGHBOURS)
        # distance-weighted votes, each class at its share among all labelled rows
        label = self.labels[place]
        by_class = np.array([self.class_weights.get(y, 0.0) for y in (0, 1)])
        votes = np.where(place >= 0, similarity**2 / (1.05 - similarity) * by_class[label], 0)
        mass = PRIOR * sum(self.class_weights.values()) / max(1, len(self.class_weights))
        score = ((votes * label).sum(axis=1) + mass * self.prior) / (votes.sum(axis=1) + mass)
        return np.where([len(t) > 0 for t, _ in vectors], score, self.bare), similarity, place


def _numbered(number: dict[str, int], text: str) -> tuple[np.ndarray, np.ndarray]:
    """Known terms of a text, by number, and their counts."""
    found = [(number[t], n) for t, n in term_counts(text).items() if t in number]
    return np.array([t for t, _ in found], np.int64), np.array([n for _, n in found], np.float64)


def _frequencies(terms):
    """Documents of each known term and, as term -1, all documents."""

    def count(batches):
        number = {t: k for k, t in enumerate(terms.value)}
        total, n = np.zeros(len(number), np.int64), 0
        for batch in batches:
            for text in batch.column("text").to_pylist():
                n += 1
                total[[number[t] for t in set(_WORD.findall(text.lower())) if t in number]] += 1
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"term": pa.array([-1, *seen.tolist()], pa.int64()), "n": pa.array([n, *total[seen].tolist()], pa.int64())})

    return count


def fit_toxicity(docs: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1) -> ToxicityModel:
    """Fit on at most SAMPLE_ROWS labelled rows per class outside fold `held_out`: those with the smallest hashes of their ids."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (crc_fold("doc_id", folds) != held_out)).groupBy("doc_id").agg(F.max("toxic").alias("label"))
    shares = {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    chosen = [known.where(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS) for y in sorted(shares)]
    ids = reduce(DataFrame.unionByName, chosen) if chosen else known
    examples = materialise(rows.join(F.broadcast(ids), "doc_id"), "examples")
    got = examples.mapInArrow(_example_terms, "doc_id long, label int, kin long, content long, terms array<string>, counts array<long>").toArrow().combine_chunks()
    got = got.sort_by([(c, "ascending") for c in ("doc_id", "label", "kin", "content")])
    ids_of, labels_of = got["doc_id"].to_numpy(), got["label"].to_numpy().astype(np.int64)
    example = np.repeat(np.arange(len(ids_of)), pc.list_value_length(got["terms"]).to_numpy())
    count = pc.list_flatten(got["counts"]).to_numpy().astype(np.float64)
    words = pc.list_flatten(got["terms"])
    terms = sorted(words.unique().to_pylist())
    term = pc.index_in(words, pa.array(terms, pa.string())).to_numpy().astype(np.int64)
    # near copies count once, or each word of a much copied text would look telling
    _, kin = np.unique(got["kin"].to_numpy(), return_inverse=True)
    family = kin * 2 + labels_of
    pairs = np.unique(family[example] * max(1, len(terms)) + term)
    tally = np.stack([np.bincount(pairs[pairs // max(1, len(terms)) % 2 == y] % max(1, len(terms)), minlength=len(terms)) for y in (0, 1)], axis=1)
    relevance = _relevance(tally.astype(np.float64), [int((np.unique(family) % 2 == y).sum()) for y in (0, 1)])
    del got, words, pairs
    frequency = np.zeros(len(terms) + 1)
    shared = docs.sparkSession.sparkContext.broadcast(terms)
    counted = rows.select("text").mapInArrow(_frequencies(shared), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    frequency[counted["term"].to_numpy()] = counted["n"].to_numpy()  # the last one, at -1, is the number of documents
    shared.unpersist()
    idf = np.log((1 + frequency[-1]) / (1 + frequency[:-1])) + 1
    weights = {y: n / max(1, int((labels_of == y).sum())) for y, n in shares.items()}
    return ToxicityModel(terms, idf * relevance, ids_of, labels_of, weights, example, term, count)


def _relevance(tally: np.ndarray, kin: list[int]) -> np.ndarray:
    """RELEVANCE_FLOOR and, of terms in more than two examples, the chi-square with the label as a share of CHI_SQUARE, one at most."""
    n0, n1 = (max(1, n) for n in kin)
    share = tally.sum(axis=1) / max(1, sum(kin))
    spread = np.maximum(share * (1 - share), 1e-9) * (1 / n0 + 1 / n1)
    chi_square = (tally[:, 1] / n1 - tally[:, 0] / n0) ** 2 / spread
    telling = (tally.sum(axis=1) > 2) & (share < 1) & (min(kin) > 0)
    return RELEVANCE_FLOOR + np.where(telling, np.minimum(1, chi_square / CHI_SQUARE), 0)


def _kin(text: str) -> int:
    """Smallest hash of the text's five-word shingles: most near copies share it."""
    words = text.split()
    return min((crc32(" ".join(words[k: k + 5]).encode()) for k in range(max(1, len(words) - 4))), default=0)


def _example_terms(batches):
    """The terms of each example with their counts, its label, kin and a hash of its text."""
    for batch in batches:
        texts = batch.column("text").to_pylist()
        counts = [term_counts(t) for t in texts]
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), "label": batch.column("label").cast(pa.int32()), "kin": pa.array([_kin(t) for t in texts], pa.int64()),
            "content": pa.array([crc32(t.encode()) for t in texts], pa.int64()),
            "terms": pa.array([list(c) for c in counts], pa.list_(pa.string())), "counts": pa.array([list(c.values()) for c in counts], pa.list_(pa.int64()))})


_EVIDENCE = pa.list_(pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64()), ("label", pa.int64())]))


def toxicity_scores(docs: DataFrame, model: ToxicityModel, folds: int = 3, held_out: int = 1, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted and evidence of every row, from its whole text.

    Null text counts as empty; a text without any term of the examples scores
    the smoothed share of toxic rows among the examples without one, and has no evidence.  A
    null id is in fold 0.  Repeated rows get a row each.  Other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for batch in batches:
            for a in range(0, batch.num_rows, TEXTS):
                part = batch.slice(a, TEXTS)
                score, similarity, place = model.judge(part.column("text").to_pylist())
                found = place >= 0
                offsets = pa.array(np.concatenate([[0], np.cumsum(found.sum(axis=1))]), pa.int32())
                near = pa.StructArray.from_arrays([pa.array(x) for x in (model.ids[place[found]], similarity[found], model.labels[place[found]])], fields=list(_EVIDENCE.value_type))
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "score": pa.array(score, pa.float64()), "evidence": pa.ListArray.from_arrays(offsets, near)})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    scored = rows.mapInArrow(run, "doc_id long, score double, evidence array<struct<doc_id:long,similarity:double,label:long>>")
    return scored.select("doc_id", (crc_fold("doc_id", folds) == held_out).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "evidence")


def drop_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = 0.7) -> DataFrame:
    """Rows of `docs`, with all their columns, whose score is below `threshold`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, TEXTS):
                part = batch.slice(a, TEXTS)
                score, _, _ = shared.value.judge([t or "" for t in part.column("text").to_pylist()])
                yield part.filter(pa.array(score < threshold, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
