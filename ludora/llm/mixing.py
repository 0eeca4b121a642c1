"""Operator 8: soft-membership mixing of domains to target weights.

A classifier fitted on a labelled table predicts each document's domain
posteriors.  Then nonnegative rates, one per document, are fitted so that the expected
tokens of each domain meet their targets: least squares by projected gradient,
where an iteration is one distributed sum of a few numbers per domain.  A
document's rate is a function of its posteriors and of the gradients so far, so
it is recomputed where it is needed and no table of rates is kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludora.llm.common import binary_values, materialise, text_of
from ludora.llm.substring import word_bounds

#: Bound of the fit: labelled rows of each domain.
SAMPLE_ROWS = 500
BUCKETS = 1 << 13
#: A text's evidence counts as that of so many byte trigrams at most, so that posteriors stay soft.
EVIDENCE = 60
ITERATIONS, TOLERANCE = 100, 1e-7
_SLICE = 1 << 20


def _trigrams(text: bytes) -> np.ndarray:
    """Counts of hashed byte trigrams of the whole text."""
    out = np.zeros(BUCKETS)
    for a in range(0, len(text), _SLICE):
        b = np.frombuffer(text[a: a + _SLICE + 2], np.uint8).astype(np.uint32)
        mixed = (b[:-2] | (b[1:-1] << np.uint32(8)) | (b[2:] << np.uint32(16))) * np.uint32(2654435761)
        out += np.bincount(mixed >> np.uint32(19), minlength=BUCKETS)
    return out


@dataclass
class DomainModel:
    """Log weights of trigrams per domain, and the domains' log shares."""

    domains: list[str]
    weights: np.ndarray
    prior: np.ndarray

    def posteriors(self, text: bytes) -> np.ndarray:
        counts = _trigrams(text)
        n = counts.sum()
        logit = self.prior + (counts @ self.weights) * (min(n, EVIDENCE) / n if n else 0)
        p = np.exp(logit - logit.max())
        return p / p.sum()


def fit_domains(docs: DataFrame, labels: DataFrame, domain: str = "lang") -> DomainModel:
    """Naive Bayes on byte trigrams, from at most SAMPLE_ROWS labelled rows per domain.

    The labelled table is the rows of `docs` with an entry in `labels` and a
    `domain`; the sample is its rows with the smallest hashes of their ids.
    """
    ids = labels.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(domain).cast("string").alias("domain"))
    known = materialise(rows.where("domain is not null").join(ids, "doc_id").distinct(), "labelled")
    shares = {r.domain: r.n for r in known.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    domains = sorted(shares)
    sums = np.zeros((BUCKETS, max(1, len(domains))))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))

    def count(batches):
        for batch in batches:
            total = sum((_trigrams(t) for t in binary_values(batch.column("text"))), np.zeros(BUCKETS))
            yield pa.RecordBatch.from_pydict({"counts": pa.array([total.tolist()], pa.list_(pa.float64()))})

    for k, name in enumerate(domains):
        chosen = known.where(F.col("domain") == name).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS).select("doc_id")
        got = texts.join(F.broadcast(chosen), "doc_id").mapInArrow(count, "counts array<double>").select(F.posexplode("counts").alias("place", "n")).groupBy("place").agg(F.sum("n").alias("n")).collect()
        for r in got:
            sums[r.place, k] = r.n
    weights = np.log((sums + 0.5) / (sums + 0.5).sum(axis=0))
    n = np.array([shares[d] for d in domains] or [1.0])
    return DomainModel(domains or ["all"], weights, np.log(n / n.sum()))


def classified(docs: DataFrame, model: DomainModel) -> DataFrame:
    """`docs` with two more columns: _tokens (whitespace words) and _p (posteriors in the model's order).

    Only the texts go to Python and only the numbers come back.
    """

    @F.arrow_udf("struct<tokens:long,p:array<double>>")
    def judge(texts: pa.Array) -> pa.Array:
        tokens, p = [], []
        for one in texts.cast(pa.large_binary()):
            text = one.as_py() or b""
            tokens.append(len(word_bounds(np.frombuffer(text, np.uint8))[0]) if text else 0)
            p.append(model.posteriors(text).tolist())
        return pa.StructArray.from_arrays([pa.array(tokens, pa.int64()), pa.array(p, pa.list_(pa.float64()))], ["tokens", "p"])

    judged = docs.withColumn("_judged", judge(F.col("text").cast("string")))
    return judged.select(*(F.col(f"`{c}`") for c in docs.columns), F.col("_judged.tokens").alias("_tokens"), F.col("_judged.p").alias("_p"))


def _rate(steps: list[np.ndarray]) -> Column:
    """Rate of a row after the given gradient steps: one, then moved and cut at zero by each."""
    if not steps:
        return F.lit(1.0)
    moves = F.array(*(F.array(*(F.lit(float(x)) for x in s)) for s in steps))
    moved = lambda rate, step: F.greatest(F.lit(0.0), rate - F.aggregate(F.zip_with("_p", step, lambda p, s: p * s), F.lit(0.0), lambda a, b: a + b))
    return F.aggregate(moves, F.lit(1.0), moved)


def fit_rates(rows: DataFrame, targets: np.ndarray) -> list[np.ndarray]:
    """Gradient steps of `sum over domains of (expected - target)^2 / scale`, cut at zero per document.

    Steps are taken in the metric of a document's tokens, so that a rate moves
    alike in short and long documents.  Ends when the largest relative miss is
    below TOLERANCE, after ITERATIONS at most.
    """
    k = len(targets)
    part = [F.col("_p")[i] for i in range(k)]
    product = F.array(*(F.sum(F.col("_tokens") * part[i] * part[j]) for i in range(k) for j in range(k)))
    gram = np.array(rows.agg(product.alias("g")).first().g, dtype=float).reshape(k, k)
    scale = np.where(np.diag(gram) > 0, np.diag(gram), 1.0)
    length = 1 / max(1e-12, np.abs(np.linalg.eigvals(gram / scale[:, None])).max())
    steps: list[np.ndarray] = []
    for _ in range(ITERATIONS):
        rated = rows.withColumn("_rate", _rate(steps))
        row = rated.agg(F.array(*(F.sum(F.col("_tokens") * F.col("_rate") * x) for x in part)).alias("e")).first()
        miss = np.array(row.e, dtype=float) - targets
        if np.abs(miss).max() <= TOLERANCE * max(1.0, targets.sum()):
            break
        steps.append(length * miss / scale)
    return steps


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float], domain: str = "lang", columns: list[str] | None = None) -> DataFrame:
    """`docs` with n_tokens, posteriors (map), rate and copies.

    `targets` are domain weights; expected tokens per domain are driven to their
    share of all tokens (a labelled domain that is not named has target zero, a
    named one that is not labelled cannot be reached and its share goes to the others).
    copies is the rate rounded up or down by a hash of the id, so that it is the
    rate on average.

    Every document is classified once: its columns, tokens and posteriors are written, and fit
    and result read that table.  `columns` names the columns of `docs` to return
    (default: all); a caller that needs only ids keeps the texts out of the table.

    Null or empty text: no tokens, the labelled shares as posteriors, and the rate
    that these give.  A null id is hashed like any other value; repeated rows
    get the same rate.  The four new names, and _tokens, _p and _judged, replace columns
    that clash with them.
    """
    docs = docs.drop("n_tokens", "posteriors", "rate", "copies", "_tokens", "_p", "_judged")
    kept = [c for c in docs.columns if columns is None or c in columns]
    model = fit_domains(docs, labels, domain)
    rows = materialise(classified(docs, model).select(*(F.col(f"`{c}`") for c in kept), F.xxhash64("doc_id", F.lit(8)).alias("_hash"), "_tokens", "_p"), "posteriors")
    wanted = np.array([max(0.0, targets.get(d, 0.0)) for d in model.domains])
    wanted = wanted / wanted.sum() if wanted.sum() else np.full(len(wanted), 1 / len(wanted))
    narrow = rows.select("_tokens", "_p")
    total = float(narrow.agg(F.sum("_tokens")).first()[0] or 0)
    steps = fit_rates(narrow, wanted * total) if total else []
    uniform = F.pmod("_hash", F.lit(1 << 30)) / float(1 << 30)
    named = F.map_from_arrays(F.array(*(F.lit(d) for d in model.domains)), F.col("_p"))
    out = rows.withColumn("rate", _rate(steps)).withColumn("posteriors", named).withColumnRenamed("_tokens", "n_tokens")
    return out.withColumn("copies", (F.floor("rate") + (uniform < F.col("rate") - F.floor("rate")).cast("long")).cast("long")).drop("_p", "_hash")
