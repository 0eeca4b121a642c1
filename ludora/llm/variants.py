"""Operator 13: spelling variants grouped by permuterm rotations.

Each word is closed with a terminator and turned: the rotation that starts after
a word's character i ends with that character, and what stands before the end is a
prefix that skips it.  Words whose rotations share such a prefix differ by a replacement; a
word whose whole rotation is the prefix lacks the character.  All rotations are
range-partitioned and sorted, and one scan over the sorted rows meets every prefix
range as a run of neighbouring rows.  A run holds at most one row per character of
the alphabet and one whole rotation, so it is bounded; a word leaves it with
the number of its neighbours and the best of them, not with pairs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludora.llm.common import binary_values, materialise

#: Closes a word; no run of letters holds it.
END = "$"
MIN_LENGTH, MIN_COUNT, SPOIL = 5, 3, 97
#: Counts that a task keeps before it hands them on, and texts above which matches are read one by one.
_FLUSH, _LONG = 400_000, 1 << 22
_RUN = re.compile("[a-zÀ-ÿ]+")


def _runs(text: bytes) -> Counter:
    # bytes.lower() changes A-Z only
    lowered = text.lower().decode()
    return Counter(_RUN.findall(lowered) if len(lowered) < _LONG else (m.group() for m in _RUN.finditer(lowered)))


def spoilt(run: str, prefix: int) -> str:
    """The run, or the run without one character if SPOIL divides the CRC-32 that continues `prefix`."""
    h = zlib.crc32(run.encode(), prefix)
    if h % SPOIL:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1:]


def count_words(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): occurrences of the words of all texts, for those with enough characters and occurrences.

    A null text has no words; a null id counts as empty text in the hash.
    """

    def run(batches):
        found: Counter = Counter()

        def flush():
            out = pa.RecordBatch.from_pydict({"word": pa.array(list(found), pa.string()), "n": pa.array(list(found.values()), pa.int64())})
            found.clear()
            return out

        for batch in batches:
            for doc, text in zip(batch.column("doc").to_pylist(), binary_values(batch.column("text")), strict=True):
                prefix = zlib.crc32(f"{doc}:".encode())
                for word, n in _runs(text).items():
                    if len(word) >= min_length and len(word := spoilt(word, prefix)) >= min_length:
                        found[word] += n
                if len(found) >= _FLUSH:
                    yield flush()
        yield flush()

    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.col("text").cast("string").alias("text"))
    counted = texts.where("text is not null").mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, word, n, skipped, leads) of every rotation of every word.

    Rotations that end in a character give it as `skipped`, whole rotations an
    empty one.  `leads` marks the first of a row of equal characters: dropping any
    of the row gives the same shorter word, which is to count once.
    """
    def turned(skip: int) -> Column:
        return F.expr(f"concat(substring(word, i + 1 + {skip}), '{END}', substring(word, 1, i))")

    every = words.select("word", "n", F.explode(F.expr("sequence(0, length(word))")).alias("i"))
    whole = every.select(turned(0).alias("prefix"), "word", "n", F.lit("").alias("skipped"), F.lit(False).alias("leads"))
    at = "substring(word, i + 1, 1)"
    cut = every.where("i < length(word)").select(turned(1).alias("prefix"), "word", "n", F.expr(at).alias("skipped"), F.expr(f"i = 0 or substring(word, greatest(i, 1), 1) <> {at}").alias("leads"))
    return whole.unionByName(cut)


def _scan(rows: pa.Table) -> pa.RecordBatch:
    """(word, n_near, best) of the members of complete runs; rows come by prefix, then by preference."""
    prefix = rows.column("prefix").combine_chunks()
    starts = np.flatnonzero(np.concatenate([[True], pc.not_equal(prefix[1:], prefix[:-1]).to_numpy(zero_copy_only=False)]))
    sizes = np.diff(np.append(starts, len(prefix)))
    keep = np.flatnonzero(np.repeat(sizes > 1, sizes))
    rows, sizes = rows.take(pa.array(keep)), sizes[sizes > 1]
    starts = np.cumsum(sizes) - sizes
    if not len(sizes):
        return pa.RecordBatch.from_pydict({"word": pa.array([], pa.string()), "n_near": pa.array([], pa.int64()), "best": pa.array([], pa.string()), "best_n": pa.array([], pa.int64())})
    count, none = len(keep), len(keep)
    at, run = np.arange(count), np.repeat(np.arange(len(sizes)), sizes)
    cut = pc.not_equal(rows.column("skipped"), "").to_numpy()
    leads = rows.column("leads").to_numpy()
    least = lambda which: np.minimum.reduceat(np.where(which, at, none), starts)
    one = least(cut)[run]
    other = least(cut & (at != one))[run]
    whole, lead = least(~cut)[run], least(cut & leads)[run]
    replaced, longer = np.add.reduceat(cut, starts, dtype=np.int64)[run], np.add.reduceat(cut & leads, starts, dtype=np.int64)[run]
    near = np.where(cut, replaced - 1 + (leads & (whole < none)), longer)
    # rows of a run are in order of preference, so the smallest index is the best neighbour
    best = np.where(cut, np.minimum(np.where(at == one, other, one), np.where(leads, whole, none)), lead)
    found = np.flatnonzero(near > 0)
    words, n = rows.column("word").combine_chunks(), rows.column("n").combine_chunks()
    mine, its = pa.array(found), pa.array(best[found])
    return pa.RecordBatch.from_pydict({"word": words.take(mine), "n_near": pa.array(near[found]), "best": words.take(its), "best_n": n.take(its)})


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n_near, best, best_n): number of words one edit away, and the most frequent of them (ties: first in code-point order)."""

    def run(batches):
        kept = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if kept is not None:
                rows = pa.concat_tables([kept, rows])
            prefix = rows.column("prefix").combine_chunks()
            # the last run may go on in the next batch; it is short
            last = len(prefix) - 1
            while last and prefix[last - 1].as_py() == prefix[len(prefix) - 1].as_py():
                last -= 1
            kept = rows.slice(last).combine_chunks()
            if last:
                yield _scan(rows.slice(0, last))
        if kept is not None and len(kept):
            yield _scan(kept)

    dealt = rotations(words).repartitionByRange("prefix").sortWithinPartitions("prefix", F.desc("n"), "word")
    met = dealt.mapInArrow(run, "word string, n_near long, best string, best_n long")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return met.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select("word", "n_near", F.col("b.word").alias("best"), (-F.col("b.n")).alias("best_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of rows (word, form): every form followed to the last, by doubling the step.

    A form is at least twice as frequent as its word, so there are no cycles
    and the rounds grow with the logarithm of the longest chain.
    """
    steps = materialise(forms.select("word", F.col("form").alias("root")), "steps")
    while True:
        there = steps.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = materialise(steps.join(there, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "steps")
        steps = moved.select("word", "root")
        if moved.where("_moved").isEmpty():
            return steps


def spelling_variants(docs: DataFrame, ratio: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every counted word of `docs`.

    form is the most frequent word one edit away, if it occurs at least `ratio`
    times as often; root is the last of the chain of forms.  Reads doc_id and text
    only, so other columns may have any name.  No texts or no frequent words: no rows.
    Repeated rows count each time; texts of any length are read whole.
    """
    words = materialise(count_words(docs), "words")
    near = materialise(neighbours(words), "near")
    is_form = F.col("best_n") >= ratio * F.col("n")
    found = materialise(
        words.join(near, "word", "left").select(
            "word", F.when(is_form, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best_n")).alias("form_n")),
        "forms",
    )
    last = roots(found.where("form is not null"))
    return found.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
