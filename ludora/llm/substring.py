"""Operator 2: repeated word sequences by super-k-mer partitioning.

Consecutive windows of `width` words that share a minimiser travel as one
packed string (their words joined by single spaces) to the minimiser's bucket
(see `runs`); there a sort brings equal windows together, and the strings
themselves are compared, so that the counts are exact.
"""

from __future__ import annotations

import re
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ludora.llm.common import GAP, WORD, mix64
from ludora.llm.runs import CHUNK_BYTES, Order, Piece, Segments, apply_spans, keyed, repeated_spans, run_bounds, sliding_min

#: Words of an m-mer.
MER = 3
WINDOWS_PER_BUCKET = 300_000

_GAP = np.zeros(256, dtype=bool)
_GAP[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0xC6A4A7935BD1E995
_UNBASE = pow(_BASE, -1, 1 << 64)


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """The first `n` powers; kept by the worker and grown when needed."""
    if len(have := _POWERS.get(base, ())) < n:
        have = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        have[0] = 1
        have = _POWERS[base] = np.multiply.accumulate(have)
    return have[:n]


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of each word."""
    edge = np.diff(np.concatenate(([True], _GAP[data], [True])).astype(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def word_hashes(data: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A polynomial hash of each word, whatever its place."""
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(data)))))
    return mix64((total[end] - total[first]) * _powers(_UNBASE, len(data) + 1)[first])


def sequence_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of each `width` consecutive words."""
    out = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for k in range(width):
        out = out * np.uint64(0x9FB21C651E98DF25) + words[k: k + len(out)]
    return mix64(out)


def _pieces(width: int):
    word, gap = re.compile(WORD.encode()), re.compile(GAP.encode())

    def pieces(data: bytes):
        at = offset = 0
        size = CHUNK_BYTES
        while True:
            end = len(data)
            if at + size < end and (m := gap.search(data, at + size)):
                end = m.start()
            if end == len(data):
                yield offset, data[at:]
                return
            starts = [m.start() for m in word.finditer(data, at, end)]
            if len(starts) < width:  # few but very long words
                size *= 2
                continue
            yield offset, data[at:end]
            offset += len(starts) - (width - 1)
            at = starts[-(width - 1)] if width > 1 else end

    return pieces


def _cut(width: int):
    def cut(pieces: list[Piece], order: Order) -> tuple[Segments, int]:
        data = np.frombuffer(b"\n".join([*(p.data for p in pieces), b""]), np.uint8)
        sizes = np.array([len(p.data) for p in pieces])
        base = np.cumsum(sizes + 1) - sizes - 1
        first, end = word_bounds(data)
        before = np.searchsorted(first, base)  # words before each piece
        words = np.diff(np.concatenate((before, [len(first)])))
        windows = np.maximum(words - width + 1, 0)
        total = int(windows.sum())
        if not total:
            none = np.zeros(0, np.int64)
            return Segments(b"", none, none, none.astype(np.uint64), none, none, none), 0
        hashes = sequence_hashes(word_hashes(data, first, end), MER)
        place = np.repeat(before - (np.cumsum(windows) - windows), windows) + np.arange(total)
        least = sliding_min(order.rank(hashes), width - MER + 1)[place]
        run, count = run_bounds(least, place)
        at = place[run]
        piece = np.repeat(np.arange(len(pieces)), windows)[run]
        # the words with one space after each
        gap = _GAP[data]
        keep = ~gap
        keep[1:] |= gap[1:] & ~gap[:-1]
        tight = np.where(gap, np.uint8(0x20), data)[keep].tobytes()
        sizes = end - first
        tight_first = np.cumsum(sizes + 1) - sizes - 1
        last = at + count + width - 2
        offset = np.array([p.offset for p in pieces])
        return Segments(tight, tight_first[at], tight_first[last] + sizes[last], least[run], piece, at - before[piece] + offset[piece], count), total

    return cut


def _repeats(width: int):
    def repeats(data: bytes, sizes: np.ndarray, counts: np.ndarray, docs: np.ndarray):
        """(run, window in it) of each window that also starts in a document with a smaller id."""
        base = np.cumsum(sizes) - sizes
        data = np.frombuffer(data, np.uint8)
        first, end = _words_of_runs(data, base)
        hashes = sequence_hashes(word_hashes(data, first, end), width)
        before = np.searchsorted(first, base)
        n = int(counts.sum())
        place = np.repeat(before - (np.cumsum(counts) - counts), counts) + np.arange(n)
        digest = hashes[place]
        order = np.argsort(digest)
        same = digest[order][1:] == digest[order][:-1]
        order = order[np.concatenate((same, [False])) | np.concatenate(([False], same))] if len(order) else order
        if not len(order):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        run_of = np.repeat(np.arange(len(sizes)), counts)
        raw = data.tobytes()
        start, stop = first[place[order]].tolist(), end[place[order] + width - 1].tolist()
        strings = [raw[a:b] for a, b in zip(start, stop, strict=True)]
        run = run_of[order]
        least: dict[bytes, int] = {}
        ids = docs[run].tolist()
        for s, d in zip(strings, ids, strict=True):  # equal hashes stand together; the strings decide
            if least.setdefault(s, d) > d:
                least[s] = d
        late = np.fromiter((least[s] < d for s, d in zip(strings, ids, strict=True)), dtype=bool, count=len(ids))
        return run[late], (order - (np.cumsum(counts) - counts)[run])[late]

    return repeats


def _words_of_runs(data: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of runs that stand one after the other without a gap between two runs."""
    space = np.flatnonzero(data == 0x20)
    return np.sort(np.concatenate((base, space + 1))), np.sort(np.concatenate((space, base[1:], [len(data)])))


class _Finish:
    types = {"n_words": pa.int64(), "n_removed": pa.int64(), "kept": pa.string()}

    def __call__(self, data: bytes, starts: np.ndarray, ends: np.ndarray) -> dict:
        words = data.split()  # at the bytes of GAP
        keep = np.ones(len(words), dtype=bool)
        for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
            keep[a:b] = False
        kept = b" ".join(compress(words, keep.tolist()) if len(starts) else words)
        return {"n_words": len(words), "n_removed": int(len(words) - keep.sum()), "kept": kept.decode()}


def substring_dedup(docs: DataFrame, width: int = 13) -> DataFrame:
    """Remove every word covered by a `width`-word sequence that also starts in an earlier document.

    Earlier: with a smaller doc_id; windows are judged on the input.  Words are
    `[^\\x20\\x09-\\x0D]+`, unchanged.  Returns one row per row of `docs`: doc_id,
    n_words, n_removed, kept (the kept words joined by one space).

    Null or empty text: no words.  Fewer than `width` words: nothing removed.  Null
    doc_id: later than all other ids and equal to other nulls, so it never makes
    others repeats.  Rows that repeat an id are the same document: they do not
    remove each other.  Other columns of `docs` are ignored.
    """
    if width < MER:
        raise ValueError(f"width must be at least {MER}")
    rows = keyed(docs)
    spans, n_origins = repeated_spans(rows, _pieces(width), _cut(width), _repeats(width), WINDOWS_PER_BUCKET)
    return apply_spans(rows, spans, n_origins, width, _Finish(), "doc_id long, n_words long, n_removed long, kept string")
