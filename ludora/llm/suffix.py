"""Operator 5: repeated byte strings by a depth-limited radix sort of suffixes.

Equal groups of suffixes, ordered only through `width` bytes, are exactly the
repeated windows.  Runs of neighbouring suffixes travel together (see `runs`);
in each bucket a first pass deals the suffixes by a hash of three of their digits,
then passes go from the most significant digit of eight bytes to the last within
`width`.  A suffix that is alone in its group leaves the sort, and a group whose
members agree in a digit needs no sorting in that pass.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ludora.llm.common import mix64
from ludora.llm.runs import CHUNK_BYTES, Order, Piece, Segments, apply_spans, keyed, repeated_spans, run_bounds, sliding_min

#: Bytes of an m-mer.
MER = 8
WINDOWS_PER_BUCKET = 1_500_000


def _loads(data: bytes) -> np.ndarray:
    """The eight bytes at each place as a number (of reversed byte order: see `byteswap` where the order counts)."""
    n = -(-len(data) // 8)
    padded = data + bytes(8 * n + 8 - len(data))
    out = np.empty((n, 8), np.uint64)
    for k in range(8):
        out[:, k] = np.frombuffer(padded, "<u8", n, k)
    return out.ravel()[: len(data)]


def _digit_places(width: int) -> list[int]:
    """Offsets of eight-byte digits that cover `width` bytes; the last may overlap."""
    return [*range(0, width - 8, 8), width - 8]


def _pieces(width: int):
    def pieces(data: bytes):
        for at in range(0, max(1, len(data) - width + 1), CHUNK_BYTES):
            yield at, data[at: at + CHUNK_BYTES + width - 1]

    return pieces


def _cut(width: int):
    def cut(pieces: list[Piece], order: Order) -> tuple[Segments, int]:
        data = b"".join(p.data for p in pieces)
        sizes = np.array([len(p.data) for p in pieces])
        base = np.cumsum(sizes) - sizes
        windows = np.maximum(sizes - width + 1, 0)
        total = int(windows.sum())
        place = np.repeat(base - (np.cumsum(windows) - windows), windows) + np.arange(total)
        if not total:
            none = np.zeros(0, np.int64)
            return Segments(data, none, none, none.astype(np.uint64), none, none, none), 0
        least = sliding_min(order.rank(mix64(_loads(data)[: len(data) - MER + 1])), width - MER + 1)[place]
        first, count = run_bounds(least, place)
        piece = np.repeat(np.arange(len(pieces)), windows)[first]
        at = place[first]
        offset = np.array([p.offset for p in pieces])
        return Segments(data, at, at + count + width - 1, least[first], piece, at - base[piece] + offset[piece], count), total

    return cut


def _repeats(width: int):
    probes = (0, (width - 8) // 2, width - 8)

    def repeats(data: bytes, sizes: np.ndarray, counts: np.ndarray, docs: np.ndarray):
        """(run, window in it) of each window that also starts in a document with a smaller id."""
        load = _loads(data)
        base = np.cumsum(sizes) - sizes
        before = np.cumsum(counts) - counts
        n = int(counts.sum())
        place = np.repeat((base - before).astype(np.int32), counts) + np.arange(n, dtype=np.int32)
        # the first pass deals by a hash of three digits: what is alone then cannot be repeated
        digest = np.zeros(n, np.uint64)
        for at in probes:
            digest = (digest + load[place + np.int32(at)]) * np.uint64(0x9FB21C651E98DF25)
            digest ^= digest >> np.uint64(29)
        digest *= np.uint64(0xA24BAED4963EE407)
        ordered = np.sort(digest)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        maybe = np.zeros(1 << 22, dtype=bool)
        maybe[twice >> np.uint64(42)] = True
        window = np.flatnonzero(maybe[digest >> np.uint64(42)])
        digest = digest[window]
        order = np.argsort(digest)
        window, group = window[order], np.cumsum(np.diff(digest[order], prepend=digest[order][:1]) != 0)
        del digest, ordered, twice
        for at in _digit_places(width):
            digit = load[place[window] + np.int32(at)]
            if len(window) and (differs := np.flatnonzero((group[1:] == group[:-1]) & (digit[1:] != digit[:-1]))).size:
                todo = np.flatnonzero(np.isin(group, group[differs]))
                moved = todo[np.lexsort((digit[todo].byteswap(), group[todo]))]
                window[todo], digit[todo] = window[moved], digit[moved]  # groups keep their places
            new = np.ones(len(window), dtype=bool)
            new[1:] = (group[1:] != group[:-1]) | (digit[1:] != digit[:-1])
            alone = new.copy()
            alone[:-1] &= new[1:]
            if alone.any():
                window, new = window[~alone], new[~alone]
            group = np.cumsum(new)
        if not len(window):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        run = np.repeat(np.arange(len(sizes), dtype=np.int32), counts)[window]
        starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        least = np.repeat(np.minimum.reduceat(docs[run], starts), np.diff(np.concatenate((starts, [len(group)]))))
        late = docs[run] > least
        return run[late].astype(np.int64), (window - before[run])[late]

    return repeats


class _Finish:
    types = {"n_bytes": pa.int64(), "n_removed": pa.int64(), "spans": pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), "kept": pa.binary()}

    def __call__(self, data: bytes, starts: np.ndarray, ends: np.ndarray) -> dict:
        # runs that touch without overlapping are one maximal removed run
        if len(starts):
            new = np.concatenate(([True], starts[1:] > ends[:-1]))
            starts, ends = starts[new], ends[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(ends) - 1]))]
        a, b = starts.tolist(), ends.tolist()
        kept = b"".join(data[x:y] for x, y in zip([0, *b], [*a, len(data)], strict=True))
        return {"n_bytes": len(data), "n_removed": len(data) - len(kept), "spans": [{"start": x, "end": y} for x, y in zip(a, b, strict=True)], "kept": kept}


def suffix_dedup(docs: DataFrame, width: int = 50) -> DataFrame:
    """Remove every byte covered by a `width`-byte string that also starts in an earlier document.

    Earlier: with a smaller doc_id; windows are judged on the input.  Returns one
    row per row of `docs`: doc_id, n_bytes, n_removed, spans (maximal removed byte
    ranges, end exclusive), kept (the remaining bytes).

    Null or empty text: zero bytes, nothing removed.  Null doc_id: later than all
    other ids and equal to other nulls, so it never makes others repeats.  Rows
    that repeat an id are the same document: they do not remove each other.  Other
    columns of `docs` are ignored.  `width` must be at least 20.
    """
    if width < MER + 8:
        raise ValueError(f"width must be at least {MER + 8}")
    rows = keyed(docs)
    spans, n_origins = repeated_spans(rows, _pieces(width), _cut(width), _repeats(width), WINDOWS_PER_BUCKET)
    return apply_spans(rows, spans, n_origins, width, _Finish(), "doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary")
