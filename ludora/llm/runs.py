"""Runs of consecutive windows, shipped to buckets by content.

Both repeated-window operators (words: `substring`, bytes: `suffix`) need equal
windows of different documents to meet in one task without sending every
window.  Consecutive windows whose smallest m-mer (minimiser) is the same travel
as one packed string to the bucket of that minimiser: the minimiser depends on
the window's content only, so equal windows always meet.

* Frequent m-mers come last in the order, so that a common phrase does not draw
  all windows around it into one bucket.
* Inside a task, a run whose packed string was already seen in a document with a
  smaller id needs no trip: all its windows are repeats.  A passage in a third
  of all documents therefore sends a row per task, not per document.
* A task sends one compressed row per bucket and flush, not one per run.
* A document is known by (id, 64-bit hash of its text), so that rows that
  repeat an id with another text keep their own result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludora.llm.common import NO_ID, binary_values, long_values, materialise, mix64, release, text_of

#: An m-mer that leads more than this share of all runs counts as frequent; at most as many exist.
FREQUENT_SHARE = 1 << 16
#: Bytes of packed runs that a task holds before it sends them.
FLUSH_BYTES = 32 << 20
#: Bytes of text that numpy works on at a time.
CHUNK_BYTES = 1 << 18
#: Bytes of text that the last step holds at a time (documents of one origin).
ORIGIN_BYTES = 8 << 20

ROW = "bucket long, packed binary, meta binary"
SPANS = "origin long, spans binary"
_META = (("over", "<u4"), ("doc", "<i8"), ("key", "<i8"), ("start", "<i8"), ("count", "<u4"))  # over: bytes above one per window
_SPAN = (("doc", "<i8"), ("key", "<i8"), ("start", "<i8"), ("count", "<u4"))


@dataclass
class Piece:
    """Part of a document: its row in the batch, its first unit's place, its bytes."""

    row: int
    offset: int
    data: bytes


@dataclass
class Segments:
    """Runs of a chunk: slices of `data`, and the minimiser, piece, place and windows of each."""

    data: bytes
    first: np.ndarray
    last: np.ndarray
    minimiser: np.ndarray
    piece: np.ndarray
    start: np.ndarray
    count: np.ndarray


#: pieces_of(document bytes) -> (offset, bytes); segments_of(pieces, order) -> Segments, units
Pieces = Callable[[bytes], Iterator[tuple[int, bytes]]]
Cut = Callable[[list[Piece], "Order"], tuple[Segments, int]]


class Order:
    """Order of the m-mers: by hash, frequent ones after all others."""

    def __init__(self, frequent: list[int]):
        self.frequent = np.sort(np.array(frequent, dtype=np.uint64))
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[self.frequent >> np.uint64(43)] = True

    def rank(self, hashes: np.ndarray) -> np.ndarray:
        rank = hashes >> np.uint64(1)
        if len(self.frequent):
            near = np.flatnonzero(self.maybe[rank >> np.uint64(43)])
            there = np.searchsorted(self.frequent, rank[near])
            hit = near[self.frequent[np.minimum(there, len(self.frequent) - 1)] == rank[near]]
            rank[hit] |= np.uint64(1 << 63)
        return rank


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` consecutive values; one result per full window."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def run_bounds(minimiser: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and length of each run of neighbouring places with one minimiser."""
    if not len(places):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    cut = np.flatnonzero((places[1:] != places[:-1] + 1) | (minimiser[1:] != minimiser[:-1])) + 1
    first = np.concatenate(([0], cut))
    return first, np.diff(np.concatenate((first, [len(places)])))


def _pack(columns, fields) -> bytes:
    """Columns as one compressed block: byte by byte, ids as differences, so that most bytes are alike."""
    raw = []
    for name, kind in fields:
        column = np.asarray(columns[name]).astype(kind)
        column = np.diff(column, prepend=column.dtype.type(0)) if name == "doc" else column
        raw.append(np.ascontiguousarray(column).view(np.uint8).reshape(len(column), -1).T.tobytes())
    return len(columns["doc"]).to_bytes(8, "little") + pa.compress(b"".join(raw), codec="zstd", asbytes=True)


def _unpack(block: bytes, fields) -> dict[str, np.ndarray]:
    n = int.from_bytes(block[:8], "little")
    width = sum(np.dtype(kind).itemsize for _, kind in fields)
    raw = np.frombuffer(pa.decompress(block[8:], decompressed_size=n * width, codec="zstd", asbytes=True), np.uint8) if n else np.zeros(0, np.uint8)
    out, at = {}, 0
    for name, kind in fields:
        size = np.dtype(kind).itemsize
        column = np.ascontiguousarray(raw[at: at + size * n].reshape(size, n).T).view(kind).ravel()
        out[name] = np.cumsum(column) if name == "doc" else column
        at += size * n
    return out


def _chunks(batches, pieces_of: Pieces):
    """Batches as (ids, keys, pieces of about CHUNK_BYTES), documents in the order of their ids."""
    for batch in batches:
        ids = long_values(batch.column("doc_id"), NO_ID)
        keys = long_values(batch.column("key"), 0)
        texts = binary_values(batch.column("text"))
        held, size = [], 0
        for row in np.argsort(ids, kind="stable").tolist():
            for offset, data in pieces_of(texts[row]):
                held.append(Piece(row, offset, data))
                size += len(data)
                if size >= CHUNK_BYTES:
                    yield ids, keys, held
                    held, size = [], 0
        if held:
            yield ids, keys, held


def _count_leaders(pieces_of: Pieces, cut: Cut):
    """Lossy counts of the minimisers of a task's runs, and its numbers of units and bytes."""

    def count(batches):
        order, mers, counts, runs = Order([]), np.zeros(0, np.uint64), np.zeros(0, np.int64), 0
        units = size = 0
        held: list[np.ndarray] = []

        def merge():
            nonlocal mers, counts, held
            one, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *held]), return_counts=True)
            held = []
            mers, place = np.unique(np.concatenate((mers, one)), return_inverse=True)
            counts = np.bincount(place, np.concatenate((counts, n)), minlength=len(mers)).astype(np.int64)
            if len(mers) > 1 << 20:  # what a count can lose here is far below the share asked for
                keep = counts > runs // (16 * FREQUENT_SHARE) + 1
                mers, counts = mers[keep], counts[keep]

        for _, _, pieces in _chunks(batches, pieces_of):
            seg, n = cut(pieces, order)
            units, size, runs = units + n, size + sum(len(p.data) for p in pieces), runs + len(seg.first)
            held.append(seg.minimiser)
            if sum(map(len, held)) > 1 << 20:
                merge()
        merge()
        keep = counts > max(2, runs // (2 * FREQUENT_SHARE))
        yield pa.RecordBatch.from_pydict({"mer": pa.array(mers[keep].view(np.int64)), "n": pa.array(counts[keep])})
        yield pa.RecordBatch.from_pydict({"mer": pa.array([-1, -2, -3]), "n": pa.array([units, size, runs])})

    return count


def _send(pieces_of: Pieces, cut: Cut, frequent: list[int], n_buckets: int, n_origins: int):
    def send(batches):
        order = Order(frequent)
        seen: dict[bytes, int] = {}
        common: dict[bytes, int] = {}  # of frequent m-mers: kept over flushes
        held: list[dict] = []
        packed: list[bytes] = []
        size = 0
        for ids, keys, pieces in _chunks(batches, pieces_of):
            seg, _ = cut(pieces, order)
            rows = np.array([p.row for p in pieces])[seg.piece]
            slices = [seg.data[a:b] for a, b in zip(seg.first.tolist(), seg.last.tolist(), strict=True)]
            often = (seg.minimiser >> np.uint64(63)).astype(bool).tolist()
            doc = ids[rows]
            followers = np.zeros(len(slices), dtype=bool)
            for i, (run, d, hot) in enumerate(zip(slices, doc.tolist(), often, strict=True)):
                known = common if hot else seen
                if (earlier := known.setdefault(run, d)) < d:
                    followers[i] = True
                elif earlier > d:  # an earlier batch showed it in a later document
                    known[run] = d
            if followers.any():
                yield from _span_rows({"doc": doc[followers], "key": keys[rows][followers], "start": seg.start[followers], "count": seg.count[followers]}, n_origins, ROW)
            own = np.flatnonzero(~followers)
            packed += [slices[i] for i in own.tolist()]
            held.append({"bucket": mix64(seg.minimiser[own]) % np.uint64(n_buckets), "over": (seg.last - seg.first - seg.count)[own], "doc": doc[own], "key": keys[rows][own], "start": seg.start[own], "count": seg.count[own]})
            size += int((seg.last - seg.first)[own].sum())
            if size >= FLUSH_BYTES:
                yield from _flush(held, packed)
                held, packed, size, seen = [], [], 0, {}
                if len(common) > 200_000:
                    common = {}
        yield from _flush(held, packed)

    return send


def _flush(held: list[dict], packed: list[bytes]):
    if not packed:
        return
    all_of = {name: np.concatenate([h[name] for h in held]) for name in held[0]}
    order = np.argsort(all_of["bucket"], kind="stable")
    buckets, first = np.unique(all_of["bucket"][order], return_index=True)
    out: dict[str, list] = {"bucket": [], "packed": [], "meta": []}
    codec = pa.Codec("zstd", 3)
    for bucket, rows in zip(buckets.tolist(), np.split(order, first[1:]), strict=True):
        out["bucket"].append(bucket)
        out["packed"].append(codec.compress(b"".join([packed[i] for i in rows.tolist()]), asbytes=True))
        out["meta"].append(_pack({name: all_of[name][rows] for name, _ in _META}, _META))
        if len(out["bucket"]) == 256:
            yield pa.RecordBatch.from_pydict({"bucket": pa.array(out["bucket"], pa.int64()), "packed": pa.array(out["packed"], pa.binary()), "meta": pa.array(out["meta"], pa.binary())})
            out = {"bucket": [], "packed": [], "meta": []}
    if out["bucket"]:
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(out["bucket"], pa.int64()), "packed": pa.array(out["packed"], pa.binary()), "meta": pa.array(out["meta"], pa.binary())})


def _span_rows(spans: dict[str, np.ndarray], n_origins: int, schema: str):
    """Repeated windows as one row per origin (the task that will hold their documents)."""
    origin = (spans["doc"] ^ spans["key"]) % n_origins
    order = np.lexsort((spans["start"], spans["key"], spans["doc"], origin))
    origins, first = np.unique(origin[order], return_index=True)
    blocks = [_pack({name: np.asarray(spans[name])[rows] for name, _ in _SPAN}, _SPAN) for rows in np.split(order, first[1:])] if len(order) else []
    if schema == ROW:  # on the way through the buckets: below zero
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(-1 - origins, pa.int64()), "packed": pa.nulls(len(blocks), pa.binary()), "meta": pa.array(blocks, pa.binary())})
    else:
        yield pa.RecordBatch.from_pydict({"origin": pa.array(origins, pa.int64()), "spans": pa.array(blocks, pa.binary())})


def _match(repeats, n_origins: int):
    """Apply `repeats` to the runs of a bucket; rows that already are spans pass."""

    def match(key, table):
        bucket = key[0].as_py()
        if bucket < 0:
            return pa.table({"origin": pa.array([-1 - bucket] * table.num_rows, pa.int64()), "spans": table.column("meta")})
        metas = [_unpack(x, _META) for x in table.column("meta").to_pylist()]
        data = b"".join(pa.decompress(x, decompressed_size=int(m["over"].sum() + m["count"].sum()), codec="zstd", asbytes=True) for x, m in zip(table.column("packed").to_pylist(), metas, strict=True))
        meta = {name: np.concatenate([m[name] for m in metas]) for name, _ in _META}
        run, at = repeats(data, meta["over"].astype(np.int64) + meta["count"], meta["count"].astype(np.int64), meta["doc"])
        # neighbouring windows of a run become one span
        order = np.lexsort((at, run))
        run, at = run[order], at[order]
        first = np.flatnonzero(np.concatenate(([True], (run[1:] != run[:-1]) | (at[1:] != at[:-1] + 1)))) if len(run) else run
        count = np.diff(np.concatenate((first, [len(run)])))
        spans = {"doc": meta["doc"][run[first]], "key": meta["key"][run[first]], "start": meta["start"][run[first]] + at[first], "count": count}
        return pa.Table.from_batches(_span_rows(spans, n_origins, SPANS))

    return match


def repeated_spans(docs: DataFrame, pieces_of: Pieces, cut: Cut, repeats, windows_per_bucket: int) -> tuple[DataFrame, int]:
    """(spans of windows that a document with a smaller id also has, number of origins)."""
    spark = docs.sparkSession
    narrow = docs.select("doc_id", "text", "key")
    leaders = materialise(narrow.mapInArrow(_count_leaders(pieces_of, cut), "mer long, n long").groupBy("mer").agg(F.sum("n").alias("n")), "leaders")
    total = {r.mer: r.n for r in leaders.where("mer < 0").collect()}
    units, size, runs = (total.get(k) or 0 for k in (-1, -2, -3))
    # fewer than FREQUENT_SHARE rows: their counts add up to at most all runs
    frequent = [r.mer for r in leaders.where((F.col("mer") >= 0) & (F.col("n") > max(64, runs // FREQUENT_SHARE))).select("mer").collect()]
    n_buckets, n_origins = units // windows_per_bucket + 1, size // ORIGIN_BYTES + 1
    sent = narrow.mapInArrow(_send(pieces_of, cut, frequent, n_buckets, n_origins), ROW)
    spans = materialise(sent.groupBy("bucket").applyInArrow(_match(repeats, n_origins), SPANS), "spans")
    release(spark)
    return spans, n_origins


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).withColumn("key", F.xxhash64("text"))


def apply_spans(docs: DataFrame, spans: DataFrame, n_origins: int, width: int, finish, schema: str) -> DataFrame:
    """Call finish(bytes, starts, ends) for each document with its covered unit ranges (sorted, merged)."""
    origin = F.pmod(F.coalesce("doc_id", F.lit(int(NO_ID))).bitwiseXOR(F.col("key")), F.lit(n_origins))

    def close(left, right):
        blocks = [_unpack(x, _SPAN) for x in right.column("spans").to_pylist()]
        ids = long_values(left.column("doc_id").combine_chunks(), NO_ID)
        keys = long_values(left.column("key").combine_chunks(), 0)
        texts = left.column("text").cast(pa.binary())
        found: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        if blocks:
            s = {name: np.concatenate([b[name] for b in blocks]) for name, _ in _SPAN}
            order = np.lexsort((s["start"], s["key"], s["doc"]))
            s = {name: s[name][order] for name in s}
            cuts = np.flatnonzero((s["doc"][1:] != s["doc"][:-1]) | (s["key"][1:] != s["key"][:-1])) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(order)], strict=True):
                starts = s["start"][a:b]
                ends = np.maximum.accumulate(starts + s["count"][a:b].astype(np.int64) - 1 + width)
                new = np.concatenate(([True], starts[1:] > ends[:-1]))
                found[int(s["doc"][a]), int(s["key"][a])] = starts[new], ends[np.concatenate((np.flatnonzero(new)[1:] - 1, [b - a - 1]))]
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        rows = [finish(t.as_py(), *found.get((i, k), none)) for t, i, k in zip(texts, ids.tolist(), keys.tolist(), strict=True)]
        return pa.table({"doc_id": left.column("doc_id"), **{name: pa.array([r[name] for r in rows], kind) for name, kind in finish.types.items()}})

    return docs.withColumn("origin", origin).groupBy("origin").cogroup(spans.groupBy("origin")).applyInArrow(close, schema)
