"""Operator 1: deterministic sharded WARC writer, and its reader.

Records are range-sorted by key into shards; a shard's writer streams its sorted
records, starts a new file before the compressed size would pass the limit, and
regenerates headers and digests.  Split points are quantiles of the rows whose
keys have the smallest hashes, so they depend on the rows only, and a rerun gives the
same bytes.  Files are written under temporary names; only the names that a finished
job recorded in the manifest are then moved to their final names, so attempts
of lost executors leave nothing behind under a final name.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import posixpath
import re
import uuid
from urllib.parse import quote, unquote

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from ludora.llm.common import materialise

#: Sampled keys per shard, for the split points.
SAMPLES = 64
MANIFEST = "shard int, part int, name string, temporary string, records long, size long, sha256 string, first_key long, last_key long"
RECORDS = "key long, uri string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"
_DATE = "1970-01-01T00:00:00Z"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(key: int | None, digest: str, again: int = 0) -> str:
    return f"<urn:record:{'null' if key is None else key}:{digest}{f':{again}' if again else ''}>"


def _record(kind: str, key: int | None, uri: str | None, payload: bytes, refers_to: int | None, again: int) -> bytes:
    digest = payload_digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    head = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", _record_id(key, digest, again)),
        ("WARC-Date", _DATE),
        ("WARC-Target-URI", quote(uri or "", safe="%:/?#[]@!$&'()*+,;=~")),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{payload_digest(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if kind == "revisit":
        head[5:5] = [("WARC-Refers-To", _record_id(refers_to, digest)), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    return b"WARC/1.1\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in head) + b"\r\n" + block + b"\r\n\r\n"


class _Files:
    """The open file of a shard: rolled by compressed size, closed into a manifest row."""

    def __init__(self, base: str, limit: int):
        self.fs, self.root = pafs.FileSystem.from_uri(base)
        self.limit, self.out, self.row, self.rows = limit, None, {}, []
        self.attempt = uuid.uuid4().hex

    def add(self, shard: int, key: int | None, record: bytes) -> None:
        data = gzip.compress(record, 6, mtime=0)
        if self.out and (shard != self.row["shard"] or self.row["size"] + len(data) > self.limit):
            part = self.row["part"] + 1 if shard == self.row["shard"] else 0
            self.close()
            self._open(shard, part, key)
        elif not self.out:
            self._open(shard, 0, key)
        self._write(data)
        self.row |= {"records": self.row["records"] + 1, "last_key": key}

    def _open(self, shard: int, part: int, key: int | None) -> None:
        name = f"shard-{shard:08d}-{part:06d}.warc.gz"
        temporary = f"_temporary/{self.attempt}-{name}.open"
        self.fs.create_dir(posixpath.join(self.root, "_temporary"), recursive=True)
        self.out, self.sha = self.fs.open_output_stream(posixpath.join(self.root, temporary)), hashlib.sha256()
        self.row = {"shard": shard, "part": part, "name": name, "temporary": temporary, "records": 0, "size": 0, "first_key": key, "last_key": key}
        info = b"software: deterministic sharded writer\r\nformat: WARC File Format 1.1\r\n"
        head = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:file:{name}>\r\nWARC-Date: {_DATE}\r\nWARC-Filename: {name}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(info)}\r\n\r\n"
        self._write(gzip.compress(head.encode() + info + b"\r\n\r\n", 6, mtime=0))

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.sha.update(data)
        self.row["size"] += len(data)

    def close(self) -> None:
        if self.out:
            self.out.close()
            self.rows.append(self.row | {"sha256": self.sha.hexdigest()})
            self.out = None


def _batch(rows: list[dict], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_pydict({n: pa.array([r[n] for r in rows], kinds[k]) for n, k in fields})


def _writer(base: str, limit: int):
    def write(batches):
        files = _Files(base, limit)
        decision, again, last = None, 0, None
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("shard", "key", "digest", "refers_to", "uri", "payload"))
            for shard, key, digest, refers_to, uri, payload in zip(*columns, strict=True):
                if payload is None:  # a decision stands before the records it is for
                    decision = (shard, key, digest), refers_to
                    continue
                again, last = (again + 1 if (key, digest) == last else 0), (key, digest)
                revisit = decision is not None and decision[0] == (shard, key, digest)
                files.add(shard, key, _record("revisit" if revisit else "response", key, uri, payload, decision[1] if revisit else None, again))
            if files.rows:
                yield _batch(files.rows, MANIFEST)
                files.rows = []
        files.close()
        yield _batch(files.rows, MANIFEST)

    return write


def _mover(base: str):
    def move(batches):
        fs, root = pafs.FileSystem.from_uri(base)
        for batch in batches:
            for name, temporary, size in zip(*(batch.column(c).to_pylist() for c in ("name", "temporary", "size")), strict=True):
                there, wanted = posixpath.join(root, temporary), posixpath.join(root, name)
                if fs.get_file_info(there).type != pafs.FileType.NotFound:
                    fs.move(there, wanted)
                elif fs.get_file_info(wanted).size != size:  # else an earlier attempt has moved it
                    raise OSError(f"{wanted}: neither the temporary nor the finished file is there")
            yield batch

    return move


def _shard_of(key: Column, points: list[int]) -> Column:
    edges = np.array(points, dtype=np.int64)

    @pandas_udf("int")
    def shard(keys):
        return pd.Series(np.searchsorted(edges, keys.to_numpy(), side="right").astype(np.int32))

    return shard(F.coalesce(key, F.lit(-(1 << 63))))


def write_warc(rows: DataFrame, path: str, key: str, uri: str, payload: str, shard_bytes: int = 1 << 30, file_bytes: int = 1 << 28, min_revisit_bytes: int = 0) -> DataFrame:
    """Write one record per row of `rows` under `path` (new or empty, shared); returns the manifest.

    The record's payload is the text of `payload` in UTF-8 (null: empty).  Of the
    rows with equal payloads of at least `min_revisit_bytes` bytes, the one with
    the largest key is a response and the others are revisits that refer to it;
    shorter payloads are all responses.

    Ties: rows that repeat the largest key with the same payload are all responses;
    a null key is smaller than any other, and rows of a group without any key are all
    responses.  Null addresses are written empty, characters that a header cannot
    hold percent-encoded.  An empty table gives an empty manifest.  Other
    columns are ignored.  Payloads are equal if their SHA-256 and lengths are.
    """
    spark = rows.sparkSession
    body = F.encode(F.coalesce(F.col(payload).cast("string"), F.lit("")), "UTF-8")
    rows = rows.select(F.col(key).cast("long").alias("key"), F.col(uri).cast("string").alias("uri"), body.alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("payload", 256)))
    narrow = materialise(rows.select("key", "digest", F.octet_length("payload").cast("long").alias("size")), "payloads")
    groups = narrow.where(F.col("size") >= min_revisit_bytes).groupBy("digest", "size").agg(F.max("key").alias("refers_to"), F.count("*").alias("n"))
    last = materialise(groups.where("n > 1 and refers_to is not null"), "groups")  # written, so that a hot digest's join can be split
    decisions = narrow.join(last, ["digest", "size"]).where(~F.col("key").eqNullSafe(F.col("refers_to"))).select("key", "digest", "refers_to").distinct()
    total = narrow.agg(F.sum("size")).first()[0] or 0
    n_shards = total // shard_bytes + 1
    points: list[int] = []
    if n_shards > 1:  # the rows with the smallest hashes are the same sample however the rows are dealt
        sample = sorted((r.key, r.size) for r in narrow.where("key is not null").select("key", "size").orderBy(F.xxhash64("key"), "key", "size").limit(SAMPLES * n_shards).collect())
        weight = np.cumsum([s + 1 for _, s in sample])
        places = np.searchsorted(weight, weight[-1] * np.arange(1, n_shards) / n_shards) if sample else []
        points = sorted({sample[p][0] for p in places})
    both = rows.select("key", "digest", F.lit(None).cast("long").alias("refers_to"), "uri", "payload").unionByName(
        decisions.select("key", "digest", "refers_to", F.lit(None).cast("string").alias("uri"), F.lit(None).cast("binary").alias("payload")))
    dealt = both.withColumn("shard", _shard_of(F.col("key"), points)).repartition("shard")
    dealt = dealt.sortWithinPartitions("shard", F.col("key").asc_nulls_first(), "digest", F.col("payload").isNotNull(), "uri")
    written = materialise(dealt.mapInArrow(_writer(path, file_bytes), MANIFEST), "manifest")
    n = written.count()
    moved = written.repartition(max(1, n), "name").mapInArrow(_mover(path), MANIFEST)
    final = f"{path.rstrip('/')}/_manifest"
    moved.coalesce(max(1, n // 10_000)).write.parquet(final)
    fs, root = pafs.FileSystem.from_uri(path)
    if fs.get_file_info(posixpath.join(root, "_temporary")).type != pafs.FileType.NotFound:
        fs.delete_dir(posixpath.join(root, "_temporary"))  # what lost attempts wrote
    return spark.read.schema(MANIFEST).parquet(final)


def _parse(stream):
    """Records of a gzip stream as (headers, block)."""
    while line := stream.readline():
        if line.strip() == b"":
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a record: {line[:60]!r}")
        head = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode().partition(":")
            head[name.strip().lower()] = value.strip()
        yield head, stream.read(int(head["content-length"]))


def _key_of(record_id: str) -> int | None:
    key = re.match(r"<urn:record:(-?\d+|null):", record_id)[1]
    return None if key == "null" else int(key)


def _reader(base: str):
    def read(batches):
        fs, root = pafs.FileSystem.from_uri(base)
        for batch in batches:
            for name in batch.column("name").to_pylist():
                rows, size = [], 0
                with fs.open_input_stream(posixpath.join(root, name), compression=None) as raw, gzip.GzipFile(fileobj=raw) as stream:
                    for head, block in _parse(stream):
                        kind = head["warc-type"]
                        if kind == "warcinfo":
                            continue
                        http, _, payload = block.partition(b"\r\n\r\n")
                        digest = head["warc-payload-digest"].removeprefix("sha1:")
                        if head["warc-block-digest"] != f"sha1:{payload_digest(block)}" or kind == "response" and payload_digest(payload) != digest:
                            raise ValueError(f"{name}: {head['warc-record-id']} does not have its digest")
                        length = int(re.search(rb"(?i)\r\ncontent-length: *(\d+)", http)[1])
                        rows.append({"key": _key_of(head["warc-record-id"]), "uri": unquote(head["warc-target-uri"]), "payload": payload if kind == "response" else None, "payload_bytes": length, "payload_digest": digest, "record_type": kind, "refers_to": _key_of(head["warc-refers-to"]) if kind == "revisit" else None})
                        size += len(block)
                        if size > 8 << 20:
                            yield _batch(rows, RECORDS)
                            rows, size = [], 0
                yield _batch(rows, RECORDS)

    return read


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of the archives that the manifest under `path` names, digests checked: key, uri, payload (null for revisits), payload_bytes, payload_digest, record_type, refers_to."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{path.rstrip('/')}/_manifest")
    return manifest.select("name").repartition(max(1, manifest.count()), "name").mapInArrow(_reader(path), RECORDS)
