"""Deterministic sharded WARC archives.

`write_warc` range-sorts records by an integer key into shards of about equal bytes, rolls each shard into
files by compressed size, regenerates the WARC headers and digests, and commits every file by renaming a
temporary name; a manifest table and a marker file end the commit. `read_warc` parses the archives of a
manifest back into rows. The same input gives the same files, byte for byte, wherever its tasks run.

Shards come from a histogram of key ranges that is refined until no range is too heavy, so their bounds follow from the
data alone. Only narrow rows (key and digest) are grouped to find equal payloads; each html crosses the network once.

Defined results: a null html is an empty payload, a null key sorts first and has no key header, a null url is written as
`urn:none`; of rows repeated with one key and payload the first is a response and the others revisit it. An empty table
gives an empty manifest. Other columns of the input are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, map_batches, new_path

_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
_NS = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
MANIFEST = "shard int, seq int, file string, n_records long, first_key long, last_key long, bytes long, sha1 string"
RECORD = (
    "record_key long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, record_id string, file string"
)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _id(key: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NS, f'{key}/{digest}')}>"


def _clean(url: str | None) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url) if url else "urn:none"


def _record(key, url, payload: bytes, digest: str, first: int | None, revisit: bool, date: str) -> bytes:
    """One gzip member: header lines, an HTTP head, and the payload unless the record revisits another."""
    head = _HTTP.format(len(payload)).encode()
    block = head if revisit else head + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_id(key, digest)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {_clean(url)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
    ]
    if key is not None:
        lines.append(f"X-Record-Key: {key}")
    if revisit:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: {_id(first, digest)}")
        if first is not None:
            lines.append(f"X-Refers-To-Key: {first}")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return gzip.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n", 6, mtime=0)


class _Store:
    """Files below a folder that all machines share: a mounted path, or what pyarrow's file systems reach."""

    def __init__(self, folder: str):
        if folder.startswith("file:") or "://" not in folder:
            self.fs, self.root = None, "/" + folder.removeprefix("file:").lstrip("/")
        else:
            from pyarrow import fs

            self.fs, self.root = fs.FileSystem.from_uri(folder)

    def put(self, name: str, data: bytes) -> None:
        """Whole under a temporary name, then renamed: a reader sees all of a file or none of it."""
        temp, final = f"{self.root}/_temporary/{name}.{uuid.uuid4().hex}", f"{self.root}/{name}"
        if self.fs is None:
            os.makedirs(os.path.dirname(temp), exist_ok=True)
            with open(temp, "wb") as f:
                f.write(data)
                f.flush()
                os.fsync(f.fileno())
            os.replace(temp, final)
        else:
            self.fs.create_dir(os.path.dirname(temp), recursive=True)
            with self.fs.open_output_stream(temp) as f:
                f.write(data)
            if self.fs.get_file_info(final).type.name != "NotFound":
                self.fs.delete_file(final)
            self.fs.move(temp, final)

    def get(self, name: str) -> bytes:
        if self.fs is None:
            with open(f"{self.root}/{name}", "rb") as f:
                return f.read()
        with self.fs.open_input_stream(f"{self.root}/{name}", compression=None) as f:
            return f.read()


def _bins(first: np.ndarray, last: np.ndarray, steps: np.ndarray):
    """The range (j) that holds a key and the step in it (i), by binary search; -1 outside all of them."""

    @F.pandas_udf("struct<j int, i long>")
    def find(keys: pd.Series) -> pd.DataFrame:
        key = keys.to_numpy("int64")
        j = np.searchsorted(first, key, side="right") - 1
        inside = (j >= 0) & (key < last[np.maximum(j, 0)])
        found = pd.DataFrame({"j": j.astype("int32"), "i": (key - first[np.maximum(j, 0)]) // steps[np.maximum(j, 0)]})
        return found.where(pd.Series(inside), -1).astype({"j": "int32", "i": "int64"})

    return find


def _ranges(keyed: DataFrame, shard_bytes: int, bins: int = 4096, rounds: int = 6) -> list[int]:
    """Upper bounds (exclusive) of key ranges of about shard_bytes; every heavy range is cut, in passes of at most `bins` rows to the driver."""
    low, high, total = keyed.agg(F.min("key"), F.max("key"), F.sum("size")).first()
    if low is None or total <= shard_bytes:
        return []
    todo, parts = [(low, high + 1)], []
    for _ in range(rounds):
        got = []
        for at in range(0, len(todo), bins // 2):
            some = todo[at : at + bins // 2]
            per = max(2, bins // len(some))
            spec = []
            for a, b in some:
                step = max(1, -(-(b - a) // per))
                spec.append((a, b, step))
            first, last, steps = (np.asarray(x, dtype=np.int64) for x in zip(*sorted(spec), strict=True))
            counted = keyed.where("key is not null").select(_bins(first, last, steps)(F.col("key")).alias("at"), "size").where("at.j >= 0").groupBy("at").agg(F.sum("size").alias("size")).collect()
            got += [(int(first[r["at"].j]), int(last[r["at"].j]), int(steps[r["at"].j]), r["at"].i, r["size"]) for r in counted]
        todo = []
        for a, b, step, i, size in got:
            x, y = a + i * step, min(b, a + (i + 1) * step)
            if size > shard_bytes // 4 and y - x > 1:
                todo.append((x, y))
            else:
                parts.append((x, y, size))
        if not todo:
            break
    parts += [(a, b, shard_bytes) for a, b in todo]
    bounds, held = [], 0
    for _, y, size in sorted(parts):
        held += size
        if held >= shard_bytes:
            bounds.append(y)
            held = 0
    return bounds


def write_warc(
    df: DataFrame,
    folder: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    shard_bytes: int = 16 << 20,
    roll_bytes: int = 64 << 20,
    min_revisit_bytes: int = 0,
    date: str = "2024-01-01T00:00:00Z",
) -> DataFrame:
    """Write one record per row below `folder` and return its manifest, one row per file.

    shard_bytes: payload bytes of a shard, the unit of work; roll_bytes: compressed size at which a file of a
    shard is closed and the next begun. Payloads of at least min_revisit_bytes are written once.
    """
    spark = df.sparkSession
    html = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    page = df.select(F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"), html.alias("payload"))
    size = F.octet_length("payload")
    narrow = cut(page.select("key", F.unhex(F.sha1(F.col("payload").cast("binary"))).alias("digest"), size.cast("long").alias("size")), "warc-digests")
    copied = (
        narrow.where(F.col("size") >= min_revisit_bytes)
        .groupBy("digest")
        .agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
        .select("digest", "first")
    )
    marks = narrow.join(cut(copied, "warc-copied"), "digest").where("key is null or key > first").select("key", "digest", "first").distinct()
    bounds = _ranges(narrow, shard_bytes)
    edges = np.asarray(bounds, dtype=np.int64)

    @F.pandas_udf("int")
    def place(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, keys.fillna(-(2**63)).to_numpy("int64"), side="right").astype("int32"))

    shard = place(F.col("key"))
    null = lambda kind: F.lit(None).cast(kind)
    rows = page.select(shard.alias("shard"), "key", F.lit(1).alias("kind"), "url", "payload", null("binary").alias("digest"), null("long").alias("first"))
    noted = marks.select(shard.alias("shard"), "key", F.lit(0).alias("kind"), null("string").alias("url"), null("string").alias("payload"), "digest", "first")
    dealt = rows.unionByName(noted).repartitionById(len(bounds) + 1, F.col("shard").cast("int")).sortWithinPartitions("shard", "key", "kind", "url", "payload")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = _Store(folder)
        at, seq, held, names, notes, seen = None, 0, io.BytesIO(), [], {}, set()
        n, first_key, last_key = 0, None, None

        def close():
            nonlocal seq, held, n, first_key, last_key
            data, name = held.getvalue(), f"shard-{at:06d}-{seq:05d}.warc.gz"
            store.put(name, data)
            names.append((at, seq, name, n, first_key, last_key, len(data), hashlib.sha1(data).hexdigest()))
            seq, held, n, first_key, last_key = seq + 1, io.BytesIO(), 0, None, None

        for batch in batches:
            columns = [batch.column(i) for i in range(7)]
            for i in range(batch.num_rows):
                where, key_, kind, url_, body, digest, first = (c[i].as_py() for c in columns)
                if where != at:
                    if n:
                        close()
                    at, seq, notes, seen = where, 0, {}, set()
                if kind == 0:
                    if notes and next(iter(notes))[0] != key_:
                        notes = {}
                    notes[key_, digest] = first
                    continue
                body = body.encode()
                raw = hashlib.sha1(body).digest()
                if seen and next(iter(seen))[0] != key_:
                    seen = set()
                original = notes.get((key_, raw))
                again = (key_, raw) in seen and len(body) >= min_revisit_bytes
                revisit = again or original is not None
                refers = key_ if original is None else original
                seen.add((key_, raw))
                held.write(_record(key_, url_, body, base64.b32encode(raw).decode(), refers if revisit else None, revisit, date))
                n, last_key = n + 1, key_
                first_key = key_ if first_key is None else first_key
                if held.tell() >= roll_bytes:
                    close()
        if n:
            close()
        if names:
            columns = list(zip(*names, strict=True))
            kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["shard", "seq", "file", "n_records", "first_key", "last_key", "bytes", "sha1"])

    manifest = f"{folder}/manifest"
    dealt.transform(map_batches, write, MANIFEST).write.parquet(manifest)
    return spark.read.schema(MANIFEST).parquet(manifest)


def _records(data: bytes) -> Iterator[tuple[dict, bytes]]:
    """Header fields and block of each gzip member."""
    while data:
        z = zlib.decompressobj(31)
        text = z.decompress(data) + z.flush()
        data = z.unused_data
        head, _, rest = text.partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        yield fields, rest[: int(fields["Content-Length"])]


def read_warc(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """The records of the archives that the manifest below `folder` names; a task reads whole files.

    A revisit's payload is null; its bytes and digest are those that its headers give. Digests of responses are
    taken again from what was read, and a file or record that doesn't match its digest is an error.
    """
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").select("file", "sha1")
    files = manifest.count()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = _Store(folder)
        names = ["record_key", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "file"]
        kinds = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]

        def flush(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            for name, sha1 in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data, rows = store.get(name), []
                if hashlib.sha1(data).hexdigest() != sha1:
                    raise ValueError(f"{name} isn't what the manifest names")
                for f, block in _records(data):
                    if f["WARC-Block-Digest"] != f"sha1:{base32_sha1(block)}":
                        raise ValueError(f"{name}: a block doesn't match its digest")
                    http, _, body = block.partition(b"\r\n\r\n")
                    revisit = f["WARC-Type"] == "revisit"
                    length = int(http.rpartition(b"Content-Length: ")[2]) if revisit else len(body)
                    digest = f["WARC-Payload-Digest"].removeprefix("sha1:") if revisit else base32_sha1(body)
                    number = lambda k, f=f: int(f[k]) if k in f else None
                    rows.append((number("X-Record-Key"), f["WARC-Target-URI"], None if revisit or not with_payload else body, length, digest, f["WARC-Type"], number("X-Refers-To-Key"), f["WARC-Record-ID"], name))
                    if len(rows) >= 500:
                        yield flush(rows)
                        rows = []
                if rows:
                    yield flush(rows)

    return manifest.repartition(max(1, files)).transform(map_batches, read, RECORD)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "warc")
    write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"), folder)
    return read_warc(spark, folder, with_payload=False).select(
        F.col("record_key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


_HEX = "sha1(coalesce(html, ''))"
#: DuckDB has no base32 of bytes: 32 groups of five bits of the digest's hexadecimal digits pick the letters.
OP1_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body, {_HEX} AS hex FROM pages),
bits AS (
  SELECT page_id, body, hex,
         list_aggregate(list_transform(generate_series(1, 40), lambda i: printf('%04d', CAST(bin(instr('0123456789abcdef', hex[i]) - 1) AS INTEGER))), 'string_agg', '') AS b
  FROM p),
d AS (
  SELECT page_id, body,
         list_aggregate(list_transform(generate_series(0, 31), lambda g: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
           1 + 16 * CAST(b[5 * g + 1] AS INTEGER) + 8 * CAST(b[5 * g + 2] AS INTEGER) + 4 * CAST(b[5 * g + 3] AS INTEGER)
             + 2 * CAST(b[5 * g + 4] AS INTEGER) + CAST(b[5 * g + 5] AS INTEGER)]), 'string_agg', '') AS digest
  FROM bits)
SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = min(page_id) OVER (PARTITION BY digest) THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = min(page_id) OVER (PARTITION BY digest) THEN NULL ELSE min(page_id) OVER (PARTITION BY digest) END AS refers_to
FROM d
"""
QUERIES = {"op1_warc": op1_warc}
ORACLES = {"op1_warc": OP1_SQL}
