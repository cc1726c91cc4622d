"""What the training-data operators share: the shared folder, cut tables, word kernels.

The word kernels work on whole Arrow string columns: one pass of NumPy over the bytes of many
documents. A word is a run of bytes other than 0x20 and 0x09-0x0D.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
#: Rows of a narrow table up to which it is broadcast (two longs a row: 64 MB); beyond it joins shuffle.
BROADCAST_ROWS = 4_000_000
SLICE_BYTES = 1_000_000
#: Bytes of an Arrow batch, in the JVM and in the Python worker: rows of long texts come in shorter batches; a longer row stands alone.
BATCH_BYTES = 4_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or, in a local session, a new one where it is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="spark-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/hillframe/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: its lineage ends there and survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether a narrow, already cut table has few enough rows to be broadcast."""
    return df.count() <= rows


def maybe_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    return F.broadcast(df) if small(df, rows) else df


def map_batches(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """mapInArrow with batches of at most BATCH_BYTES, however long the texts are. The session keeps that bound."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    names = df.columns
    if not any(set(c) & {".", "`"} for c in names):
        return df.mapInArrow(work, schema)

    def renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(pa.RecordBatch.from_arrays(b.columns, names=names) for b in batches)

    return df.toDF(*(f"c{i}" for i in range(len(names)))).mapInArrow(renamed, schema)


def labelled_sample(df: DataFrame, key: str, limit: int, seed: str) -> DataFrame:
    """At most `limit` rows in the order of a seeded hash of the key: the same rows in every run."""
    return df.orderBy(F.xxhash64(F.lit(seed), F.col(key)), F.col(key)).limit(limit)


def named(name: str) -> F.Column:
    """A column by its whole name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def columns_of(df: DataFrame) -> list[F.Column]:
    return [named(c) for c in df.columns]


def unused(df: DataFrame, stem: str) -> str:
    """A column name that the table doesn't have."""
    have, name = {c.lower() for c in df.columns}, stem
    while name.lower() in have:
        name += "_"
    return name


def planes(x: np.ndarray) -> bytes:
    """The first bytes of all numbers, then the second ones and so on: what is alike stands together, for the shuffle's compression."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def numbers(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


# ------------------------------------------------------------------ Arrow text

_M64 = (1 << 64) - 1
_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLDED = _BYTE.copy()
_FOLDED[65:91] = _BYTE[97:123]
_R = 0x9E3779B97F4A7C15 | 1
_RI = pow(_R, -1, 1 << 64)
_POW: dict[str, np.ndarray] = {}
_WS = np.zeros(256, dtype=bool)
_WS[[32, 9, 10, 11, 12, 13]] = True


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "r" not in _POW or len(_POW["r"]) < n:
        n = max(n, SLICE_BYTES + 1024)
        with np.errstate(over="ignore"):
            for name, base in (("r", _R), ("i", _RI)):
                p = np.full(n, base, dtype=np.uint64)
                p[0] = 1
                _POW[name] = np.multiply.accumulate(p)
    return _POW["r"], _POW["i"]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective mixer on uint64 (splitmix64's finaliser)."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; a null row has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about `most` bytes; a longer row stands alone."""
    n, a = len(offsets) - 1, 0
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + most, side="right")) - 1
        b = min(n, max(b, a + 1))
        yield a, b
        a = b


class Words:
    """The words of a slice of documents.

    starts, ends: byte ranges; doc: index of the document; pos: index within it; n: words per document. apart: by byte, whether
    it stands between words.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, apart: np.ndarray = _WS):
        docs = len(offsets) - 1
        ws = apart[data]
        first = np.zeros(len(data) + 1, dtype=bool)
        first[offsets] = True
        solid = ~ws
        begin = solid.copy()
        begin[1:] &= ws[:-1] | first[1:-1]
        end = solid
        end[:-1] &= ws[1:] | first[1:-1]
        self.data, self.offsets, self.ws = data, offsets, ws
        self.starts = np.flatnonzero(begin)
        self.ends = np.flatnonzero(end) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.n = np.diff(self.first)
        self.doc = np.repeat(np.arange(docs), self.n)
        self.pos = np.arange(len(self.starts)) - np.repeat(self.first[:-1], self.n)

    def hashes(self, fold: bool = True) -> np.ndarray:
        """A 64-bit hash of each word; with fold, A-Z count as a-z."""
        if not len(self.starts):
            return np.zeros(0, dtype=np.uint64)
        r, ri = _powers(len(self.data) + 1)
        with np.errstate(over="ignore"):
            total = np.zeros(len(self.data) + 1, dtype=np.uint64)
            np.cumsum((_FOLDED if fold else _BYTE)[self.data] * r[: len(self.data)], out=total[1:])
            h = (total[self.ends] - total[self.starts]) * ri[self.starts]
            return mix(h + (self.ends - self.starts).astype(np.uint64))


def shingles(words: Words, h: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, document and word position of every k-word window; a shorter document is one window."""
    n = len(h)
    out_h, out_d, out_p = [], [], []
    weights = [pow(0xD6E8FEB86659FD93, j + 1, 1 << 64) for j in range(k)]
    with np.errstate(over="ignore"):
        if n >= k:
            s = np.zeros(n - k + 1, dtype=np.uint64)
            for j in range(k):
                s += h[j : n - k + 1 + j] * np.uint64(weights[j])
            whole = words.doc[: n - k + 1] == words.doc[k - 1 :]
            out_h.append(mix(s[whole]))
            out_d.append(words.doc[: n - k + 1][whole])
            out_p.append(words.pos[: n - k + 1][whole])
        for m in range(1, k):
            docs = np.flatnonzero(words.n == m)
            if len(docs):
                s = np.full(len(docs), m, dtype=np.uint64)
                for j in range(m):
                    s += h[words.first[docs] + j] * np.uint64(weights[j])
                out_h.append(mix(s * np.uint64(0x9FB21C651E98DF25)))
                out_d.append(docs)
                out_p.append(np.zeros(len(docs), dtype=np.int64))
    if not out_h:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(out_h), np.concatenate(out_d), np.concatenate(out_p)


def order_by(major: np.ndarray, minor: np.ndarray | None = None) -> np.ndarray:
    """The order by a small integer, then by a uint64 (or, without one, as the rows stand)."""
    major = major.astype(np.uint16 if major.max(initial=0) < 65536 else np.int64)  # 16 bits are sorted by radix
    if minor is None:
        return np.argsort(major, kind="stable")
    first = np.argsort(minor)
    return first[np.argsort(major[first], kind="stable")]


def distinct(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (document, hash) pairs, in that order."""
    order = order_by(doc, h)
    doc, h = doc[order], h[order]
    if len(h):
        keep = np.ones(len(h), dtype=bool)
        keep[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
        doc, h = doc[keep], h[keep]
    return doc, h


def signed(h: np.ndarray) -> pa.Array:
    """uint64 as a Spark long."""
    return pa.array(np.ascontiguousarray(h).view(np.int64))


def n_words(text: str = "text"):
    """Words of a text as a Spark expression; 0 for null."""
    return F.coalesce(F.expr(rf"regexp_count({text}, '[^\\x20\\x09-\\x0D]+')"), F.lit(0)).cast("long")
