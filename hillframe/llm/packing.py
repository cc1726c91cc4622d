"""Best-fit packing by patterns: non-negative least squares over the length histogram.

A document is its token ids and an end id; only one longer than a sequence is cut, into whole sequences and one shorter first
piece. The histogram of piece lengths (one row per length, never one per piece) goes to the driver. Patterns of one, two or
three lengths that fill a sequence exactly are enumerated, their repeat counts are fitted to the histogram by non-negative
least squares (accelerated projected gradients), and rounded down, never above what is left of a length. What no pattern takes is packed by best fit decreasing on counts: the longest pieces go to the fullest sequences
that still hold them. The result is a plan: for ranges of ranks within a length, the sequence and the place in it.

Ranks are dealt in Spark: pieces are counted by (length, hash bucket), the counts are summed before each bucket, and a row
number inside its bucket places a piece, so a length that a third of all pieces have spreads over the buckets.

Defined results: a null or empty text is only the end id; rows that repeat are documents of their own; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import bisect
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, map_batches, named

PIECE = "doc_id long, piece int, start long, length int, ids_crc32 long"
#: How a byte-level pre-tokenizer cuts a text (a fixed value of that format).
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_ranks(data: dict) -> dict[bytes, int] | None:
    """The tokens of a byte-level `tokenizers` file with their ids, where an id is also the rank of its merge; else None."""
    model, pre = data["model"], data.get("pre_tokenizer") or {}
    plain = model.get("type") == "BPE" and not data.get("normalizer") and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    if not plain or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
        return None
    printed = [*range(33, 127), *range(161, 173), *range(174, 256)]  # these bytes stand for themselves, the others for 256, 257, ...
    letters = {chr(b): b for b in printed} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(printed))}
    ranks = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items()}
    single = sum(len(t) == 1 for t in ranks)
    pairs = ("".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"])
    return ranks if single == 256 and all(model["vocab"].get(p) == 256 + i for i, p in enumerate(pairs)) and len(ranks) == 256 + len(model["merges"]) else None


class Coder:
    """Token ids of whole texts, little-endian, as `tokenizers` gives them for this file.

    Where the file's ids are the ranks of its merges, tiktoken merges by these ranks: the same ids in a third of the time. Texts
    that hold an added token, and other files, are left to `tokenizers`.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        ranks = byte_ranks(data)
        self.added = tuple(t["content"] for t in data.get("added_tokens", ()))
        self.tokenizer = Tokenizer.from_file(path)
        self.ranked = tiktoken.Encoding("file", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={}).encode_ordinary if ranks else None

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if self.ranked is None or any(t in text for t in self.added):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            ids = self.ranked(text)
        return np.array(ids, dtype="<u4").tobytes()


_CODERS: dict[str, Coder] = {}


def coder(path: str) -> Coder:
    """One tokenizer per worker process, kept from task to task."""
    if path not in _CODERS:
        _CODERS[path] = Coder(path)
    return _CODERS[path]


def token_pieces(df: DataFrame, tokenizer_path: str, max_tokens: int, end_id: int, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length and the CRC-32 of its ids as unsigned 32-bit little-endian."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end, step = coder(tokenizer_path), np.asarray([end_id], dtype="<u4").tobytes(), 4 * max_tokens
        for batch in batches:
            sizes, sums = np.zeros(batch.num_rows, dtype=np.int64), []
            for i, value in enumerate(batch.column(1)):
                ids = words.encode(value.as_py() or "") + end
                sizes[i] = len(ids) // 4
                first = len(ids) % step or step
                sums.append(zlib.crc32(ids[:first]))
                sums += [zlib.crc32(ids[at : at + step]) for at in range(first, len(ids), step)]
            count = -(-sizes // max_tokens)
            row = np.repeat(np.arange(batch.num_rows), count)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            head = ((sizes - 1) % max_tokens + 1)[row]  # the first piece takes what doesn't fill a sequence
            start = np.where(piece == 0, 0, head + (piece - 1) * max_tokens)
            length = np.where(piece == 0, head, max_tokens)
            columns = [batch.column(0).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length, pa.int32()), pa.array(sums, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return df.select(named(id_col).cast("long").alias("doc_id"), named(text).cast("string").alias("text")).transform(map_batches, pieces, PIECE)


def exact_patterns(lengths: np.ndarray, size: int) -> np.ndarray:
    """Rows (a, b, c) with a <= b <= c of present lengths, 0 for none, that sum to size exactly."""
    has = np.zeros(size + 1, dtype=bool)
    has[0] = True
    has[lengths] = True
    have = np.flatnonzero(has)
    out = []
    for a in have:
        b = have[(have >= a) & (have <= (size - a) // 2)]
        c = size - a - b
        ok = has[c]
        out.append(np.stack([np.full(ok.sum(), a), b[ok], c[ok]], axis=1))
    return np.concatenate(out) if out else np.zeros((0, 3), dtype=np.int64)


def fit_repeats(patterns: np.ndarray, counts: np.ndarray, steps: int = 300) -> np.ndarray:
    """Non-negative repeats x that minimise |A x - counts|^2, A counting each length in each pattern."""
    size = len(counts)
    x = np.zeros(len(patterns))
    if not len(patterns):
        return x
    b = counts.astype(float).copy()
    b[0] = 0

    def forward(v):
        out = sum(np.bincount(patterns[:, j], v, minlength=size) for j in range(3))
        out[0] = 0
        return out

    def back(r):
        return r[patterns[:, 0]] + r[patterns[:, 1]] + r[patterns[:, 2]]

    v = np.random.default_rng(0).random(len(patterns))
    for _ in range(12):  # the largest eigenvalue of A'A by powers
        v = back(forward(v))
        norm = np.linalg.norm(v)
        v /= norm or 1.0
    y, t, rate = x.copy(), 1.0, 1.0 / (1.05 * norm or 1.0)
    for _ in range(steps):
        new = np.maximum(0, y - rate * back(forward(y) - b))
        after = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y, x, t = new + (t - 1) / after * (new - x), new, after
    return x


def plan(histogram: dict[int, int], size: int, share: float = 0.9) -> list[tuple[int, int, int, int, int, int]]:
    """The places of all pieces: (length, first rank, count, first sequence, sequence step, offset) in order of rank.

    share: of the fitted repeats that become sequences; what stays gives best fit the short pieces that it closes gaps with.
    """
    left = np.zeros(size + 1, dtype=np.int64)
    for n, c in histogram.items():
        left[n] = c
    used, out, sequence = np.zeros(size + 1, dtype=np.int64), [], 0

    def place(length: int, count: int, first: int, offset: int) -> None:
        out.append((length, int(used[length]), count, first, 1, offset))
        used[length] += count
        left[length] -= count

    patterns = exact_patterns(np.flatnonzero(left), size)
    x = fit_repeats(patterns, left)
    for k in np.argsort(-x, kind="stable"):
        if share * x[k] < 1:
            break
        parts = [int(p) for p in patterns[k] if p]
        repeat = min([int(share * x[k]), *(int(left[p]) // parts.count(p) for p in parts)])
        if repeat > 0:
            offset = 0
            for p in sorted(parts, reverse=True):
                place(p, repeat, sequence, offset)
                offset += p
            sequence += repeat
    # best fit decreasing on counts: groups of equal sequences by the room they have
    rooms: dict[int, list[tuple[int, int]]] = {}
    order: list[int] = []
    for length in range(size, 0, -1):
        while left[length]:
            i = bisect.bisect_left(order, length)
            if i < len(order):
                room = order[i]
                first, count = rooms[room].pop()
                take = min(count, int(left[length]))
                if take < count:
                    rooms[room].append((first + take, count - take))
                if not rooms[room]:
                    del rooms[room]
                    order.pop(i)
            else:
                each = size // length  # new sequences take as many of this length as they hold
                full, rest = divmod(int(left[length]), each)
                for n, k in ((full, each), (1 if rest else 0, rest)):
                    if n:
                        for j in range(k):
                            place(length, n, sequence, j * length)
                        if size - k * length:
                            rooms.setdefault(size - k * length, []).append((sequence, n))
                            if size - k * length not in order:
                                bisect.insort(order, size - k * length)
                        sequence += n
                break
            place(length, take, first, size - room)
            if room - length:
                rooms.setdefault(room - length, []).append((first, take))
                if room - length not in order:
                    bisect.insort(order, room - length)
    return out


def pack(pieces: DataFrame, size: int, bucket_pieces: int = 20_000, most_buckets: int = 100_000, seed: str = "pack") -> DataFrame:
    """Adds sequence_id and offset to a table of pieces (doc_id, piece, length, ...): no sequence above `size`, no gaps.

    A bucket holds about bucket_pieces pieces of one length, more where there would be over most_buckets of them. At most size rows
    (the histogram) and size + most_buckets rows (counts) reach the driver, however many pieces there are.
    """
    pieces = cut(pieces, "pieces")
    spark = pieces.sparkSession
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    per = max(bucket_pieces, -(-sum(histogram.values()) // most_buckets))
    spread = spark.createDataFrame([(length, max(1, -(-n // per))) for length, n in histogram.items()], "length int, buckets int")
    pieces = pieces.join(F.broadcast(spread), "length").withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "piece", "ids_crc32"), "buckets").cast("int")).drop("buckets")
    counts = sorted((r["length"], r["bucket"], r["n"]) for r in pieces.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n")).collect())
    before, held_so_far = [], {}
    for length, bucket, n in counts:
        before.append((length, bucket, held_so_far.get(length, 0)))
        held_so_far[length] = held_so_far.get(length, 0) + n
    places: dict[int, list[tuple[int, int, int]]] = {}
    for length, rank, _, first, _, offset in plan(histogram, size):
        places.setdefault(length, []).append((rank, first, offset))
    table = {n: tuple(np.asarray(c, dtype=np.int64) for c in zip(*sorted(p), strict=True)) for n, p in places.items()}
    held = pieces.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("struct<sequence_id long, offset long>")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        n, r = length.to_numpy(), rank.to_numpy("int64")
        out = np.zeros((2, len(n)), dtype=np.int64)
        for one in np.unique(n):
            at = np.flatnonzero(n == one)
            ranks, first, offset = held.value[int(one)]
            i = np.searchsorted(ranks, r[at], side="right") - 1
            out[0, at], out[1, at] = first[i] + r[at] - ranks[i], offset[i]
        return pd.DataFrame({"sequence_id": out[0], "offset": out[1]})

    sums = spark.createDataFrame(before, "length int, bucket int, before long")
    within = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32"))
    ranked = pieces.withColumn("within", within).join(F.broadcast(sums), ["length", "bucket"])
    placed = ranked.withColumn("p", place("length", F.col("before") + F.col("within") - 1))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", F.col("p.sequence_id").alias("sequence_id"), F.col("p.offset").alias("offset"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    pieces = token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), 1024, 2)
    packed = pack(pieces, 1024)
    return packed.select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset")


QUERIES = {"op8_packing": op8_packing}
ORACLES: dict[str, str] = {}
