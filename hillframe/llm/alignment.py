"""Cross-tokenizer alignment: the groups in which a byte-level BPE and a sentencepiece model with byte fallback agree.

Both sides tokenise a space and the text. The coarse cuts are the spans that the libraries report: character offsets of `tokenizers`,
byte spans of sentencepiece's proto (the installed version has given up the name `immutable_proto` and gives its spans as
`offset_mapping`). Where a span isn't as
long as its token's own bytes (parts of a multibyte character all get the whole character, byte-fallback pieces get nothing or the whole one), the
end is refined with the decoded bytes of the tokens before it. Bytes at which tokens of both sides end cut the text into groups, and the
two tokens that end there are linked.

Texts are cut before a single space between two visible characters: neither side has a token across such a place (the pre-tokenizer of one
begins a token there, the other has no piece with a space mark behind anything else; both are checked when the files are read, else texts stay
whole). A task so aligns each different unit once, with a memory of bounded size. Units and whole texts give the same tokens; tests hold them together.

A first step writes ids' groups and links per document and the counts of linked id pairs per task; the pair counts are summed, each B id gets
its highest, and a second step looks every link up: in a broadcast table of at most `most_pairs` pairs, or by a join beyond that.

Defined results: null and empty texts, and texts that either side doesn't give back byte for byte, have no tokens, counts of zero and empty
groups; repeated rows and ids are documents each; texts of any length are whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, map_batches, named, numbers, planes

GROUPS = "kind int, row long, doc_id long, n_a int, n_b int, n_groups int, groups string, links binary, key long, c long"
LINKED = "doc_id long, n_a int, n_b int, n_groups int, groups string, n_links long, n_best long, count_sum long"
SHIFT = 32  # a pair of ids is one number: A's id above, B's below
UNIT = re.compile(r"(?<=\S)(?= \S)")


class ByteLevel:
    """A `tokenizers` file with byte-level tokens: ids, character spans and the bytes of every id."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        printed = [*range(33, 127), *range(161, 173), *range(174, 256)]  # these bytes stand for themselves, the others for 256, 257, ...
        letters = {chr(b): b for b in printed} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(printed))}
        vocabulary = self.tokenizer.get_vocab()
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.length = np.fromiter(map(len, self.bytes), np.int64, len(self.bytes))
        data = json.loads(self.tokenizer.to_str())
        pre = data.get("pre_tokenizer") or {}
        self.cuts = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not data.get("normalizer") and not data.get("truncation") and not data.get("padding")

    def spans(self, texts: list[str], raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Tokens per text, and id, begin and end (in bytes of all texts together) of every token, by the library's offsets."""
        encoded = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        ids = [e.ids for e in encoded]
        n = np.fromiter(map(len, ids), np.int64, len(ids))
        chars = np.fromiter(chain.from_iterable(chain.from_iterable(e.offsets for e in encoded)), np.int64, 2 * int(n.sum())).reshape(-1, 2)
        data = np.frombuffer(b"".join(raw), np.uint8)
        starts = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))  # the byte at which every character begins
        before = np.cumsum([0, *map(len, texts)])[:-1]
        at = starts[np.minimum(chars + np.repeat(before, n)[:, None], len(starts) - 1)]
        return n, np.fromiter(chain.from_iterable(ids), np.int64, len(at)), at[:, 0], at[:, 1]


class Pieces:
    """A sentencepiece model that puts a space before a text: ids, byte spans and the bytes of every id."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.length = np.fromiter(map(len, self.bytes), np.int64, len(self.bytes))
        self.cuts = not any("▁" in p.lstrip("▁") for p in pieces)

    def spans(self, texts: list[str], raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        found = self.model.encode([t[1:] for t in texts], return_type="offset_mapping", return_bytes=True, num_threads=1)
        n = np.fromiter((len(f["ids"]) for f in found), np.int64, len(found))
        ids = np.fromiter(chain.from_iterable(f["ids"] for f in found), np.int64, int(n.sum()))
        at = np.fromiter(chain.from_iterable(chain.from_iterable(f["offsets"] for f in found)), np.int64, 2 * len(ids)).reshape(-1, 2) + 1  # the space before
        at[(np.cumsum(n) - n)[n > 0], 0] = 0
        at += np.repeat(np.cumsum([0, *map(len, raw)])[:-1], n)[:, None]
        return n, ids, at[:, 0], at[:, 1]


_SIDES: dict[tuple[str, str], tuple[ByteLevel, Pieces]] = {}


def sides(a_path: str, b_path: str) -> tuple[ByteLevel, Pieces]:
    """Both tokenizers, once per worker process."""
    if (a_path, b_path) not in _SIDES:
        _SIDES[a_path, b_path] = ByteLevel(a_path), Pieces(b_path)
    return _SIDES[a_path, b_path]


def token_ends(side: ByteLevel | Pieces, texts: list[str], raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens per text, ids, ends in the bytes of all texts together, and whether each text's tokens have exactly its bytes."""
    n, ids, begin, end = side.spans(texts, raw)
    own, length = [side.bytes[i] for i in ids.tolist()], side.length[ids]
    before, base = np.cumsum(n) - n, np.cumsum([0, *map(len, raw)])[:-1]
    total = np.append(0, np.cumsum(length))
    decoded = total[1:] + np.repeat(base - total[before], n)
    end = np.where(end - begin == length, end, decoded)  # a span of another length isn't the token's own
    if b"".join(own) == b"".join(raw) and (total[before + n] - total[before] == np.diff(np.append(base, total[-1]))).all():
        return n, ids, end, np.ones(len(texts), dtype=bool)
    whole = np.fromiter((b"".join(own[i : i + k]) == r for i, k, r in zip(before.tolist(), n.tolist(), raw, strict=True)), bool, len(texts))
    return n, ids, end, whole


class Units:
    """The aligned units of one task: groups as text, tokens of both sides, links, whether both sides give the unit back."""

    def __init__(self, a: ByteLevel, b: Pieces, most_bytes: int = 48_000_000):
        self.a, self.b, self.most = a, b, most_bytes
        self.cuts = a.cuts and b.cuts
        self.strings = [[str(i) + mark for i in range(len(side.bytes)) for mark in marks] for side, marks in ((a, (",", "|")), (b, (",", ";")))]
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.groups: list[str] = []
        self.size = 0
        self.n = np.zeros((0, 3), dtype=np.int64)  # tokens of A and B, groups
        self.whole = np.zeros(0, dtype=bool)
        self.links = np.zeros(0, dtype=np.uint64)
        self.times = np.zeros(0, dtype=np.int64)  # how often documents have each unit

    def full(self) -> bool:
        return self.size > self.most

    def thin_out(self) -> None:
        """Forget the units that documents had at most once; all of them, where the others still take half of the room."""
        keep = np.flatnonzero(self.times > 1)
        index, groups, n, whole, links = self.index, self.groups, self.n, self.whole, self.links
        self.clear()
        names = list(index)
        size = sum(self.bytes_of(names[i]) for i in keep.tolist())
        if 2 * size > self.most:
            return
        first = np.cumsum(n[:, 2]) - n[:, 2]
        self.index = {names[i]: k for k, i in enumerate(keep.tolist())}
        self.groups = [groups[i] for i in keep.tolist()]
        self.size, self.n, self.whole, self.times = size, n[keep], whole[keep], np.zeros(len(keep), dtype=np.int64)
        have = self.n[:, 2]
        self.links = links[np.arange(int(have.sum())) - np.repeat(np.cumsum(have) - have - first[keep], have)]

    @staticmethod
    def bytes_of(unit: str) -> int:
        return 8 * len(unit) + 100

    def numbers_of(self, units: list[str]) -> np.ndarray:
        """The number of every unit; new ones are aligned, several together in one text."""
        new = [u for u in dict.fromkeys(units) if u not in self.index]
        if new:
            self.add(self.together(new) if self.cuts else [[u] for u in new])
        return np.fromiter(map(self.index.__getitem__, units), np.int64, len(units))

    @staticmethod
    def together(units: list[str], most: int = 2000) -> list[list[str]]:
        """Units for one text each: none but the last one ends in white space."""
        out: list[list[str]] = []
        size, begins = 0, True
        for u in units:
            if begins:
                out.append([])
                size = 0
            out[-1].append(u)
            size += len(u)
            begins = size > most or u[-1].isspace()
        return out

    def add(self, sets: list[list[str]]) -> None:
        texts = ["".join(x) for x in sets]
        raw = [t.encode() for t in texts]
        na, ia, ea, fine_a = token_ends(self.a, texts, raw)
        nb, ib, eb, fine_b = token_ends(self.b, texts, raw)
        fine = fine_a & fine_b
        keep_a, keep_b = np.repeat(fine, na), np.repeat(fine, nb)
        ia, ea, ib, eb = ia[keep_a], ea[keep_a], ib[keep_b], eb[keep_b]
        ends, at_a, at_b = np.intersect1d(ea, eb, assume_unique=True, return_indices=True)
        links = (ia[at_a].astype(np.uint64) << np.uint64(SHIFT)) | ib[at_b].astype(np.uint64)
        last_a, last_b = np.zeros(len(ia), dtype=np.int64), np.zeros(len(ib), dtype=np.int64)
        last_a[at_a] = last_b[at_b] = 1
        group = np.concatenate([np.searchsorted(ends, ea) * 2, np.searchsorted(ends, eb) * 2 + 1])
        strings_a, strings_b = self.strings
        words = [strings_a[i] for i in (2 * ia + last_a).tolist()] + [strings_b[i] for i in (2 * ib + last_b).tolist()]
        words = [words[i] for i in np.argsort(group, kind="stable").tolist()]
        again: list[list[str]] = []
        units, good, at, where = [], [], [], 0
        for own, ok, r in zip(sets, fine.tolist(), raw, strict=True):
            if ok or len(own) == 1:  # else one of them isn't given back: each by itself
                for u in own:
                    units.append(u)
                    good.append(ok)
                    where += len(u) if u.isascii() else len(u.encode())
                    at.append(where)
            else:
                again += [[u] for u in own]
                where += len(r)
        edge, whole = np.array(at, dtype=np.int64), np.array(good, dtype=bool)
        n = np.stack([np.bincount(np.searchsorted(edge, x), minlength=len(units)) for x in (ea, eb, ends)], axis=1) if units else np.zeros((0, 3), dtype=np.int64)
        to = np.cumsum(n[:, 0] + n[:, 1]).tolist()
        first = 0
        for u, last in zip(units, to, strict=True):
            self.index[u] = len(self.groups)
            self.groups.append("".join(words[first:last])[:-1])
            self.size += self.bytes_of(u)
            first = last
        self.n, self.whole = np.concatenate([self.n, n]), np.concatenate([self.whole, whole])
        self.links = np.concatenate([self.links, links])
        self.times = np.concatenate([self.times, np.zeros(len(units), dtype=np.int64)])
        if again:
            self.add(again)

    def pair_counts(self) -> tuple[np.ndarray, np.ndarray]:
        """The linked pairs of the documents so far, and how many links have each."""
        pair, at = np.unique(self.links, return_inverse=True)
        c = np.zeros(len(pair), dtype=np.int64)
        np.add.at(c, at, np.repeat(self.times, self.n[:, 2]))
        return pair[c > 0], c[c > 0]


def align(df: DataFrame, a_path: str, b_path: str, digest: bool, slice_chars: int = 1_000_000) -> DataFrame:
    """kind 0: tokens, groups and packed links of every document; kind 1: how many links of a task have a pair (key)."""
    names = ["kind", "row", "doc_id", "n_a", "n_b", "n_groups", "groups", "links", "key", "c"]
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.binary(), pa.int64(), pa.int64())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, row = Units(*sides(a_path, b_path)), TaskContext.get().partitionId() << 40

        def counts() -> pa.RecordBatch:
            pair, c = units.pair_counts()
            zero = [0] * len(pair)
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(([1] * len(pair), *[zero] * 5, [None] * len(pair), [None] * len(pair), pair.view(np.int64), c), kinds, strict=True)], names=names)

        def documents(ids: list, texts: list) -> pa.RecordBatch:
            parts = [(UNIT.split(" " + t) if units.cuts else [" " + t]) if t else [] for t in texts]
            count = np.fromiter(map(len, parts), np.int64, len(parts))
            of = units.numbers_of([u for p in parts for u in p])
            doc = np.repeat(np.arange(len(parts)), count)
            bad = np.bincount(doc[~units.whole[of]], minlength=len(parts)) > 0
            fine = ~bad & (count > 0)
            doc, of = doc[fine[doc]], of[fine[doc]]
            units.times += np.bincount(of, minlength=len(units.times))
            n = np.stack([np.bincount(doc, units.n[of, j], len(parts)).astype(np.int64) for j in range(3)])
            have = units.n[of, 2]
            first = np.cumsum(units.n[:, 2]) - units.n[:, 2]
            link = units.links[np.arange(int(have.sum())) - np.repeat(np.cumsum(have) - have - first[of], have)]
            text, packed, at, to = [], [], 0, 0
            for i, k, good in zip(n[2].tolist(), count.tolist(), fine.tolist(), strict=True):
                groups = ";".join([units.groups[j] for j in of[at : at + k].tolist()]) if good else ""
                text.append(hashlib.sha256(groups.encode()).hexdigest() if digest and groups else groups)
                packed.append(planes(link[to : to + i]))
                at, to = at + k * good, to + i
            zero = [0] * len(parts)
            columns = (zero, row + np.arange(len(parts)), ids, *n, text, packed, zero, zero)
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            ids, texts = (batch.column(i).to_pylist() for i in (0, 1))
            a = 0
            while a < len(ids):
                b, size = a, 0
                while b < len(ids) and (b == a or size + len(texts[b] or "") <= slice_chars):
                    size += len(texts[b] or "")
                    b += 1
                if units.full():
                    yield counts()
                    units.thin_out()
                yield documents(ids[a:b], texts[a:b])
                row += b - a
                a = b
        yield counts()

    return df.transform(map_batches, read, GROUPS)


def looked_up(found: DataFrame, pairs: DataFrame) -> DataFrame:
    """LINKED of found's documents by a broadcast table of pairs (key, c, best), whose size is bounded by the caller."""
    table = pairs.toPandas()
    order = np.argsort(table["key"].to_numpy("int64").view(np.uint64))
    known = found.sparkSession.sparkContext.broadcast(tuple(table[x].to_numpy(t)[order] for x, t in (("key", "int64"), ("c", "int64"), ("best", "bool"))))
    names = [f.split(" ")[0] for f in LINKED.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, c, best = known.value
        key = key.view(np.uint64)
        for batch in batches:
            rows = []
            for packed in batch.column(5):
                link = numbers(packed.as_py(), np.uint64)
                at = np.searchsorted(key, link)
                rows.append((len(link), int(best[at].sum()) if len(link) else 0, int(c[at].sum()) if len(link) else 0))
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], *(pa.array(x, pa.int64()) for x in zip(*rows, strict=True))], names=names)

    return found.select("doc_id", "n_a", "n_b", "n_groups", "groups", "links").transform(map_batches, read, LINKED)


def joined(found: DataFrame, pairs: DataFrame) -> DataFrame:
    """The same by a join: every document's distinct pairs meet their counts, whatever the number of pairs."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, packed in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                key, times = np.unique(numbers(packed.as_py(), np.uint64), return_counts=True)
                if len(key):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), row)), pa.array(key.view(np.int64)), pa.array(times.astype(np.int64))], names=["row", "key", "times"])

    links = found.select("row", "links").transform(map_batches, spread, "row long, key long, times long").join(pairs, "key")
    times = F.col("times")
    sums = links.groupBy("row").agg(F.sum(times).alias("n_links"), F.sum(F.when(F.col("best"), times).otherwise(0)).alias("n_best"), F.sum(times * F.col("c")).alias("count_sum"))
    zero = [F.coalesce(x, F.lit(0)).cast("long").alias(x) for x in ("n_links", "n_best", "count_sum")]
    return found.join(sums, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", "groups", *zero)


def aligned(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text: str = "text", digest: bool = False, most_pairs: int = 3_000_000) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, groups, n_links, n_best and count_sum of every document.

    groups: `a1,a2|b1;a3|b2,b3`, or its SHA-256 with digest. most_pairs bounds the broadcast of pair counts (17 bytes each).
    """
    rows = df.select(named(id_col).cast("long").alias("doc_id"), named(text).cast("string").alias("text"))
    found = cut(align(rows, a_path, b_path, digest), "groups")
    pairs = cut(found.where("kind = 1").groupBy("key").agg(F.sum("c").alias("c")).withColumn("b", F.expr(f"key & {(1 << SHIFT) - 1}")), "pairs")
    pairs = cut(pairs.join(pairs.groupBy("b").agg(F.max("c").alias("most")), "b").select("key", "c", (F.col("c") == F.col("most")).alias("best")), "pair-counts")
    found = found.where("kind = 0")
    return looked_up(found, pairs) if pairs.count() <= most_pairs else joined(found, pairs)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = aligned(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), digest=True)
    counts = [F.col(c).cast("long").alias(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    return found.select(*counts, F.col("groups").alias("groups_sha256"))


QUERIES = {"op11_alignment": op11_alignment}
ORACLES: dict[str, str] = {}
