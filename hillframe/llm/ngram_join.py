"""N-gram Jaccard join: size-aware, heavy and light.

Sets are the distinct k-word shingles of whole texts, each as a 64-bit hash: sets are compared as hashes, never as words. All shingles
stand in one fixed order, by the number of sets that hold them. Two sets that meet the Jaccard threshold t share at least
ceil(t * |x|) elements, so they share l elements of their first |x| - ceil(t * |x|) + l.

* Shingles that one set alone holds can't be shared. First 32 bits of every shingle are dealt by hash, and every set learns how many of its
  shingles some other set may hold too: if they are fewer than the threshold asks for, it has no link and goes no further.
* The shingles of the other sets are dealt whole and counted, and those of two sets and more return to their sets with the number
  of sets that hold them, which gives the order.
* Small sets (at most `boundary` elements) enumerate the pairs (subsets of fixed size two) of their prefix with l = 2 as join keys.
* Large sets put the prefix with l = 1 into inverted lists, and so do small sets near enough to the boundary to match a large one.
  Lists of shingles that a thousand sets and more hold are salted by set: each part has its own leader (below), and the leaders of
  the parts are compared with the first of them.

The boundary minimises the estimated cost (subsets written against postings times the cost of scanning a list), from sums over
set sizes.

Equal sets are one set (a third of all rows may be copies of one text). In each list every set is compared with the list's leader, the
set with fewest shingles of its own; then, in lists where some set isn't connected with the leader, those sets with all others of other
components: no link between different components is lost, and a group of near copies costs as many comparisons as it has members, not
their square. Size and position filters, which keep every pair that can meet the threshold, come before exact comparison
of whole sets. A leader's set is sent once to about 250 sets that are compared with it.

Defined results: a null text or one without words has no set, no links and itself as component; shorter texts than k words are
one shingle; equal texts and repeated rows are linked; rows with a null id take the component of their links, but a text that only rows
with a null id have links no other texts; empty tables give no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Words, columns_of, cut, distinct, map_batches, maybe_broadcast, mix, named, numbers, order_by, planes, shingles, signed, slices, text_bytes, unused
from .components import components

SETS = "kind int, doc_id long, n int, sig long, key long, c long"
PRINTS = "share int, docs binary, counts binary, prints binary"
FOUND = "share int, docs binary, counts binary"
SHINGLES = "share int, sigs binary, sizes binary, keys binary, owners binary, held binary"
SHARED = "sig long, n int, keys binary, held binary"
ORDERED = "sig long, n int, rare int, keys binary, held binary"
POSTINGS = "key long, salt int, sig long, n int, pos int, rare int"
LISTS = "key long, salt int, sig long, n int, pos int, rare int, lead long, lead_n int, lead_pos int, lead_rare int"


def _sets(column: pa.Array, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Row range, then document, hash of the distinct shingles, set sizes and signatures of a slice."""
    data, offsets = text_bytes(column)
    for a, b in slices(offsets):
        w = Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        h, d, _ = shingles(w, w.hashes(), k)
        d, h = distinct(d, h)
        n = np.bincount(d, minlength=b - a)
        sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(mix(h ^ np.uint64(0xA5A5A5A5DEADBEEF)), dtype=np.uint64)])
        edge = np.concatenate([[0], np.cumsum(n)])
        with np.errstate(over="ignore"):
            sig = mix(sums[edge[1:]] - sums[edge[:-1]] + n.astype(np.uint64))
        yield a, b, d, h, n, sig


def read_sets(docs: DataFrame, k: int, common: int = 3, window: int = 500_000) -> DataFrame:
    """kind 0: doc_id, n, sig of every document; kind 1: a shingle (key) that `common` or more sets of one window hold, and how many."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        seen: set[int] = set()

        def frequent() -> pa.RecordBatch:
            h = np.sort(np.concatenate(held))
            edge = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1], [True]]))
            c = np.diff(edge)
            h, c = h[edge[:-1][c >= common]], c[c >= common]
            zero = np.zeros(len(h), dtype=np.int64)
            return pa.RecordBatch.from_arrays([pa.array(zero + 1, pa.int32()), pa.array(zero), pa.array(zero, pa.int32()), pa.array(zero), signed(h), pa.array(c)], names=["kind", "doc_id", "n", "sig", "key", "c"])

        for batch in batches:
            for a, b, d, h, n, sig in _sets(batch.column(1), k):
                zero = np.zeros(b - a, dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(zero, pa.int32()), batch.column(0).slice(a, b - a), pa.array(n, pa.int32()), signed(sig), pa.array(zero), pa.array(zero)], names=["kind", "doc_id", "n", "sig", "key", "c"])
                fresh = np.zeros(b - a, dtype=bool)
                for i, s in enumerate(sig.tolist()):
                    if s not in seen:
                        seen.add(s)
                        fresh[i] = True
                held.append(h[fresh[d]])
                if sum(map(len, held)) > window:
                    yield frequent()
                    held, seen = [], set()
        if held:
            yield frequent()

    return docs.transform(map_batches, read, SETS)


def choose_boundary(sizes: list[tuple[int, int, float, float]], numerator: int, denominator: int, scan: float = 4.0) -> int:
    """The set size up to which subsets are enumerated, of least estimated cost.

    sizes: (size, sets of about that size, sum and sum of squares of their shared shingles beyond what the threshold asks for).
    """
    best = (float("inf"), 0)
    for bound in sorted({0, *(s[0] for s in sizes)}):
        cost = 0.0
        for n, c, w, w2 in sizes:
            if n <= bound:
                cost += (w2 + 3 * w + 2 * c) / 2
            if n > bound or denominator * n >= numerator * bound:
                cost += (w + c) * scan
        best = min(best, (cost, bound))
    return best[1]


def print_rows(docs: DataFrame, k: int, numerator: int, denominator: int, frequent: np.ndarray, shares: int) -> DataFrame:
    """32 bits of the shingles of every set that another set can match, by share, with the documents and how many are of each.

    Of frequent shingles only the number in each document is given (in rows without prints).
    """
    known = docs.sparkSession.sparkContext.broadcast(frequent)
    names = ["share", "docs", "counts", "prints"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = known.value
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for a, _, d, h, n, _ in _sets(batch.column(1), k):
                able = denominator * n >= numerator * (n + 1)  # else only an equal set can match
                take = able[d]
                h, d = h[take], d[take]
                if not len(h):
                    continue
                rows: list[tuple] = []
                if len(frequent):
                    hit = frequent[np.minimum(np.searchsorted(frequent, h), len(frequent) - 1)] == h
                    sure = np.bincount(d[hit], minlength=len(n))
                    who = np.flatnonzero(sure)
                    if len(who):
                        rows.append((int(mix(h[:1])[0] % np.uint64(shares)), planes(ids[a + who]), planes(sure[who].astype(np.uint32)), b""))
                    h, d = h[~hit], d[~hit]
                share = (mix(h + np.uint64(1)) % np.uint64(shares)).astype(np.int64)
                order = order_by(share)
                share, h, d = share[order], (h[order] >> np.uint64(32)).astype(np.uint32), d[order]
                new = np.ones(len(h), dtype=bool)  # the beginning of a document in a share
                new[1:] = (share[1:] != share[:-1]) | (d[1:] != d[:-1])
                begin = np.flatnonzero(new)
                count = np.diff(np.append(begin, len(h))).astype(np.uint32)
                who, of = ids[a + d[begin]], share[begin]
                edge = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1], [True]])) if len(of) else np.zeros(1, dtype=np.int64)
                at = np.append(begin, len(h))
                for i, j in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                    rows.append((int(of[i]), planes(who[i:j]), planes(count[i:j]), planes(h[at[i] : at[j]])))
                for i in range(0, len(rows), 5000):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i : i + 5000], strict=True), (pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)], names=names)

    return docs.transform(map_batches, read, PRINTS)


def shared_counts(rows: DataFrame, shares: int) -> DataFrame:
    """(doc_id, shared): how many shingles of a document some other one may hold too; documents without any are left out."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, counts, prints, sure = [], [], [], []
        for batch in batches:
            for who, c, print_ in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                if print_:
                    docs.append(numbers(who, np.int64))
                    counts.append(numbers(c, np.uint32))
                    prints.append(numbers(print_, np.uint32))
                else:
                    sure.append((numbers(who, np.int64), numbers(c, np.uint32)))
        if docs:
            x = np.concatenate(prints)
            prints.clear()
            order = np.argsort(x)
            x = x[order]
            same = np.zeros(len(x), dtype=bool)
            same[order] = np.append(x[1:] == x[:-1], False) | np.append(False, x[1:] == x[:-1])
            who, c = np.concatenate(docs), np.concatenate(counts).astype(np.int64)
            total = np.concatenate([[0], np.cumsum(same)])
            end = np.cumsum(c)
            sure.append((who, (total[end] - total[end - c]).astype(np.uint32)))
        if not sure:
            return
        who, c = (np.concatenate(v) for v in zip(*sure, strict=True))
        who, c = who[c > 0], c[c > 0]
        to = (mix(who.view(np.uint64)) % np.uint64(shares)).astype(np.int64)
        order = order_by(to)
        to, who, c = to[order], who[order], c[order]
        edge = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1], [True]])) if len(to) else np.zeros(1, dtype=np.int64)
        for k in range(0, len(edge) - 1, 5000):
            own = edge[k : k + 5001].tolist()
            columns = [pa.array(to[own[:-1]], pa.int32()), *(pa.array([planes(v[i:j]) for i, j in zip(own[:-1], own[1:], strict=True)], pa.binary()) for v in (who, c))]
            yield pa.RecordBatch.from_arrays(columns, names=["share", "docs", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(numbers(who, np.int64), numbers(c, np.uint32)) for batch in batches for who, c in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
        if parts:
            who, c = (np.concatenate(v) for v in zip(*parts, strict=True))
            who, at = np.unique(who, return_inverse=True)
            yield pa.RecordBatch.from_arrays([pa.array(who), pa.array(np.bincount(at, c).astype(np.int64))], names=["doc_id", "shared"])

    found = rows.repartitionById(shares, F.col("share")).transform(map_batches, count, FOUND)
    return found.repartitionById(shares, F.col("share")).transform(map_batches, add, "doc_id long, shared long")


def shingle_rows(docs: DataFrame, k: int, numerator: int, denominator: int, frequent: np.ndarray, held_by: np.ndarray, shares: int) -> DataFrame:
    """The shingles of every set that another set can match, by share of the hashes, as bytes: one row per slice of texts and share.

    frequent: sorted shingles whose number of sets (held_by) is known; they are dealt by set, so that none of them is one task's.
    """
    known = docs.sparkSession.sparkContext.broadcast((frequent, np.minimum(held_by, 2**31 - 1).astype(np.uint32)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, held_by = known.value
        seen: set[int] = set()
        for batch in batches:
            for _, _, d, h, n, sig in _sets(batch.column(0), k):
                fresh = denominator * n >= numerator * (n + 1)  # else only an equal set can match
                for i in np.flatnonzero(fresh).tolist():
                    s = int(sig[i])
                    if s in seen:
                        fresh[i] = False
                    seen.add(s)
                if len(seen) > 200_000:
                    seen.clear()
                take = fresh[d]
                h, d = h[take], d[take]
                if not len(h):
                    continue
                held = np.zeros(len(h), dtype=np.uint32)
                if len(frequent):
                    at = np.minimum(np.searchsorted(frequent, h), len(frequent) - 1)
                    held = np.where(frequent[at] == h, held_by[at], np.uint32(0)).astype(np.uint32)
                share = (np.where(held > 0, mix(h ^ sig[d]), mix(h + np.uint64(1))) % np.uint64(shares)).astype(np.int64)
                order = order_by(share)
                share, h, d, held = share[order], h[order], d[order], held[order]
                edge = np.concatenate([[0], np.flatnonzero(share[1:] != share[:-1]) + 1, [len(share)]])
                columns: list[list[bytes]] = [[], [], [], [], []]
                for i, j in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                    own = np.ones(j - i, dtype=bool)
                    own[1:] = d[i + 1 : j] != d[i : j - 1]
                    docs_ = d[i:j][own]
                    owner = (np.cumsum(own) - 1).astype(np.uint32)
                    for out, v in zip(columns, (sig[docs_], n[docs_].astype(np.uint32), h[i:j], owner, held[i:j]), strict=True):
                        out.append(planes(v))
                yield pa.RecordBatch.from_arrays([pa.array(share[edge[:-1]], pa.int32()), *(pa.array(c, pa.binary()) for c in columns)], names=["share", "sigs", "sizes", "keys", "owners", "held"])

    return docs.select("text").transform(map_batches, read, SHINGLES)


def shared_shingles(rows: DataFrame, shares: int) -> DataFrame:
    """Per share and set: the shingles that two sets and more hold, and by how many sets each is held."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[list[np.ndarray]] = []
        sets = 0
        for batch in batches:
            for row in zip(*(batch.column(i) for i in range(1, 6)), strict=True):
                sig, n, key, owner, held = (numbers(v.as_py(), t) for v, t in zip(row, (np.uint64, np.uint32, np.uint64, np.uint32, np.uint32), strict=True))
                parts.append([sig, n, key, owner + np.uint32(sets), held])
                sets += len(sig)
        if not parts:
            return
        sig, n, key, owner, held = (np.concatenate(v) for v in zip(*parts, strict=True))
        parts.clear()
        order = np.argsort(key)
        sorted_ = key[order]
        edge = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1], [True]]))
        count_ = np.empty(len(key), dtype=np.uint32)
        count_[order] = np.repeat(np.diff(edge), np.diff(edge)).astype(np.uint32)
        held = np.where(held > 0, held, count_)
        give = np.flatnonzero(held > 1)
        give = give[order_by(owner[give].astype(np.int64))]
        owner, key, held = owner[give], key[give], held[give]
        edge = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1], [True]])) if len(owner) else np.zeros(1, dtype=np.int64)
        for i in range(0, len(edge) - 1, 5000):
            own = edge[i : i + 5001].tolist()
            who = owner[own[:-1]]
            yield pa.RecordBatch.from_arrays(
                [signed(sig[who]), pa.array(n[who].astype(np.int32)), *(pa.array([v[a:b].tobytes() for a, b in zip(own[:-1], own[1:], strict=True)], pa.binary()) for v in (key, held))],
                names=["sig", "n", "keys", "held"],
            )

    return rows.repartitionById(shares, F.col("share")).transform(map_batches, count, SHARED)


def ordered_sets(shared: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """sig, n, rare (shingles that no other set holds) and the shared shingles, least held first, of sets that have enough of them for a link."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def one():
            sig, n = held[0][:2]
            key = np.frombuffer(b"".join(r[2] for r in held), np.uint64)
            count_ = np.frombuffer(b"".join(r[3] for r in held), np.uint32)
            order = np.lexsort((key, count_))
            key, count_ = key[order], count_[order]
            if len(key) > 1 and not (key[1:] != key[:-1]).all():  # a set that was read twice
                new = np.append(True, key[1:] != key[:-1])
                key, count_ = key[new], count_[new]
            if len(key) >= -(-numerator * n // denominator):
                rows.append((sig, n, n - len(key), key.tobytes(), count_.tobytes()))

        rows: list[tuple] = []
        names, kinds = ["sig", "n", "rare", "keys", "held"], (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if held and held[0][0] != row[0]:
                    one()
                    held.clear()
                held.append(row)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                rows.clear()
        if held:
            one()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return shared.repartition("sig").sortWithinPartitions("sig").transform(map_batches, merge, ORDERED)


def prefix_keys(sets: DataFrame, numerator: int, denominator: int, boundary: int, hot: int = 1000) -> DataFrame:
    """One row per key of every set: prefix pairs of small sets, prefix shingles of large ones and of those near the boundary.

    Keys of `hot` sets and more get one salt per `hot` / 2 sets.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in range(0, whole.num_rows, 500):
                batch = whole.slice(part, 500)
                sig = batch.column(0).to_numpy().view(np.uint64)
                n, rare = (batch.column(i).to_numpy().astype(np.int64) for i in (1, 2))
                h = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint64)
                by = np.frombuffer(b"".join(batch.column(4).to_pylist()), np.uint32).astype(np.int64)
                have = n - rare
                edge = np.concatenate([[0], np.cumsum(have)])
                d = np.repeat(np.arange(len(n)), have)
                at = np.arange(len(h)) - edge[d]
                spread = np.where(by >= hot, 2 * by // hot, 0)
                more = have + numerator * n // -denominator  # what it shares beyond ceil(t * n)
                lists = (n > boundary) | (denominator * n >= numerator * boundary)
                take = lists[d] & (at <= more[d])
                out = [(h[take], d[take], at[take], spread[take])]
                width = np.where((n <= boundary) & (n >= 2), np.minimum(more + 2, have), 0)
                for p in range(1, int(width.max(initial=0))):  # the pair's second element stands at p
                    docs_ = np.flatnonzero(width > p)
                    second = edge[docs_] + p
                    for q in range(p):
                        one = edge[docs_] + q
                        with np.errstate(over="ignore"):
                            pair = mix(h[one] * np.uint64(0xC2B2AE3D27D4EB4F) + h[second])
                        # one shared element stands before p, so a pair that meets here can share one more than from p on
                        out.append((pair, docs_, np.full(len(docs_), p - 1), np.minimum(spread[one], spread[second])))
                key, doc, place, parts = (np.concatenate(x) for x in zip(*out, strict=True))
                if len(key):
                    own = sig[doc]
                    salt = np.where(parts > 0, (own % np.maximum(parts, 1).astype(np.uint64)).astype(np.int64) + 1, 0)
                    columns = [signed(key), pa.array(salt, pa.int32()), signed(own), pa.array(n[doc], pa.int32()), pa.array(rare[doc] + place, pa.int32()), pa.array(rare[doc], pa.int32())]
                    yield pa.RecordBatch.from_arrays(columns, names=["key", "salt", "sig", "n", "pos", "rare"])

    return sets.transform(map_batches, read, POSTINGS)


def led_lists(postings: DataFrame) -> DataFrame:
    """Every posting of a list of two different sets or more (or of a salted list), with the list's leader.

    Postings come sorted by list and by shingles of their own; a list streams by, so its length needs no memory.
    """
    names = ["key", "salt", "sig", "n", "pos", "rare"]

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried, told = None, False  # the last list's leader, and whether it has been given
        for batch in batches:
            x = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(6)]
            if carried is not None:
                x = [np.concatenate([[c], v]).astype(v.dtype) for c, v in zip(carried, x, strict=True)]
            keep = np.ones(len(x[0]), dtype=bool)
            keep[1:] = (x[0][1:] != x[0][:-1]) | (x[1][1:] != x[1][:-1]) | (x[2][1:] != x[2][:-1])
            was = carried is not None
            x = [v[keep] for v in x]
            begin = np.ones(len(x[0]), dtype=bool)
            begin[1:] = (x[0][1:] != x[0][:-1]) | (x[1][1:] != x[1][:-1])
            starts = np.flatnonzero(begin)
            run = np.cumsum(begin) - 1
            first, size = starts[run], np.diff(np.append(starts, len(begin)))[run]
            give = (size > 1) | (x[1] > 0)
            if was and told:
                give[0] = False
            last = starts[-1]
            carried, told = [v[last] for v in x], bool(give[last] or (was and told and last == 0))
            if give.any():
                rows = [v[give] for v in x] + [x[j][first[give]] for j in (2, 3, 4, 5)]
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows, kinds, strict=True)], names=[*names, "lead", "lead_n", "lead_pos", "lead_rare"])

    return postings.repartition("key", "salt").sortWithinPartitions("key", "salt", "rare", "sig").transform(map_batches, lead, LISTS)


def compare(pairs: DataFrame, sets: DataFrame, numerator: int, denominator: int, group: int = 250) -> DataFrame:
    """The pairs (s, t) of signatures whose whole sets meet the threshold exactly, with shared and total sizes.

    The pairs of one s are cut into groups of about `group`; a group gets the set of s once and then streams by.
    """
    c = F.col
    parts = maybe_broadcast(cut(pairs.groupBy("s").count().where(c("count") > group).select("s", F.ceil(c("count") / group).alias("parts")), "hubs"))
    dealt = pairs.join(parts, "s", "left").select("s", "t", F.pmod(F.xxhash64("t"), F.coalesce("parts", F.lit(1))).cast("int").alias("part"))
    members = dealt.join(sets.select(c("sig").alias("t"), "n", "keys"), "t").select("s", "part", F.lit(1).alias("side"), "t", "n", "keys")
    hubs = dealt.select("s", "part").distinct().join(sets.select(c("sig").alias("s"), "n", "keys"), "s").select("s", "part", F.lit(0).alias("side"), c("s").alias("t"), "n", "keys")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, size, own = None, 0, np.zeros(0, dtype=np.uint64)
        for batch in batches:
            rows = []
            for s, side, t, n, keys in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4, 5)), strict=True):
                x = np.frombuffer(keys, np.uint64)
                if not side:
                    hub, size, own = s, n, np.sort(x)
                    continue
                if s != hub:
                    raise ValueError("a set without its hub")
                if len(own) and len(x):
                    same = int((own[np.minimum(np.searchsorted(own, x), len(own) - 1)] == x).sum())
                    if denominator * same >= numerator * (size + n - same):
                        rows.append((s, t, same, size + n - same))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in zip(*rows, strict=True)], names=["s", "t", "shared", "total"])

    met = hubs.unionByName(members).repartition("s", "part").sortWithinPartitions("s", "part", "side")
    return met.transform(map_batches, read, "s long, t long, shared long, total long")


def jaccard_components(
    df: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    k: int = 5,
    numerator: int = 80,
    denominator: int = 100,
    common: int = 3,
    hot: int = 1000,
    most_frequent: int = 2_000_000,
    share_shingles: int = 1_000_000,
) -> DataFrame:
    """doc_id, n_shingles, class_id (smallest id linked with it, directly or not) and links of every document.

    A link: numerator * union <= denominator * shared. most_frequent bounds the broadcast list of shingles that are known to be held by
    `hot` sets or more (12 bytes each, the most frequent first); it spreads work and never changes the result. links: the
    links of a document's set with other sets that were needed to connect its class; equal sets add none. share_shingles: about how
    many shingles a task counts at once.
    """
    c = F.col
    docs = df.select(named(id_col).cast("long").alias("doc_id"), named(text).cast("string").alias("text"))
    read = cut(read_sets(docs, k, common), "sets")
    members = read.where("kind = 0").select("doc_id", "n", "sig")
    frequent = read.where("kind = 1").groupBy("key").agg(F.sum("c").alias("c")).where(c("c") >= hot).orderBy(F.desc("c"), "key").limit(most_frequent).toPandas()
    keys = frequent["key"].to_numpy("int64").view(np.uint64)
    order = np.argsort(keys)
    total = read.where("kind = 0").agg(F.sum("n")).first()[0] or 0
    shares = max(1, -(-total // share_shingles))
    # equal sets are one: its other documents aren't read again
    firsts = members.where("n > 0").groupBy("sig").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    firsts = cut(firsts.where("rep is not null"), "representatives")
    twice = maybe_broadcast(firsts.where("copies > 1").select("sig", "rep"))
    others = maybe_broadcast(cut(members.join(twice, "sig").where("doc_id <> rep").select("doc_id").distinct(), "copies"))
    single = docs.where("doc_id is not null").join(others, "doc_id", "left_anti")
    shared = shared_counts(print_rows(single, k, numerator, denominator, keys[order], shares), shares)
    able = members.join(shared, "doc_id").where(denominator * c("shared") >= numerator * c("n")).groupBy("doc_id").agg(F.max("n").alias("n"))
    able = cut(able, "with-shared-shingles")
    shares = max(1, -(-(able.agg(F.sum("n")).first()[0] or 0) // share_shingles))
    rows = shingle_rows(single.join(maybe_broadcast(able.select("doc_id")), "doc_id", "left_semi"), k, numerator, denominator, keys[order], frequent["c"].to_numpy("int64")[order], shares)
    sets = cut(ordered_sets(shared_shingles(rows, shares), numerator, denominator), "shared-shingles")

    bucket = F.when(c("n") <= 256, c("n")).otherwise(F.ceil(F.pow(F.lit(1.05), F.ceil(F.log(c("n")) / F.log(F.lit(1.05))))))
    more = c("n") - c("rare") - F.ceil(numerator * c("n") / denominator)
    sized = sets.groupBy(bucket.cast("int").alias("size")).agg(F.count(F.lit(1)).alias("c"), F.sum(more).alias("w"), F.sum(more.cast("double") * more).alias("w2")).collect()
    boundary = choose_boundary([(r["size"], r["c"], r["w"], r["w2"]) for r in sized], numerator, denominator)
    lists = cut(led_lists(prefix_keys(sets, numerator, denominator, boundary, hot)), "lists")

    def can_match(n1, p1, n2, p2):
        """Sizes near enough, and as many elements left from the shared position on as the threshold asks for."""
        return (denominator * F.least(n1, n2) >= numerator * F.greatest(n1, n2)) & ((numerator + denominator) * F.least(n1 - p1, n2 - p2) >= numerator * (n1 + n2))

    # every set with its list's leader; of a salted list, the leader of every part with the first of them
    parts = cut(lists.where("salt > 0").select("key", "lead", "lead_n", "lead_pos", "lead_rare").distinct(), "part-leaders")
    heads = cut(parts.groupBy("key").agg(F.min(F.struct("lead_rare", "lead", "lead_n", "lead_pos")).alias("h")).select("key", "h.lead", "h.lead_n", "h.lead_pos"), "heads")
    first = lists.where((c("sig") != c("lead")) & can_match(c("n"), c("pos"), c("lead_n"), c("lead_pos"))).select(c("lead").alias("s"), c("sig").alias("t"))
    across = parts.alias("p").join(heads.alias("h"), "key").where((c("p.lead") != c("h.lead")) & can_match(c("p.lead_n"), c("p.lead_pos"), c("h.lead_n"), c("h.lead_pos")))
    tried = cut(first.unionByName(across.select(c("h.lead").alias("s"), c("p.lead").alias("t"))).distinct(), "leader-pairs")
    links = cut(compare(tried, sets, numerator, denominator), "leader-links")
    label = maybe_broadcast(cut(components(links, "s", "t"), "leader-classes"))

    # what is left: in a list, sets that aren't in its leader's class against those of other classes; s comes first by (rare, sig)
    classed = lambda t, key, name: t.join(label.select(c("node").alias(key), c("component").alias(name)), key, "left").withColumn(name, F.coalesce(name, key))
    leaders = lists.where("salt = 0 and sig = lead").select("key", "lead").unionByName(heads.select("key", "lead")).distinct()
    leaders = cut(classed(leaders, "lead", "lead_class").select("key", "lead_class"), "leader-classes-of-lists")
    placed = classed(lists.select("key", "sig", "n", "pos", "rare"), "sig", "class")
    stray = cut(placed.join(leaders, "key").where("class <> lead_class").select("key").distinct(), "stray-lists")
    placed = cut(placed.join(maybe_broadcast(stray), "key", "left_semi").join(leaders, "key"), "placed")
    apart = placed.where("class <> lead_class").select("key", c("sig").alias("sig1"), c("n").alias("n1"), c("pos").alias("pos1"), c("rare").alias("rare1"), c("class").alias("class1"))
    one, two = F.struct(c("rare1").alias("rare"), c("sig1").alias("sig")), F.struct("rare", "sig")
    rest = apart.join(placed, "key").where((c("class1") != c("class")) & ((c("class") == c("lead_class")) | (one < two)) & can_match(c("n1"), c("pos1"), c("n"), c("pos")))
    more = rest.select(F.least(one, two)["sig"].alias("s"), F.greatest(one, two)["sig"].alias("t")).distinct().join(tried, ["s", "t"], "left_anti")
    links = cut(links.unionByName(compare(cut(more, "other-pairs"), sets, numerator, denominator)), "all-links")

    degree = links.select(c("s").alias("sig")).unionByName(links.select(c("t").alias("sig"))).groupBy("sig").agg(F.count(F.lit(1)).alias("links"))
    joined = cut(components(links, "s", "t").select(c("node").alias("sig"), "component").join(degree, "sig"), "components")
    reps = cut(firsts.join(maybe_broadcast(joined), "sig").select("sig", "component", "rep", "links"), "linked")
    least = reps.groupBy("component").agg(F.min("rep").alias("class_id"))
    linked = reps.join(least, "component").select("sig", "class_id", "links")
    alone = firsts.where("copies > 1").join(maybe_broadcast(reps.select("sig")), "sig", "left_anti").select("sig", c("rep").alias("class_id"), F.lit(0).cast("long").alias("links"))
    classes = maybe_broadcast(cut(linked.unionByName(alone), "classes"))
    return members.join(classes, "sig", "left").select(
        "doc_id",
        c("n").cast("long").alias("n_shingles"),
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("links"),
    )


def one_of_each(df: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows whose id is the smallest of their class, each text of an id once; rows without an id stay."""
    found = cut(jaccard_components(df, id_col, text, **options), "classes-of-documents")
    own = unused(df, "own_id")
    gone = maybe_broadcast(cut(found.where("doc_id <> class_id").select(F.col("doc_id").alias(own)).distinct(), "near-duplicates"))
    twice = maybe_broadcast(cut(found.where("doc_id is not null").groupBy(F.col("doc_id").alias(own)).count().where("count > 1").select(own), "repeated-ids"))
    same = named(id_col).cast("long") == F.col(own)
    kept = df.join(gone, same, "left_anti")
    once = kept.join(twice, same, "left_anti")
    again = kept.join(twice, same, "left_semi").dropDuplicates([id_col, text])
    return once.union(again).select(*columns_of(df))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), k=4, numerator=85)
    return found.select("doc_id", "n_shingles", F.col("class_id").alias("component_id"))


OP7_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i : i + 3], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 3, 1))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS c FROM s GROUP BY 1),
o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * o.c >= 85 * (na.c + nb.c - o.c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT w.doc_id, CAST(coalesce(n.c, 0) AS BIGINT) AS n_shingles, m.component_id
FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY 1) m USING (doc_id)
"""
QUERIES = {"op7_ngram_join": op7_ngram_join}
ORACLES = {"op7_ngram_join": OP7_SQL}
