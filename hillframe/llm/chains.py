"""Substring dedup by collinear chaining: passages that documents share, edits included.

1. Seeds: every k-word window of a text, so that two texts with a common run of k words share a seed; and of its windows of
   `long` words those of least hash among `window` in a row, so that two texts with a common run of long + window - 1 words share one of
   them, whoever else holds parts of the run. Texts that are equal as word sequences are one text here.
2. Anchors: a seed that several texts hold links each of its places with its first place (the leader of the list), not all with all. Seeds
   that a thousand texts hold are salted by text, and the leaders of the parts are linked with the first of them.
3. Chains: the anchors of two texts, in the order of the first, are joined into runs on one diagonal; a tree over places in
   the second text gives every run its best predecessor within reach under a linear gap cost, in O(n log n).
4. Alignment: the words of each chain, with a margin, are fetched from both texts; anchors are exact, gaps between them and
   the ends are aligned word by word, and the chain is kept if enough of its words match.
5. Passages: aligned chains of one text that overlap or touch are merged; merged passages of at least min_words words remain.

Defined results: null and empty texts have no passage; of equal texts with at least min_words words the one with the smallest
id is the source of the others' only passage, which is all of the text; a repeat inside one text alone isn't reported; rows
without an id take no part; empty tables give no rows; other columns are ignored by the search and kept by the removal.

Open: a passage without a common run of long + window - 1 words (19), whose seeds are all led by different earlier texts in stretches
under min_words // 4 words, is not found.
"""

from __future__ import annotations

import bisect
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Words, columns_of, cut, map_batches, maybe_broadcast, mix, named, numbers, order_by, planes, shingles, signed, slices, small, text_bytes, unused

SEEDS = "share int, keys binary, docs binary, counts binary, places binary, salts binary"
#: Bytes of a seed's hash that are dealt: two seeds of one length that agree in these and in their share alone give a false anchor, which
#: alignment drops. Seeds of k and of `long` words never meet: `long` words from the other's place might run beyond its text.
KEY_BYTES = 5
ANCHORS = "key long, salt int, doc long, pos int, lead long, lead_pos int"
CHAINS = "x long, y long, x0 int, x1 int, y0 int, y1 int, anchors array<int>"


def _seeds(column: pa.Array, k: int, long: int, window: int):
    """Row range, then document, hash and place of the seeds of a slice, words per document and a signature.

    A place is twice the word position, and one more for a seed of `long` words.
    """
    data, offsets = text_bytes(column)
    for a, b in slices(offsets):
        w = Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        words = w.hashes()
        with np.errstate(over="ignore"):
            ranked = mix(words + mix(w.pos.astype(np.uint64) + np.uint64(1)))
            total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(ranked, dtype=np.uint64)])
            sig = mix(total[w.first[1:]] - total[w.first[:-1]] + w.n.astype(np.uint64))
        h, d, p = shingles(w, words, k)
        whole = w.n[d] >= k
        h, d, p = h[whole], d[whole], p[whole]
        h2, d2, p2 = shingles(w, words, long)
        whole = w.n[d2] >= long
        h2, d2, p2 = mix(h2[whole] + np.uint64(long)), d2[whole], p2[whole]
        if len(h2) >= window:
            rows = np.lib.stride_tricks.sliding_window_view(h2, window)
            at = np.arange(len(rows)) + rows.argmin(axis=1)
            at = np.unique(at[d2[: len(rows)] == d2[window - 1 :]])
            h, d, p = np.concatenate([h, h2[at]]), np.concatenate([d, d2[at]]), np.concatenate([2 * p, 2 * p2[at] + 1])
        else:
            p = 2 * p
        yield a, b, d, h, p, w.n, sig


def read_texts(docs: DataFrame, k: int, long: int, window: int, hot: int) -> DataFrame:
    """kind 0: doc_id, words and signature of every text; kind 1: a seed at hot / 20 or more places of one part, and how many."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["kind", "doc_id", "n", "sig", "key", "c"]
        held: list[np.ndarray] = []
        few = max(3, hot // 20)

        def frequent():
            h = np.sort(np.concatenate(held))
            edge = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1], [True]])) if len(h) else np.zeros(1, dtype=np.int64)
            c = np.diff(edge)
            h, c = h[edge[:-1][c >= few]], c[c >= few]
            zero = np.zeros(len(h), dtype=np.int64)
            return pa.RecordBatch.from_arrays([pa.array(zero + 1, pa.int32()), pa.array(zero), pa.array(zero), pa.array(zero), signed(h), pa.array(c)], names=names)

        for batch in batches:
            for a, b, _, h, _, n, sig in _seeds(batch.column(1), k, long, window):
                zero = np.zeros(b - a, dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(zero, pa.int32()), batch.column(0).slice(a, b - a), pa.array(n), signed(sig), pa.array(zero), pa.array(zero)], names=names)
                held.append(h)
                if sum(map(len, held)) > 500_000:
                    yield frequent()
                    held = []
        if held:
            yield frequent()

    return docs.transform(map_batches, read, "kind int, doc_id long, n long, sig long, key long, c long")


def seed_rows(docs: DataFrame, k: int, long: int, window: int, frequent: np.ndarray, parts: np.ndarray, shares: int) -> DataFrame:
    """The seeds of every text, by share of the seeds, as bytes; frequent seeds get one of their parts as salt, by text.

    One row per slice of texts and share: a row per seed would take twice the disk and most of the time.
    """
    held = docs.sparkSession.sparkContext.broadcast((frequent, parts))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, parts = held.value
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for a, _, d, h, p, _, _ in _seeds(batch.column(1), k, long, window):
                if not len(h):
                    continue
                doc = ids[a + d]
                salt = np.zeros(len(h), dtype=np.int32)
                if len(frequent):
                    at = np.minimum(np.searchsorted(frequent, h), len(frequent) - 1)
                    hit = frequent[at] == h
                    salt[hit] = (mix(doc[hit].astype(np.uint64)) % parts[at[hit]].astype(np.uint64)).astype(np.int32) + 1
                share = (mix(h ^ mix(salt.astype(np.uint64))) % np.uint64(shares)).astype(np.int64)
                order = order_by(share)
                share, h, doc, p, salt = share[order], h[order], doc[order], p[order], salt[order]
                edge = np.concatenate([[0], np.flatnonzero(share[1:] != share[:-1]) + 1, [len(share)]])
                new = np.ones(len(h), dtype=bool)  # the beginning of a document in a share
                new[1:] = (share[1:] != share[:-1]) | (doc[1:] != doc[:-1])
                step = p.copy()  # places as distances from the one before
                step[1:] -= np.where(new[1:], 0, p[:-1])
                begin = np.flatnonzero(new)
                count = np.diff(np.append(begin, len(h))).astype(np.uint32)
                first = np.searchsorted(begin, edge)
                rows: list[list[bytes]] = [[], [], [], [], []]
                for i, j, f, g in zip(edge[:-1].tolist(), edge[1:].tolist(), first[:-1].tolist(), first[1:].tolist(), strict=True):
                    rows[0].append(planes(h[i:j])[: KEY_BYTES * (j - i)])
                    rows[1].append(planes(doc[begin[f:g]]))
                    rows[2].append(planes(count[f:g]))
                    rows[3].append(planes(step[i:j].astype(np.int32)))
                    rows[4].append(planes(salt[i:j]) if salt[i:j].any() else b"")
                yield pa.RecordBatch.from_arrays([pa.array(share[edge[:-1]], pa.int32()), *(pa.array(r, pa.binary()) for r in rows)], names=["share", "keys", "docs", "counts", "places", "salts"])

    return docs.transform(map_batches, read, SEEDS)


def led_places(seeds: DataFrame, shares: int, apart: int) -> DataFrame:
    """Every place of a seed with the first place (smallest document) of its list; lists in one text alone are left out.

    The key is given for salted lists, whose leaders are linked later, and is 0 elsewhere. A long seed gives two anchors, `apart`
    words from one another: its first and its last k words. Seeds of both lengths have lists of their own.
    """

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for batch in batches:
            for keys, docs, counts, steps, salts in zip(*(batch.column(i).to_pylist() for i in range(1, 6)), strict=True):
                n = len(steps) // 4
                count = numbers(counts, np.uint32).astype(np.int64)
                total = np.cumsum(numbers(steps, np.int32), dtype=np.int64)
                begin = np.cumsum(count) - count
                before = np.where(begin > 0, total[begin - 1], 0)
                places = (total - np.repeat(before, count)).astype(np.int32)
                held.append([numbers(keys + bytes((8 - KEY_BYTES) * n), np.uint64), np.repeat(numbers(docs, np.int64), count), places, numbers(salts, np.int32) if salts else np.zeros(n, dtype=np.int32)])
        if not held:
            return
        key, doc, pos, salt = (np.concatenate(v) for v in zip(*held, strict=True))
        held.clear()
        order = np.argsort(key)
        same = key[order[1:]] == key[order[:-1]]
        order = order[np.append(same, False) | np.append(False, same)]  # most seeds stand at one place alone
        key, doc, pos, salt = key[order], doc[order], pos[order], salt[order]
        order = np.lexsort((pos, doc, 2 * salt + (pos & 1), key))
        key, doc, pos, salt = key[order], doc[order], pos[order], salt[order]
        del order
        begin = np.ones(len(key), dtype=bool)
        begin[1:] = (key[1:] != key[:-1]) | (salt[1:] != salt[:-1]) | ((pos[1:] & 1) != (pos[:-1] & 1))
        first = np.flatnonzero(begin)[np.cumsum(begin) - 1]
        # the leader's own row is given for salted lists alone: there it stands for its part
        give = np.flatnonzero((doc != doc[first]) | ((salt > 0) & begin))
        for i in range(0, len(give), 100_000):
            at = give[i : i + 100_000]
            both = pos[at] & 1
            at, late = np.repeat(at, 1 + both), np.repeat(np.arange(len(at)), 1 + both)
            late = np.append(False, late[1:] == late[:-1]).astype(np.int32) * apart
            led = first[at]
            part = (late + (pos[at] & 1)).astype(np.uint64) << np.uint64(8 * KEY_BYTES)  # of a short seed, a long one's first or last words
            own = np.where(salt[at] > 0, mix(key[at] + part), np.uint64(0)).view(np.int64)
            rows = [own, salt[at], doc[at], (pos[at] >> 1) + late, doc[led], (pos[led] >> 1) + late]
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in rows], names=["key", "salt", "doc", "pos", "lead", "lead_pos"])

    return seeds.repartitionById(shares, F.col("share")).transform(map_batches, lead, ANCHORS)


class GreatestInRange:
    """Greatest value over a range of places, where values come and go in one order."""

    def __init__(self, n: int):
        self.size = n
        self.best: list[tuple[float, int]] = [(float("-inf"), -1)] * (2 * n)
        self.held: list[deque[tuple[float, int]]] = [deque() for _ in range(n)]

    def _show(self, i: int) -> None:
        own = self.held[i]
        i += self.size
        self.best[i] = own[0] if own else (float("-inf"), -1)
        while i > 1:
            i //= 2
            self.best[i] = max(self.best[2 * i], self.best[2 * i + 1])

    def put(self, i: int, value: tuple[float, int]) -> None:
        own = self.held[i]
        while own and own[-1] < value:  # goes earlier and is less: never the greatest again
            own.pop()
        own.append(value)
        self._show(i)

    def drop(self, i: int, j: int) -> None:
        if self.held[i] and self.held[i][0][1] == j:
            self.held[i].popleft()
            self._show(i)

    def between(self, i: int, j: int) -> tuple[float, int]:
        """Over places i to j - 1."""
        out = (float("-inf"), -1)
        i, j = i + self.size, j + self.size
        while i < j:
            if i & 1:
                out = max(out, self.best[i])
                i += 1
            if j & 1:
                j -= 1
                out = max(out, self.best[j])
            i, j = i // 2, j // 2
        return out


def diagonal_runs(x: np.ndarray, y: np.ndarray, k: int, reach: int) -> list[tuple[int, int, int]]:
    """Anchors on one diagonal, each within `reach` of the last, as (x, y, words)."""
    diagonal = x - y
    order = np.lexsort((x, diagonal))
    x, y, diagonal = x[order], y[order], diagonal[order]
    begin = np.ones(len(x), dtype=bool)
    begin[1:] = (diagonal[1:] != diagonal[:-1]) | (x[1:] - x[:-1] > reach)
    starts = np.flatnonzero(begin)
    ends = np.append(starts[1:], len(x)) - 1
    return sorted(zip(x[starts].tolist(), y[starts].tolist(), (x[ends] - x[starts] + k).tolist(), strict=True))


def chain(runs: list[tuple[int, int, int]], gap_cost: float = 0.5, most_gap: int = 60) -> list[list[tuple[int, int, int]]]:
    """Best collinear chains of runs, each run in one chain.

    f(i) = words(i) + max over j that end before i in both texts, by most_gap words at most, of f(j) - gap_cost * (gap in x + gap in y):
    the costs split into a part of j and a part of i, so the maximum is a range query on where j ends in the second text. Runs
    enter the tree in the order in which they end in the first text, and leave it in that order when they are out of reach.
    """
    if len(runs) == 1:
        return [runs]
    ends = sorted({y + n for _, y, n in runs})
    place = [bisect.bisect_left(ends, y + n) for _, y, n in runs]
    tree = GreatestInRange(len(ends))
    score, back = [0.0] * len(runs), [-1] * len(runs)
    waiting = sorted(range(len(runs)), key=lambda i: runs[i][0] + runs[i][2])
    w = gone = 0
    for i, (x, y, n) in enumerate(runs):
        while w < len(waiting) and runs[waiting[w]][0] + runs[waiting[w]][2] <= x and waiting[w] < i:
            j = waiting[w]
            xj, yj, nj = runs[j]
            tree.put(place[j], (score[j] + gap_cost * (xj + nj + yj + nj), j))
            w += 1
        while gone < w and x - runs[waiting[gone]][0] - runs[waiting[gone]][2] > most_gap:
            tree.drop(place[waiting[gone]], waiting[gone])
            gone += 1
        best, j = tree.between(bisect.bisect_left(ends, y - most_gap), bisect.bisect_right(ends, y))
        score[i] = float(n)
        if j >= 0:
            gain = best - gap_cost * (x + y)
            if gain > 0:
                score[i], back[i] = n + gain, j
    used = [False] * len(runs)
    out = []
    for i in sorted(range(len(runs)), key=lambda i: (-score[i], i)):
        own, j = [], i
        while j >= 0 and not used[j]:
            used[j] = True
            own.append(runs[j])
            j = back[j]
        if own:
            out.append(own[::-1])
    return out


def chain_pairs(anchors: DataFrame, k: int, reach: int, least: int) -> DataFrame:
    """The chains of every pair (x, y) of texts that span `least` words or more; anchors are flat (x, y, words) triples."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def pairs(x: list[np.ndarray]):
            edge = np.flatnonzero(np.concatenate([[True], (x[0][1:] != x[0][:-1]) | (x[1][1:] != x[1][:-1]), [True]]))
            rows = []
            span = np.maximum(*(np.maximum.reduceat(v, edge[:-1]) - np.minimum.reduceat(v, edge[:-1]) for v in x[2:])) + k
            wide = np.flatnonzero(span >= least)  # most pairs share a few places by chance: no chain spans more than all of them do
            for a, b in zip(edge[wide].tolist(), edge[wide + 1].tolist(), strict=True):
                for own in chain(diagonal_runs(x[2][a:b], x[3][a:b], k, reach)):
                    x0, x1 = own[0][0], max(r[0] + r[2] for r in own)
                    y0, y1 = own[0][1], max(r[1] + r[2] for r in own)
                    if max(x1 - x0, y1 - y0) >= least:
                        rows.append((int(x[0][a]), int(x[1][a]), x0, x1, y0, y1, [v for r in own for v in r]))
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["x", "y", "x0", "x1", "y0", "y1", "anchors"])

        for batch in batches:
            x = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            x = [x[0], x[1], x[2].astype(np.int64), x[3].astype(np.int64)]
            if held and (held[-1][0][-1], held[-1][1][-1]) != (x[0][0], x[1][0]):
                yield from pairs([np.concatenate(c) for c in zip(*held, strict=True)])
                held = []
            new = np.flatnonzero((x[0][1:] != x[0][:-1]) | (x[1][1:] != x[1][:-1])) + 1
            if len(new):  # the last pair may go on
                held.append([c[: new[-1]] for c in x])
                yield from pairs([np.concatenate(c) for c in zip(*held, strict=True)])
                held, x = [], [c[new[-1] :] for c in x]
            held.append(x)
        if held:
            yield from pairs([np.concatenate(c) for c in zip(*held, strict=True)])

    return anchors.select("x", "y", "px", "py").repartition("x", "y").sortWithinPartitions("x", "y", "px", "py").transform(map_batches, read, CHAINS)


def _extend(a: np.ndarray, b: np.ndarray, drop: int = 4) -> tuple[int, int]:
    """Words to go on, and matches among them, while a match gives 1, a mismatch takes 1 and the sum stays near its best."""
    n = min(len(a), len(b))
    total = best = same = 0
    out = 0, 0
    for i, hit in enumerate((a[:n] == b[:n]).tolist()):  # a few words: a loop that ends early takes less time than whole arrays
        total += 1 if hit else -1
        same += hit
        if total > best:
            best, out = total, (i + 1, same)
        elif best - total > drop:
            break
    return out


def _gap(a: np.ndarray, b: np.ndarray) -> int:
    """Matches of a best global alignment of two short word sequences."""
    if not len(a) or not len(b):
        return 0
    if len(a) == len(b):
        same = int((a == b).sum())
        if same >= len(a) - 1:
            return same
    row = np.zeros(len(b) + 1, dtype=np.int64)
    for w in a:
        new = row.copy()
        new[1:] = np.maximum(row[1:], row[:-1] + (b == w))
        row = np.maximum.accumulate(new)
    return int(row[-1])


def align(x: np.ndarray, y: np.ndarray, runs: list[tuple[int, int, int]], x_at: int, y_at: int) -> tuple[int, int, int, int, int]:
    """The chain's ends in both texts and its matching words; x, y: word hashes from word x_at and y_at on."""
    matches, px, py = 0, None, None
    for rx, ry, n in runs:
        a, b = rx - x_at, ry - y_at
        if px is not None:
            if a < px or b < py:  # runs may overlap in one text by a few words
                cut_ = max(px - a, py - b)
                a, b, n = a + cut_, b + cut_, n - cut_
                if n <= 0:
                    continue
            matches += _gap(x[px:a], y[py:b])
        matches += int((x[a : a + n] == y[b : b + n]).sum())
        px, py = a + n, b + n
    left, m1 = _extend(x[: runs[0][0] - x_at][::-1], y[: runs[0][1] - y_at][::-1])
    right, m2 = _extend(x[px:], y[py:])
    return runs[0][0] - left, x_at + px + right, runs[0][1] - left, y_at + py + right, matches + m1 + m2


def aligned_chains(chains: DataFrame, docs: DataFrame, margin: int, identity: float, least: int, group: int = 500) -> DataFrame:
    """Aligned spans (doc, from_word, to_word, other, other_from, other_to, identity) of the chains.

    Only the words of each chain's ends and margin leave the documents, as 64-bit hashes; a text is sent once to about `group` chains.
    """
    chains = cut(chains.withColumn("chain", F.monotonically_increasing_id()), "chains")
    x = chains.select(F.col("x").alias("doc_id"), "chain", F.lit(0).alias("side"), F.col("x0").alias("a"), F.col("x1").alias("b"))
    y = chains.select(F.col("y").alias("doc_id"), "chain", F.lit(1).alias("side"), F.col("y0").alias("a"), F.col("y1").alias("b"))
    ends = cut(x.unionByName(y), "chain-ends")
    many = maybe_broadcast(cut(ends.groupBy("doc_id").count().where(F.col("count") > group).select("doc_id", F.ceil(F.col("count") / group).alias("parts")), "hubs"))
    part = F.pmod(F.xxhash64("chain"), F.coalesce("parts", F.lit(1)))
    few = small(ends, 400_000)
    spans = ends.join(many, "doc_id", "left").groupBy("doc_id", part.alias("part")).agg(F.collect_list(F.struct("chain", "side", "a", "b")).alias("spans"))
    met = docs.join(F.broadcast(spans) if few else spans, "doc_id").select("text", "spans")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            for i, j in slices(offsets):
                w = Words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                h, first = w.hashes(), w.first.tolist()
                chain, side, low, words = [], [], [], []
                for d, own in enumerate(batch.column(1).slice(i, j - i).to_pylist()):
                    for r in own:
                        p = max(r["a"] - margin, 0)
                        chain.append(r["chain"])
                        side.append(r["side"])
                        low.append(p)
                        words.append(h[first[d] + p : min(first[d] + r["b"] + margin, first[d + 1])].tobytes())
                        if len(words) >= 5000:
                            yield pa.RecordBatch.from_arrays([pa.array(chain, pa.int64()), pa.array(side, pa.int32()), pa.array(low, pa.int32()), pa.array(words, pa.binary())], names=["chain", "side", "low", "words"])
                            chain, side, low, words = [], [], [], []
                if words:
                    yield pa.RecordBatch.from_arrays([pa.array(chain, pa.int64()), pa.array(side, pa.int32()), pa.array(low, pa.int32()), pa.array(words, pa.binary())], names=["chain", "side", "low", "words"])

    words = met.transform(map_batches, fetch, "chain long, side int, low int, words binary")
    one = words.groupBy("chain").agg(*(F.max(F.when(F.col("side") == s, F.col(c))).alias(f"{c}{s}") for s in (0, 1) for c in ("low", "words")))
    joined = chains.join(one, "chain")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            ids = [batch.column(i).to_pylist() for i in range(7)]
            for n, (doc, other, flat, low0, low1, words0, words1) in enumerate(zip(*ids, strict=True)):
                if words0 is None or words1 is None:
                    continue
                runs = list(zip(flat[::3], flat[1::3], flat[2::3], strict=True))
                x0, x1, y0, y1, same = align(np.frombuffer(words0, np.uint64), np.frombuffer(words1, np.uint64), runs, low0, low1)
                share = same / max(1, max(x1 - x0, y1 - y0))
                if share >= identity and max(x1 - x0, y1 - y0) >= least:
                    rows.append((doc, x0, x1, other, y0, y1, share))
            if rows:
                kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["doc_id", "from_word", "to_word", "other_id", "other_from", "other_to", "identity"])

    schema = "doc_id long, from_word int, to_word int, other_id long, other_from int, other_to int, identity double"
    return joined.select("x", "y", "anchors", "low0", "low1", "words0", "words1").transform(map_batches, read, schema)


def repeated_passages(
    df: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    k: int = 5,
    reach: int = 13,
    min_words: int = 50,
    identity: float = 0.8,
    most_frequent: int = 1_000_000,
    long: int = 12,
    window: int = 8,
    hot: int = 200,
    share_seeds: int = 1_000_000,
) -> tuple[DataFrame, DataFrame]:
    """(spans, copies). spans: aligned spans of a document's text with an earlier document's; copies: doc_id, source_id, n_words of equal texts.

    Spans may be shorter than min_words: passages() merges what touches and keeps the long ones. most_frequent bounds the broadcast list of
    seeds to salt (16 bytes each, the most frequent first); it spreads work and leaves nothing out. reach: words between anchors of a run,
    and words beside a chain that are aligned too. share_seeds: about how many seeds a task sorts at once.
    """
    docs = df.where(named(id_col).isNotNull()).select(named(id_col).cast("long").alias("doc_id"), named(text).cast("string").alias("text"))
    found = cut(read_texts(docs, k, long, window, hot), "texts")
    texts = found.where("kind = 0 and n > 0").select("doc_id", "n", "sig")
    first = cut(texts.groupBy("sig").agg(F.min("doc_id").alias("source_id"), F.count(F.lit(1)).alias("copies")).where("copies > 1").select("sig", "source_id"), "sources")
    copies = cut(texts.join(first, "sig").where("doc_id <> source_id").select("doc_id", "source_id", F.col("n").alias("n_words")).distinct(), "copies")
    frequent = found.where("kind = 1").groupBy("key").agg(F.sum("c").alias("c")).where(F.col("c") >= hot).orderBy(F.desc("c"), "key").limit(most_frequent).toPandas()
    keys = frequent["key"].to_numpy("int64").view(np.uint64)
    order = np.argsort(keys)
    parts = np.maximum(1, frequent["c"].to_numpy("int64")[order] // (2 * hot))
    single = docs.where("text is not null").join(maybe_broadcast(copies.select("doc_id")), "doc_id", "left_anti")
    shares = max(1, -(-(texts.agg(F.sum("n")).first()[0] or 0) // share_seeds))
    places = cut(led_places(seed_rows(single, k, long, window, keys[order], parts, shares), shares, long - k), "places")
    # parts of frequent seeds: their leaders with the first of them
    c = F.col
    leaders = cut(places.where("salt > 0").select("key", "lead", "lead_pos").distinct(), "part-leaders")
    head = leaders.groupBy("key").agg(F.min(F.struct("lead", "lead_pos")).alias("h")).select("key", c("h.lead").alias("y"), c("h.lead_pos").alias("py"))
    across = leaders.join(cut(head, "heads"), "key").where("lead <> y").select(c("lead").alias("x"), "y", c("lead_pos").alias("px"), "py")
    anchors = places.where("doc <> lead").select(c("doc").alias("x"), c("lead").alias("y"), c("pos").alias("px"), c("lead_pos").alias("py")).unionByName(across)
    chains = chain_pairs(anchors, k, reach, min_words // 4)
    return aligned_chains(chains, single, reach, identity, min_words // 4), copies


def passages(spans: DataFrame, copies: DataFrame, min_words: int = 50, touch: int = 3, both_sides: bool = True) -> DataFrame:
    """Merged passages (doc_id, from_word, to_word, source_id, is_source): spans of one document that overlap or are `touch` words apart.

    source_id: the smallest document that any of the spans matches. With both_sides the sources' own spans are given too.
    """
    c = F.col
    own = spans.select("doc_id", "from_word", "to_word", c("other_id").alias("source_id"), F.lit(False).alias("is_source"))
    if both_sides:
        other = spans.select(c("other_id").alias("doc_id"), c("other_from").alias("from_word"), c("other_to").alias("to_word"), c("other_id").alias("source_id"), F.lit(True).alias("is_source"))
        own = own.unionByName(other.distinct())
    # spans of a text fall on at most as many places as it has words: first the longest from each place
    w = own.groupBy("doc_id", "is_source", "from_word").agg(F.max("to_word").alias("to_word"), F.min("source_id").alias("source_id"))
    order = Window.partitionBy("doc_id", "is_source").orderBy("from_word")
    w = w.withColumn("new", F.coalesce((c("from_word") > F.max("to_word").over(order.rowsBetween(Window.unboundedPreceding, -1)) + touch).cast("int"), F.lit(1)))
    w = w.withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = w.groupBy("doc_id", "is_source", "island").agg(F.min("from_word").alias("from_word"), F.max("to_word").alias("to_word"), F.min("source_id").alias("source_id")).drop("island")
    whole = copies.select("doc_id", F.lit(False).alias("is_source"), F.lit(0).alias("from_word"), c("n_words").cast("int").alias("to_word"), "source_id")
    if both_sides:
        whole = whole.unionByName(copies.select(c("source_id").alias("doc_id"), F.lit(True).alias("is_source"), F.lit(0).alias("from_word"), c("n_words").cast("int").alias("to_word"), "source_id").distinct())
    return merged.unionByName(whole).where(c("to_word") - c("from_word") >= min_words).select("doc_id", "from_word", "to_word", "source_id", "is_source")


def remove_passages(df: DataFrame, found: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The table without the passages' words (white space before each of them goes too); texts that lose every word go."""
    whose, gone_ = unused(df, "span_doc"), unused(df, "spans")
    spans = cut(found.groupBy("doc_id").agg(F.collect_set(F.struct("from_word", "to_word")).alias("spans")).select(F.col("doc_id").alias(whose), F.col("spans").alias(gone_)), "removed")
    joined = df.join(maybe_broadcast(spans, 500_000), named(id_col).cast("long") == F.col(whose), "left")
    names, at, schema = df.columns, df.columns.index(text), df.schema

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, dtype=bool)
            texts = batch.column(at).to_pylist()
            spans = batch.column(batch.num_columns - 1)
            for i in np.flatnonzero(spans.is_valid().to_numpy(zero_copy_only=False)).tolist():
                column = pa.array([texts[i]], pa.string())
                w = Words(*text_bytes(column))
                gone = np.zeros(len(w.starts) + 1, dtype=bool)
                for s in spans[i].as_py():
                    gone[s["from_word"] : s["to_word"]] = True
                gone[-1] = False
                raw, out, last = texts[i].encode(), [], 0
                for j in np.flatnonzero(gone).tolist():
                    out.append(raw[last : w.ends[j - 1] if j else 0])
                    last = int(w.ends[j])
                out.append(raw[last:])
                keep[i] = not gone[:-1].all()
                texts[i] = b"".join(out).decode()
            columns = [batch.column(j) for j in range(batch.num_columns - 1)]
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(keep))

    return joined.select(*columns_of(df), gone_).transform(map_batches, read, schema)


def op10_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans, copies = repeated_passages(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return passages(cut(spans, "spans"), copies)


QUERIES = {"op10_chains": op10_chains}
ORACLES: dict[str, str] = {}
