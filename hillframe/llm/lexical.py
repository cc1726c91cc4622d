"""Ranked lexical search: every item's best documents, found best first over document intervals.

Terms are folded runs of letters and digits. Documents are read once into packed postings (document, term, occurrences) of the items' terms,
with the counts that weights need; a second step searches them in shards of a few thousand documents.

In a shard every term has a posting list with the impact of each document and a sparse table of range maxima over it, so the greatest
impact within any interval of documents takes two look-ups. The sum of these maxima over an item's terms bounds every score in an
interval. Each item keeps a queue of intervals: the ones with the greatest bounds are taken, their document of maximum impact is scored, and
what is left on both sides of it goes back with bounds of its own; an interval of few documents is scored whole. An item is done when no
bound reaches its last rank's score. That score is carried from shard to shard within a task. Within a shard documents stand in hash order, so
that no order of the table makes the splits uneven. All numbers are 64-bit integers and the result is exact.

Items come in blocks of bounded size, which are broadcast one at a time.

Defined results: null texts have no terms and no score; items without terms, or whose terms no document holds, have no rows; documents that
repeat are ranked each; rows with a null id count in the statistics and are not ranked; items of one id are ranked each; an empty table
gives no rows; other columns are ignored. Terms are compared as 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Words, cut, map_batches, mix, named, numbers, planes, slices, text_bytes

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
POSTINGS = "kind int, docs binary, lengths binary, who binary, term binary, tf binary, key int, df long, words long"
HITS = "item int, doc_id long, score long"
APART = np.zeros(256, dtype=bool)
APART[:128] = True
for _low, _high in ((48, 58), (65, 91), (97, 123)):
    APART[_low:_high] = False


def items_with_terms(items: DataFrame, id_col: str, text: str) -> DataFrame:
    """item_id and the distinct terms of every item that has some."""
    folded = F.translate(named(text).cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = F.array_sort(F.array_distinct(F.regexp_extract_all(folded, F.lit(TERM), F.lit(0))))
    return items.select(named(id_col).alias("item_id"), terms.alias("terms")).where("size(terms) > 0")


def term_hashes(terms: list[str]) -> np.ndarray:
    """The hashes that the terms have as words of a text."""
    data, offsets = text_bytes(pa.array(terms, pa.string()))
    return Words(data, offsets, APART).hashes()


def read_postings(docs: DataFrame, terms: np.ndarray) -> DataFrame:
    """kind 0: postings of a slice of documents; kind 1: documents that hold term `key`; kind 2: documents with terms, and all their terms.

    terms: sorted hashes; a term's number is its place there.
    """
    known = docs.sparkSession.sparkContext.broadcast(terms)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = known.value
        df, documents, words = np.zeros(len(terms), dtype=np.int64), 0, 0
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            ids = batch.column(0).fill_null(0).to_numpy()
            alive = ~batch.column(0).is_null().to_numpy(zero_copy_only=False)
            for a, b in slices(offsets):
                w = Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], APART)
                documents += int((w.n > 0).sum())
                words += int(w.n.sum())
                h = w.hashes()
                at = np.minimum(np.searchsorted(terms, h), len(terms) - 1)
                hit = terms[at] == h
                pair, tf = np.unique(w.doc[hit] * len(terms) + at[hit], return_counts=True)
                who, term = pair // len(terms), pair % len(terms)
                df += np.bincount(term, minlength=len(terms))
                keep = alive[a:b][who]
                who, term, tf = who[keep], term[keep], tf[keep]
                if len(who):
                    packed = (ids[a:b], w.n.astype(np.int64), who.astype(np.uint32), term.astype(np.uint32), tf.astype(np.uint32))
                    yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), *(pa.array([planes(x)], pa.binary()) for x in packed), *(pa.array([0], t) for t in (pa.int32(), pa.int64(), pa.int64()))], names=names)
        key = np.append(np.flatnonzero(df), 0)
        kind = np.append(np.full(len(key) - 1, 1), 2)
        nothing = pa.array([None] * len(key), pa.binary())
        counts = np.append(df[key[:-1]], documents)
        yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), *[nothing] * 5, pa.array(key, pa.int32()), pa.array(counts), pa.array(np.where(kind == 2, words, 0))], names=names)

    names = ["kind", "docs", "lengths", "who", "term", "tf", "key", "df", "words"]
    return docs.transform(map_batches, read, POSTINGS)


class RangeMaxima:
    """Posting lists of one shard, one after the other, with sparse tables of the place of the greatest impact.

    Row j of `best` has, for every posting p, the place of the greatest impact among p .. p + 2^j - 1; across the end of a list it means nothing and is never asked.
    """

    def __init__(self, impact: np.ndarray, longest: int):
        self.impact = impact
        self.best = [np.arange(len(impact), dtype=np.int32)]
        self.log = np.zeros(longest + 2, dtype=np.int8)
        for i in range(2, len(self.log)):
            self.log[i] = self.log[i >> 1] + 1
        j = 1
        while (1 << j) <= longest:
            last = self.best[-1]
            other = last[np.minimum(np.arange(len(last)) + (1 << (j - 1)), len(last) - 1)]
            self.best.append(np.where(impact[other] > impact[last], other, last))
            j += 1
        self.best = np.stack(self.best)

    def places(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The place of the greatest impact in every [low, high); none of them is empty."""
        j = self.log[high - low].astype(np.int64)
        one, two = self.best[j, low], self.best[j, high - (1 << j)]
        return np.where(self.impact[two] > self.impact[one], two, one)


class Best:
    """The best documents of every item so far: score, document and item, in order of item, score and document."""

    def __init__(self, items: int, top: int):
        self.items, self.top = items, top
        self.item, self.doc, self.score = (np.zeros(0, dtype=np.int64) for _ in range(3))
        self.floor = np.ones(items, dtype=np.int64)  # what the last rank's score is, or 1 while ranks are free

    def add(self, item: np.ndarray, doc: np.ndarray, score: np.ndarray) -> None:
        take = score >= self.floor[item]
        if not take.any():
            return
        item, doc, score = (np.concatenate(x) for x in ((self.item, item[take]), (self.doc, doc[take]), (self.score, score[take])))
        order = np.lexsort((doc, -score, item))
        item, doc, score = item[order], doc[order], score[order]
        begin = np.searchsorted(item, np.arange(self.items))
        rank = np.arange(len(item)) - begin[item]
        keep = rank < self.top
        self.item, self.doc, self.score = item[keep], doc[keep], score[keep]
        last = rank == self.top - 1
        self.floor[item[last]] = score[last]


def search_shard(best: Best, first: np.ndarray, terms: np.ndarray, ids: np.ndarray, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, whole: int = 32, at_once: int = 150_000) -> int:
    """Adds the shard's best documents to `best`; returns how many documents were scored, over all items.

    first, terms: the items' term numbers, those of item i from first[i] on; ids: the shard's documents; doc, term, impact: postings.
    whole: an interval of at most so many documents is scored as it is. at_once: about how many (interval, term) pairs are looked up together.
    """
    items, size = len(first) - 1, len(ids)
    order = np.lexsort((doc, term))
    doc, term, impact = doc[order], term[order], impact[order]
    key = term * np.int64(size + 1) + doc
    longest = int(np.bincount(term).max())
    maxima = RangeMaxima(impact, longest)
    count = np.diff(first)
    width = max(1, at_once // max(1, len(terms)))

    def pairs(item: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of every interval's item: the interval's number and the term, for each of its terms."""
        n = count[item]
        of = np.repeat(np.arange(len(item)), n)
        return of, terms[np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[item], n)]

    def bounds(item, low, high):
        of, t = pairs(item)
        a = np.searchsorted(key, t * np.int64(size + 1) + low[of])
        b = np.searchsorted(key, t * np.int64(size + 1) + high[of])
        some = a < b
        of, place = of[some], maxima.places(a[some], b[some])
        total = np.bincount(of, impact[place], len(item)).astype(np.int64)  # sums below 2^53 are exact
        return total, of, place

    item = np.arange(items)
    low, high = np.zeros(items, dtype=np.int64), np.full(items, size, dtype=np.int64)
    bound, _, _ = bounds(item, low, high)
    scored = 0
    while True:
        keep = bound >= best.floor[item]
        item, low, high, bound = item[keep], low[keep], high[keep], bound[keep]
        if not len(item):
            return scored
        order = np.lexsort((-bound, item))  # best first, within each item
        item, low, high, bound = item[order], low[order], high[order], bound[order]
        take = np.arange(len(item)) - np.searchsorted(item, item) < width
        now = item[take], low[take], high[take]
        rest = item[~take], low[~take], high[~take], bound[~take]
        few = now[2] - now[1] <= whole
        # intervals of few documents: every posting in them counts for its document
        i, a, b = (x[few] for x in now)
        if len(i):
            of, t = pairs(i)
            p, q = np.searchsorted(key, t * np.int64(size + 1) + a[of]), np.searchsorted(key, t * np.int64(size + 1) + b[of])
            n = q - p
            posting = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n - p, n)
            cell = np.repeat(of, n) * whole + doc[posting] - np.repeat(a[of], n)
            total = np.bincount(cell, impact[posting], len(i) * whole).astype(np.int64)
            have = np.flatnonzero(total)
            best.add(i[have // whole], ids[a[have // whole] + have % whole], total[have])
            scored += int((b - a).sum())
        # larger ones: score the document of maximum impact and go on with both sides
        i, a, b = (x[~few] for x in now)
        if len(i):
            _, of, place = bounds(i, a, b)
            top = np.lexsort((impact[place], of))
            split = doc[place[top[np.append(of[top][1:] != of[top][:-1], True)]]]  # every interval kept has a posting
            of, t = pairs(i)
            at = np.minimum(np.searchsorted(key, t * np.int64(size + 1) + split[of]), len(key) - 1)
            mine = key[at] == t * np.int64(size + 1) + split[of]
            best.add(i, ids[split], np.bincount(of[mine], impact[at[mine]], len(i)).astype(np.int64))
            scored += len(i)
            i, a, b = np.concatenate([i, i]), np.concatenate([a, split + 1]), np.concatenate([split, b])
            i, a, b = (x[a < b] for x in (i, a, b))
            item, low, high, bound = (np.concatenate(x) for x in zip(rest, (i, a, b, bounds(i, a, b)[0]), strict=True))
        else:
            item, low, high, bound = rest


def search(postings: DataFrame, first: np.ndarray, terms: np.ndarray, weight: np.ndarray, documents: int, words: int, top: int, most_documents: int = 4096, most_postings: int = 1_000_000) -> DataFrame:
    """item, doc_id, score: the best `top` documents of every item among those of each task. A shard has at most about most_documents documents and most_postings postings."""
    known = postings.sparkSession.sparkContext.broadcast((first, terms, weight))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, terms, weight = known.value
        best = Best(len(first) - 1, top)
        held: list[tuple[np.ndarray, ...]] = []

        def run() -> None:
            ids = np.concatenate([x[0] for x in held])
            base = np.cumsum([0, *(len(x[0]) for x in held)])
            who = np.concatenate([x[1] + b for x, b in zip(held, base, strict=False)])
            place = np.empty(len(ids), dtype=np.int64)
            place[np.argsort(mix(ids.view(np.uint64)), kind="stable")] = np.arange(len(ids))
            ordered = np.empty_like(ids)
            ordered[place] = ids
            search_shard(best, first, terms, ordered, place[who], np.concatenate([x[2] for x in held]), np.concatenate([x[3] for x in held]))
            held.clear()

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                ids, n, who, term, tf = (numbers(x, t) for x, t in zip(row, (np.int64, np.int64, np.uint32, np.uint32, np.uint32), strict=True))
                who, term, tf = who.astype(np.int64), term.astype(np.int64), tf.astype(np.int64)
                m = 100 - 50 + (50 * n * documents) // words
                impact = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[who]))
                for a in range(0, len(ids), most_documents):  # a slice of many short texts
                    i, j = np.searchsorted(who, [a, a + most_documents])
                    part = ids[a : a + most_documents]
                    if held and (sum(len(x[0]) for x in held) + len(part) > most_documents or sum(len(x[1]) for x in held) + j - i > most_postings):
                        run()
                    if j > i:
                        held.append((part, who[i:j] - a, term[i:j], impact[i:j]))
        if held:
            run()
        yield pa.RecordBatch.from_arrays([pa.array(best.item, pa.int32()), pa.array(best.doc), pa.array(best.score)], names=["item", "doc_id", "score"])

    return postings.transform(map_batches, read, HITS)


def ranked_search(docs: DataFrame, items: DataFrame, top: int = 50, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", block_terms: int = 50_000) -> DataFrame:
    """item_id, rank, doc_id, score: the `top` best documents of every item, equal scores by document.

    Items are searched in blocks of about block_terms terms of items, one broadcast each; the postings of a block are written once.
    """
    spark = docs.sparkSession
    asked = cut(items_with_terms(items, item_id, item_text), "items")
    blocks = -(-(asked.agg(F.sum(F.size("terms"))).first()[0] or 0) // block_terms)
    rows = docs.select(named(id_col).cast("long").alias("doc_id"), named(text).cast("string").alias("text"))
    out = None
    for block in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("terms", "item_id"), F.lit(blocks)) == block).collect() if blocks > 1 else asked.collect()
        if not own:
            continue
        words = sorted({t for r in own for t in r["terms"]})
        hashes = term_hashes(words)
        order = np.argsort(hashes)
        if (hashes[order][1:] == hashes[order][:-1]).any():
            raise ValueError("two terms have the same hash")
        number = {words[j]: i for i, j in enumerate(order.tolist())}
        first = np.cumsum([0, *(len(r["terms"]) for r in own)])
        terms = np.array([number[t] for r in own for t in r["terms"]], dtype=np.int64)
        postings = cut(read_postings(rows, hashes[order]), "postings")
        counts = postings.where("kind > 0").groupBy("kind", "key").agg(F.sum("df").alias("df"), F.sum("words").alias("words"))
        total = counts.where("kind = 2").first()
        if total is None or not total["words"]:
            continue
        w = F.floor(F.lit(1000) * F.log(F.lit(2.0 * total["df"] + 2) / (2 * F.col("df") + 1).cast("double")))
        weight = np.zeros(len(words), dtype=np.int64)
        for r in counts.where("kind = 1").select("key", w.alias("w")).collect():
            weight[r["key"]] = r["w"]
        lists = postings.where("kind = 0").select("docs", "lengths", "who", "term", "tf")
        found = search(lists, first, terms, weight, total["df"], total["words"], top)
        ids = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(own)], f"item int, item_id {asked.schema['item_id'].dataType.simpleString()}")
        # the best of every task, then of some of them, then of all: no task gets the rows of all others
        spread = F.pmod(F.xxhash64("doc_id"), F.lit(64))
        order_ = [F.desc("score"), F.asc("doc_id")]
        found = found.withColumn("part", spread).withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order_))).where(F.col("rank") <= top)
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order_))).where(F.col("rank") <= top)
        found = found.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    kind = asked.schema["item_id"].dataType.simpleString()
    return out if out is not None else spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return ranked_search(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


OP12_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws
  FROM documents),
c AS (SELECT count(*) AS n, CAST(sum(len(ws)) AS BIGINT) AS l FROM w WHERE len(ws) > 0),
p AS (SELECT doc_id, len, term, count(*) AS tf FROM (SELECT doc_id, len(ws) AS len, unnest(ws) AS term FROM w) GROUP BY ALL),
d AS (SELECT term, count(*) AS df FROM p GROUP BY term),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
s AS (
  SELECT q.item_id, p.doc_id, CAST(sum(CAST(floor(1000 * ln(CAST(2 * c.n + 2 AS DOUBLE) / (2 * d.df + 1))) AS BIGINT) * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * p.len * c.n) // c.l)))) AS BIGINT) AS score
  FROM q JOIN d USING (term) JOIN p USING (term) CROSS JOIN c GROUP BY 1, 2)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= 50
"""
QUERIES = {"op12_lexical": op12_lexical}
ORACLES = {"op12_lexical": OP12_SQL}
