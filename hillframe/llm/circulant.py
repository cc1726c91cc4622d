"""Circulant MinHash: near-duplicate classes from two permutations, one of them shifted.

A set is the distinct k-word shingles of a whole text, each as a 64-bit hash. Two fixed permutations of the 64-bit numbers give the
whole signature: the first scatters the shingles, the second is shifted by one place a coordinate, and coordinate i is the least value
that it gives, min(second(first(x) + i)). Signatures are cut into bands; sets that agree in a whole band share a bucket. With 44 bands of 7 coordinates
two sets of similarity 0.85 share none with a chance of 4e-8, of similarity 0.5 with 0.71. Every candidate pair that decides anything is
confirmed on the whole sets.

Equal sets are one set. A bucket of many sets doesn't give all its pairs:

* every set is compared with one leader, the most central of the leaders of its buckets (central: sharing buckets with most sets);
* in buckets that still hold several classes, every set is compared with its bucket's own leader;
* in those that hold several classes even then, the sets outside the leader's class are compared with those of other classes with which
  they share one of their rarest shingles, as any two sets that meet the threshold do.

So a class of near copies costs about as many comparisons as it has members, and no link between bucket mates of different classes is lost.

Defined results: a null text or one without words has no set, no links and itself as component; shorter texts than k words are one
shingle and linked with equal ones only; equal texts and repeated rows are linked; a row with a null id takes the component of its
links (null without any) and gives none; empty tables give no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Words, cut, distinct, map_batches, maybe_broadcast, mix, named, shingles, signed, slices, text_bytes
from .components import components
from .ngram_join import compare

SIGNED = "doc_id long, n int, sig long, bands binary"
SETS = "sig long, n int, keys binary"


def sets_of(column: pa.Array, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Row range, then document and hash of the distinct shingles, set sizes and a hash of each whole set."""
    data, offsets = text_bytes(column)
    for a, b in slices(offsets):
        w = Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        h, d, _ = shingles(w, w.hashes(), k)
        d, h = distinct(d, h)
        n = np.bincount(d, minlength=b - a)
        total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(mix(h ^ np.uint64(0xC3C3C3C3DEADBEEF)), dtype=np.uint64)])
        edge = np.concatenate([[0], np.cumsum(n)])
        with np.errstate(over="ignore"):
            yield a, b, d, h, n, mix(total[edge[1:]] - total[edge[:-1]] + n.astype(np.uint64))


def circulant(h: np.ndarray, starts: np.ndarray, coordinates: int, block: int = 32_768) -> np.ndarray:
    """(sets, coordinates): the least value of the shifted second permutation over the elements h of each set; sets begin at starts.

    The first permutation is the mixer of `common`, the second multiplies, folds and multiplies; the shift is an addition modulo 2^64.
    """
    first = mix(h ^ np.uint64(0x5851F42D4C957F2D))
    least = np.full((len(starts), coordinates), np.uint64(2**64 - 1))
    one, two = np.empty(block, dtype=np.uint64), np.empty(block, dtype=np.uint64)
    for a in range(0, len(first), block):  # blocks stay in the processor's cache for all coordinates
        b = min(a + block, len(first))
        i, j = int(np.searchsorted(starts, a, side="right")) - 1, int(np.searchsorted(starts, b, side="left"))
        at = np.maximum(starts[i:j] - a, 0)
        x, y = one[: b - a], two[: b - a]
        for shift in range(coordinates):
            np.add(first[a:b], np.uint64(shift), out=x)
            np.multiply(x, np.uint64(0xD1B54A32D192ED03), out=x)
            np.right_shift(x, np.uint64(32), out=y)
            np.bitwise_xor(x, y, out=x)
            np.multiply(x, np.uint64(0x8CB92BA72F3D8DD7), out=x)
            least[i:j, shift] = np.minimum(least[i:j, shift], np.minimum.reduceat(x, at))
    return least


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """(sets, bands): a 64-bit hash of each band's number and coordinates."""
    rows = signature.shape[1] // bands
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(signature), bands))
    with np.errstate(over="ignore"):
        for r in range(rows):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + signature[:, r::rows])
    return key


def signatures(docs: DataFrame, k: int, bands: int, rows: int, numerator: int, denominator: int, remembered: int = 200_000) -> DataFrame:
    """doc_id, n, sig of every document, and the band keys of sets that a different one can match; a task gives those of equal sets once."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for a, b, d, h, n, sig in sets_of(batch.column(1), k):
                fresh = denominator * n >= numerator * (n + 1)
                for i in np.flatnonzero(fresh).tolist():
                    s = int(sig[i])
                    fresh[i] = s not in seen
                    seen.add(s)
                if len(seen) > remembered:
                    seen.clear()
                packed: list[bytes | None] = [None] * (b - a)
                take = np.flatnonzero(fresh)
                if len(take):
                    h = h[fresh[d]]
                    starts = np.cumsum(n[take]) - n[take]
                    for i, key in zip(take.tolist(), band_keys(circulant(h, starts, bands * rows), bands), strict=True):
                        packed[i] = key.tobytes()
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(n, pa.int32()), signed(sig), pa.array(packed, pa.binary())], names=["doc_id", "n", "sig", "bands"])

    return docs.transform(map_batches, read, SIGNED)


def bucket_rows(sets: DataFrame, bands: int) -> DataFrame:
    """(key, sig, n) of every band of (sig, n, bands)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                key = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint64)
                sig, n = (np.repeat(batch.column(i).to_numpy(), bands) for i in (0, 1))
                yield pa.RecordBatch.from_arrays([signed(key), pa.array(sig), pa.array(n)], names=["key", "sig", "n"])

    return sets.transform(map_batches, read, "key long, sig long, n int")


def whole_sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """sig, n and all shingles of the documents named in wanted (doc_id, sig)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = batch.column(2).to_numpy().view(np.uint64)
            for a, b, _, h, n, sig in sets_of(batch.column(1), k):
                edge = np.concatenate([[0], np.cumsum(n)]).tolist()
                mine = np.flatnonzero(sig == asked[a:b])  # an id may stand on several rows
                keys = pa.array([h[edge[i] : edge[i + 1]].tobytes() for i in mine.tolist()], pa.binary())
                yield pa.RecordBatch.from_arrays([signed(sig[mine]), pa.array(n[mine], pa.int32()), keys], names=["sig", "n", "keys"])

    named_rows = docs.join(wanted.withColumnRenamed("doc_id", "wanted_id"), F.col("doc_id") == F.col("wanted_id")).select("doc_id", "text", "sig")
    return named_rows.transform(map_batches, read, SETS)


def first_shared(sets: DataFrame, left: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """sig, element, pos: the shingles with which a link to another class can begin. left: sig, class.

    A set's shingles are ordered: first those that no other class holds, then by the number of sets that hold them. Two sets that meet the
    threshold have their first common shingle among the first (1 - threshold) of either.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 200):
                batch = whole.slice(at, 200)
                n = batch.column(1).to_numpy()
                key = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint64)
                sig, size, of = (np.repeat(batch.column(i).to_numpy(), n) for i in (0, 1, 3))
                yield pa.RecordBatch.from_arrays([signed(key), pa.array(sig), pa.array(size), pa.array(of)], names=["element", "sig", "n", "class"])

    held = sets.join(left.select("sig", "class").distinct(), "sig").select("sig", "n", "keys", "class").transform(map_batches, spread, "element long, sig long, n int, class long")
    held = cut(held, "shingles-left")
    several = held.groupBy("element").agg(F.min("class").alias("low"), F.max("class").alias("high"), F.count(F.lit(1)).alias("c")).where("low <> high").select("element", "c")
    shared = held.join(several, "element").select("element", "sig", "n", "c")
    own = F.col("n") - F.count(F.lit(1)).over(Window.partitionBy("sig"))  # those that no other class holds
    pos = own + F.row_number().over(Window.partitionBy("sig").orderBy("c", "element")) - 1
    return shared.withColumn("pos", pos).where(denominator * F.col("pos") <= (denominator - numerator) * F.col("n")).select("sig", "element", "pos")


def minhash_components(
    df: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = 5, numerator: int = 80, denominator: int = 100, bands: int = 44, rows: int = 7
) -> DataFrame:
    """doc_id, n_shingles, class_id (smallest id linked with it, directly or not) and kept (whether it is that id) of every document.

    A link: numerator * union <= denominator * shared, on the whole sets.
    """
    c = F.col
    docs = df.select(named(id_col).cast("long").alias("doc_id"), named(text).cast("string").alias("text"))
    found = cut(signatures(docs, k, bands, rows, numerator, denominator), "signatures")
    members = found.select("doc_id", "n", "sig")
    firsts = members.where("n > 0").groupBy("sig").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    firsts = cut(firsts.where("rep is not null"), "representatives")

    once = found.where("bands is not null").groupBy("sig").agg(F.first("n").alias("n"), F.first("bands").alias("bands"))
    posted = cut(bucket_rows(once, bands), "bucket-rows")
    shared = posted.groupBy("key").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    buckets = cut(posted.join(shared, "key"), "buckets")
    central = cut(buckets.groupBy("sig").agg(F.sum("held").alias("weight")), "central")
    buckets = cut(buckets.join(maybe_broadcast(central), "sig").select("key", "sig", "n", "weight"), "weighed")
    leaders = cut(buckets.groupBy("key").agg(F.max(F.struct("weight", "sig", "n")).alias("lead")), "leaders")

    def near(n1, n2):
        return denominator * F.least(n1, n2) >= numerator * F.greatest(n1, n2)

    wanted = firsts.join(maybe_broadcast(central.select("sig")), "sig", "left_semi").select(c("rep").alias("doc_id"), "sig")
    wanted = cut(wanted, "candidates")
    sets = cut(whole_sets(docs, maybe_broadcast(wanted), k), "whole-sets")
    if sets.count() > wanted.count():  # ids that stand on several rows
        sets = cut(sets.dropDuplicates(["sig"]), "whole-sets")

    best = buckets.join(leaders, "key").groupBy("sig").agg(F.first("n").alias("n"), F.max("lead").alias("lead"))
    tried = cut(best.where((c("sig") != c("lead.sig")) & near(c("n"), c("lead.n"))).select(c("lead.sig").alias("s"), c("sig").alias("t")), "leader-pairs")
    links = cut(compare(tried, sets, numerator, denominator), "leader-links")

    def in_classes(links: DataFrame) -> DataFrame:
        """Members of buckets that hold two classes and more: key, sig, n, weight, class and the leader with its class."""
        label = maybe_broadcast(cut(components(links, "s", "t"), "classes-so-far"))
        placed = buckets.join(label, c("sig") == c("node"), "left").select("key", "sig", "n", "weight", F.coalesce("component", "sig").alias("class"))
        placed = cut(placed, "placed")
        several = placed.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high"), F.max(F.struct("weight", "sig", "n", "class")).alias("lead"))
        return placed.join(cut(several.where("low <> high").select("key", "lead"), "several-classes"), "key")

    apart = in_classes(links).where((c("class") != c("lead.class")) & near(c("n"), c("lead.n"))).select(c("lead.sig").alias("s"), c("sig").alias("t"))
    more = cut(apart.distinct().join(tried, ["s", "t"], "left_anti"), "bucket-leader-pairs")
    tried = tried.unionByName(more)
    links = cut(links.unionByName(compare(more, sets, numerator, denominator)), "links-of-leaders")

    left = cut(in_classes(links), "several-classes-left")
    classes = left.select("sig", "n", "class").distinct()
    begin = cut(first_shared(sets, classes, numerator, denominator).join(classes, "sig"), "first-shared")
    other = begin.select("element", c("sig").alias("sig2"), c("n").alias("n2"), c("class").alias("class2"), c("pos").alias("pos2"))
    room = (numerator + denominator) * F.least(c("n") - c("pos"), c("n2") - c("pos2")) >= numerator * (c("n") + c("n2"))
    rest = begin.join(other, "element").where((c("class") != c("class2")) & (c("sig") > c("sig2")) & near(c("n"), c("n2")) & room).select(c("sig").alias("x"), c("sig2").alias("y")).distinct()
    mates = rest.join(left.select("key", c("sig").alias("x")), "x").join(left.select("key", c("sig").alias("y")), ["key", "y"], "left_semi")
    rest = mates.select("x", "y").distinct()
    done = tried.select(F.greatest("s", "t").alias("x"), F.least("s", "t").alias("y"))
    rest = cut(rest.join(done, ["x", "y"], "left_anti").select(c("x").alias("s"), c("y").alias("t")), "other-pairs")
    links = cut(links.unionByName(compare(rest, sets, numerator, denominator)), "all-links")

    reps = cut(components(links, "s", "t").join(firsts, c("node") == c("sig")).select("sig", "component", "rep"), "linked")
    linked = reps.join(reps.groupBy("component").agg(F.min("rep").alias("class_id")), "component").select("sig", "class_id")
    alone = firsts.where("copies > 1").join(maybe_broadcast(reps.select("sig")), "sig", "left_anti").select("sig", c("rep").alias("class_id"))
    classes = maybe_broadcast(cut(linked.unionByName(alone), "classes"))
    out = members.join(classes, "sig", "left").select("doc_id", c("n").cast("long").alias("n_shingles"), F.coalesce("class_id", "doc_id").alias("class_id"))
    return out.withColumn("kept", c("doc_id").eqNullSafe(c("class_id")))


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash_components(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), k=5, numerator=85)
    return found.select("doc_id", "n_shingles", F.col("class_id").alias("component_id"), "kept")


OP13_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 4, 1))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS c FROM s GROUP BY 1),
o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * o.c >= 85 * (na.c + nb.c - o.c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
m AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY 1)
SELECT w.doc_id, CAST(coalesce(n.c, 0) AS BIGINT) AS n_shingles, m.component_id, w.doc_id = m.component_id AS kept
FROM w LEFT JOIN n USING (doc_id) JOIN m USING (doc_id)
"""
QUERIES = {"op13_minhash": op13_minhash}
ORACLES = {"op13_minhash": OP13_SQL}
