"""Exact top-k search by inner product with multi-resolution segment statistics.

Every vector is cut into 1, 2, 4, ... equal segments; of each segment its mean and deviation are kept. For two
vectors the squared distance is at least the sum over segments of L * ((mean difference)^2 + (deviation
difference)^2), so the inner product (|q|^2 + |c|^2 - distance^2) / 2 is at most the sum of L * (mean * mean +
deviation * deviation). Bounds are taken coarse to fine; a pair whose bound falls below the query's k-th best exact
score so far goes no further, and the exact integer score decides among the survivors.

Queries and candidates are cut into blocks of bounded size; each pair of blocks is one task group, and only k rows a
query leave it. No bound on the number of candidates is set: pruning is by proof only.

Scores are exact whole numbers: where a block's components are so large that a double could round a sum, the products are taken in
64-bit integers instead.

Defined results: vectors that are null, empty or hold a null or non-finite component take no part, nor do those whose score could
pass a long (a component of 2^31 and more after scaling); vectors of other length
than the query's aren't its candidates; rows repeated with one id and one vector count once; ties go to the smaller id. An
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, map_batches

RESULT = "query_id long, vec_id long, score long"


def segment_levels(dim: int) -> list[int]:
    """Numbers of segments, coarse to fine; the finest has segments of at least four components."""
    levels, s = [], 1
    while s * 4 <= dim:
        levels.append(s)
        s *= 2
    return levels or [1]


def statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Rows of sqrt(L) * mean and sqrt(L) * deviation of each segment: their inner product bounds the vectors'."""
    edges = np.linspace(0, x.shape[1], segments + 1).astype(int)[:-1]
    lengths = np.diff(np.append(edges, x.shape[1]))
    mean = np.add.reduceat(x, edges, axis=1) / lengths
    square = np.add.reduceat(x * x, edges, axis=1) / lengths
    deviation = np.sqrt(np.maximum(0, square - mean * mean))
    return np.concatenate([mean, deviation], axis=1) * np.tile(np.sqrt(lengths), 2)


def block_top_k(qid: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Each query's k best candidates of one block, as (query id, candidate ids, scores); vectors are whole doubles."""
    levels = segment_levels(q.shape[1])
    qs, cs = ([statistics(x, s) for s in levels] for x in (q, c))
    coarse = qs[0] @ cs[0].T
    slack = 1e-6 * (1 + np.abs(coarse).max(initial=0))
    middle = min(len(levels) - 1, 2)
    exact = np.abs(q).max(initial=0) * np.abs(c).max(initial=0) * q.shape[1] < 2.0**53
    whole = None if exact else c.astype(np.int64)
    slack += 0 if exact else 1e-9 * np.abs(q).max() * np.abs(c).max() * q.shape[1]  # rounding of the doubles in bounds and thresholds
    for i in range(len(q)):
        alive = np.flatnonzero(cid != qid[i])
        if not len(alive):
            continue
        bound = coarse[i, alive]
        probe = alive
        if len(alive) > 4 * k:  # a first threshold from the candidates that the statistics like best
            near = cs[middle][alive] @ qs[middle][i]
            probe = alive[np.argpartition(-near, 4 * k)[: 4 * k]]
        scores = c[probe] @ q[i]
        least = np.partition(scores, len(scores) - k)[len(scores) - k] if len(scores) >= k else -np.inf
        alive = alive[bound + slack >= least]
        for level in range(1, len(levels)):
            if len(alive) <= 4 * k:
                break
            alive = alive[cs[level][alive] @ qs[level][i] + slack >= least]
        scores = (c[alive] @ q[i]).astype(np.int64) if exact else whole[alive] @ q[i].astype(np.int64)
        order = np.lexsort((cid[alive], -scores))[:k]
        yield int(qid[i]), cid[alive][order], scores[order]


def top_k(
    df: DataFrame,
    is_query: F.Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector: str = "embedding",
    scale: float = 256.0,
    query_block: int = 1024,
    candidate_block: int = 16384,
) -> DataFrame:
    """query_id, rank, id and score of each query's k rows of largest integer inner product.

    Components become floor(scale * x). Blocks are filled by a hash of the id: a block holds about query_block or
    candidate_block rows, so the memory of a task doesn't grow with the table.
    """
    spark = df.sparkSession
    x = F.col(vector)
    whole = F.expr(f"size({vector}) > 0 and forall({vector}, v -> v is not null and not isnan(v) and abs(double(v)) < {2.0**31 / abs(scale)})")
    ints = (
        df.where(F.col(id_col).isNotNull() & x.isNotNull() & whole)
        .select(F.col(id_col).cast("long").alias("id"), F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("long")).alias("v"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
        .groupBy("id", "v")
        .agg(F.max("is_query").alias("is_query"))
    )
    ints = cut(ints, "vectors")
    queries = ints.where("is_query")
    n, m = ints.count(), queries.count()
    blocks, groups = max(1, -(-n // candidate_block)), max(1, -(-m // query_block))
    part = lambda seed, count: F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(count)).cast("int")
    one = ints.select(F.lit(1).alias("side"), "id", "v", part("c", blocks).alias("cb"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("qb"))
    other = queries.select(F.lit(0).alias("side"), "id", "v", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("cb"), part("q", groups).alias("qb"))
    # the smaller of the two copies of the data grows: every pair of a query block and a candidate block is a task's work
    dealt = one.unionByName(other).repartitionById(blocks * groups, F.col("cb") * groups + F.col("qb")).sortWithinPartitions("cb", "qb", "side")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides: dict[int, list] = {0: [], 1: []}
        for b in batches:
            v, side = b.column(2), b.column(0).to_numpy(zero_copy_only=False)
            ids = b.column(1).to_numpy(zero_copy_only=False)
            off = v.offsets.to_numpy()
            flat = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
            for s in (0, 1):
                for d in np.unique(np.diff(off)[side == s]):
                    at = np.flatnonzero((side == s) & (np.diff(off) == d))
                    sides[s].append((int(d), ids[at], flat[off[at][:, None] + np.arange(d)]))
        rows: list[tuple] = []
        for d in sorted({x[0] for x in sides[0]}):
            (qi, q), (ci, c) = ((np.concatenate([x[1] for x in sides[s] if x[0] == d]), np.concatenate([x[2] for x in sides[s] if x[0] == d])) for s in (0, 1))
            for a in range(0, len(qi), 256):
                for query, found, scores in block_top_k(qi[a : a + 256], q[a : a + 256], ci, c, k):
                    rows.append((np.full(len(found), query), found, scores))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*rows, strict=True)], names=["query_id", "vec_id", "score"])

    found = dealt.select("side", "id", "v").transform(map_batches, score, RESULT).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("vec_id").alias("v")))), 1, k)
    return (
        found.groupBy("query_id")
        .agg(best.alias("best"))
        .select("query_id", F.posexplode("best").alias("p", "b"))
        .select("query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("b.v").alias("vec_id"), (-F.col("b.s")).alias("score"))
    )


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)


OP6_SQL = """
WITH e AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x) OR abs(CAST(x AS DOUBLE)) >= 8388608)) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, max(CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: CAST(p[1] AS HUGEINT) * p[2])) AS BIGINT)) AS score
  FROM e q JOIN e c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 50 = 0 GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
QUERIES = {"op6_topk": op6_topk}
ORACLES = {"op6_topk": OP6_SQL}
