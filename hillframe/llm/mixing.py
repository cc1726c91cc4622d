"""Mixing sources to target weights by Sainte-Lague apportionment.

The words of a source are cut into shards (by a hash of the document) and each shard, in a seeded document order, into blocks
of equal numbers of words. Sainte-Lague's rule (each next block to the highest quotient of votes over 2 * seats + 1)
gives every source a whole number of blocks for its target, then every group of a source's shards a whole number for its size, and
every shard of a group its own. Inside a shard every block is taken quota div blocks times, and a seeded choice of quota mod
blocks of them once more. A document's share is what the taken blocks hold of it. The last block of a
shard is shorter than the others, so a source comes within most_repeats + 1 blocks a shard of its target; a block is never taken more
than `most_repeats` times.

Sources get targets in code point order, null last, with weights 1, 2, 3, repeating; a target stops at most_repeats times
the source's size and what is over goes to the others by weight. Only one row per source and per group of shards (about max_groups in
all) reaches the driver; shards have a size that doesn't grow with the table, and their quotas are dealt in Spark.

Defined results: null and empty texts have size 0 and nothing is taken; a null source is a source of its own; repeated rows
are documents of their own; an empty table gives no rows; other columns stay as they are where the operator keeps them.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, Words, cut, map_batches, maybe_broadcast, mix, named, text_bytes, unused


def fill_targets(sizes: list[int], weights: list[float], most: float) -> list[float]:
    """Shares of the total by weight, none above most * size; what is over is shared by weight among the rest."""
    total, free, out = float(sum(sizes)), set(range(len(sizes))), [0.0] * len(sizes)
    left = total
    while free:
        w = sum(weights[i] for i in free)
        over = [i for i in free if left * weights[i] / w > most * sizes[i]]
        if not over:
            for i in free:
                out[i] = left * weights[i] / w
            break
        for i in sorted(over):
            out[i] = float(most * sizes[i])
            free.remove(i)
        left = total - sum(out[i] for i in range(len(sizes)) if i not in free)
    return out


def sainte_lague(votes: list[float], seats: int) -> list[int]:
    """Seats by highest quotients votes / (2 * seats + 1); ties to the earlier. Starts at the rounded quotas."""
    total = float(sum(votes))
    if total <= 0 or seats <= 0:
        return [0] * len(votes)
    got = [int(v * seats / total + 0.5) for v in votes]
    more = seats - sum(got)
    if more > 0:
        heap = [(-v / (2 * g + 1), i) for i, (v, g) in enumerate(zip(votes, got, strict=True))]
        heapq.heapify(heap)
        for _ in range(more):
            _, i = heapq.heappop(heap)
            got[i] += 1
            heapq.heappush(heap, (-votes[i] / (2 * got[i] + 1), i))
    elif more < 0:
        heap = [(v / (2 * g - 1), -i) for i, (v, g) in enumerate(zip(votes, got, strict=True)) if g]
        heapq.heapify(heap)
        for _ in range(-more):
            _, i = heapq.heappop(heap)
            got[-i] -= 1
            if got[-i]:
                heapq.heappush(heap, (votes[-i] / (2 * got[-i] - 1), i))
    return got


def mix_sources(
    df: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[float, ...] = (1.0, 2.0, 3.0),
    most_repeats: int = 3,
    block_words: int = 32,
    shard_words: int = 250_000,
    shard_docs: int = 5_000,
    max_groups: int = 4096,
    seed: str = "mix",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """What the mix takes: id, source, size, source_size, target, taken, and pieces (start, words, repeats) of a document.

    Pieces are in words from the document's start; a document that isn't taken has none. keep: columns to carry along as
    keep_0, keep_1 and so on. Sources are labels: one row of each reaches the driver.
    """
    spark = df.sparkSession
    carried = [named(c).alias(f"keep_{i}") for i, c in enumerate(keep)]
    size = F.coalesce(F.regexp_count(named(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    wide = df.select(named(id_col).alias("id"), named(source).cast("string").alias("source"), size.alias("size"), F.xxhash64(F.lit(seed), named(id_col), named(text)).alias("h"), *carried)
    docs = cut(wide.drop(*(f"keep_{i}" for i in range(len(keep)))), "sizes")
    per = [(r["source"], r["words"], r["docs"]) for r in docs.groupBy("source").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("docs")).collect()]
    per.sort(key=lambda x: (x[0] is None, (x[0] or "").encode("utf-32-be")))
    sizes = [x[1] for x in per]
    targets = fill_targets(sizes, [weights[i % len(weights)] for i in range(len(per))], most_repeats)
    quotas = sainte_lague(targets, round(sum(targets) / block_words))
    shards = [max(1, round(max(n / shard_words, d / shard_docs))) for _, n, d in per]
    groups = [max(1, min(k, k * max_groups // max(1, sum(shards)))) for k in shards]
    plan = maybe_broadcast(
        spark.createDataFrame(
            [(name, n, t, k, g) for (name, n, _), t, k, g in zip(per, targets, shards, groups, strict=True)],
            "p_source string, source_size long, target double, shards int, groups int",
        )
    )

    def sharded(t: DataFrame) -> DataFrame:
        t = t.join(plan, F.col("source").eqNullSafe(F.col("p_source"))).drop("p_source")
        return t.withColumn("shard", F.pmod("h", F.col("shards")).cast("int")).withColumn("grp", F.pmod("shard", "groups")).drop("shards", "groups")

    docs = sharded(docs)
    sized = cut(docs.groupBy("source", "grp", "shard").agg(F.sum("size").alias("words")), "shards")
    held: dict[str | None, list[tuple[int, int]]] = {}
    for r in sized.groupBy("source", "grp").agg(F.sum("words").alias("words")).collect():
        held.setdefault(r["source"], []).append((r["grp"], r["words"]))
    rows = []
    for (name, _, _), quota in zip(per, quotas, strict=True):
        own = sorted(held.get(name, []))
        rows += [(name, grp, seats) for (grp, _), seats in zip(own, sainte_lague([w for _, w in own], quota), strict=True)]
    shared = spark.createDataFrame(rows, "g_source string, g_grp int, seats long")

    def deal(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("shard")
        words = group["words"].to_numpy("int64")
        seats = sainte_lague(words.tolist(), int(group["seats"].iloc[0]))
        return pd.DataFrame({"q_source": group["source"], "q_shard": group["shard"], "quota": np.minimum(seats, most_repeats * -(-words // block_words))})

    quota = sized.join(F.broadcast(shared), F.col("source").eqNullSafe(F.col("g_source")) & (F.col("grp") == F.col("g_grp"))).select("source", "grp", "shard", "words", "seats")
    quota = cut(quota.groupBy("source", "grp").applyInPandas(deal, "q_source string, q_shard int, quota long"), "quotas")
    tasks = min(max(1, sum(shards)), 10_000)
    if keep:
        docs = sharded(wide)
    docs = docs.join(maybe_broadcast(quota), F.col("source").eqNullSafe(F.col("q_source")) & (F.col("shard") == F.col("q_shard"))).drop("q_source", "q_shard")

    def take(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["h", "id"], kind="stable")
        size = shard["size"].to_numpy("int64")
        end = np.cumsum(size)
        start, blocks, seats = end - size, -(-int(end[-1]) // block_words), int(shard["quota"].iloc[0])
        base, extra = divmod(seats, blocks) if blocks else (0, 0)
        name = f"{seed}/{shard['source'].iloc[0]}/{shard['shard'].iloc[0]}"
        with np.errstate(over="ignore"):
            rank = mix(np.arange(blocks, dtype=np.uint64) + np.uint64(int.from_bytes(hashlib.sha1(name.encode()).digest()[:8], "big")))
        repeats = np.full(blocks, base, dtype=np.int64)
        repeats[np.argsort(rank, kind="stable")[:extra]] += 1
        # words taken up to each word: whole blocks before it, and its part of its own block
        before = np.concatenate([[0], np.cumsum(repeats * block_words)])
        padded = np.append(repeats, 0)

        def upto(word):
            return before[word // block_words] + padded[word // block_words] * (word % block_words)

        pieces = []
        for s, e in zip(start.tolist(), end.tolist(), strict=True):
            own: list[dict] = []
            while s < e:
                b = s // block_words
                stop = min(e, (b + 1) * block_words)
                if repeats[b]:
                    at = s - int(start[len(pieces)])
                    if own and own[-1]["repeats"] == repeats[b] and own[-1]["start"] + own[-1]["words"] == at:
                        own[-1]["words"] += stop - s
                    else:
                        own.append({"start": at, "words": stop - s, "repeats": int(repeats[b])})
                s = stop
            pieces.append(own)
        return shard.drop(columns=["h", "shard", "grp", "quota"], errors="ignore").assign(taken=upto(end) - upto(start), pieces=pieces)

    # as many tasks as shards, up to 10,000: a shard is Python's unit of work, however few bytes it has
    kinds = dict(df.dtypes)
    held_columns = "".join(f", keep_{i} {kinds[c]}" for i, c in enumerate(keep))
    schema = f"id {kinds[id_col]}, source string, size long{held_columns}, source_size long, target double, taken long, pieces array<struct<start long, words long, repeats long>>"
    return docs.select("id", "source", "size", *(f"keep_{i}" for i in range(len(keep))), "source_size", "target", "h", "shard", "quota").repartition(tasks, "source", "shard").groupBy("source", "shard").applyInPandas(take, schema)


def mixed_documents(df: DataFrame, text: str = "text", **options) -> DataFrame:
    """The mix as rows of df's columns: of a document what is taken once, twice, ... as a row each, pieces joined by a line feed."""
    mixed = mix_sources(df, text=text, keep=tuple(df.columns), **options)
    names, at, schema = df.columns, df.columns.index(text), df.schema

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, rows, out = batch.column(at).to_pylist(), [], []
            for i, pieces in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                if not pieces or not texts[i]:
                    continue
                w = Words(*text_bytes(pa.array([texts[i]], pa.string())))
                raw = texts[i].encode()
                for r in range(1, max(p["repeats"] for p in pieces) + 1):
                    own = [raw[w.starts[p["start"]] : w.ends[p["start"] + p["words"] - 1]] for p in pieces if p["repeats"] >= r]
                    rows.append(i)
                    out.append(b"\n".join(own).decode())
            columns = [batch.column(j).take(pa.array(rows, pa.int64())) for j in range(batch.num_columns - 1)]
            columns[at] = pa.array(out, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    taken = mixed.where("taken > 0").select(*(F.col(f"keep_{i}").alias(c) for i, c in enumerate(names)), F.col("pieces").alias(unused(df, "pieces")))
    # cut here: two Python steps in one task would hold two workers a core
    return cut(taken, "mixed").transform(map_batches, read, schema)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source"))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


QUERIES = {"op9_mixing": op9_mixing}
ORACLES: dict[str, str] = {}
