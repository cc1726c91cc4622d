"""Language identification by prediction by partial matching.

Every language has a byte context tree: counts of the bytes that follow each context of up to `max_order` bytes. A text's code
length under a language is the sum over its bytes of -log2 of what the tree gives: the longest known context codes the
byte, or an escape (probability d / (n + d) for d distinct followers of n occurrences, a follower c / (n + d)) to the next
shorter one, down to a uniform byte. Statistics are frozen: scoring changes nothing, so a text's lengths are exact and don't
depend on other texts. The language of the shortest code wins, ties to the smaller name.

The trees of all languages share one set of nodes: the node of an n-gram is a row of a dense table reached from the node of
its first n - 1 bytes, so whole batches of text walk the trees by NumPy look-ups, each language a column.

The trees are fitted to a bounded sample (`docs_per_language` labelled texts a language, by a seeded hash of the id), counted
in Spark; texts are whole. Prediction reads nothing but the text.

Defined results: `und` with score 0 for null texts and texts without a letter, and for every text where no language was
learned; empty tables give no rows; repeated rows are rows of their own; other columns are ignored.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, slices, text_bytes

RESULT = "doc_id long, lang_pred string, score double, bits_per_byte double"
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True


@dataclasses.dataclass
class ContextTrees:
    """classes: byte -> symbol (0 unknown). step[k]: (node of k bytes) * symbols + symbol -> node of k + 1 bytes (0 none).

    cost[k]: bits of the last byte of a (k + 1)-gram, by node and language. escape[k]: bits of leaving a k-byte context.
    """

    languages: list[str]
    classes: np.ndarray
    symbols: int
    step: list[np.ndarray]
    cost: list[np.ndarray]
    escape: list[np.ndarray]

    @property
    def order(self) -> int:
        return len(self.step) - 1

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of every text under every language."""
        texts = len(offsets) - 1
        out = np.zeros((texts, len(self.languages)))
        if not len(data):
            return out
        symbol = self.classes[data].astype(np.int64)
        # node[k][i]: of the k bytes that end at i; none across the start of a text
        fresh = np.zeros(len(data), dtype=bool)
        fresh[offsets[:-1][np.diff(offsets) > 0]] = True
        nodes = [self.step[0][symbol]]
        for k in range(1, len(self.step)):
            before = np.empty_like(nodes[-1])
            before[1:] = nodes[-1][:-1]
            before[fresh] = 0
            nodes.append(self.step[k][before.astype(np.int64) * self.symbols + symbol])
        bits = self.cost[-1][nodes[-1]]
        at = np.flatnonzero(nodes[-1] == 0)
        total = np.zeros((len(at), len(self.languages)), dtype=np.float32)
        for k in range(self.order, -1, -1):
            # the k-byte context is left; a (k + 1)-gram is unknown here
            if k:
                context = np.where(fresh[at], 0, nodes[k - 1][at - 1])
                total += self.escape[k][context]
            else:
                total += self.escape[0][0]
            if k == 0:
                bits[at] = total + 8.0
                break
            node = nodes[k - 1][at]
            known = node > 0
            bits[at[known]] = total[known] + self.cost[k - 1][node[known]]
            at, total = at[~known], total[~known]
            if not len(at):
                break
        sums = np.zeros((len(data) + 1, len(self.languages)))
        np.cumsum(bits, axis=0, dtype=np.float64, out=sums[1:])
        return sums[offsets[1:]] - sums[offsets[:-1]]


def build_trees(rows: list[tuple[str, int, int, int]], max_order: int) -> ContextTrees:
    """From counts (language, length, packed bytes, count) of all 1- to (max_order + 1)-grams."""
    languages = sorted({r[0] for r in rows})
    number = {name: i for i, name in enumerate(languages)}
    lang = np.array([number[r[0]] for r in rows], dtype=np.int64)
    length, key, count = (np.array([r[j] for r in rows], dtype=np.int64) for j in (1, 2, 3))
    keys = [np.unique(key[length == k + 1]) for k in range(max_order + 1)]
    classes = np.zeros(256, dtype=np.int32)
    classes[keys[0]] = np.arange(1, len(keys[0]) + 1)
    symbols = len(keys[0]) + 1
    counts = []
    for k, own in enumerate(keys):
        c = np.zeros((len(own) + 1, len(languages)))
        at = length == k + 1
        np.add.at(c, (np.searchsorted(own, key[at]) + 1, lang[at]), count[at])
        counts.append(c)
    step, cost, escape = [], [], []
    for k, own in enumerate(keys):
        if k == 0:
            table = np.zeros(symbols, dtype=np.int32)
            table[1:] = np.arange(1, symbols)
            parent = np.zeros(len(own), dtype=np.int64)
            contexts = 1
        else:
            parent = np.searchsorted(keys[k - 1], own >> 8) + 1
            contexts = len(keys[k - 1]) + 1
            table = np.zeros(contexts * symbols, dtype=np.int32)
            table[parent * symbols + classes[own & 255]] = np.arange(1, len(own) + 1)
        c = counts[k]
        n, d = np.zeros((contexts, len(languages))), np.zeros((contexts, len(languages)))
        np.add.at(n, parent, c[1:])
        np.add.at(d, parent, c[1:] > 0)
        out = np.where(n > 0, -np.log2(np.where(n > 0, d / np.maximum(n + d, 1), 1)), 0.0)
        if k == 0:
            shorter = np.full(c.shape, 8.0)
        else:  # the same byte after a context shorter by its first byte
            suffix = np.searchsorted(keys[k - 1], own & ((1 << (8 * k)) - 1)) + 1
            shorter = np.concatenate([np.zeros((1, len(languages))), cost[k - 1][suffix]])
        grown = np.concatenate([[0], parent])
        with np.errstate(divide="ignore"):
            direct = -np.log2(c / np.maximum(n[grown] + d[grown], 1))
        bits = np.where(c > 0, direct, out[grown] + shorter)
        bits[0] = 0
        step.append(table)
        cost.append(bits)
        escape.append(out)
    return ContextTrees(languages, classes, symbols, step, [c.astype(np.float32) for c in cost], [e.astype(np.float32) for e in escape])


def train_trees(labelled: DataFrame, docs_per_language: int = 1500, max_order: int = 3, text: str = "text", lang: str = "lang", id_col: str = "doc_id") -> ContextTrees | None:
    """Trees from about docs_per_language whole texts of each language: those whose seeded hash is below its share."""
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(id_col).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    sizes = rows.groupBy("lang").count().collect()
    if not sizes:
        return None
    spark = rows.sparkSession
    share = F.broadcast(spark.createDataFrame([(r["lang"], min(1.0, docs_per_language / r["count"])) for r in sizes], "l string, share double"))
    draw = F.pmod(F.xxhash64(F.lit("langid"), "id"), F.lit(1_000_000)) / 1e6
    some = rows.join(share, F.col("lang") == F.col("l")).where(draw < F.col("share")).select("lang", "text")

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = np.array(batch.column(0).to_pylist(), dtype=object)
            for name in sorted(set(names)):
                data, offsets = text_bytes(batch.column(1).filter(pa.array(names == name)))
                first = np.zeros(len(data) + 1, dtype=np.int64)
                first[offsets[:-1]] = 1
                start = np.maximum.accumulate(np.where(first[:-1] > 0, np.arange(len(data)), 0))
                into = np.arange(len(data)) - start
                key = np.zeros(len(data), dtype=np.int64)
                for k in range(max_order + 1):
                    shifted = np.zeros(len(data), dtype=np.int64)
                    shifted[k:] = data[: len(data) - k]
                    key |= shifted << (8 * k)
                    found, count = np.unique(key[into >= k], return_counts=True)
                    if len(found):
                        yield pa.RecordBatch.from_arrays([pa.array([name] * len(found)), pa.array(np.full(len(found), k + 1, dtype=np.int32)), pa.array(found), pa.array(count)], names=["lang", "n", "key", "c"])

    counted = some.transform(map_batches, grams, "lang string, n int, key long, c long").groupBy("lang", "n", "key").agg(F.sum("c").alias("c"))
    got = counted.toPandas()
    rows_ = list(zip(got["lang"], got["n"].tolist(), got["key"].tolist(), got["c"].tolist(), strict=True))
    return build_trees(rows_, max_order) if rows_ else None


def score_column(column: pa.Array, trees: ContextTrees | None) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, posterior and bits a byte of every text of a column, in slices of bounded size."""
    data, offsets = text_bytes(column)
    names, scores, rates = [], [], []
    for a, b in slices(offsets, 1_000_000):
        part, off = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        letters = np.concatenate([[0], np.cumsum(_LETTER[part])])
        some = letters[off[1:]] > letters[off[:-1]]
        for i in np.flatnonzero(~some & (np.diff(off) > 0)):
            some[i] = any(map(str.isalpha, part[off[i] : off[i + 1]].tobytes().decode("utf-8", "replace")))
        if trees is None:
            names += ["und"] * (b - a)
            scores.append(np.zeros(b - a))
            rates.append(np.zeros(b - a))
            continue
        bits = trees.code_lengths(part, off)
        best = np.argmin(bits, axis=1)
        least = bits[np.arange(b - a), best]
        names += [trees.languages[j] if s else "und" for j, s in zip(best, some, strict=True)]
        scores.append(np.where(some, 1 / np.exp2(np.clip(least[:, None] - bits, -1000, 0)).sum(axis=1), 0.0))
        rates.append(least / np.maximum(np.diff(off), 1))
    return names, np.concatenate([np.zeros(0), *scores]), np.concatenate([np.zeros(0), *rates])


def predict(docs: DataFrame, trees: ContextTrees | None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score (the posterior of the best language, 0 to 1) and the code length a byte."""
    held = docs.sparkSession.sparkContext.broadcast(trees)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, score, rate = score_column(batch.column(1), held.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(score), pa.array(rate)], names=["doc_id", "lang_pred", "score", "bits_per_byte"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).transform(map_batches, read, RESULT)


def keep_in_a_language(docs: DataFrame, trees: ContextTrees | None, text: str = "text", most_bits: float = 8.0) -> DataFrame:
    """The rows whose text has a language and is coded in fewer than most_bits a byte by its tree; columns as they are."""
    held, at = docs.sparkSession.sparkContext.broadcast(trees), docs.columns.index(text)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, _, rate = score_column(batch.column(at), held.value)
            yield batch.filter(pa.array((np.array(names, dtype=object) != "und") & (rate < most_bits)))

    return docs.transform(map_batches, read, docs.schema)


def held_out(id_col: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    trees = train_trees(docs.where(~held_out()).select("doc_id", "text", "lang"))
    return predict(docs, trees).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


QUERIES = {"op3_langid": op3_langid}
ORACLES: dict[str, str] = {}
