"""Toxicity by compression distance.

Two zstandard dictionaries of a few kilobytes are trained on labelled text: both begin with the commonest ordinary words, and
each ends with what marks its own class: beginnings of words, and the commonest words that begin so, which are many times as
frequent in it and occur after many different words there (so a text and its copies alone mark nothing). A text is cut into
windows of about 48 bytes at blanks; each window is compressed with either dictionary, and the difference of the two lengths is the
evidence of the window. Per-difference log-likelihood ratios, their sum and maximum over a text, and a logistic curve on
them are calibrated on labelled windows and texts, so the score is a probability.

Learning uses a bounded seeded sample of labelled rows (`sample`); scoring reads the whole text and nothing else.

Defined results: null and empty texts have no window and get the score of no evidence; labels repeated for one document count
by their largest value, null labels not at all; without labels of both kinds every score is 0; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import collections
import dataclasses
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import labelled_sample, map_batches
from .langid import held_out

RESULT = "doc_id long, score double, evidence double, strongest double, windows long"
_LOW, _HIGH = -8, 14


def windows(text: str, width: int) -> list[bytes]:
    """Lower-cased text, white space as one blank, in pieces that end before a blank, of at least `width` bytes."""
    data = b" " + b" ".join(text.lower().encode().split()) + b" "
    out, start, n = [], 0, len(data)
    if n <= 2:
        return out
    while n - start > width:
        end = data.find(b" ", start + width)
        if end < 0 or end >= n - 1:
            break
        out.append(data[start:end])
        start = end
    out.append(data[start:])
    return out


def _grams(text: str, shortest: int, longest: int) -> set[tuple[bytes, bytes]]:
    """Beginnings of words (with the blank before), whole words (between blanks), each with the word before."""
    out, before = set(), b""
    for word in text.lower().encode().split():
        w = b" " + word + b" "
        out.update((w[:k], before) for k in range(shortest, min(len(w), longest) + 1))
        out.add((w, before))
        before = word
    return out


def marks(own: list[str], other: list[str], ratio: float = 30.0, contexts: int = 5, shortest: int = 5, longest: int = 13) -> list[bytes]:
    """What marks the texts `own` against `other`, rarest first (a dictionary's end is cheapest to point at)."""
    seen: dict[bytes, set] = collections.defaultdict(set)
    for text in own:
        for gram, before in _grams(text, shortest, longest):
            seen[gram].add(before)
    seen = {g: s for g, s in seen.items() if len(s) >= contexts}
    held = collections.Counter()
    for text in other:
        held.update({g for g, _ in _grams(text, shortest, longest) if g in seen})
    good = {g: len(s) for g, s in seen.items() if len(s) / max(1, len(own)) > ratio * (held[g] + 0.5) / max(1, len(other))}
    root: dict[bytes, list[bytes]] = {}
    for g in sorted(good, key=lambda g: (len(g), g)):
        begun = next((g[:k] for k in range(shortest, len(g)) if g[:k] in root), None)
        if begun is None:
            root[g] = []
        elif g.endswith(b" "):
            root[begun].append(g)
    out: list[bytes] = []
    for g in sorted(root, key=lambda g: (good[g], g)):
        words = sorted(root[g], key=lambda w: (-good[w], w))[:3]
        out += [g, *reversed(words)]
    return out


@dataclasses.dataclass
class Model:
    """Two raw dictionaries, the evidence of each difference of lengths, and the logistic curve of a text's."""

    toxic: bytes
    ordinary: bytes
    ratios: np.ndarray
    curve: tuple[float, float, float]
    width: int = 48
    level: int = 7

    def __post_init__(self):
        self._pair = None

    def __getstate__(self):
        return self.__dict__ | {"_pair": None}

    def differences(self, text: str) -> np.ndarray:
        """Bytes saved in each window by the toxic dictionary against the ordinary one, clipped and shifted to an index."""
        if self._pair is None:
            most = max(len(self.toxic), len(self.ordinary))
            p = zstandard.ZstdCompressionParameters.from_level(
                self.level, source_size=2 * self.width, dict_size=most, min_match=4, write_content_size=0, write_dict_id=0, write_checksum=0
            )
            pair = []
            for content in (self.toxic, self.ordinary):
                d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(compression_params=p)
                pair.append(zstandard.ZstdCompressor(dict_data=d, compression_params=p).compress)
            self._pair = pair
        toxic, ordinary = self._pair
        found = [len(ordinary(w)) - len(toxic(w)) for w in windows(text, self.width)]
        return np.clip(np.array(found, dtype=np.int64), _LOW, _HIGH) - _LOW

    def evidence(self, text: str) -> tuple[float, float, int]:
        r = self.ratios[self.differences(text)] if text else np.zeros(0)
        return float(r.sum()), float(r.max(initial=0.0)), len(r)

    def score(self, total: float, strongest: float) -> float:
        a, b, c = self.curve
        return float(1 / (1 + np.exp(-np.clip(a + b * np.clip(total, -10, 30) + c * strongest, -50, 50))))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 60) -> np.ndarray:
    """Newton's method for a ridge-penalised logistic regression with a constant."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + ridge * w
        hess = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w))
        change = np.linalg.solve(hess, grad)
        w -= change
        if np.abs(change).max() < 1e-8:
            break
    return w


def fit(texts: list[str], toxic: np.ndarray, fold: np.ndarray, odds: float | None = None, common: int = 800, **options) -> Model | None:
    """Dictionaries from the texts of fold 0, evidence and curve from those of fold 1.

    odds: toxic to ordinary texts in the corpus, where the sample holds them in another proportion.
    """
    own = [t for t, y, f in zip(texts, toxic, fold, strict=True) if y and f == 0]
    other = [t for t, y, f in zip(texts, toxic, fold, strict=True) if not y and f == 0]
    if not own or not other or not (toxic & (fold == 1)).any() or not (~toxic & (fold == 1)).any():
        return None
    count = collections.Counter(w for t in other for w in set(t.lower().encode().split()))
    base = b"".join(b" " + w + b" " for w, _ in reversed(sorted(count.items(), key=lambda x: (-x[1], x[0]))[:common]))
    theirs = marks(own, other, **options)
    # the ordinary end is as long as the toxic one, so that neither side gains by size
    ends, room = [], sum(map(len, theirs))
    for w, _ in sorted(count.items(), key=lambda x: (-x[1], x[0]))[common:]:
        room -= len(w) + 2
        if room < 0:
            break
        ends.append(b" " + w + b" ")
    model = Model(base + b"".join(theirs), base + b"".join(reversed(ends)), np.zeros(_HIGH - _LOW + 1), (0.0, 1.0, 0.0))
    kinds = np.ones((2, len(model.ratios)))
    later = [(t, bool(y)) for t, y, f in zip(texts, toxic, fold, strict=True) if f == 1]
    found = [(model.differences(t), y) for t, y in later]
    for d, y in found:
        kinds[int(y)] += np.bincount(d, minlength=kinds.shape[1])
    p = kinds / kinds.sum(axis=1, keepdims=True)
    model.ratios = np.log(p[1] / p[0])
    x = np.array([[np.clip(model.ratios[d].sum(), -10, 30), model.ratios[d].max(initial=0.0)] for d, _ in found])
    w = _logistic(x, np.array([y for _, y in found], dtype=float))
    y = np.array([y for _, y in found])
    shift = np.log(odds / (y.sum() / (~y).sum())) if odds else 0.0
    model.curve = (float(w[0] + shift), float(w[1]), float(w[2]))
    return model


def train(docs: DataFrame, labels: DataFrame, sample: int = 4_000, **options) -> Model | None:
    """Fit on at most `sample` toxic and as many ordinary labelled documents outside the held-out fold."""
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"] > 0: r["count"] for r in known.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return None
    known = labelled_sample(known.where("toxic > 0"), "doc_id", sample, "toxicity").unionByName(labelled_sample(known.where("toxic <= 0"), "doc_id", sample, "toxicity"))
    known = known.withColumnRenamed("doc_id", "label_id")
    rows = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(known), F.col("doc_id") == F.col("label_id"))
    rows = rows.select("doc_id", "text", "toxic", F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)).alias("fold")).toPandas().sort_values(["doc_id", "text"], kind="stable")
    if rows.empty:
        return None
    return fit(rows["text"].tolist(), rows["toxic"].to_numpy() > 0, rows["fold"].to_numpy(), sizes[True] / sizes[False], **options)


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score, the evidence behind it and the number of windows of every whole text."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            rows = []
            for t in batch.column(1):
                total, strongest, n = model.evidence(t.as_py() or "") if model else (0.0, 0.0, 0)
                rows.append((model.score(total, strongest) if model else 0.0, total, strongest, n))
            out = pd.DataFrame(rows, columns=["score", "evidence", "strongest", "windows"])
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(out[c].to_numpy(k)) for c, k in zip(out, ("f8", "f8", "f8", "i8"), strict=True))], names=["doc_id", *out])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).transform(map_batches, read, RESULT)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic"))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


QUERIES = {"op4_toxicity": op4_toxicity}
ORACLES: dict[str, str] = {}
