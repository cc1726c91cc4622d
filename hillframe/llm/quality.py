"""Quality rules: a learned decision list over text statistics.

`text_statistics` reads the statistics of every whole text in one pass over its bytes. `learn_rules` runs sequential
covering on a bounded, seeded sample of labelled rows: it grows a conjunction of thresholds by information gain on two
thirds of what is left, prunes it on the other third, keeps it while it is precise there, removes what it covers and begins
again. `DecisionList.column` emits the ordered rules as one Spark conditional expression.

Defined results: a null text counts as empty (no words: base_failed); labels repeated for one document count by their
smallest value, null labels not at all; without labels of both kinds the list is empty and keeps all that passes the base;
an empty table gives no rows; other columns are ignored. Ties between conditions go to the earlier feature and the lower
threshold.
"""

from __future__ import annotations

import dataclasses
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Words, labelled_sample, map_batches, mix, slices, text_bytes

LONGS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars", "n_upper", "n_digits", "n_marks", "n_lines", "n_distinct", "n_stops"]
#: What the rules may test, as expressions of the statistics; all are rates, so they mean the same at any length.
FEATURES = {
    "mean_word": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
    "mark_share": "n_marks / greatest(word_chars, 1)",
    "words_per_line": "n_words / greatest(n_lines, 1)",
    "distinct_share": "n_distinct / greatest(n_words, 1)",
    "stops_per_word": "n_stops / greatest(n_words, 1)",
}
_SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
_MARKS = np.isin(np.arange(256), list(b"!?;:()[]{}@/\\_=+~^\"'`-"))


def _window_repeats(h: np.ndarray, k: int) -> int:
    """Words inside k-word windows that occur twice or more."""
    n = len(h) - k + 1
    if n < 2:
        return 0
    with np.errstate(over="ignore"):
        w = np.zeros(n, dtype=np.uint64)
        for j in range(k):
            w = (w + h[j : n + j]) * np.uint64(0xD6E8FEB86659FD93)
    w = mix(w)
    order = np.argsort(w, kind="stable")
    same = w[order][1:] == w[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(n + k, dtype=np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + k, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def text_statistics(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the statistics in LONGS of each whole text."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            ids = batch.column(0)
            for a, b in slices(offsets):
                part, off = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                w = Words(part, off)
                h = w.hashes(fold=False)
                raw = part.tobytes()
                out = np.zeros((b - a, len(LONGS)), dtype=np.int64)
                for i in range(b - a):
                    x, y = int(off[i]), int(off[i + 1])
                    if x == y:
                        continue
                    count = np.bincount(part[x:y], minlength=256)
                    white = int(count[9:14].sum() + count[32])
                    chars = y - x - int(count[128:192].sum())
                    own = h[w.first[i] : w.first[i + 1]]
                    lines = [s for s in raw[x:y].split(b"\n") if s and not s.isspace()]
                    out[i] = (
                        len(own), chars - white, count[_SYMBOLS].sum(), len(lines) - len(set(lines)), _window_repeats(own, 5), chars,
                        count[65:91].sum(), count[48:58].sum(), count[_MARKS].sum(), len(lines), len(np.unique(own)), count[46],
                    )
                yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), *(pa.array(out[:, j]) for j in range(len(LONGS)))], names=["doc_id", *LONGS])

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in LONGS)
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).transform(map_batches, read, schema)


@dataclasses.dataclass(frozen=True)
class Rule:
    """All conditions (feature, at_least, threshold) hold: the text is rejected."""

    conditions: tuple[tuple[str, bool, float], ...]
    covered: int
    precision: float

    def sql(self) -> str:
        return " AND ".join(f"({FEATURES[f]}) {'>=' if up else '<='} {t!r}D" for f, up, t in self.conditions)


@dataclasses.dataclass(frozen=True)
class DecisionList:
    rules: tuple[Rule, ...]

    def column(self) -> F.Column:
        """true: kept. The first rule that holds decides; none: kept."""
        out = None
        for rule in self.rules:
            out = F.when(F.expr(rule.sql()), False) if out is None else out.when(F.expr(rule.sql()), False)
        return F.lit(True) if out is None else out.otherwise(True)


def _holds(x: np.ndarray, conditions: list[tuple[int, bool, float]]) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for f, up, t in conditions:
        out &= x[:, f] >= t if up else x[:, f] <= t
    return out


def learn_rules(x: np.ndarray, bad: np.ndarray, fold: np.ndarray, names: list[str], most_rules: int = 12, most_conditions: int = 4, precision: float = 0.95, least: int = 5, cuts: int = 64) -> DecisionList:
    """Sequential covering of the rows marked bad. fold: 0 and 1 grow, 2 prunes."""
    rules: list[Rule] = []
    left = np.ones(len(x), dtype=bool)
    grids = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, cuts))) if len(x) else np.zeros(0) for f in range(x.shape[1])]
    while len(rules) < most_rules:
        grow, prune = left & (fold != 2), left & (fold == 2)
        if (bad & grow).sum() < least:
            break
        conditions: list[tuple[int, bool, float]] = []
        inside = grow.copy()
        while len(conditions) < most_conditions:
            p, n = int((bad & inside).sum()), int((~bad & inside).sum())
            if not n or not p:
                break
            base, best = math.log2(p / (p + n)), (1e-9, None)
            xi, bi = x[inside], bad[inside]
            for f, grid in enumerate(grids):
                order = np.argsort(xi[:, f], kind="stable")
                v, cum = xi[order, f], np.concatenate([[0], np.cumsum(bi[order])])
                for up in (True, False):
                    at = np.searchsorted(v, grid, side="left" if up else "right")
                    p1 = p - cum[at] if up else cum[at]
                    t1 = len(v) - at if up else at
                    with np.errstate(divide="ignore", invalid="ignore"):
                        gain = np.where(p1 >= least, p1 * (np.log2(p1 / t1) - base), -1.0)
                    j = int(np.argmax(gain))
                    if gain[j] > best[0]:
                        best = (float(gain[j]), (f, up, float(grid[j])))
            if best[1] is None:
                break
            conditions.append(best[1])
            inside &= _holds(x, [best[1]])
        if not conditions:
            break

        def worth(c, prune=prune):
            h = _holds(x, c) & prune
            return ((bad & h).sum() - (~bad & h).sum() + 1) / (h.sum() + 2)

        while len(conditions) > 1 and worth(conditions[:-1]) >= worth(conditions):
            conditions.pop()
        hit = _holds(x, conditions) & left
        share = (bad & hit).sum() / max(1, hit.sum())
        tried = _holds(x, conditions) & prune
        if share < precision or (tried.sum() >= least and (bad & tried).sum() / tried.sum() < precision):
            break
        rules.append(Rule(tuple((names[f], up, t) for f, up, t in conditions), int(hit.sum()), float(share)))
        left &= ~hit
    return DecisionList(tuple(rules))


def train_rules(docs: DataFrame, labels: DataFrame, sample: int = 20_000, **options) -> DecisionList:
    """Learn from at most `sample` labelled documents (quality 0: bad), the smallest seeded hashes of their ids."""
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = labelled_sample(known, "doc_id", sample, "quality").withColumnRenamed("doc_id", "label_id")
    some = docs.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("label_id"), "left_semi")  # at most `sample` rows
    stats = text_statistics(some).where("n_words >= 10").join(F.broadcast(known), F.col("doc_id") == F.col("label_id"))
    rows = stats.select("doc_id", "quality", F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(3)).alias("fold"), *(F.expr(e).alias(f) for f, e in FEATURES.items())).toPandas()
    rows = rows.sort_values("doc_id", kind="stable")
    return learn_rules(rows[list(FEATURES)].to_numpy("float64"), rows["quality"].to_numpy() == 0, rows["fold"].to_numpy(), list(FEATURES), **options)


def judge(docs: DataFrame, rules: DecisionList, least_words: int = 10, most_repeat_percent: int = 20) -> DataFrame:
    """Statistics, base_failed and kept of every document."""
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeat_percent * F.col("n_words"))
    return text_statistics(docs).withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & rules.column())


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rules = train_rules(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality"))
    return judge(docs, rules).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


QUERIES = {"op2_quality": op2_quality}
ORACLES: dict[str, str] = {}
