"""Exact percentiles without a buffer per group: bins are counted first, then only the values of the bins that hold a wanted rank."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .iterate import cut

c = F.col


def _same(a: str, b: str, keys: list[str]) -> Column:
    return reduce(lambda x, y: x & y, (c(f"{a}.{k}").eqNullSafe(c(f"{b}.{k}")) for k in keys), F.lit(True))


def percentiles(df: DataFrame, keys: list[str], value: str | Column, fractions: dict[str, float], bins: int = 1000, times: str | None = None, dealt_by: list[str] | None = None) -> DataFrame:
    """One row per group: the linearly interpolated percentiles named in fractions; rows without a value (null or NaN) take no part.

    A group's values are dealt to equal bins between its least and greatest; running counts over the bins (at most `bins` rows a group)
    give the bins of the wanted ranks, and only their values are counted one by one. Nothing but counts is ever held by group. times: a column that says how often
    each row counts. Names that begin with `q_` are taken. dealt_by: columns, the keys among them and none of them null, by whose values the rows already lie in buckets
    (`cut_bucketed`); then spans and wanted bins go to the rows, and of the rows only those of wanted bins move.
    """
    v = c(value) if isinstance(value, str) else value
    near = dealt_by or keys
    rows = df.select(*near, v.cast("double").alias("q_v"), (c(times) if times else F.lit(1)).cast("long").alias("q_t")).where("q_v is not null and not isnan(q_v)")
    span = rows.groupBy(*near).agg(F.min("q_v").alias("q_low"), F.max("q_v").alias("q_high"), F.sum("q_t").alias("q_n"))
    if dealt_by:
        span = cut(span, "spans")
        whole = span.groupBy(*keys).agg(F.min("q_low").alias("q_low"), F.max("q_high").alias("q_high"), F.sum("q_n").alias("q_n"))
        span = span.select(*near).join(whole, keys)
    span = span.where("q_n > 0")
    share = (c("q_v") - c("q_low")) / (c("q_high") - c("q_low"))
    bin_ = F.when(c("q_high") > c("q_low"), F.least(F.lit(bins - 1), F.floor(share * bins))).otherwise(0).cast("int")
    if dealt_by:
        both = rows.alias("x").join(span.hint("shuffle_hash").alias("g"), reduce(lambda x, y: x & y, (c(f"x.{k}") == c(f"g.{k}") for k in near)))
    else:
        both = rows.alias("x").join(span.alias("g"), _same("x", "g", keys)) if keys else rows.alias("x").crossJoin(F.broadcast(span.alias("g")))  # without keys, one row
    dealt = both.select(*(c(f"x.{k}").alias(k) for k in near), "q_v", "q_t", "q_n", bin_.alias("q_bin"))
    counted = dealt.groupBy(*near, "q_bin").agg(F.sum("q_t").alias("q_c"), F.first("q_n").alias("q_n"))
    if dealt_by:
        counted = counted.groupBy(*keys, "q_bin").agg(F.sum("q_c").alias("q_c"), F.first("q_n").alias("q_n"))
    before = F.sum("q_c").over(Window.partitionBy(*keys).orderBy("q_bin").rowsBetween(Window.unboundedPreceding, -1))
    ranks = F.array(*(F.struct(F.lit(name).alias("name"), F.lit(up).alias("up"), (F.lit(float(f)) * (c("q_n") - 1)).alias("at")) for name, f in fractions.items() for up in (False, True)))
    wanted = counted.withColumn("q_before", F.coalesce(before, F.lit(0))).withColumn("q_w", F.explode(ranks))
    wanted = wanted.withColumn("q_rank", F.when(c("q_w.up"), F.ceil("q_w.at")).otherwise(F.floor("q_w.at")))
    wanted = wanted.where((c("q_rank") >= c("q_before")) & (c("q_rank") < c("q_before") + c("q_c")))
    wanted = wanted.select(*keys, "q_bin", (c("q_rank") - c("q_before")).alias("q_place"), c("q_w.name").alias("q_name"), c("q_w.up").alias("q_up"), (c("q_w.at") - F.floor("q_w.at")).alias("q_part"))
    own = [*keys, "q_bin"]
    if dealt_by:
        wanted = cut(wanted, "wanted")
        asked = span.select(*near).join(wanted.groupBy(*keys).agg(F.collect_set("q_bin").alias("q_bins")), keys)
        kept = dealt.join(asked.hint("shuffle_hash"), near).where(F.array_contains("q_bins", c("q_bin")))
    else:
        kept = dealt.alias("d").join(wanted.select(*own).distinct().alias("a"), _same("d", "a", own), "left_semi")
    values = kept.groupBy(*own, "q_v").agg(F.sum("q_t").alias("q_k"))
    values = values.withColumn("q_upto", F.sum("q_k").over(Window.partitionBy(*own).orderBy("q_v").rowsBetween(Window.unboundedPreceding, 0)))
    inside = (c("a.q_place") < c("d.q_upto")) & (c("a.q_place") >= c("d.q_upto") - c("d.q_k"))
    hit = values.alias("d").join(wanted.alias("a"), _same("d", "a", own) & inside).select(*(c(f"d.{k}").alias(k) for k in keys), "q_v", "q_name", "q_up", "q_part")

    def found(name: str) -> Column:
        low, high = (F.max(F.when((c("q_name") == name) & (c("q_up") == up), c("q_v"))) for up in (False, True))
        part = F.max(F.when(c("q_name") == name, c("q_part")))
        return F.when(low == high, low).otherwise(low * (1 - part) + high * part).alias(name)  # equal ones stay as they are, to the last bit

    return hit.groupBy(*keys).agg(*(found(name) for name in fractions), F.count(F.lit(1)).alias("q_found")).where("q_found > 0").drop("q_found")
