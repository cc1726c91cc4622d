"""Queries of aggregates over cells, rings, roads and runs."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from hillframe.operators import focal as Fo
from hillframe.operators.quantiles import percentiles
from hillframe.plans.grids import _ROUGH
from hillframe.streaming import twins

from .registry import Registry

R = Registry()
QUERIES, ORACLES = R.queries, R.oracles
c = F.col


@R.add("d2_roughness_summary", "cells", f"WITH {_ROUGH} SELECT count(rough) AS n, count(*) FILTER (rough >= 1.5) AS hot, round(quantile_cont(rough, 0.5), 6) AS p50, round(quantile_cont(rough, 0.9), 6) AS p90, round(quantile_cont(rough, 0.99), 6) AS p99 FROM ro")
def d2(cells):
    t = Fo.roughness(cells, "z")
    p = percentiles(t, [], "rough", {"p50": 0.5, "p90": 0.9, "p99": 0.99})
    return t.agg(F.count("rough").alias("n"), F.count_if(c("rough") >= 1.5).alias("hot")).join(F.broadcast(p), how="left").select("n", "hot", *(F.round(k, 6).alias(k) for k in ("p50", "p90", "p99")))  # one row each


@R.add("d3_distribution", "cells", "SELECT code, count(z) AS n, round(quantile_cont(z, 0.5), 6) AS p50, round(max(z), 6) AS worst, round(avg(CASE WHEN z >= 1020 THEN 1.0 ELSE 0.0 END), 6) AS share FROM cells WHERE z IS NOT NULL GROUP BY 1")
def d3(cells):
    known = cells.where("z is not null")
    t = known.groupBy("code").agg(F.count("z").alias("n"), F.round(F.max("z"), 6).alias("worst"), F.round(F.avg((c("z") >= 1020).cast("double")), 6).alias("share"))
    return t.join(percentiles(known, ["code"], "z", {"p50": 0.5}), "code").withColumn("p50", F.round("p50", 6))


@R.add("d5_summary", "cells", "SELECT round(min(z), 6) AS low, round(max(z), 6) AS high, round(quantile_cont(z, 0.5), 6) AS p50, round(quantile_cont(z, 0.95), 6) AS p95, round(avg(z), 6) AS mean FROM cells")
def d5(cells):
    p = percentiles(cells, [], "z", {"p50": 0.5, "p95": 0.95})
    t = cells.agg(F.round(F.min("z"), 6).alias("low"), F.round(F.max("z"), 6).alias("high"), F.round(F.avg("z"), 6).alias("mean"))
    return t.join(F.broadcast(p), how="left").select("low", "high", *(F.round(k, 6).alias(k) for k in ("p50", "p95")), "mean")  # one row each


@R.add("d12_area", "ring", """
WITH e AS (SELECT poly_id, x, y, coalesce(lead(x) OVER q, first_value(x) OVER q) AS x1, coalesce(lead(y) OVER q, first_value(y) OVER q) AS y1 FROM ring WINDOW q AS (PARTITION BY poly_id ORDER BY seq))
SELECT poly_id, round(abs(sum(x * y1 - x1 * y)) / 2, 6) AS area, round(sum(sqrt(pow(x1 - x, 2) + pow(y1 - y, 2))), 6) AS perimeter FROM e GROUP BY 1""")
def d12(ring):
    w = Window.partitionBy("poly_id").orderBy("seq")
    nxt = lambda a: F.coalesce(F.lead(a).over(w), F.first(a).over(w))
    e = ring.withColumns({"x1": nxt("x"), "y1": nxt("y")})
    return e.groupBy("poly_id").agg(F.round(F.abs(F.sum(c("x") * c("y1") - c("x1") * c("y"))) / 2, 6).alias("area"), F.round(F.sum(F.hypot(c("x1") - c("x"), c("y1") - c("y"))), 6).alias("perimeter"))


@R.add("d29_counters", "run", "SELECT site % 10 AS site, step, count(*) AS n, count(*) FILTER (NOT ok) AS failed FROM run GROUP BY ROLLUP (site % 10, step)")
def d29(run):
    return run.withColumn("site", c("site") % 10).rollup("site", "step").agg(F.count(F.lit(1)).alias("n"), F.count_if(~c("ok")).alias("failed"))


@R.add("d21_station_bins", "road_node", "SELECT road_id, CAST(floor(x / 20) AS BIGINT) AS bin, round(sum(w * z), 6) AS wv, sum(w) AS w FROM road_node GROUP BY 1, 2")
def d21(n):
    return n.groupBy("road_id", F.floor(c("x") / 20).alias("bin")).agg(F.round(F.sum(c("w") * c("z")), 6).alias("wv"), F.sum("w").alias("w"))


@R.add("c12_end_join", "road_end", """
WITH j AS (SELECT a.objectid AS a, b.objectid AS b, sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)) AS d FROM road_end a JOIN road_end b ON a.objectid <> b.objectid AND a.authority <> b.authority AND abs(a.x - b.x) <= 3 AND abs(a.y - b.y) <= 3 AND pow(a.x - b.x, 2) + pow(a.y - b.y, 2) <= 9), k AS (SELECT a, count(*) AS n FROM j GROUP BY 1)
SELECT j.a, j.b, round(d, 6) + 0.0 AS d, ka.n = 1 AND kb.n = 1 AS mutual FROM j JOIN k ka ON ka.a = j.a JOIN k kb ON kb.a = j.b""")
def c12(ends):
    cell = lambda t: t.withColumns({"cx": F.floor(c("x") / 3), "cy": F.floor(c("y") / 3)})
    steps = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)))
    a = cell(ends).withColumn("t", F.explode(steps)).select(c("objectid").alias("a"), c("authority").alias("aa"), c("x").alias("ax"), c("y").alias("ay"), (c("cx") + c("t.i")).alias("cx"), (c("cy") + c("t.j")).alias("cy"))
    b = cell(ends).select(c("objectid").alias("b"), c("authority").alias("ba"), c("x").alias("bx"), c("y").alias("by"), "cx", "cy")
    j = a.join(b, ["cx", "cy"]).withColumn("d", F.hypot(c("ax") - c("bx"), c("ay") - c("by"))).where("a <> b and aa <> ba and d <= 3").select("a", "b", "d")
    k = j.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
    return j.join(k, "a").join(k.select(c("a").alias("b"), c("n").alias("m")), "b").select("a", "b", (F.round("d", 6) + F.lit(0.0)).alias("d"), ((c("n") == 1) & (c("m") == 1)).alias("mutual"))


@R.add("c35_nearer_claim", "cells", """
WITH p AS (SELECT r, c, 'left' AS side, 0 AS o, abs(c - 30) AS d FROM cells UNION ALL SELECT r, c, 'right', 1, abs(c - 61) FROM cells) SELECT r, c, arg_min(side, d * 10 + o) AS side, min(d) AS d FROM p GROUP BY 1, 2""")
def c35(cells):
    p = cells.select("r", "c", F.lit("left").alias("side"), F.lit(0).alias("o"), F.abs(c("c") - 30).alias("d")).unionByName(cells.select("r", "c", F.lit("right").alias("side"), F.lit(1).alias("o"), F.abs(c("c") - 61).alias("d")))
    return p.groupBy("r", "c").agg(F.min_by("side", F.struct("d", "o")).alias("side"), F.min("d").alias("d"))


@R.add("j1_tile_intake", "attempt", None)
def j1(attempt):
    return twins.intake_batch(attempt, 0.3)


@R.add("j2_step_monitor", "run", "SELECT step, strftime(date_trunc('hour', finished_at), '%Y-%m-%d %H:%M:%S') AS hour, count(*) AS n, round(avg(seconds), 6) AS mean, round(quantile_cont(seconds, 0.5), 6) AS p50, round(quantile_cont(seconds, 0.9), 6) AS p90, arg_max(ok, (finished_at, event_id)) AS ok FROM run GROUP BY 1, 2")
def j2(run):
    t = twins.monitor(run.withColumn("finished_at", c("finished_at").cast("timestamp")))
    return t.select("step", F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("hour"), "n", *(F.round(v, 6).alias(v) for v in ("mean", "p50", "p90")), "ok")


ORACLES["j1_tile_intake"] = __import__("hillframe.sources.fixtures", fromlist=["ctes"]).ctes("attempt") + " SELECT tile, max(attempt) FILTER (nodata_share <= 0.3) AS attempt, count(*) AS attempts, count(*) FILTER (NOT nodata_share <= 0.3) AS failed FROM attempt GROUP BY 1"
