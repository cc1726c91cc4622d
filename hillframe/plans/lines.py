"""Queries along roads: stations, windows, runs, joins of lines, bridge flags."""

import sys

from pyspark.sql import Window
from pyspark.sql import functions as F

from hillframe.functions import scalars as S
from hillframe.operators import lines as L

from .registry import Registry

R = Registry()
QUERIES, ORACLES = R.queries, R.oracles
c = F.col
r6 = S.r6
ALL = -sys.maxsize, 0

_ST = """st AS (SELECT road_id, seq, x, y, z, w, sum(d) OVER (PARTITION BY road_id ORDER BY seq) AS s
  FROM (SELECT *, coalesce(sqrt(pow(x - lag(x) OVER q, 2) + pow(y - lag(y) OVER q, 2)), 0) AS d FROM road_node WINDOW q AS (PARTITION BY road_id ORDER BY seq)))"""
_SEG = _ST + """, sg AS (SELECT * FROM (SELECT road_id, seq AS seg, x AS x0, y AS y0, z AS z0, s AS s0, w AS w0, lead(x) OVER q AS x1, lead(y) OVER q AS y1, lead(z) OVER q AS z1, lead(s) OVER q AS s1, lead(w) OVER q AS w1
  FROM st WINDOW q AS (PARTITION BY road_id ORDER BY seq)) WHERE x1 IS NOT NULL)"""


@R.add("e1_cumulative_length", "road_node", f"WITH {_ST} SELECT road_id, seq, round(s, 6) + 0.0 AS s FROM st")
def e1(n):
    return L.stations(n).select("road_id", "seq", r6(c("s")).alias("s"))


@R.add("e2_rolling_max", "road_node", """
SELECT road_id, seq, max(z) OVER (PARTITION BY road_id ORDER BY seq ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS back, max(z) OVER (PARTITION BY road_id ORDER BY seq ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS ahead FROM road_node""")
def e2(n):
    back, ahead = L.baseline(c("z"), 5, L.along())
    return n.select("road_id", "seq", back.alias("back"), ahead.alias("ahead"))


_UNSTABLE = """u AS (SELECT road_id, seq, greatest(max(z) OVER (PARTITION BY road_id ORDER BY seq ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), max(z) OVER (PARTITION BY road_id ORDER BY seq ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)) - z >= 6 AS unstable FROM road_node)"""


def _unstable(n):
    back, ahead = L.baseline(c("z"), 5, L.along())
    return n.select("road_id", "seq", (F.greatest(back, ahead) - c("z") >= 6).alias("unstable"))


@R.add("e3_unstable", "road_node", f"WITH {_UNSTABLE} SELECT * FROM u")
def e3(n):
    return _unstable(n)


@R.add("e4_runs", "road_node", f"""
WITH {_UNSTABLE}, g AS (SELECT *, seq - row_number() OVER (PARTITION BY road_id, unstable ORDER BY seq) AS g FROM u)
SELECT road_id, min(seq) AS first, max(seq) AS last, count(*) AS n FROM g WHERE unstable GROUP BY road_id, g""")
def e4(n):
    return L.runs(_unstable(n), "road_id", "seq", "unstable").select("road_id", "first", "last", "n")


@R.add("e6_hole_closing", "road_node", f"""
WITH {_UNSTABLE}, g AS (SELECT *, seq - row_number() OVER (PARTITION BY road_id, unstable ORDER BY seq) AS g FROM u),
h AS (SELECT road_id, seq, unstable, count(*) OVER (PARTITION BY road_id, unstable, g) AS n, min(seq) OVER (PARTITION BY road_id, unstable, g) AS a, max(seq) OVER (PARTITION BY road_id, unstable, g) AS b FROM g)
SELECT road_id, seq, unstable OR (n <= 2 AND a > 0 AND b < 19) AS closed FROM h""")
def e6(n):
    u = _unstable(n)
    holes = L.runs(u.withColumn("stable", ~c("unstable")), "road_id", "seq", "stable").where("n <= 2")
    ends = u.groupBy("road_id").agg(F.min("seq").alias("a"), F.max("seq").alias("b"))
    fill = holes.join(ends, "road_id").where("first > a and last < b").select("road_id", F.explode(F.sequence("first", "last")).alias("seq"), F.lit(True).alias("fill"))
    return u.join(fill, ["road_id", "seq"], "left").select("road_id", "seq", (c("unstable") | F.coalesce("fill", F.lit(False))).alias("closed"))


@R.add("e9_gap_fill", "road_node", f"""
WITH {_ST}, k AS (SELECT road_id, seq, s, CASE WHEN seq % 4 <> 2 AND seq % 7 <> 5 AND seq <> 0 THEN z END AS v FROM st),
b AS (SELECT *, last_value(CASE WHEN v IS NOT NULL THEN s END IGNORE NULLS) OVER p AS s0, last_value(v IGNORE NULLS) OVER p AS v0, first_value(CASE WHEN v IS NOT NULL THEN s END IGNORE NULLS) OVER f AS s1, first_value(v IGNORE NULLS) OVER f AS v1 FROM k
  WINDOW p AS (PARTITION BY road_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), f AS (PARTITION BY road_id ORDER BY seq ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT road_id, seq, round(CASE WHEN v IS NOT NULL THEN v WHEN s1 - s0 <= 16 THEN v0 + (v1 - v0) * (s - s0) / (s1 - s0) END, 6) + 0.0 AS v FROM b""")
def e9(n):
    k = L.stations(n).withColumn("v", F.when(F.expr("seq % 4 <> 2 and seq % 7 <> 5 and seq <> 0"), c("z")))
    return k.select("road_id", "seq", r6(L.fill_gaps(k, "road_id", "seq", "s", "v", 16.0)).alias("v"))


@R.add("e11_width_closing", "road_node", f"""
WITH {_ST}, m AS (SELECT *, max(w + seq % 3) OVER (PARTITION BY road_id ORDER BY s RANGE BETWEEN 20 PRECEDING AND 20 FOLLOWING) AS m FROM st)
SELECT road_id, seq, greatest(1.5, min(m) OVER (PARTITION BY road_id ORDER BY s RANGE BETWEEN 20 PRECEDING AND 20 FOLLOWING)) AS width FROM m""")
def e11(n):
    near = "over (partition by road_id order by s range between 20D preceding and 20D following)"
    m = L.stations(n).withColumn("m", F.expr(f"max(w + seq % 3) {near}"))
    return m.select("road_id", "seq", F.greatest(F.lit(1.5), F.expr(f"min(m) {near}")).alias("width"))


@R.add("e12_range_mean", "road_node", f"""
WITH {_ST} SELECT road_id, seq, round(CASE WHEN seq % 6 = 0 THEN z ELSE avg(z) OVER (PARTITION BY road_id ORDER BY s RANGE BETWEEN 12.5 PRECEDING AND 12.5 FOLLOWING) END, 6) + 0.0 AS z FROM st""")
def e12(n):
    mean = F.expr("avg(z) over (partition by road_id order by s range between 12.5D preceding and 12.5D following)")
    return L.stations(n).select("road_id", "seq", r6(F.when(c("seq") % 6 == 0, c("z")).otherwise(mean)).alias("z"))


@R.add("e13_three_taps", "road_node", """
SELECT road_id, seq, round(coalesce(0.25 * lag(z) OVER q + 0.5 * z + 0.25 * lead(z) OVER q, z), 6) + 0.0 AS z FROM road_node WINDOW q AS (PARTITION BY road_id ORDER BY seq)""")
def e13(n):
    return n.select("road_id", "seq", r6(F.coalesce(0.25 * F.lag("z").over(L.along()) + 0.5 * c("z") + 0.25 * F.lead("z").over(L.along()), c("z"))).alias("z"))


@R.add("e15_second_difference", "road_node", """
SELECT * FROM (SELECT road_id, seq, round(abs(lag(z) OVER q - 2 * z + lead(z) OVER q), 6) + 0.0 AS d2 FROM road_node WINDOW q AS (PARTITION BY road_id ORDER BY seq)) WHERE d2 IS NOT NULL""")
def e15(n):
    return n.select("road_id", "seq", r6(F.abs(F.lag("z").over(L.along()) - 2 * c("z") + F.lead("z").over(L.along()))).alias("d2")).where("d2 is not null")


@R.add("e17_running_median", "road_node", """
SELECT road_id, seq, round(CASE WHEN v IS NULL THEN NULL WHEN count(v) OVER q >= 3 THEN median(v) OVER q ELSE v END, 6) + 0.0 AS m FROM (SELECT road_id, seq, CASE WHEN seq % 5 > 1 THEN z END AS v FROM road_node) WINDOW q AS (PARTITION BY road_id ORDER BY seq ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)""")
def e17(n):
    q = L.along().rowsBetween(-3, 3)
    t = n.select("road_id", "seq", F.when(c("seq") % 5 > 1, c("z")).alias("v"))
    # a null stays null, and a value with fewer than three known ones around it stays as it is
    return t.select("road_id", "seq", r6(F.when(c("v").isNull(), None).when(F.count("v").over(q) >= 3, F.percentile("v", F.lit(0.5)).over(q)).otherwise(c("v"))).alias("m"))


@R.add("e18_prefix", "road_node", """
SELECT road_id, seq, bool_and(z < 1007) OVER (PARTITION BY road_id ORDER BY seq) AS inside FROM road_node""")
def e18(n):
    return n.select("road_id", "seq", (F.min((c("z") < 1007).cast("int")).over(L.along().rowsBetween(*ALL)) == 1).alias("inside"))


@R.add("e26_hold_across", "road_node", """
SELECT road_id, seq, last_value(CASE WHEN seq % 3 = 0 THEN z END IGNORE NULLS) OVER (PARTITION BY road_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS z FROM road_node""")
def e26(n):
    return n.select("road_id", "seq", F.last(F.when(c("seq") % 3 == 0, c("z")), True).over(L.along().rowsBetween(*ALL)).alias("z"))


@R.add("e28_blend_ends", "road_node", f"""
WITH {_ST}, e AS (SELECT road_id, max(s) AS len FROM st GROUP BY 1)
SELECT road_id, seq, round(z + greatest(0, 1 - s / 30) * 2.0 + greatest(0, 1 - (len - s) / 30) * -1.5, 6) + 0.0 AS z FROM st JOIN e USING (road_id)""")
def e28(n):
    t = L.stations(n).withColumn("len", F.max("s").over(Window.partitionBy("road_id")))
    w0, w1 = F.greatest(F.lit(0.0), 1 - c("s") / 30), F.greatest(F.lit(0.0), 1 - (c("len") - c("s")) / 30)
    return t.select("road_id", "seq", r6(c("z") + w0 * 2.0 + w1 * -1.5).alias("z"))


@R.add("e10_slew_limit", "road_node", f"""
WITH RECURSIVE {_ST}, p AS (SELECT road_id, row_number() OVER (PARTITION BY road_id ORDER BY s) AS k, s, CASE WHEN seq % 9 <> 4 THEN z END AS v FROM st),
f AS (SELECT road_id, k, s, v FROM p WHERE k = 1 UNION ALL SELECT p.road_id, p.k, p.s, CASE WHEN p.v IS NULL OR f.v IS NULL THEN p.v ELSE greatest(f.v - 0.4 * abs(p.s - f.s), least(f.v + 0.4 * abs(p.s - f.s), p.v)) END FROM f JOIN p ON p.road_id = f.road_id AND p.k = f.k + 1),
b AS (SELECT road_id, k, s, v FROM f WHERE (road_id, k) IN (SELECT road_id, max(k) FROM p GROUP BY 1) UNION ALL SELECT f.road_id, f.k, f.s, CASE WHEN f.v IS NULL OR b.v IS NULL THEN f.v ELSE greatest(b.v - 0.4 * abs(f.s - b.s), least(b.v + 0.4 * abs(f.s - b.s), f.v)) END FROM b JOIN f ON f.road_id = b.road_id AND f.k = b.k - 1)
SELECT road_id, round(s, 6) + 0.0 AS s, round(v, 6) + 0.0 AS v FROM b""")
def e10(n):
    t = L.stations(n).select("road_id", "s", F.when(c("seq") % 9 != 4, c("z")).alias("v"))
    return L.slew_limit(t, "road_id", "s", "v", 0.4).select("road_id", r6(c("s")).alias("s"), r6(c("v")).alias("v"))


_TAN = """t AS (SELECT road_id, seq, x, y, w, coalesce(lead(x) OVER q, x) - coalesce(lag(x) OVER q, x) AS dx, coalesce(lead(y) OVER q, y) - coalesce(lag(y) OVER q, y) AS dy FROM road_node WINDOW q AS (PARTITION BY road_id ORDER BY seq))"""


@R.add("g2_tangent", "road_node", f"WITH {_TAN} SELECT road_id, seq, round(dx / sqrt(dx*dx + dy*dy), 6) + 0.0 AS tx, round(dy / sqrt(dx*dx + dy*dy), 6) + 0.0 AS ty FROM t")
def g2(n):
    return L.tangents(n).select("road_id", "seq", r6(c("tx")).alias("tx"), r6(c("ty")).alias("ty"))


@R.add("g5_offset_line", "road_node", f"WITH {_TAN} SELECT road_id, seq, round(x - dy / sqrt(dx*dx + dy*dy) * (w / 2 + 0.5), 6) + 0.0 AS x, round(y + dx / sqrt(dx*dx + dy*dy) * (w / 2 + 0.5), 6) + 0.0 AS y FROM t")
def g5(n):
    off = c("w") / 2 + 0.5
    return L.tangents(n).select("road_id", "seq", r6(c("x") + c("nx") * off).alias("x"), r6(c("y") + c("ny") * off).alias("y"))


@R.add("g35_edge_marking", "road_node", f"WITH {_TAN} SELECT road_id, seq, round(x - dy / sqrt(dx*dx + dy*dy) * greatest(0.05, w / 2 - 0.06), 6) + 0.0 AS x, round(y + dx / sqrt(dx*dx + dy*dy) * greatest(0.05, w / 2 - 0.06), 6) + 0.0 AS y FROM t")
def g35(n):
    off = F.greatest(F.lit(0.05), c("w") / 2 - 0.06)
    return L.tangents(n).select("road_id", "seq", r6(c("x") + c("nx") * off).alias("x"), r6(c("y") + c("ny") * off).alias("y"))


_LEN = f"{_SEG}, ln AS (SELECT road_id, max(s1) AS len, max(seg) AS ls FROM sg GROUP BY 1)"
_AT = """tt AS (SELECT road_id, len, ls, CAST(i AS BIGINT) AS i, CASE WHEN i = floor(len / 8) AND i > 0 AND len - floor(len / 8) * 8 <= 0.25 THEN len ELSE i * 8.0 END AS pos FROM (SELECT *, unnest(generate_series(0, CAST(floor(len / 8) AS BIGINT))) AS i FROM ln)
  UNION ALL SELECT road_id, len, ls, CAST(floor(len / 8) + 1 AS BIGINT), len FROM ln WHERE len - floor(len / 8) * 8 > 0.25)"""


@R.add("g1_densify", "road_node", f"""
WITH {_LEN}, {_AT}
SELECT road_id, i, round(pos, 6) + 0.0 AS "at", round(x0 + (pos - s0) / (s1 - s0) * (x1 - x0), 6) + 0.0 AS x, round(z0 + (pos - s0) / (s1 - s0) * (z1 - z0), 6) + 0.0 AS z
FROM tt JOIN sg USING (road_id) WHERE pos >= s0 AND (pos < s1 OR (seg = ls AND pos <= s1))""")
def g1(n):
    segs = L.segments(n)
    at = L.every(segs.groupBy("road_id").agg(F.max("s1").alias("length")), 8.0)
    return L.sample_at(segs, at).select("road_id", "i", r6(c("at")).alias("at"), r6(c("x")).alias("x"), r6(c("z")).alias("z"))


@R.add("c21_station_interpolation", "road_node", f"""
WITH {_LEN}, p AS (SELECT road_id, len, ls, k, len * k / 7.0 AS pos FROM ln, (SELECT unnest(generate_series(0, 6)) AS k))
SELECT road_id, CAST(k AS BIGINT) AS k, round(y0 + (pos - s0) / (s1 - s0) * (y1 - y0), 6) + 0.0 AS y, round(z0 + (pos - s0) / (s1 - s0) * (z1 - z0), 6) + 0.0 AS z FROM p JOIN sg USING (road_id) WHERE pos >= s0 AND (pos < s1 OR (seg = ls AND pos <= s1))""")
def c21(n):
    segs = L.segments(n)
    p = segs.groupBy("road_id").agg(F.max("s1").alias("len")).select("road_id", "len", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(6).cast("long"))).alias("k")).withColumn("at", c("len") * c("k") / 7.0)
    return L.sample_at(segs, p).select("road_id", "k", r6(c("y")).alias("y"), r6(c("z")).alias("z"))


@R.add("g22_post_stations", "road_node", f"""
WITH {_LEN} SELECT road_id, round(pos, 6) + 0.0 AS "at" FROM (SELECT road_id, unnest(generate_series(0, CAST(floor(len / 12) AS BIGINT))) * 12.0 AS pos FROM ln UNION ALL SELECT road_id, len FROM ln WHERE len - floor(len / 12) * 12 > 0.35 * 12)""")
def g22(n):
    ln = L.segments(n).groupBy("road_id").agg(F.max("s1").alias("len"))
    k = F.floor(c("len") / 12)
    regular = ln.select("road_id", F.explode(F.sequence(F.lit(0).cast("long"), k)).alias("i")).select("road_id", (c("i") * 12.0).alias("at"))
    return regular.unionByName(ln.where(c("len") - k * 12 > 0.35 * 12).select("road_id", c("len").alias("at"))).select("road_id", r6(c("at")).alias("at"))


@R.add("g18_dashes", "road_node", f"""
WITH {_LEN}, d AS (SELECT road_id, len, unnest(generate_series(0, CAST(floor(len / 9) AS BIGINT))) * 9.0 AS s0 FROM ln)
SELECT road_id, round(s0, 6) + 0.0 AS s0, round(least(s0 + 3, len), 6) + 0.0 AS s1 FROM d WHERE least(s0 + 3, len) - s0 >= 0.25""")
def g18(n):
    ln = L.segments(n).groupBy("road_id").agg(F.max("s1").alias("len"))
    d = ln.select("road_id", "len", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(c("len") / 9))).alias("i")).withColumn("s0", c("i") * 9.0)
    return d.withColumn("s1", F.least(c("s0") + 3, c("len"))).where("s1 - s0 >= 0.25").select("road_id", r6(c("s0")).alias("s0"), r6(c("s1")).alias("s1"))


@R.add("g6_pieces", "road_node", f"""
WITH {_LEN}, p AS (SELECT road_id, len, unnest(generate_series(0, CAST(ceil(len / 20) AS BIGINT) - 1)) AS i FROM ln)
SELECT road_id, CAST(i AS BIGINT) AS i, i * 20.0 AS s0, round(CASE WHEN len - (i + 1) * 20 < 2 THEN len ELSE (i + 1) * 20 END, 6) + 0.0 AS s1 FROM p WHERE i = 0 OR len - i * 20 >= 2""")
def g6(n):
    ln = L.segments(n).groupBy("road_id").agg(F.max("s1").alias("len"))
    p = ln.select("road_id", "len", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(c("len") / 20) - 1)).alias("i")).where("i = 0 or len - i * 20 >= 2")
    return p.select("road_id", "i", (c("i") * 20.0).alias("s0"), r6(F.when(c("len") - (c("i") + 1) * 20 < 2, c("len")).otherwise((c("i") + 1) * 20)).alias("s1"))


@R.add("d25_chord_dip", "road_node", f"""
WITH {_ST}, e AS (SELECT road_id, max(s) AS len, arg_min(z, seq) AS z0, arg_max(z, seq) AS z1 FROM st GROUP BY 1)
SELECT road_id, round(greatest(0, max(z0 + s / len * (z1 - z0) - z)), 6) + 0.0 AS dip FROM st JOIN e USING (road_id) GROUP BY 1""")
def d25(n):
    return _dip(n).select("road_id", r6(c("dip")).alias("dip"))


def _dip(n):
    t = L.stations(n)
    e = t.groupBy("road_id").agg(F.max("s").alias("len"), F.min_by("z", "seq").alias("z0"), F.max_by("z", "seq").alias("z1"), F.count(F.lit(1)).alias("nodes"))
    return t.join(e, "road_id").groupBy("road_id").agg(F.greatest(F.lit(0.0), F.max(c("z0") + c("s") / c("len") * (c("z1") - c("z0")) - c("z"))).alias("dip"), F.first("len").alias("len"), F.first("nodes").alias("nodes"))


_CROSS = """x AS (SELECT a.road_id, b.road_id AS other, a.s0 + t * (a.s1 - a.s0) AS s, a.z0 + t * (a.z1 - a.z0) - b.z0 - u * (b.z1 - b.z0) AS dz FROM (
  SELECT a, b, ((b.x0 - a.x0) * (b.y1 - b.y0) - (b.y0 - a.y0) * (b.x1 - b.x0)) / d AS t, ((b.x0 - a.x0) * (a.y1 - a.y0) - (b.y0 - a.y0) * (a.x1 - a.x0)) / d AS u
  FROM (SELECT a, b, (a.x1 - a.x0) * (b.y1 - b.y0) - (a.y1 - a.y0) * (b.x1 - b.x0) AS d FROM sg a JOIN sg b ON a.road_id <> b.road_id
    AND least(a.x0, a.x1) <= greatest(b.x0, b.x1) AND least(b.x0, b.x1) <= greatest(a.x0, a.x1) AND least(a.y0, a.y1) <= greatest(b.y0, b.y1) AND least(b.y0, b.y1) <= greatest(a.y0, a.y1)) WHERE abs(d) > 1e-9)
  WHERE t > 0.02 AND t < 0.98 AND u > 0.02 AND u < 0.98)"""


@R.add("c14_crossings", "road_node", f"WITH {_SEG}, {_CROSS} SELECT road_id, other, round(s, 6) + 0.0 AS s, round(dz, 6) + 0.0 AS dz FROM x")
def c14(n):
    return L.crossings(L.segments(n), 40.0).select("road_id", "other", r6(c("s")).alias("s"), r6(c("dz")).alias("dz"))


@R.add("d26_bridge_flags", "road_node road", f"""
WITH {_SEG}, {_CROSS}, e AS (SELECT road_id, max(s) AS len, arg_min(z, seq) AS z0, arg_max(z, seq) AS z1 FROM st GROUP BY 1),
d AS (SELECT road_id, max(e.len) AS len, greatest(0, max(z0 + s / len * (z1 - z0) - z)) AS dip FROM st JOIN e USING (road_id) GROUP BY 1),
k AS (SELECT x.road_id, count(DISTINCT (other, round_even(s, 0))) AS n FROM x JOIN e USING (road_id) WHERE dz >= 2.5 AND s >= least(4, len / 4) AND s <= len - least(4, len / 4) GROUP BY 1),
r AS (SELECT road_id, objekt, str_code, dip, len, objekt IN ('S-AB', 'S-BB', 'S-LB') OR coalesce(lower(kunstbauten) LIKE '%brücke%', false) AS claim FROM road JOIN d USING (road_id) WHERE objekt NOT IN ('S-AT', 'S-BT', 'S-LT', 'S-BG')),
f AS (SELECT road_id, dip, claim, CASE WHEN claim AND dip < 1 AND coalesce(n, 0) = 0 THEN 'no_opening' WHEN NOT claim AND str_code <> '' AND objekt IN ('S-A', 'S-B', 'S-L') AND len BETWEEN 6 AND 160 AND dip >= 2.5 THEN 'opening' WHEN claim THEN 'kept' END AS reason, coalesce(n, 0) AS n FROM r LEFT JOIN k USING (road_id))
SELECT road_id, reason, reason <> 'no_opening' AS bridge, round(dip, 2) + 0.0 AS dip_m, CAST(n AS BIGINT) AS undercross FROM f WHERE reason IS NOT NULL""")
def d26(n, road):
    dip = _dip(n)
    x = L.crossings(L.segments(n), 40.0).join(dip.select("road_id", "len"), "road_id")
    edge = F.least(F.lit(4.0), c("len") / 4)
    under = x.where((c("dz") >= 2.5) & (c("s") >= edge) & (c("s") <= c("len") - edge)).groupBy("road_id").agg(F.countDistinct("other", F.rint("s")).alias("n"))
    r = road.where(~c("objekt").isin(*S.TUNNEL_OR_GALLERY)).join(dip.where("nodes >= 2"), "road_id").join(under, "road_id", "left")
    r = r.withColumns({"claim": S.claims_bridge(c("objekt"), c("kunstbauten")), "n": F.coalesce("n", F.lit(0))})
    stem = c("objekt").isin("S-A", "S-B", "S-L", *S.BRIDGE_OBJEKT)
    opening = ~c("claim") & (c("str_code") != "") & stem & c("len").between(6, 160) & (c("dip") >= 2.5)
    reason = F.when(c("claim") & (c("dip") < 1) & (c("n") == 0), "no_opening").when(opening, "opening").when(c("claim"), "kept")
    return r.withColumn("reason", reason).where("reason is not null").select("road_id", "reason", (c("reason") != "no_opening").alias("bridge"), (F.round("dip", 2) + F.lit(0.0)).alias("dip_m"), "n").withColumnRenamed("n", "undercross")


@R.add("d6_jumps", "road_node", f"""
WITH {_ST}, j AS (SELECT road_id, abs(z - lag(z) OVER q) AS d, s - lag(s) OVER q AS g FROM st WINDOW q AS (PARTITION BY road_id ORDER BY seq)), k AS (SELECT road_id, list_sort(list(d)) AS a FROM j WHERE g <= 7.5 GROUP BY 1)
SELECT road_id, CAST(len(a) AS BIGINT) AS n, CAST(len(list_filter(a, lambda v: v > 1)) AS BIGINT) AS over1, round(a[CAST(floor(0.95 * (len(a) - 1)) AS BIGINT) + 1], 6) AS p95, round(a[len(a)], 6) AS worst FROM k""")
def d6(n):
    t = L.stations(n).select("road_id", F.abs(c("z") - F.lag("z").over(L.along())).alias("d"), (c("s") - F.lag("s").over(L.along())).alias("g")).where("g <= 7.5")
    a = t.groupBy("road_id").agg(F.sort_array(F.collect_list("d")).alias("a"))
    at = F.floor(0.95 * (F.size("a") - 1)).cast("int") + 1
    return a.select("road_id", F.size("a").cast("long").alias("n"), F.size(F.filter("a", lambda v: v > 1)).cast("long").alias("over1"), F.round(F.element_at("a", at), 6).alias("p95"), F.round(F.element_at("a", F.lit(-1)), 6).alias("worst"))


@R.add("d32_anomalies", "road_node", f"""
WITH {_ST}, j AS (SELECT road_id, seq, w, z - lag(z) OVER q AS dz, s - lag(s) OVER q AS g FROM st WINDOW q AS (PARTITION BY road_id ORDER BY seq))
SELECT road_id, seq, 'pinch' AS kind FROM j WHERE w <= 4 UNION ALL SELECT road_id, seq, 'jump' FROM j WHERE abs(dz) / g > 0.8""")
def d32(n):
    j = L.stations(n).select("road_id", "seq", "w", ((F.abs(c("z") - F.lag("z").over(L.along()))) / (c("s") - F.lag("s").over(L.along()))).alias("grade"))
    return j.where("w <= 4").select("road_id", "seq", F.lit("pinch").alias("kind")).unionByName(j.where("grade > 0.8").select("road_id", "seq", F.lit("jump").alias("kind")))


@R.add("c11_nearest_on_line", "road_node road_end", f"""
WITH {_SEG}, p AS (SELECT objectid, x * 20 AS px, y * 8 AS py FROM road_end),
t AS (SELECT objectid, px, py, sg.*, greatest(0, least(1, ((px - x0) * (x1 - x0) + (py - y0) * (y1 - y0)) / (pow(x1 - x0, 2) + pow(y1 - y0, 2)))) AS t FROM p, sg),
d AS (SELECT objectid, road_id, seg, s0 + t * (s1 - s0) AS s, pow(x0 + t * (x1 - x0) - px, 2) + pow(y0 + t * (y1 - y0) - py, 2) AS d2 FROM t),
k AS (SELECT *, row_number() OVER (PARTITION BY objectid ORDER BY round(d2, 9), road_id, seg) AS n FROM d WHERE d2 <= 2500)
SELECT objectid, road_id, round(s, 6) + 0.0 AS s, round(sqrt(d2), 6) + 0.0 AS d FROM k WHERE n = 1""")
def c11(n, ends):
    p = ends.select("objectid", (c("x") * 20).alias("px"), (c("y") * 8).alias("py"))
    return L.nearest_on_line(p, L.segments(n), "objectid", 50.0).select("objectid", "road_id", r6(c("s")).alias("s"), r6(c("d")).alias("d"))
