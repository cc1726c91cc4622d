"""Queries of road widths from street polygons."""

from pyspark.sql import functions as F

from hillframe.functions import scalars as S
from hillframe.operators import lines as L
from hillframe.operators import streets as T

from .registry import Registry

R = Registry()
QUERIES, ORACLES = R.queries, R.oracles
c = F.col
r6 = S.r6

# The classes of polygons that a class of road prefers, in order; others take the last row.
PREFERRED = {"S-F": ["LN-VFW"], "S-GW": ["LN-VFW"], "S-FRW": ["LN-VFW", "LN-VSO"], "S-STRAIL": ["LN-VFW", "LN-VSO"], "S-G": ["LN-VSO", "LN-VPR"]}
DEFAULT = ["LN-VSU", "LN-VSO", "LN-VPR", "LN-VFW"]

_STATIONS = """st AS (SELECT road_id, seq, x, y, w, sum(d) OVER (PARTITION BY road_id ORDER BY seq) AS s FROM (SELECT *, coalesce(sqrt(pow(x - lag(x) OVER q, 2) + pow(y - lag(y) OVER q, 2)), 0) AS d FROM axis_node WINDOW q AS (PARTITION BY road_id ORDER BY seq))),
sg AS (SELECT * FROM (SELECT road_id, seq, x AS x0, y AS y0, s AS s0, lead(x) OVER q AS x1, lead(y) OVER q AS y1, lead(s) OVER q AS s1 FROM st WINDOW q AS (PARTITION BY road_id ORDER BY seq)) WHERE s1 > s0),
le AS (SELECT road_id, max(s) AS len, CASE WHEN 2 * least(8, 0.15 * max(s)) >= max(s) - 0.5 THEN 0.1 * max(s) ELSE least(8, 0.15 * max(s)) END AS ins FROM st GROUP BY 1),
sp AS (SELECT road_id, 0 AS k, ins AS at_ FROM le WHERE len >= 2 UNION ALL SELECT road_id, 1, len * 0.5 FROM le UNION ALL SELECT road_id, 2, greatest(ins, len - ins) FROM le WHERE len >= 2),
pt AS (SELECT road_id, k, objekt, x0 + (at_ - s0) / (s1 - s0) * (x1 - x0) AS px, y0 + (at_ - s0) / (s1 - s0) * (y1 - y0) AS py, -(y1 - y0) / sqrt((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)) AS nx, (x1 - x0) / sqrt((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)) AS ny FROM sp JOIN sg USING (road_id) JOIN road USING (road_id) WHERE at_ >= s0 AND at_ < s1),
ed AS (SELECT poly_id, objekt AS code, x AS x0, y AS y0, coalesce(lead(x) OVER q, first_value(x) OVER q) AS x1, coalesce(lead(y) OVER q, first_value(y) OVER q) AS y1 FROM ring WINDOW q AS (PARTITION BY poly_id ORDER BY seq)),
ou AS (SELECT * FROM (SELECT poly_id, min(x0) AS bx0, max(x0) AS bx1, min(y0) AS by0, max(y0) AS by1 FROM ed GROUP BY 1)),
ds AS (SELECT road_id, k, objekt, px, py, nx, ny, poly_id, min(code) AS code, count(*) FILTER ((y0 > py) <> (y1 > py) AND px < x0 + (py - y0) / (y1 - y0) * (x1 - x0)) % 2 = 1 AS inside,
  min(sqrt(pow(x0 + greatest(0, least(1, ((px - x0) * (x1 - x0) + (py - y0) * (y1 - y0)) / ((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)))) * (x1 - x0) - px, 2) + pow(y0 + greatest(0, least(1, ((px - x0) * (x1 - x0) + (py - y0) * (y1 - y0)) / ((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)))) * (y1 - y0) - py, 2))) AS e
  FROM pt JOIN ou ON px BETWEEN bx0 - 3 AND bx1 + 3 AND py BETWEEN by0 - 3 AND by1 + 3 JOIN ed USING (poly_id) GROUP BY 1, 2, 3, 4, 5, 6, 7, 8),
rk AS (SELECT *, CASE WHEN inside THEN 0 ELSE round(e, 9) END AS d, CASE WHEN objekt IN ('S-F', 'S-GW') THEN CASE code WHEN 'LN-VFW' THEN 0 ELSE 1 END WHEN objekt IN ('S-FRW', 'S-STRAIL') THEN CASE code WHEN 'LN-VFW' THEN 0 WHEN 'LN-VSO' THEN 1 ELSE 2 END
  WHEN objekt = 'S-G' THEN CASE code WHEN 'LN-VSO' THEN 0 WHEN 'LN-VPR' THEN 1 ELSE 2 END ELSE CASE code WHEN 'LN-VSU' THEN 0 WHEN 'LN-VSO' THEN 1 WHEN 'LN-VPR' THEN 2 WHEN 'LN-VFW' THEN 3 ELSE 4 END END AS rank FROM ds),
pk AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY road_id, k ORDER BY d, rank, poly_id) AS n FROM rk WHERE d <= 2) WHERE n = 1)"""

_RAYS = _STATIONS + """,
ry AS (SELECT road_id, k, side, poly_id, inside, px, py, nx * side AS dx, ny * side AS dy FROM pk, (VALUES (1), (-1)) v(side)),
hi AS (SELECT ry.*, x0, y0, x1, y1, px + 20 * dx AS qx, py + 20 * dy AS qy, ((x0 - px) * (y1 - y0) - (y0 - py) * (x1 - x0)) / nullif(dx * (y1 - y0) - dy * (x1 - x0), 0) AS t, ((x0 - px) * dy - (y0 - py) * dx) / nullif(dx * (y1 - y0) - dy * (x1 - x0), 0) AS u FROM ry JOIN ed USING (poly_id)),
ex AS (SELECT road_id, k, side, poly_id, inside, CASE WHEN count(*) FILTER ((y0 > qy) <> (y1 > qy) AND qx < x0 + (qy - y0) / (y1 - y0) * (x1 - x0)) % 2 = 1 THEN 20.0 ELSE max(t) FILTER (t BETWEEN 0 AND 20 AND u BETWEEN 0 AND 1) END AS extent,
  CASE WHEN inside THEN min(t) FILTER (t > 0.05 AND t <= 20 AND u BETWEEN 0 AND 1) END AS first_ FROM hi GROUP BY 1, 2, 3, 4, 5)"""


def _points(nodes, road):
    segs = L.segments(nodes)
    at = T.sample_stations(segs.groupBy("road_id").agg(F.max("s1").alias("length")))
    return L.sample_at(segs, at, direction=True).join(road.select("road_id", "objekt"), "road_id").select("road_id", "k", c("objekt").alias("road_objekt"), "x", "y", "nx", "ny")


def _picked(points, ring):
    place = lambda codes: F.coalesce(F.nullif(F.array_position(F.array(*(F.lit(x) for x in codes)), c("objekt")), F.lit(0)) - 1, F.lit(len(codes)))
    order = place(DEFAULT)
    for objekt, codes in PREFERRED.items():
        order = F.when(c("road_objekt") == objekt, place(codes)).otherwise(order)
    return T.picked_polygon(points, ["road_id", "k"], ring, ring.where("seq = 0").select("poly_id", "objekt"), order)


def _hits(nodes, road, ring):
    points = _points(nodes, road)
    sides = points.join(_picked(points, ring).select("road_id", "k", "poly_id"), ["road_id", "k"]).withColumn("side", F.explode(F.array(F.lit(1), F.lit(-1))))
    return T.ray_hits(sides.select("road_id", "k", "side", "poly_id", "x", "y", (c("nx") * c("side")).alias("dx"), (c("ny") * c("side")).alias("dy")), ["road_id", "k", "side"], ring)


@R.add("c8_picked_polygon", "axis_node road ring", f"WITH {_STATIONS} SELECT road_id, k, poly_id, code AS objekt, round(d, 6) + 0.0 AS d FROM pk")
def c8(nodes, road, ring):
    return _picked(_points(nodes, road), ring).select("road_id", "k", "poly_id", "objekt", r6(c("d")).alias("d"))


@R.add("c9_ray_extent", "axis_node road ring", f"WITH {_RAYS} SELECT road_id, k, side, poly_id, round(extent, 6) + 0.0 AS extent FROM ex")
def c9(nodes, road, ring):
    return _hits(nodes, road, ring).select("road_id", "k", "side", "poly_id", r6(c("extent")).alias("extent"))


@R.add("c10_first_boundary", "axis_node road ring", f"WITH {_RAYS} SELECT road_id, k, side, round(first_, 6) + 0.0 AS first_m FROM ex")
def c10(nodes, road, ring):
    return _hits(nodes, road, ring).select("road_id", "k", "side", r6(c("first")).alias("first_m"))


@R.add("d10_road_widths", "axis_node road ring", f"""
WITH {_RAYS}, wd AS (SELECT road_id, k, sum(extent) AS width FROM ex GROUP BY 1, 2 HAVING count(extent) = 2),
ro AS (SELECT road_id, max(w) AS cw, CASE WHEN min(objekt) IN ('S-AR', 'S-AP', 'S-BR', 'S-BP') THEN 'subordinate_lane' WHEN road_id % 10 = 4 THEN NULL WHEN min(objekt) IN ('S-AT', 'S-BT', 'S-LT', 'S-BG') THEN 'tunnel_bore' WHEN regexp_matches(lower(min(kunstbauten)), 'tunnel|galerie|unterflur') THEN 'kunstbauten' END AS skip FROM axis_node JOIN road USING (road_id) GROUP BY 1),
me AS (SELECT road_id, cw, skip, count(width) AS n_valid, avg(width) AS width_mean FROM ro LEFT JOIN wd ON wd.road_id = ro.road_id AND width BETWEEN 1.5 AND greatest(6, 2.5 * cw) GROUP BY 1, 2, 3)
SELECT road_id, n_valid, round(width_mean, 6) + 0.0 AS width_mean, skip IS NULL AND n_valid >= 2 AND round(width_mean, 9) <= round(1.75 * cw, 9) AS applied, CASE WHEN skip IS NULL AND n_valid >= 2 AND round(width_mean, 9) > round(1.75 * cw, 9) THEN 'mean_above_class' ELSE skip END AS skip FROM me""".replace("SELECT road_id, cw, skip, count", "SELECT ro.road_id, cw, skip, count"))
def d10(nodes, road, ring):
    sides = _hits(nodes, road, ring).groupBy("road_id", "k").agg(F.max(F.when(c("side") == 1, c("extent"))).alias("left"), F.max(F.when(c("side") == -1, c("extent"))).alias("right"))
    own = nodes.groupBy("road_id").agg(F.max("w").alias("class_width")).join(road, "road_id")
    own = own.select("road_id", "class_width", T.skip_reason(c("objekt"), c("kunstbauten"), c("road_id") % 10 == 4).alias("skip"))
    return T.road_widths(sides.select("road_id", "left", "right"), own).select("road_id", "n_valid", r6(c("width_mean")).alias("width_mean"), "applied", "skip")


@R.add("g30_edge_choice", "axis_node road ring", f"""
WITH {_RAYS}, br AS (SELECT road_id, k, side, first_ AS p, CASE WHEN (road_id + k) % 6 > 0 THEN first_ * 0.4 + (road_id * 7 + k * 5) % 9 END AS b, CAST((road_id * 3 + k * 11) % 31 AS DOUBLE) AS deg, CASE WHEN road_id % 11 = 4 THEN 'span' WHEN (road_id + k) % 17 = 3 THEN 'junction' END AS hold FROM ex)
SELECT road_id, k, side, round(CASE WHEN hold IS NOT NULL OR b IS NULL OR deg < 10 THEN p WHEN abs(b - p) <= 2 OR b < p - 2 AND deg >= 15 THEN b ELSE p END, 6) + 0.0 AS edge_m,
  CASE WHEN hold IS NULL AND b IS NOT NULL AND deg >= 10 AND (abs(b - p) <= 2 OR b < p - 2 AND deg >= 15) THEN 'break' WHEN p IS NULL THEN 'none' ELSE 'polygon' END AS source,
  coalesce(hold, CASE WHEN b IS NULL OR deg < 10 THEN 'no_break' WHEN abs(b - p) <= 2 THEN 'near' WHEN b < p - 2 AND deg >= 15 THEN 'inside_wide' WHEN b > p + 2 THEN 'outside' ELSE 'inside_weak' END) AS reason FROM br""")
def g30(nodes, road, ring):
    hits = _hits(nodes, road, ring)
    found = F.when((c("road_id") + c("k")) % 6 > 0, c("first") * 0.4 + (c("road_id") * 7 + c("k") * 5) % 9)
    hold = F.when(c("road_id") % 11 == 4, "span").when((c("road_id") + c("k")) % 17 == 3, "junction")
    e = T.edge_choice(found, ((c("road_id") * 3 + c("k") * 11) % 31).cast("double"), c("first"), hold)
    return hits.withColumn("e", e).select("road_id", "k", "side", r6(c("e.edge_m")).alias("edge_m"), "e.source", "e.reason")
