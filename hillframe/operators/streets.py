"""Road widths from street polygons: the polygon at a station, how far it reaches to both sides, means per road, the choice of an edge.

Points: their key columns, x, y; polygons: rings (poly_id, seq, x, y, ...) of one outline each. Edges are dealt to bands of y, points and rays
join the bands they touch of the polygons whose box they meet, so that long outlines are never compared whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

c = F.col
BAND = 4.0  # metres of y to a band
BOX = 32.0  # metres to a side of a cell in which points and boxes of polygons meet


def ring_edges(rings: DataFrame) -> DataFrame:
    """poly_id, x0, y0, x1, y1: the closed outline's edges; repeated vertices give none."""
    w = Window.partitionBy("poly_id").orderBy("seq")
    nxt = lambda a: F.coalesce(F.lead(a).over(w), F.first(a).over(w))
    t = rings.select("poly_id", "seq", "x", "y").withColumns({"x1": nxt("x"), "y1": nxt("y")})
    return t.select("poly_id", c("x").alias("x0"), c("y").alias("y0"), "x1", "y1").where("x0 <> x1 or y0 <> y1")


def _banded(edges: DataFrame, pad: float) -> DataFrame:
    return edges.withColumn("band", F.explode(F.sequence(F.floor((F.least("y0", "y1") - pad) / BAND), F.floor((F.greatest("y0", "y1") + pad) / BAND))))


def _odd(x: Column, y: Column) -> Column:
    """1 for an edge that the ray to the east crosses."""
    met = (c("y0") > y) != (c("y1") > y)
    return F.when(met & (x < c("x0") + (y - c("y0")) / (c("y1") - c("y0")) * (c("x1") - c("x0"))), 1).otherwise(0)


def picked_polygon(points: DataFrame, key: list[str], rings: DataFrame, kinds: DataFrame, order: Column, near: float = 2.0) -> DataFrame:
    """key, poly_id, objekt, d of the best polygon no farther than `near` (0 inside): by distance, then order (of objekt), then poly_id.

    kinds: poly_id, objekt. Points may hold columns that order needs. Points without a polygon have no row.
    """
    edges = ring_edges(rings)
    box = edges.groupBy("poly_id").agg(F.min("x0").alias("bx0"), F.max("x0").alias("bx1"), F.min("y0").alias("by0"), F.max("y0").alias("by1"))
    cells = box.withColumn("gx", F.explode(F.sequence(F.floor((c("bx0") - near) / BOX), F.floor((c("bx1") + near) / BOX)))).withColumn("gy", F.explode(F.sequence(F.floor((c("by0") - near) / BOX), F.floor((c("by1") + near) / BOX))))
    met = points.withColumns({"gx": F.floor(c("x") / BOX), "gy": F.floor(c("y") / BOX), "band": F.floor(c("y") / BAND)}).join(cells, ["gx", "gy"])
    met = met.where((c("x") >= c("bx0") - near) & (c("x") <= c("bx1") + near) & (c("y") >= c("by0") - near) & (c("y") <= c("by1") + near))
    j = met.select(*points.columns, "poly_id", "band").join(_banded(edges, near), ["poly_id", "band"])
    dx, dy = c("x1") - c("x0"), c("y1") - c("y0")
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((c("x") - c("x0")) * dx + (c("y") - c("y0")) * dy) / (dx * dx + dy * dy)))
    ex, ey = c("x0") + t * dx - c("x"), c("y0") + t * dy - c("y")
    own = j.groupBy(*points.columns, "poly_id").agg((F.sum(_odd(c("x"), c("y"))) % 2 == 1).alias("inside"), F.min(ex * ex + ey * ey).alias("d2"))
    own = own.withColumn("d", F.when(c("inside"), 0.0).otherwise(F.round(F.sqrt("d2"), 9))).where(c("d") <= near).join(kinds, "poly_id")
    best = own.groupBy(*key).agg(F.min(F.struct("d", order.alias("rank"), "poly_id", "objekt")).alias("b"))
    return best.select(*key, c("b.poly_id").alias("poly_id"), c("b.objekt").alias("objekt"), c("b.d").alias("d"))


def ray_hits(rays: DataFrame, key: list[str], rings: DataFrame, reach: float = 20.0, own: float = 0.05) -> DataFrame:
    """Rays (key, poly_id, x, y and the unit direction dx, dy) with covered (the origin lies in the polygon), extent and first.

    extent: distance to the farthest point of the polygon on the ray, null where they don't meet; first: the nearest crossing of the outline farther than
    `own`, null where the origin isn't covered or nothing is crossed. Edges along the ray itself count by their neighbours.
    """
    ends = rays.withColumns({"xe": c("x") + reach * c("dx"), "ye": c("y") + reach * c("dy")})
    low, high = F.floor(F.least("y", "ye") / BAND), F.floor(F.greatest("y", "ye") / BAND)
    j = ends.withColumn("band", F.explode(F.sequence(low, high))).join(_banded(ring_edges(rings), 0.0), ["poly_id", "band"], "left")
    ex, ey = c("x1") - c("x0"), c("y1") - c("y0")
    cross = c("dx") * ey - c("dy") * ex
    den = F.when(F.abs(cross) > 1e-12, cross)
    px, py = c("x0") - c("x"), c("y0") - c("y")
    at, u = (px * ey - py * ex) / den, (px * c("dy") - py * c("dx")) / den
    j = j.withColumns({"at": at, "u": u}).withColumn("at", F.when((c("u") >= 0) & (c("u") <= 1) & (c("at") >= 0) & (c("at") <= reach), c("at")))
    odd = lambda x, y: F.sum(F.when(c("band") == F.floor(c(y) / BAND), _odd(c(x), c(y))).otherwise(0)) % 2 == 1
    t = j.groupBy(*key, "poly_id").agg(odd("x", "y").alias("covered"), odd("xe", "ye").alias("beyond"), F.max("at").alias("far"), F.min(F.when(c("at") > own, c("at"))).alias("next"))
    return t.select(*key, "poly_id", "covered", F.when(c("beyond"), F.lit(reach)).otherwise(c("far")).alias("extent"), F.when(c("covered"), c("next")).alias("first"))


def sample_stations(roads: DataFrame, inset: float = 8.0) -> DataFrame:
    """road_id, k, at for roads (road_id, length): start, middle and end, drawn in by the inset or 15 %; under two metres the middle alone (k = 1)."""
    part = F.least(F.lit(inset), c("length") * 0.15)
    part = F.when(part * 2 >= c("length") - 0.5, c("length") * 0.1).otherwise(part)
    three = F.array(*(F.struct(F.lit(k).alias("k"), at.alias("at")) for k, at in enumerate((part, c("length") * 0.5, F.greatest(part, c("length") - part)))))
    return roads.select("road_id", F.explode(F.when(c("length") < 2, F.slice(three, 2, 1)).otherwise(three)).alias("p")).select("road_id", "p.k", "p.at")


def skip_reason(objekt: Column, kunstbauten: Column, exempt: Column) -> Column:
    """Why a road's measured width isn't used; null: it is. exempt: known not to be a tunnel."""
    code = F.upper(F.trim(F.coalesce(objekt, F.lit(""))))
    name = F.lower(F.coalesce(kunstbauten, F.lit("")))
    bore = F.when(code.isin("S-AT", "S-BT", "S-LT", "S-BG"), "tunnel_bore").when(name.rlike("tunnel|galerie|unterflur"), "kunstbauten")
    return F.when(code.isin("S-AR", "S-AP", "S-BR", "S-BP"), "subordinate_lane").when(~exempt, bore)


def road_widths(samples: DataFrame, roads: DataFrame) -> DataFrame:
    """road_id, n_valid, width_mean, applied, skip. samples: road_id, left, right; roads: road_id, class_width, skip.

    A sample counts from 1.5 m to 2.5 class widths (6 m at least); the mean of two or more is applied unless there is a reason against it or it exceeds 1.75 class widths.
    """
    t = roads.join(samples, "road_id", "left").withColumn("width", c("left") + c("right"))
    good = F.when((c("width") >= 1.5) & (c("width") <= F.greatest(F.lit(6.0), 2.5 * c("class_width"))), c("width"))
    t = t.groupBy("road_id", "class_width", "skip").agg(F.count(good).alias("n_valid"), F.avg(good).alias("width_mean"))
    wide = c("skip").isNull() & (c("n_valid") >= 2) & (F.round("width_mean", 9) > F.round(1.75 * c("class_width"), 9))
    return t.select("road_id", "n_valid", "width_mean", (c("skip").isNull() & (c("n_valid") >= 2) & ~wide).alias("applied"), F.when(wide, "mean_above_class").otherwise(c("skip")).alias("skip"))


def edge_choice(break_m: Column, degrees: Column, poly_m: Column, hold: Column, near: float = 2.0, least: float = 10.0, inside: float = 15.0) -> Column:
    """A struct of edge_m, source (break, polygon, none) and reason: which of a break in the terrain and a polygon's outline is the road's edge."""
    pick = lambda m, source, reason: F.struct(m.cast("double").alias("edge_m"), F.lit(source).alias("source"), reason.alias("reason"))
    outline = lambda reason: F.when(poly_m.isNotNull(), pick(poly_m, "polygon", reason)).otherwise(pick(F.lit(None), "none", reason))
    broken = break_m.isNotNull() & F.coalesce(degrees >= least, F.lit(False))
    return (
        F.when(F.coalesce(hold, F.lit("")) != "", outline(hold))
        .when(~broken, outline(F.lit("no_break")))
        .when(poly_m.isNull(), pick(break_m, "break", F.lit("no_polygon")))
        .when(F.abs(break_m - poly_m) <= near, pick(break_m, "break", F.lit("near")))
        .when((break_m < poly_m - near) & (degrees >= inside), pick(break_m, "break", F.lit("inside_wide")))
        .when(break_m > poly_m + near, pick(poly_m, "polygon", F.lit("outside")))
        .otherwise(pick(poly_m, "polygon", F.lit("inside_weak")))
    )
