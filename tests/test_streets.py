"""Road widths from polygons, against plain loops on concave outlines."""

import math
import random

from hillframe.operators import streets as T
from pyspark.sql import functions as F

RING = "poly_id long, seq long, x double, y double"


def _outlines(pick):
    """Star-shaped outlines of 3 to 14 corners, some far longer than a band or a box."""
    out = {}
    for p in range(40):
        size, n = pick.choice([2, 6, 60]), pick.randrange(3, 15)
        x, y = pick.random() * 90, pick.random() * -90
        angles = sorted(pick.random() * 2 * math.pi for _ in range(n))
        out[p] = [(x + size * (0.2 + pick.random()) * math.cos(a), y + size * (0.2 + pick.random()) * math.sin(a)) for a in angles]
    return out


def _inside(x, y, ring):
    odd = False
    for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1], strict=True):
        if (y0 > y) != (y1 > y) and x < x0 + (y - y0) / (y1 - y0) * (x1 - x0):
            odd = not odd
    return odd


def _distance(x, y, ring):
    best = math.inf
    for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1], strict=True):
        dx, dy = x1 - x0, y1 - y0
        t = max(0.0, min(1.0, ((x - x0) * dx + (y - y0) * dy) / (dx * dx + dy * dy)))
        best = min(best, math.hypot(x0 + t * dx - x, y0 + t * dy - y))
    return best


def test_polygons_and_rays_equal_loops(spark):
    pick = random.Random(5)
    outlines = _outlines(pick)
    rings = spark.createDataFrame([(p, q, x, y) for p, ring in outlines.items() for q, (x, y) in enumerate([*ring, ring[-1]])], RING)  # the last corner twice
    points = [(k, pick.random() * 90, pick.random() * -90) for k in range(150)]
    kinds = spark.createDataFrame([(p, "ab"[p % 2]) for p in outlines], "poly_id long, objekt string")
    got = {r["k"]: (r["poly_id"], r["d"]) for r in T.picked_polygon(spark.createDataFrame(points, "k long, x double, y double"), ["k"], rings, kinds, F.when(F.col("objekt") == "b", 0).otherwise(1)).collect()}
    want = {}
    for k, x, y in points:
        found = [(0.0 if _inside(x, y, ring) else round(_distance(x, y, ring), 9), 1 - p % 2, p) for p, ring in outlines.items()]
        best = min((f for f in found if f[0] <= 2), default=None)
        if best:
            want[k] = (best[2], best[0])
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()} and len(want) > 50
    assert all(abs(got[k][1] - want[k][1]) < 1e-8 for k in want)

    rays = [(k, want[k][0], x, y, math.cos(k), math.sin(k)) for k, x, y in points if k in want]
    hits = {r["k"]: r for r in T.ray_hits(spark.createDataFrame(rays, "k long, poly_id long, x double, y double, dx double, dy double"), ["k"], rings).collect()}
    assert len(hits) == len(rays)
    for k, p, x, y, dx, dy in rays:
        ring, at = outlines[p], []
        for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1], strict=True):
            den = dx * (y1 - y0) - dy * (x1 - x0)
            t, u = ((x0 - x) * (y1 - y0) - (y0 - y) * (x1 - x0)) / den, ((x0 - x) * dy - (y0 - y) * dx) / den
            at += [t] if 0 <= u <= 1 and 0 <= t <= 20 else []
        far = 20.0 if _inside(x + 20 * dx, y + 20 * dy, ring) else max(at, default=None)
        near = min((t for t in at if t > 0.05), default=None) if _inside(x, y, ring) else None
        for value, expected in ((hits[k]["extent"], far), (hits[k]["first"], near)):
            assert (value is None) == (expected is None) and (value is None or abs(value - expected) < 1e-8)
        assert hits[k]["covered"] == _inside(x, y, ring)


def test_no_rings_no_points(spark):
    rings = spark.createDataFrame([(1, 0, 0.0, 0.0), (1, 1, 0.0, 0.0)], RING)  # a point has no outline
    points = spark.createDataFrame([(1, 0.0, 0.0)], "k long, x double, y double")
    kinds = spark.createDataFrame([(1, "a")], "poly_id long, objekt string")
    for r, p in ((rings, points), (rings.limit(0), points), (rings, points.limit(0))):
        assert T.picked_polygon(p, ["k"], r, kinds, F.lit(0)).count() == 0
    ray = T.ray_hits(points.selectExpr("*", "1L as poly_id", "1.0D as dx", "0.0D as dy"), ["k"], rings).first()
    assert (ray["covered"], ray["extent"], ray["first"]) == (False, None, None)


def test_stations_and_means(spark):
    at = T.sample_stations(spark.createDataFrame([(1, 100.0), (2, 10.0), (3, 1.5), (4, 2.0)], "road_id long, length double")).collect()
    assert sorted((r["road_id"], r["k"], round(r["at"], 6)) for r in at) == [(1, 0, 8.0), (1, 1, 50.0), (1, 2, 92.0), (2, 0, 1.5), (2, 1, 5.0), (2, 2, 8.5), (3, 1, 0.75), (4, 0, 0.3), (4, 1, 1.0), (4, 2, 1.7)]
    samples = spark.createDataFrame([(1, 2.0, 2.0), (1, 2.5, 2.5), (1, 9.0, 9.0), (2, 2.0, None), (2, 1.0, 1.0), (3, 2.9, 2.9), (3, 3.0, 3.0), (4, 2.0, 2.0), (4, 2.0, 2.0)], "road_id long, left double, right double")
    roads = spark.createDataFrame([(1, 4.0, None), (2, 4.0, None), (3, 3.0, None), (4, 4.0, "tunnel_bore"), (5, 4.0, None)], "road_id long, class_width double, skip string")
    got = {r["road_id"]: (r["n_valid"], r["width_mean"], r["applied"], r["skip"]) for r in T.road_widths(samples, roads).collect()}
    assert got == {1: (2, 4.5, True, None), 2: (1, 2.0, False, None), 3: (2, 5.9, False, "mean_above_class"), 4: (2, 4.0, False, "tunnel_bore"), 5: (0, None, False, None)}
    reasons = spark.createDataFrame([("s-ap ", None, False), ("S-AT", None, True), ("S-AT", None, False), ("S-L", "Galerie", False), (None, None, False)], "o string, k string, e boolean")
    assert [r[0] for r in reasons.select(T.skip_reason(F.col("o"), F.col("k"), F.col("e"))).collect()] == ["subordinate_lane", None, "tunnel_bore", "kunstbauten", None]


def test_edges_follow_the_table(spark):
    rows = [(3.0, 20.0, 9.0, "span"), (3.0, 20.0, None, "span"), (None, None, 9.0, None), (3.0, 9.9, None, ""), (3.0, 10.0, None, None), (8.0, 10.0, 9.0, None), (3.0, 15.0, 9.0, None), (3.0, 14.9, 9.0, None), (12.0, 20.0, 9.0, None)]
    t = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i long, b double, deg double, p double, hold string").withColumn("e", T.edge_choice(F.col("b"), F.col("deg"), F.col("p"), F.col("hold")))
    got = [tuple(r) for r in t.orderBy("i").select("e.edge_m", "e.source", "e.reason").collect()]
    assert got == [(9.0, "polygon", "span"), (None, "none", "span"), (9.0, "polygon", "no_break"), (None, "none", "no_break"), (3.0, "break", "no_polygon"), (8.0, "break", "near"), (3.0, "break", "inside_wide"), (9.0, "polygon", "inside_weak"), (9.0, "polygon", "outside")]
