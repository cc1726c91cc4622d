"""Overlaps against clipping, adaptive tiles against recursion."""

import math
import random

from hillframe.operators import water
from hillframe.sources.fixtures import fixture


def clipped_area(ring, x0, y0, x1, y1):
    """Sutherland-Hodgman."""
    for axis, bound, keep in ((0, x0, 1), (0, x1, -1), (1, y0, 1), (1, y1, -1)):
        out = []
        for p, q in zip(ring, ring[1:] + ring[:1], strict=True):
            a, b = keep * (p[axis] - bound) >= 0, keep * (q[axis] - bound) >= 0
            if a:
                out.append(p)
            if a != b:
                t = (bound - p[axis]) / (q[axis] - p[axis])
                out.append((p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])))
        ring = out
        if not ring:
            return 0.0
    return abs(sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(ring, ring[1:] + ring[:1], strict=True))) / 2


def test_overlaps_equal_clipping(spark):
    pick = random.Random(2)
    rings, boxes, want = [], [], {}
    for k in range(12):  # stars, not convex
        ring = [(pick.uniform(3, 9) * math.cos(a / 9 * 2 * math.pi), pick.uniform(3, 9) * math.sin(a / 9 * 2 * math.pi)) for a in range(9)]
        ring = ring[:: pick.choice([1, -1])]
        rings += [(k, i, float(x), float(y)) for i, (x, y) in enumerate(ring)]
        for b in range(8):
            x0, y0 = pick.uniform(-9, 6), pick.uniform(-9, 6)
            x1, y1 = x0 + pick.uniform(0.5, 12), y0 + pick.uniform(0.5, 12)
            boxes.append((k, f"b{b}", x0, y0, x1, y1))
            want[k, f"b{b}"] = clipped_area(ring, x0, y0, x1, y1)
    boxes.append((0, "far", 50.0, 50.0, 51.0, 51.0))
    want[0, "far"] = 0.0
    got = water.overlap_areas(spark.createDataFrame(rings, "poly_id long, seq long, x double, y double"), spark.createDataFrame(boxes, "poly_id long, box string, x0 double, y0 double, x1 double, y1 double")).collect()
    assert len(got) == len(want) and all(abs(r["area"] - want[r["poly_id"], r["box"]]) < 1e-9 for r in got)


def plain_fit(box, height, hang, bank, spacing, bad_most, side, area, depth=0):
    """One box after another."""

    def measured(x0, y0, x1, y1, level):
        nx, ny = (min(24, max(2, math.ceil((b - a) / max(2.0, spacing)) + 1)) for a, b in ((x0, x1), (y0, y1)))
        good = []
        for i in range(nx):
            for j in range(ny):
                z = height.get((math.floor(-(y0 + (y1 - y0) * (j + 0.5) / ny)), math.floor(x0 + (x1 - x0) * (i + 0.5) / nx)))
                if z is None or not (level - z > hang or z - level > bank):
                    good.append((i, j))
        inner = None
        if good:
            i0, i1, j0, j1 = min(g[0] for g in good), max(g[0] for g in good) + 1, min(g[1] for g in good), max(g[1] for g in good) + 1
            inner = (x0 + (x1 - x0) * i0 / nx, y0 + (y1 - y0) * j0 / ny, x0 + (x1 - x0) * i1 / nx, y0 + (y1 - y0) * j1 / ny)
        return 1 - len(good) / (nx * ny), inner

    name, x0, y0, x1, y1, level = box
    bad, inner = measured(x0, y0, x1, y1, level)

    def shrunk():
        if inner is None or (inner[2] - inner[0]) * (inner[3] - inner[1]) < area / 4 or min(inner[2] - inner[0], inner[3] - inner[1]) < side:
            return None
        return (name, *inner, level, depth) if measured(*inner, level)[0] <= bad_most + 1e-12 else None

    if bad <= bad_most + 1e-12:
        return [(shrunk() if bad > 1e-12 else None) or (*box, depth)]
    if depth < 3 and min(x1 - x0, y1 - y0) >= 2 * side:
        mx, my, out = (x0 + x1) / 2, (y0 + y1) / 2, []
        for q in range(4):
            child = (f"{name}_q{q}", mx if q % 2 else x0, my if q > 1 else y0, x1 if q % 2 else mx, y1 if q > 1 else my, level)
            out += plain_fit(child, height, hang, bank, spacing, bad_most, side, area, depth + 1)
        return out
    one = shrunk()
    return [one] if one else []


def test_adaptive_tiles_equal_recursion(spark, sf_dir):
    ring, cells = fixture(spark, sf_dir, "ring"), fixture(spark, sf_dir, "cells")
    level = ring.selectExpr("poly_id", "1005.0D + poly_id % 30 as level").distinct()
    tiles = water.water_tiles(ring, level, 6.0, 2.5).cache()
    got = water.fitted_tiles(tiles, cells, 6.0, 5.0, 2.0, 0.3, 0.4, 0.5).collect()
    height = {(r["r"], r["c"]): r["z"] for r in cells.collect()}
    want = {}
    for t in tiles.collect():
        for b in plain_fit(tuple(t[x] for x in ("box", "x0", "y0", "x1", "y1", "level")), height, 6.0, 5.0, 2.0, 0.3, 0.4, 0.5):
            want[t["poly_id"], b[0]] = b[1:]
    assert {(r["poly_id"], r["box"]) for r in got} == set(want)
    assert all(abs(a - b) < 1e-9 for r in got for a, b in zip([r[x] for x in ("x0", "y0", "x1", "y1", "level", "depth")], want[r["poly_id"], r["box"]], strict=True))
    assert {b[-1] for b in want.values()} >= {0, 1, 2}
    assert water.fitted_tiles(tiles.limit(0), cells, 6.0, 5.0, 2.0, 0.3, 0.4, 0.5).count() == 0


def test_boxes_of_all_sizes_meet_the_terrain_once(spark, sf_dir, monkeypatch):
    cells = fixture(spark, sf_dir, "cells").unionByName(fixture(spark, sf_dir, "cells").where("r = 3").selectExpr("r - 40 as r", "c - 9 as c", "z", "dom", "code", "twi", "rock", "asphalt"))
    boxes = [(1, f"b{i}", i * 7.3 % 90 - 5, -(i * 3.7 % 12) - 3.0 + i % 4 * 12, i * 7.3 % 90 - 5 + 0.6 + i * 1.9 % 7, -(i * 3.7 % 12) + i * 0.31 % 4 + i % 4 * 12, 1001.0 + i % 23) for i in range(150)]
    boxes += [(2, f"w{i}", 3.0 + i * 9, -9.5, 3.0 + i * 9 + w, -0.25, 1002.0 + 2 * i) for i, w in enumerate((8.0, 8.99, 9.5, 30.0, 60.0))]
    table = spark.createDataFrame(boxes, "poly_id long, box string, x0 double, y0 double, x1 double, y1 double, level double").cache()
    height = {(r["r"], r["c"]): r["z"] for r in cells.collect()}
    written = []
    plain_cut = water.cut
    monkeypatch.setattr(water, "cut", lambda t, name: written.append(name) or plain_cut(t, name))
    small = water.fitted_tiles(table.where("poly_id = 1"), cells, 6.0, 5.0, 2.0, 0.3, 0.4, 0.5).collect()
    assert written == ["boxes"]  # no level is written
    large = water.fitted_tiles(table.where("poly_id = 2"), cells, 6.0, 5.0, 2.0, 0.3, 0.4, 0.5).collect()
    got = {r["box"]: tuple(r[x] for x in ("x0", "y0", "x1", "y1", "level", "depth")) for r in small + large}
    want = {b[0]: b[1:] for t in boxes for b in plain_fit(t[1:], height, 6.0, 5.0, 2.0, 0.3, 0.4, 0.5)}
    assert len(got) == len(small) + len(large) and set(got) == set(want)
    assert all(abs(a - b) < 1e-9 for k in got for a, b in zip(got[k], want[k], strict=True))
    assert {v[-1] for v in want.values()} == {0, 1, 2, 3}
