"""Axes moved to calmer ground, against plain loops."""

import math
import random

from hillframe.operators import centerline as C

NODE = "road_id long, seq long, x double, y double, z double, w double"


def _axis(spark, rows):
    return C.pieces(C.piece_segments(spark.createDataFrame([(a, b, float(x), float(y), 0.0, float(w)) for a, b, x, y, w in rows], NODE)))


def test_pieces_keep_short_rests_and_drop_points(spark):
    rows = [(1, 0, 0, 0, 4), (1, 1, 41, 0, 4), (2, 0, 0, 5, 4), (2, 1, 0, 5, 4), (2, 2, 50, 5, 4), (3, 0, 9, 9, 4), (3, 1, 9, 9, 4), (4, 0, 1, 1, 4), (5, 0, 0, 0, 4), (5, 1, 5, 0, 4), (5, 2, 0, 0, 4)]
    got = sorted((r["road_id"], r["i"], r["n"], r["s0"], r["s1"], r["ux"]) for r in _axis(spark, rows).collect())
    assert got == [(1, 0, 2, 0.0, 20.0, 1.0), (1, 1, 2, 20.0, 41.0, 1.0), (2, 0, 3, 0.0, 20.0, 1.0), (2, 1, 3, 20.0, 40.0, 1.0), (2, 2, 3, 40.0, 50.0, 1.0), (5, 0, 1, 0.0, 10.0, None)]


def test_a_calm_strip_is_found(spark):
    """The ground is calm only where y lies between -5 and -8; the axis stands half a metre off, so its band must move or narrow."""
    rough = spark.createDataFrame([(r, k, 100 if 5 <= r < 8 else 15000) for r in range(14) for k in range(30)], "r long, c long, um long")
    segs = C.piece_segments(spark.createDataFrame([(k, q, 2.0 + 18.0 * q, y, 0.0, w) for k, y, w in ((1, -6.0, 3.0), (2, -6.5, 3.0), (3, -6.5, 12.0), (4, -40.0, 3.0)) for q in (0, 1)], NODE))
    axis = C.pieces(segs).selectExpr("*", "road_id = 9 as structure")
    got = {r["road_id"]: r for r in C.searched(axis, C.lateral_scores(segs, rough)).collect()}
    assert got[1]["best"] == -5 or got[1]["best"] < 0  # to the right of a road that leads east
    assert got[2]["kind"] in ("unique", "several") and got[2]["chosen"] == 0
    assert got[3]["kind"] == "flat" and got[3]["level"] == 20 and got[3]["chosen"] == 0
    assert got[4]["kind"] == "no_sample" and got[4]["level"] == 0
    assert C.searched(axis, C.lateral_scores(segs, rough.limit(0))).where("kind <> 'no_sample'").count() == 0


def test_band_counts_equal_a_loop(spark):
    pick = random.Random(3)
    rough = {(r, k): pick.randrange(19000) for r in range(24) for k in range(24) if pick.random() < 0.9}
    line = [(3.1, -4.2), (9.3, -6.1), (14.2, -11.7), (15.0, -19.0)]
    segs = C.piece_segments(spark.createDataFrame([(1, q, x, y, 0.0, 4.0) for q, (x, y) in enumerate(line)], NODE), most=100.0)
    got = {(r["level"], r["off"]): (r["n"], r["um"]) for r in C.lateral_scores(segs, spark.createDataFrame([(*k, v) for k, v in rough.items()], "r long, c long, um long")).collect()}
    (x0, y0), (x1, y1) = line[0], line[-1]
    length = math.hypot(x1 - x0, y1 - y0)
    nx, ny = -(y1 - y0) / length, (x1 - x0) / length
    for level in (0, 7, 20):
        half = (4.0 - level / 10) / 2
        for off in (-10, -3, 0, 8):
            inside = []
            for (r, k), um in rough.items():
                x, y = k + 0.5 - off / 10 * nx, -(r + 0.5) - off / 10 * ny
                hit, before = False, None
                for (ax, ay), (bx, by) in zip(line, line[1:], strict=False):
                    size = math.hypot(bx - ax, by - ay)
                    tx, ty = (bx - ax) / size, (by - ay) / size
                    along, lateral = (x - ax) * tx + (y - ay) * ty, abs((x - ax) * ty - (y - ay) * tx)
                    hit |= 0 <= along <= size and lateral <= half
                    if before and before[0] > 0 and along < 0:
                        hit |= before[1] <= half and lateral <= half and math.hypot(x - ax, y - ay) <= 1.5 * half
                    before = (along - size, lateral)
                if hit:
                    inside.append(um)
            assert got[level, off] == (len(inside), sum(inside))


def test_links_equal_taking_the_nearest_pairs_in_turn(spark):
    pick = random.Random(8)
    rows = []
    for road in range(120):
        x, y, turn = pick.random() * 60, pick.random() * 12, pick.random() * 0.8
        rows += [(road, q, x + 12 * q * math.cos(turn), y + 12 * q * math.sin(turn), 4) for q in range(pick.choice([2, 3, 4]))]
    axis = _axis(spark, rows).selectExpr("*", "road_id % 9 = 0 as structure")
    got = {(r["road_id"], r["i"], r["road_id2"], r["i2"]) for r in C.road_links(axis).collect()}
    own = [r for r in axis.collect() if not r["structure"]]
    pairs = []
    for a in (r for r in own if r["i"] == r["n"] - 1):
        for b in (r for r in own if r["i"] == 0 and r["road_id"] != a["road_id"]):
            dx, dy = b["x0"] - a["x1"], b["y0"] - a["y1"]
            if max(abs(dx), abs(dy)) <= 3 and math.hypot(dx, dy) < 4 and a["ux"] * b["ux"] + a["uy"] * b["uy"] >= 0.85:
                pairs.append((math.hypot(dx, dy), a["road_id"], b["road_id"], a["i"], b["i"]))
    ends, starts, want = set(), set(), set()
    for _, a, b, i, j in sorted(pairs):
        if a not in ends and b not in starts:
            ends.add(a)
            starts.add(b)
            want.add((a, i, b, j))
    assert got == want and len(want) > 20
    assert C.road_links(axis.limit(0)).count() == 0


def test_locking_spreads_from_anchors(spark):
    rows = [(1, i, 30, False, 1.0 if i != 6 else -1.0, 0.0, "unique" if i == 0 else "structure" if i == 20 else "several", 4 if i == 0 else 9, [-6, -4, 3, 5]) for i in range(30)]
    rows += [(2, 0, 1, False, 1.0, 0.0, "several", 9, [2])]
    found = spark.createDataFrame(rows, "road_id long, i long, n long, structure boolean, ux double, uy double, kind string, chosen int, good array<int>")
    none = spark.createDataFrame([], "road_id long, i long, road_id2 long, i2 long")
    got = {(r["road_id"], r["i"]): (r["kind"], r["chosen"]) for r in C.locked(found, none).collect()}
    assert got[1, 0] == ("unique", 4) and got[1, 1] == ("several", 3) and got[1, 5] == ("several", 3)
    assert got[1, 6] == ("several", -4) and got[1, 7] == ("several", 3)  # turned about, and back
    assert got[1, 12][0] == "several" and got[1, 13] == ("several_unanchored", 0)  # twelve rounds
    assert got[2, 0] == ("several_unanchored", 0) and got[1, 20][0] == "structure"
    linked = spark.createDataFrame([(2, 0, 1, 0)], none.schema)
    assert C.locked(found, linked).where("road_id = 2").first()["chosen"] == 2


def test_widths_ramp_on_the_wider_piece(spark):
    placed = spark.createDataFrame([(1, 0, 0.0, 20.0, 4.0), (1, 1, 20.0, 40.0, 6.0), (1, 2, 40.0, 50.0, 4.0), (1, 3, 50.0, 50.2, 6.0)], "road_id long, i long, s0 double, s1 double, width_used double")
    points = spark.createDataFrame([(1, 0, 20.0), (1, 1, 20.0), (1, 1, 30.0), (1, 1, 40.0), (1, 2, 45.0), (1, 3, 50.1)], "road_id long, i long, s double")
    got = {(r["i"], r["s"]): r["width"] for r in C.tapered_widths(points, placed).collect()}
    assert got == {(0, 20.0): 4.0, (1, 20.0): 4.0, (1, 30.0): 5.0, (1, 40.0): 4.0, (2, 45.0): 4.0, (3, 50.1): 6.0}
