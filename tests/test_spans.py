"""Properties of spans that SQL twins don't state."""

import random

from hillframe.operators import spans


def test_monotone_heights_never_overshoot(spark):
    pick = random.Random(6)
    knots, points = [], []
    for k in range(40):
        s = sorted(pick.sample(range(200), pick.choice([2, 3, 8])))
        z = [pick.choice([1.0, 1.0, pick.random() * 9]) for _ in s]
        knots += [(k, float(a), b) for a, b in zip(s, z, strict=True)]
        points += [(k, a + (b - a) * t / 7) for a, b in zip(s, s[1:], strict=False) for t in range(8)]
    by = {}
    for k, s, z in knots:
        by.setdefault(k, []).append((s, z))
    pieces = spans.monotone_slopes(spark.createDataFrame([*knots, knots[0]], "span long, s double, z double"))
    got = spans.on_curve(pieces, spark.createDataFrame(points, "span long, at double")).collect()
    assert len({(r["span"], r["at"]) for r in got}) == len(set(points))
    for r in got:
        before = max(x for x in by[r["span"]] if x[0] <= r["at"])
        after = min(x for x in by[r["span"]] if x[0] >= r["at"])
        low, high = sorted((before[1], after[1]))
        assert low - 1e-9 <= r["z"] <= high + 1e-9
        if len(by[r["span"]]) == 2 and after != before:
            assert abs(r["z"] - before[1] - (after[1] - before[1]) * (r["at"] - before[0]) / (after[0] - before[0])) < 1e-9


def test_abutments_of_short_windows_and_no_terrain(spark):
    schema = "span long, line long, j long, s double, z double"
    ends = spark.createDataFrame([(1, 9.0, 4.0, None, None), (2, 1.0, 2.0, 8.0, 3.0)], "span long, g0 double, g1 double, o0 double, o1 double")
    terrain = spark.createDataFrame([(1, 0, j, float(j), 0.0 if j == 2 else 9.0) for j in range(4)], schema)
    for t in (terrain, terrain.limit(0)):
        got = {r["span"]: (r["a0"], r["a1"], r["method"]) for r in spans.abutments(t, ends).collect()}
        assert got == {1: (4.0, 9.0, "fallback"), 2: (3.0, 8.0, "override")}
