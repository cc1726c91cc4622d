"""Sight, nearness, rims, colour clusters and section repair against plain loops."""

import random

import numpy as np
import pytest

from hillframe.operators import colours, focal, scatter, sections, viewshed
from hillframe.sources.fixtures import fixture


def test_viewshed_of_a_wall(spark):
    cells = spark.range(21 * 21).selectExpr("cast(id / 21 as long) as r", "id % 21 as c").selectExpr("r", "c", "case when c = 12 then 500.0D when r = 3 and c = 3 then null else 100.0D end as z")
    spots = spark.createDataFrame([(1, 10.0, 10.0), (2, 3.0, 3.0)], "spot long, row double, col double")
    seen = {(r["r"], r["c"]) for r in viewshed.visible(cells, spots, rays=512).collect()}
    assert (10, 12) in seen and (10, 0) in seen and (10, 10) in seen
    assert not any(c > 13 for _, c in seen)  # the spot without a height sees nothing
    assert viewshed.view_counts(viewshed.visible(cells, spots, rays=64), cap=1).where("views <> 1").count() == 0


def test_dedupe_equals_a_scan(spark):
    pick = random.Random(8)
    points = [(k, pick.choice("ab"), pick.random() * 6, pick.random() * 6) for k in pick.sample(range(10_000), 400)] + [(20_000, "a", 0.0, 0.0), (20_001, "a", 0.0, 0.0)]
    got = {r["id"] for r in scatter.kept_apart(spark.createDataFrame(points, "id long, kind string, x double, y double"), 0.5).collect()}
    kept = []
    for k, kind, x, y in sorted(points):
        if all(kind != q or (x - u) ** 2 + (y - v) ** 2 > 0.25 for _, q, u, v in kept):
            kept.append((k, kind, x, y))
    assert got == {k for k, *_ in kept}


@pytest.mark.parametrize("cells", [[(r, c) for r in range(12) for c in range(12) if (r * 7 + c * 5) % 3], [(300, -200), (301, -200), (0, 900)], []])
def test_nearest_cells_equal_all_distances(spark, cells):
    holes = [(5, 5), (0, 0), (11, 40), (-30, 2), (1000, 1000)]
    schema = "r long, c long"
    got = sorted(map(tuple, scatter.nearest_cells(spark.createDataFrame(holes, schema), spark.createDataFrame(cells, schema), 4).collect()))
    want = sorted((r, c, *x[1:], x[0]) for r, c in holes for x in sorted(((a - r) ** 2 + (b - c) ** 2, a, b) for a, b in cells)[:4])
    assert got == want


def test_fill_without_edges_or_cells(spark):
    holes, none = spark.createDataFrame([(0, 0)], "r long, c long"), spark.createDataFrame([], "r long, c long, z double")
    near = spark.createDataFrame([(0, 2, 7.0)], "r long, c long, z double")
    assert [tuple(r) for r in scatter.filled_from_nearest(holes, none, near, 0.5).collect()] == [(0, 0, 7.0)]
    assert [tuple(r) for r in scatter.filled_from_nearest(holes, near, none, 0.5).collect()] == [(0, 0, 7.0)]
    assert [tuple(r) for r in scatter.filled_from_nearest(holes, none, none, 0.5).collect()] == [(0, 0, None)]


def test_rings_reproduce_the_mask(spark):
    pick = random.Random(3)
    mask = {(r, c) for r in range(14) for c in range(14) if pick.random() < 0.5} | {(20, 20)} | {(r, c) for r in range(30, 37) for c in range(3, 10) if not (32 <= r <= 34 and 5 <= c <= 7) or (r, c) == (33, 6)}
    rings = scatter.rim_rings(spark.createDataFrame(sorted(mask), "r long, c long"))
    one = rings.selectExpr("0 as poly_id", "ring", "pos as seq", "x", "y", "area")
    counts = {}
    for r in focal.cells_in_rings(one.withColumn("poly_id", one["ring"])).collect():  # even and odd over all rings
        counts[r["r"], r["c"]] = counts.get((r["r"], r["c"]), 0) + 1
    assert {k for k, n in counts.items() if n % 2} == mask
    areas = {r["ring"]: r["area"] for r in rings.collect()}
    assert sum(areas.values()) == len(mask) and any(a < 0 for a in areas.values())
    assert rings.where("x = 20 or x = 21").where("y <= -20").count() == 4
    assert scatter.rim_rings(spark.createDataFrame([], "r long, c long")).count() == 0


def test_clusters_equal_plain_rounds(spark, sf_dir):
    pixels = fixture(spark, sf_dir, "pixel").where("masked").limit(400).cache()
    got = colours.clustered(pixels, 2, 6, 0.9, 50.0, seed=3).toPandas()
    counted = colours.counted_colours(pixels)
    drawn = colours.seeds(counted, 6, 3)
    assert len(set(drawn)) == 6
    table = counted.toPandas().sort_values(["red", "green", "blue"])
    x, n = table[["l", "a", "b"]].to_numpy(), table["n"].to_numpy()
    for k in range(2, 7):
        centres = np.array(drawn[:k])
        for _ in range(40):
            label = ((x[:, None] - centres) ** 2).sum(-1).argmin(1)
            new = np.array([np.average(x[label == i], axis=0, weights=n[label == i]) for i in range(k)])
            shift = np.sqrt(((new - centres) ** 2).sum())
            centres = new
            if shift <= 1e-4:
                break
        label = ((x[:, None] - centres) ** 2).sum(-1).argmin(1)
        delta = np.sqrt(((x - centres[label]) ** 2).sum(1))
        if max(np.percentile(np.repeat(delta[label == i], n[label == i]), 90) for i in range(k)) <= 50 or k == 6:
            break
    got = got.sort_values(["red", "green", "blue"])
    assert set(got.k) == {k} and got.cluster.tolist() == label.tolist() and np.allclose(got.delta, delta)
    assert colours.clustered(pixels.limit(0)).count() == 0
    assert set(colours.clustered(pixels.limit(2), 3).toPandas().k) == {2}


def plain_repair(samples, points):
    """Every line by direct fits."""
    profiles, best = {}, {}
    for line, p in points.groupby("line"):
        p = p.sort_values("i")
        xy, s, n = p[["x", "y"]].to_numpy(), p["s"].to_numpy(), len(p)
        rays = dict(list(samples[samples.line == line].groupby("i")))
        xa, za, slope, rmse, source = (np.full(n, np.nan) for _ in range(5))
        source[:] = 0
        for i in range(n):
            ray = rays[i].sort_values("off")
            good = ray[ray.inside & ray.z.notna() & ray.rough.notna() & (ray.rough < 0.015)]
            if not len(good):
                continue
            a, z0, held = good.off.iloc[0], good.z.iloc[0], None
            for span in (1.5, 2.5, 4.0, 6.0):
                g = good[good.off <= a + span + 1e-9]
                dx, dz = (g.off - a).to_numpy(), (g.z - z0).to_numpy()
                if len(g) < 3 or (dx * dx).sum() <= 1e-4 or dx.max() < 0.5:
                    continue
                b = (dx * dz).sum() / (dx * dx).sum()
                e = np.sqrt(((dz - b * dx) ** 2).mean())
                if abs(b) > 0.25 or e > 0.04:
                    continue
                if e <= 0.02:
                    xa[i], za[i], slope[i], rmse[i], source[i], held = a, z0, b, e, 1 if span == 1.5 else 2, None
                    break
                if held is None or e < held[0]:
                    held = (e, b)
            if source[i] == 0 and held:
                xa[i], za[i], slope[i], rmse[i], source[i] = a, z0, held[1], held[0], -1
        straight = np.zeros(n, dtype=int)
        for k in (1, 2, 4, 8, 12, 16, 24, 32, 48):
            for i in range(k, n - k):
                a, b, m = xy[i - k], xy[i + k], xy[i]
                if abs((m[0] - a[0]) * (b[1] - a[1]) - (m[1] - a[1]) * (b[0] - a[0])) / max(np.hypot(*(b - a)), 1e-6) <= 0.25:
                    straight[i] = k
        lend = [i for i in range(n) if source[i] > 0]
        for i in range(n):
            if source[i] == -1:
                near = [j for j in lend if abs(j - i) <= straight[i]]
                j = min(near, key=lambda j: (rmse[j], j)) if near else None
                if j is not None and straight[i] and rmse[j] < rmse[i]:
                    slope[i] = slope[j]
        source[source == -1] = 2
        edge, valid = za - slope * xa, np.flatnonzero(source > 0)
        out = [(xa[i], za[i], slope[i], int(source[i])) for i in range(n)]
        for i0, i1 in zip(valid[:-1], valid[1:], strict=True):
            a, b, m = xy[i0], xy[i1], xy[(i0 + i1) // 2]
            if i1 == i0 + 1 or abs((m[0] - a[0]) * (b[1] - a[1]) - (m[1] - a[1]) * (b[0] - a[0])) / max(np.hypot(*(b - a)), 1e-6) > 0.25:
                continue
            around = valid[(s[valid] >= s[i0] - 40) & (s[valid] <= s[i1] + 40)]
            curve = np.polyfit(s[around], edge[around], 2) if s[i1] - s[i0] > 20 and len(around) >= 4 else None
            for i in range(i0 + 1, i1):
                t = (s[i] - s[i0]) / (s[i1] - s[i0])
                b, x = slope[i0] * (1 - t) + slope[i1] * t, xa[i0] * (1 - t) + xa[i1] * t
                h = edge[i0] * (1 - t) + edge[i1] * t if curve is None else np.polyval(curve, s[i])
                out[i] = (x, h + b * x, b, 3 if curve is None else 4)
        for i in range(n):
            profiles[line, i] = out[i]
            x, z, b, kind = out[i]
            if kind:
                for row in rays[i].itertuples():
                    if row.inside and row.rough >= 0.015 and row.off + 1e-6 < x:
                        best[row.r, row.c] = min(best.get((row.r, row.c), (np.inf,)), (row.off, line, i, z + b * (row.off - x), kind))
    return profiles, {k: v[3:] for k, v in best.items()}


def test_section_repair_equals_direct_fits(spark, sf_dir):
    samples, points = (fixture(spark, sf_dir, x).cache() for x in ("edge_sample", "edge_point"))
    profiles, cells = (t.toPandas() for t in sections.repair(samples, points))
    want, filled = plain_repair(samples.toPandas(), points.toPandas())
    assert len(profiles) == len(want) and set(profiles.source) == {0, 1, 2, 3, 4}
    for row in profiles.itertuples():
        assert row.source == want[row.line, row.i][3]
        assert np.allclose([row.xa, row.za, row.slope], want[row.line, row.i][:3], atol=1e-6, equal_nan=True)
    assert len(cells) == len(filled)
    for row in cells.itertuples():
        assert abs(row.z - filled[row.r, row.c][0]) < 1e-6 and row.source == filled[row.r, row.c][1]
    assert all(t.count() == 0 for t in sections.repair(samples.limit(0), points.limit(0)))
