"""The road surface model against one dense fit of each road, percentiles against numpy."""

import numpy as np
import pytest

from hillframe.operators import iterate, quantiles, roadfit
from hillframe.sources.fixtures import fixture


def dense_fit(s, t, e, z, bears, length):
    """The whole road at once, with dense matrices."""
    n = max(4, int(np.ceil(length / 0.5)) + 1)
    u = np.clip(s / 0.5, 0, n - 1 - 1e-9)
    i, p, m = np.floor(u).astype(int), np.maximum(t, 0), np.minimum(t, 0)
    f = u - i
    design = np.zeros((len(s), n, 3))
    for step, share in ((0, 1 - f), (1, f)):
        design[np.arange(len(s)), i + step] = np.column_stack([share, share * p, share * m])
    design = design.reshape(len(s), 3 * n)
    second = np.zeros((n - 2, n))
    for k in range(n - 2):
        second[k, k : k + 3] = 1, -2, 1
    square = second.T @ second
    w = bears.astype(float)
    for _ in range(4):
        scale = max(1.0, len(z) / n)
        weight = [(20 / (2 * np.pi)) ** 4] + [(60 / (2 * np.pi)) ** 4 * max((w * x * x).sum() / scale / n, 0.1) for x in (p, m)]
        normal = design.T @ (design * (w / scale)[:, None]) + np.kron(square, np.diag(weight)) + np.eye(3 * n) * 1e-8
        own = np.linalg.solve(normal, design.T @ (w / scale * z)).reshape(n, 3)
        rise = np.where(u < 0.5 * (n - 1), own[1, 0] - own[0, 0], own[-1, 0] - own[-2, 0]) / 0.5
        r = z - design @ own.ravel() - e * rise
        sigma = min(max(1.4826 * np.median(np.abs(r[bears])), 0.01), 0.05)
        v = np.abs(r) / (4.685 * sigma)
        w = np.where(bears & (v < 1), (1 - v * v) ** 2, 0.0)
    share, beyond = (w[bears] > 0).mean(), int((np.abs(own[:, 1:]) > 0.15).sum())
    own[:, 1:] = np.clip(own[:, 1:], -0.15, 0.15)
    model = design @ own.ravel() + e * rise
    r = z - model
    v = np.abs(r) / 0.08
    keep = np.where(v < 1, (1 - v * v) ** 2, 0.0)
    grid = np.zeros((2, n, 33))
    np.add.at(grid[0], (np.clip(np.rint(u).astype(int), 0, n - 1), np.clip(np.rint((t + 8) / 0.5).astype(int), 0, 32)), keep * r)
    np.add.at(grid[1], (np.clip(np.rint(u).astype(int), 0, n - 1), np.clip(np.rint((t + 8) / 0.5).astype(int), 0, 32)), keep)

    def bell(size, deviation, reach):
        d = np.arange(-reach, reach + 1)
        w = np.exp(-0.5 * (d / deviation) ** 2)
        out = np.zeros((size, size))
        for a in range(size):
            for b, x in zip(d, w / w.sum(), strict=True):
                if 0 <= a + b < size:
                    out[a, a + b] = x
        return out

    num, den = bell(n, 4, 16) @ grid @ bell(33, 2, 8).T
    low = np.where(den > 0.05, num / np.maximum(den, 1e-12), 0)
    j = np.clip(np.floor((t + 8) / 0.5).astype(int), 0, 31)
    g = (t + 8) / 0.5 - j
    kept = (low[i, j] * (1 - g) + low[i, j + 1] * g) * (1 - f) + (low[i + 1, j] * (1 - g) + low[i + 1, j + 1] * g) * f
    return model, kept, sigma, share, beyond, int((keep <= 0).sum())


@pytest.fixture(scope="module")
def road_tables(spark, sf_dir):
    return fixture(spark, sf_dir, "road_pixel").cache(), fixture(spark, sf_dir, "road_axis").cache()


def test_surface_model_equals_dense_fits(road_tables):
    pixels, roads = road_tables
    surface, report = (x.toPandas() for x in roadfit.surface_model(pixels, roads))
    lengths = dict(map(tuple, roads.collect()))
    told = report.set_index("road_id")
    groups = {k: g for k, g in pixels.where("z is not null and abs(t) <= 8").toPandas().groupby("road_id") if len(g) >= 12}
    assert set(told.index) == set(groups)
    unfit = clamped = 0
    for road, g in groups.items():
        bears = (g.edge >= 1).to_numpy()
        bears = bears if bears.mean() >= 0.3 else np.ones(len(g), dtype=bool)
        model, kept, sigma, share, beyond, outliers = dense_fit(*(g[x].to_numpy() for x in ("s", "t", "e", "z")), bears, lengths[road])
        one = told.loc[road]
        assert one.pixels == len(g) and one.clamped == beyond and one.unfit == (share < 0.35)
        assert abs(one.sigma - sigma) < 1e-7 and abs(one.fit_share - share) < 1e-9
        unfit, clamped = unfit + bool(one.unfit), clamped + (beyond > 0)
        mine = surface[surface.road_id == road].set_index("pixel").reindex(g.pixel)
        if one.unfit:
            assert mine.model.isna().all()
            continue
        assert one.outliers == outliers
        assert np.abs(mine.model.to_numpy() - model).max() < 1e-6 and np.abs(mine.kept.to_numpy() - kept).max() < 1e-6
    assert unfit and clamped and unfit < len(groups)


def test_windows_of_a_long_road_equal_one_solution(spark):
    make = np.random.default_rng(4)
    n = 6000
    s = np.sort(make.random(n) * 1500)
    t = make.random(n) * 12 - 6
    z = 900 + np.sin(s / 40) + 0.03 * t + make.normal(0, 0.01, n)
    data = [(1, k, float(a), float(b), 0.0, float(h), 2.0) for k, (a, b, h) in enumerate(zip(s, t, z, strict=True))]
    pixels = spark.createDataFrame(data, "road_id long, pixel long, s double, t double, e double, z double, edge double")
    roads = spark.createDataFrame([(1, 1500.0)], "road_id long, length double")
    whole = roadfit.surface_model(pixels, roads, core=10_000)[0].toPandas().set_index("pixel")
    cut = roadfit.surface_model(pixels, roads)[0].toPandas().set_index("pixel").reindex(whole.index)
    assert len(whole) == n and np.abs(whole.height - cut.height).max() < 1e-5


def test_rounds_neither_write_nor_deal_pixels(spark, road_tables, monkeypatch):
    pixels, roads = road_tables
    written, plain_cut = {}, roadfit.cut

    def counted(t, name):
        out = plain_cut(t, name)
        written[name] = max(written.get(name, 0), out.count())
        return out

    monkeypatch.setattr(roadfit, "cut", counted)
    monkeypatch.setattr(quantiles, "cut", counted)
    roadfit.surface_model(pixels, roads)
    assert written and max(written.values()) < pixels.count() / 100
    placed, fittable = roadfit.located(pixels, roads)
    told, stations = roadfit.robust_fit(placed, fittable, rounds=1)
    sums = roadfit.normal_equations(roadfit.reweighted(placed, told, stations))
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Bucketed: true") == 2 and plan.count("Exchange ") == 1  # the road's columns go to its windows


def test_windows_share_stations_and_lend_sums(spark):
    make = np.random.default_rng(6)
    n = 900
    s, t = np.sort(make.random(n) * 60), make.random(n) * 14 - 7
    z = 900 + np.sin(s / 9) + np.where(t > 0, 0.05, -0.02) * t + make.normal(0, 0.01, n)
    edge, e = 7 - np.abs(t), np.where(s > 59, 0.25, 0.0)
    data = [(1, k, *map(float, row)) for k, row in enumerate(zip(s, t, e, z, edge, strict=True))]
    pixels = spark.createDataFrame(data, "road_id long, pixel long, s double, t double, e double, z double, edge double")
    roads = spark.createDataFrame([(1, 60.0)], "road_id long, length double")
    whole, told = (x.toPandas() for x in roadfit.surface_model(pixels, roads))
    # the halo holds the whole road, so that windows of 40 stations give the same
    cut, cut_told = (x.toPandas() for x in roadfit.surface_model(pixels, roads, core=40))
    whole, cut = whole.set_index("pixel"), cut.set_index("pixel").reindex(range(n))
    assert len(whole) == n and all(np.abs(whole[x] - cut[x]).max() < 1e-8 for x in ("model", "kept", "height", "w"))
    assert told[["pixels", "stations", "clamped", "outliers"]].equals(cut_told[["pixels", "stations", "clamped", "outliers"]])


def test_percentiles_of_dealt_rows_equal_others(spark):
    make = np.random.default_rng(3)
    data = [(int(k), int(w), float(v)) for k, w, v in zip(make.integers(0, 3, 4000), make.integers(0, 5, 4000), make.normal(0, 1, 4000), strict=True)] + [(7, 0, 2.5), (8, 1, None)]
    t = spark.createDataFrame(data, "k long, part long, v double")
    dealt = iterate.cut_bucketed(t, "values", ["k", "part"])
    want = {r["k"]: (r["half"], r["most"]) for r in quantiles.percentiles(t, ["k"], "v", {"half": 0.5, "most": 0.99}).collect()}
    got = {r["k"]: (r["half"], r["most"]) for r in quantiles.percentiles(dealt, ["k"], "v", {"half": 0.5, "most": 0.99}, bins=20, dealt_by=["k", "part"]).collect()}
    assert got == want and set(got) == {0, 1, 2, 7}


def test_too_few_pixels_and_empty_tables(spark, road_tables):
    pixels, roads = road_tables
    few = pixels.where("road_id = 0").limit(11)
    for table in (few, pixels.limit(0)):
        surface, report = roadfit.surface_model(table, roads)
        assert surface.count() == 0 and report.count() == 0


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_percentiles_equal_numpy(spark, keys):
    make = np.random.default_rng(9)
    data = [(int(k), float(v)) for k, v in zip(make.integers(0, 4, 5000), np.concatenate([make.normal(0, 1, 3000), np.full(1500, 0.25), [1e9, -1e9], make.random(498)]), strict=True)]
    data += [(9, 1.5), (None, 2.0), (None, 4.0), (3, None), (8, None), (7, float("nan"))]
    t = spark.createDataFrame(data, "k long, v double")
    got = quantiles.percentiles(t, keys, "v", {"half": 0.5, "most": 0.99, "least": 0.0}, bins=50).collect()
    groups = {}
    for k, v in data:
        if v is not None and v == v:
            groups.setdefault(k if keys else 0, []).append(v)
    assert {r["k"] if keys else 0 for r in got} == set(groups)
    for r in got:
        want = np.quantile(groups[r["k"] if keys else 0], [0.5, 0.99, 0.0])
        assert np.allclose([r["half"], r["most"], r["least"]], want)
    assert quantiles.percentiles(t.limit(0), keys, "v", {"half": 0.5}).count() == 0
