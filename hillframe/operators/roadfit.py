"""Road surface model: a penalised robust fit of height over station and offset, and the blend of overlapping models.

Along a road stand stations half a metre apart; at each the model has an axis height a and a crossfall to either side, so a point at station s and
offset t has z = a(s) + left(s) * max(t, 0) + right(s) * min(t, 0), linear between stations. Squared second differences of all three are
penalised. Normal equations are summed in Spark by road and station; only these sums, one row per station, go to the solver, in windows of stations
that overlap so far that what lies beyond has no say. So no road is one group, however long it is.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .iterate import cut, cut_bucketed
from .quantiles import percentiles

# fixed values of the model
STATION = 0.5  # metres between stations
AXIS_CUTOFF, SLOPE_CUTOFF = 10.0, 30.0  # metres of the wave that passes at half power
HALF_MAX = 8.0
TUKEY, SIGMA_LOW, SIGMA_HIGH, ROUNDS = 4.685, 0.010, 0.050, 4
FIT_SHARE, SUPPORT_EDGE, SUPPORT_SHARE, CROSSFALL, KEEP = 0.35, 1.0, 0.3, 0.15, 0.08
ALONG, ACROSS, OFFSET = 2.0, 1.0, 0.5  # of the kept remainder: metres of its low-pass, and between its offsets
REACH = 2.0

MOMENTS = ("1", "p", "m", "pp", "mm")
PARTS = ("lo", "mid", "hi")  # products of a pixel's shares in its two stations: lower twice, both, upper twice
CORE, HALO = 480, 240  # stations of a window, and those around it on either side


def penalty(cutoff: float) -> float:
    """The weight of squared second differences that halves the power of waves of the cutoff's length."""
    return (cutoff / STATION / (2 * math.pi)) ** 4


def located(pixels: DataFrame, roads: DataFrame, key: str = "road_id", core: int = CORE) -> tuple[DataFrame, DataFrame]:
    """Pixels of roads of a metre and more with their place u among the stations, dealt once by road and window; and the fittable roads.

    pixels: key, pixel, s, t, e (metres past an end of the axis), z, edge (metres from the own polygon's edge); roads: key, length.
    A road of under 12 pixels within 8 m, or of under a metre, has no model. Where less than 0.3 of the pixels are a metre and more from
    the edge, all of them bear the fit: such a road's bearing edge is null.
    """
    near = pixels.where(F.col("z").isNotNull() & (F.abs("t") <= HALF_MAX)).join(roads.where(F.col("length") >= 2 * STATION).select(key, "length"), key)
    t = near.withColumn("stations", F.greatest(F.lit(4), F.ceil(F.col("length") / STATION) + 1).cast("long"))
    t = t.withColumn("u", F.greatest(F.lit(0.0), F.least(F.col("s") / STATION, F.col("stations") - 1 - 1e-9))).withColumn("window", F.floor(F.floor("u") / core))
    t = cut_bucketed(t.select(key, "window", "pixel", "u", "t", "e", "z", "edge", "stations"), "pixels", [key, "window"])
    inner = (F.col("edge") >= SUPPORT_EDGE).cast("double")
    held = t.groupBy(key, "window").agg(F.first("stations").alias("stations"), F.count(F.lit(1)).alias("n"), F.sum(inner).alias("inner"), F.count(inner).alias("told"))
    held = held.groupBy(key).agg(F.first("stations").alias("stations"), F.sum("n").alias("n"), (F.sum("inner") / F.sum("told")).alias("share")).where("n >= 12")
    all_bear = F.col("share") < SUPPORT_SHARE
    fittable = held.select(key, "stations", "n", F.when(all_bear, 1.0).otherwise(F.col("share")).alias("support_share"), F.when(~all_bear, SUPPORT_EDGE).alias("bearing_edge"))
    return t, cut(fittable, "fittable")


def by_window(roads: DataFrame, core: int) -> DataFrame:
    """A row for every window of a road."""
    return roads.withColumn("window", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("stations") - 1) / core))))


def bearing(pixels: DataFrame, roads: DataFrame, key: str = "road_id", core: int = CORE) -> DataFrame:
    """Pixels of the given roads with those roads' columns, station i, the share f of the next one, offsets by side p and m, and whether they bear the fit. No pixel moves."""
    t = pixels.join(by_window(roads, core).drop("stations").hint("shuffle_hash"), [key, "window"])
    return t.withColumns({"i": F.floor("u"), "f": F.col("u") - F.floor("u"), "p": F.greatest("t", F.lit(0.0)), "m": F.least("t", F.lit(0.0)), "bears": F.coalesce(F.col("bearing_edge").isNull() | (F.col("edge") >= F.col("bearing_edge")), F.lit(False))})


def normal_equations(pixels: DataFrame, key: str = "road_id") -> DataFrame:
    """Sums of weighted products by road, window and lower station: left sides {part}_{moment}, right sides of both stations."""
    f, w, z = F.col("f"), F.col("w"), F.col("z")
    shares = dict(zip(PARTS, ((1 - f) * (1 - f), f * (1 - f), f * f), strict=True))
    by = {"1": F.lit(1.0), "p": F.col("p"), "m": F.col("m"), "pp": F.col("p") * F.col("p"), "mm": F.col("m") * F.col("m")}
    left = [F.sum(w * share * moment).alias(f"{part}_{name}") for part, share in shares.items() for name, moment in by.items()]
    right = [F.sum(w * share * by[name] * z).alias(f"z{at}_{name}") for at, share in (("0", 1 - f), ("1", f)) for name in MOMENTS[:3]]
    return pixels.where("w > 0").groupBy(key, "window", "i").agg(*left, *right)


def solve_window(left: np.ndarray, right: np.ndarray, lam: tuple[float, float, float]) -> np.ndarray:
    """(stations, 3) heights and crossfalls of one window.

    left: (stations, 3 parts, 5 moments), right: (stations, 2, 3), sums by the lower station. The matrix couples a station with two on either
    side; taken two at a time, stations make a block-tridiagonal one of six rows a block, which is eliminated forward and substituted back.
    """
    n = len(left)
    pairs = n + n % 2
    diag, near, far, rhs = np.zeros((pairs + 2, 3, 3)), np.zeros((pairs + 2, 3, 3)), np.zeros((pairs + 2, 3, 3)), np.zeros((pairs + 2, 3))
    # moments as a symmetric 3 x 3; a pixel is on one side of the axis, so the sides don't meet
    outer = np.zeros((n, 3, 3, 3))
    for (x, y), k in {(0, 0): 0, (0, 1): 1, (1, 0): 1, (0, 2): 2, (2, 0): 2, (1, 1): 3, (2, 2): 4}.items():
        outer[:, :, x, y] = left[:, :, k]
    diag[:n] += outer[:, 0]
    near[:n] += outer[:, 1]  # a station with the next one
    diag[1 : n + 1] += outer[:, 2]
    rhs[:n] += right[:, 0]
    rhs[1 : n + 1] += right[:, 1]
    second = np.arange(n - 2)
    for k, weight in enumerate(lam):
        for step, own in enumerate((1.0, 4.0, 1.0)):
            diag[second + step, k, k] += weight * own
        near[second, k, k] -= 2 * weight
        near[second + 1, k, k] -= 2 * weight
        far[second, k, k] += weight
    diag[np.arange(n)] += np.eye(3) * 1e-8
    diag[n:pairs] = np.eye(3)
    near[n - 1 :] = far[max(0, n - 2) :] = 0.0
    rhs[n:] = 0.0
    blocks = pairs // 2
    own, ahead, given = np.zeros((blocks, 6, 6)), np.zeros((blocks, 6, 6)), rhs[:pairs].reshape(blocks, 6)
    own[:, :3, :3], own[:, 3:, 3:] = diag[0:pairs:2], diag[1:pairs:2]
    own[:, :3, 3:] = near[0:pairs:2]
    own[:, 3:, :3] = near[0:pairs:2].transpose(0, 2, 1)
    ahead[:, :3, :3], ahead[:, 3:, 3:], ahead[:, 3:, :3] = far[0:pairs:2], far[1:pairs:2], near[1:pairs:2]
    kept, value = np.zeros((blocks, 6, 6)), np.zeros((blocks, 6))
    for b in range(blocks):
        matrix, vector = own[b], given[b]
        if b:
            matrix, vector = matrix - ahead[b - 1].T @ kept[b - 1], vector - ahead[b - 1].T @ value[b - 1]
        solved = np.linalg.solve(matrix, np.column_stack([ahead[b], vector]))
        kept[b], value[b] = solved[:, :6], solved[:, 6]
    for b in range(blocks - 2, -1, -1):
        value[b] -= kept[b] @ value[b + 1]
    return value.reshape(pairs, 3)[:n]


def _lent(table: DataFrame, core: int, halo: int) -> DataFrame:
    """Every station's row in each other window that has it in its halo."""
    first, last = F.greatest(F.lit(0), F.floor((F.col("i") - halo) / core)), F.floor((F.col("i") + halo) / core)
    return table.withColumn("to", F.explode(F.sequence(first.cast("long"), last.cast("long")))).where("to <> window").withColumn("window", F.col("to")).drop("to")


def solved(pixels: DataFrame, roads: DataFrame, key: str = "road_id", core: int = CORE, halo: int = HALO) -> DataFrame:
    """A row per window: its first station and the lists a, left and right of its stations and the next one, solved with `halo` stations on either side.

    pixels: weighted ones, as dealt; roads: key, stations, scale (pixels a station) and spread_p, spread_m (mean squared offsets). A window sums its own normal
    equations where its pixels lie; only the sums that other windows have in their halos move. Stations without pixels follow from the penalty alone.
    """
    lists = [f"{part}_{name}" for part in PARTS for name in MOMENTS]
    goals = [f"z{at}_{name}" for at in "01" for name in MOMENTS[:3]]
    told = by_window(roads.select(key, "stations", "scale", "spread_p", "spread_m"), core)
    lent = _lent(normal_equations(pixels.where(F.col("stations") > core), key), core, halo)
    given = told.unionByName(lent, allowMissingColumns=True)

    def solve(keys: tuple, summed: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
        road, window = keys
        facts = given[given["stations"].notna()]
        if facts.empty:  # lent beyond the road's last window
            return pd.DataFrame(columns=[key, "window", "stations", "first", "a", "left", "right"])
        one = facts.iloc[0]
        stations = int(one["stations"])
        low, high = max(0, window * core - halo), min(stations, (window + 1) * core + halo)
        left, right = np.zeros((high - low, 15)), np.zeros((high - low, 6))
        for held in (summed, given[given["i"].notna()]):
            at = held["i"].to_numpy().astype(int) - low
            inside = (at >= 0) & (at < high - low - 1)  # the last station's pixels lie beyond the window
            left[at[inside]], right[at[inside]] = held[lists].to_numpy()[inside], held[goals].to_numpy()[inside]
        lam = penalty(AXIS_CUTOFF), penalty(SLOPE_CUTOFF) * one["spread_p"], penalty(SLOPE_CUTOFF) * one["spread_m"]
        found = solve_window(left.reshape(-1, 3, 5) / one["scale"], right.reshape(-1, 2, 3) / one["scale"], lam)
        own = np.arange(window * core, min(stations, (window + 1) * core) + 1)
        lists_of = found[np.minimum(own, stations - 1) - low].T
        return pd.DataFrame({key: [road], "window": window, "stations": stations, "first": window * core, "a": [lists_of[0]], "left": [lists_of[1]], "right": [lists_of[2]]})

    kind = roads.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, window long, stations long, first long, a array<double>, left array<double>, right array<double>"
    return normal_equations(pixels, key).groupBy(key, "window").cogroup(given.groupBy(key, "window")).applyInPandas(solve, schema)


def end_grades(stations: DataFrame, key: str = "road_id") -> DataFrame:
    """grade0 and grade1: the rise of an axis in its first and in its last half metre."""
    rise = lambda at: (F.element_at("a", at + 1) - F.element_at("a", at)) / STATION
    last = (F.col("stations") - 1 - F.col("first")).cast("int")  # before the last station, from 1
    begins, ends = F.col("first") == 0, (last >= 1) & (last < F.size("a"))
    return stations.groupBy(key).agg(F.max(F.when(begins, rise(F.lit(1)))).alias("grade0"), F.max(F.when(ends, rise(last))).alias("grade1"))


def modelled(pixels: DataFrame, stations: DataFrame, key: str = "road_id", limit: float | None = None) -> DataFrame:
    """Adds model and r, the height that it leaves; past the ends of an axis the end grade goes on. limit clamps the crossfalls.

    pixels: as by `bearing`, with the end grades. They and the windows' lists lie in the same buckets.
    """
    side = (lambda x: F.greatest(F.lit(-limit), F.least(F.lit(limit), x))) if limit else (lambda x: x)
    at, f = (F.col("i") - F.col("first")).cast("int"), F.col("f")
    between = lambda x, bound: bound(F.element_at(x, at + 1)) * (1 - f) + bound(F.element_at(x, at + 2)) * f
    z = between("a", lambda x: x) + between("left", side) * F.col("p") + between("right", side) * F.col("m")
    t = pixels.join(stations.drop("stations").hint("shuffle_hash"), [key, "window"])
    model = z + F.col("e") * F.when(F.col("u") < 0.5 * (F.col("stations") - 1), F.col("grade0")).otherwise(F.col("grade1"))
    return t.withColumn("model", model).withColumn("r", F.col("z") - F.col("model")).select(*pixels.columns, "model", "r")


def biweight(r: Column, scale: Column) -> Column:
    v = F.abs(r) / scale
    return F.when(v < 1, F.pow(1 - v * v, F.lit(2))).otherwise(0.0)


def reweighted(pixels: DataFrame, roads: DataFrame, stations: DataFrame, key: str = "road_id", core: int = CORE) -> DataFrame:
    """Bearing pixels' weights w by what the stations' model leaves of them, on the scale of their road's sigma."""
    t = modelled(bearing(pixels, roads, key, core), stations, key)
    return t.withColumn("w", F.when(F.col("bears"), biweight(F.col("r"), TUKEY * F.col("sigma"))).otherwise(0.0))


def robust_fit(pixels: DataFrame, roads: DataFrame, key: str = "road_id", rounds: int = ROUNDS, core: int = CORE, halo: int = HALO) -> tuple[DataFrame, DataFrame]:
    """Roads with sigma, grade0 and grade1, and the stations' unclamped parameters: `rounds` fits, each reweighted by the last one's remainders.

    pixels, roads: as by `located`. The scale of a round is 1.4826 times the road's median remainder, within 1 and 5 cm. A round writes parameters of stations and of
    roads; the weights follow from them where the pixels lie, so these are neither dealt nor written again.
    """
    told, stations = roads, None
    for turn in range(rounds):
        t = reweighted(pixels, told, stations, key, core) if turn else bearing(pixels, told, key, core).withColumn("w", F.col("bears").cast("double"))
        spread = t.groupBy(key, "window").agg(*(F.sum(F.col("w") * F.col(x) * F.col(x)).alias(x + x) for x in ("p", "m"))).groupBy(key).agg(F.sum("pp").alias("pp"), F.sum("mm").alias("mm"))
        scale = F.greatest(F.lit(1.0), F.col("n") / F.col("stations"))
        road = told.join(spread, key).select(key, "stations", scale.alias("scale"), *(F.greatest(F.col(x) / scale / F.col("stations"), F.lit(0.1)).alias(y) for x, y in (("pp", "spread_p"), ("mm", "spread_m"))))
        stations = cut_bucketed(solved(t, cut(road, "spreads"), key, core, halo), "stations", [key, "window"])
        graded = cut(told.drop("grade0", "grade1", "sigma").join(end_grades(stations, key), key), "graded")
        fitted = modelled(bearing(pixels, graded, key, core), stations, key).where("bears")
        middle = percentiles(fitted, [key], F.abs("r"), {"middle": 0.5}, bins=256, dealt_by=[key, "window"])
        sigma = middle.select(key, F.greatest(F.lit(SIGMA_LOW), F.least(F.lit(SIGMA_HIGH), 1.4826 * F.col("middle"))).alias("sigma"))
        told = cut(graded.join(sigma, key), "scales")
    return told, stations


def gauss(sigma: float) -> np.ndarray:
    """Normal weights as far as four deviations, that sum to 1."""
    k = int(4 * sigma + 0.5)
    w = np.exp(-0.5 * (np.arange(-k, k + 1) / sigma) ** 2)
    return w / w.sum()


def kept_remainder(pixels: DataFrame, key: str = "road_id", core: int = CORE) -> DataFrame:
    """Adds kept: the low-pass of the remainders (2 m along, 1 m across), weighted by how near they are to the model.

    Remainders are summed by station and half-metre offset where the pixels lie; the grid's windows are smoothed apart, with as much around them as a weight reaches.
    """
    across = int(round(2 * HALF_MAX / OFFSET)) + 1
    along, over = gauss(ALONG / STATION), gauss(ACROSS / OFFSET)
    halo = len(along) // 2 + 1
    w = biweight(F.col("r"), F.lit(KEEP))
    place = (F.col("t") + HALF_MAX) / OFFSET
    near = lambda x, top: F.greatest(F.lit(0), F.least(F.rint(x).cast("long"), top))
    grid = pixels.select(key, "window", "stations", near(F.col("u"), F.col("stations") - 1).alias("i"), near(place, F.lit(across - 1)).cast("int").alias("j"), w.alias("w"), (w * F.col("r")).alias("wr"))
    grid = grid.groupBy(key, "window", "i", "j").agg(F.first("stations").alias("stations"), F.sum("w").alias("w"), F.sum("wr").alias("wr"))

    def smooth(keys: tuple, summed: pd.DataFrame, lent: pd.DataFrame) -> pd.DataFrame:
        road, window = keys
        if summed.empty:  # no pixel asks
            return pd.DataFrame(columns=[key, "window", "low_pass"])
        stations = int(summed["stations"].iloc[0])
        low, size = window * core - halo, core + 2 * halo
        sums = np.zeros((2, size, across))
        for k, x in enumerate(("wr", "w")):
            for part in (summed, lent):  # pixels of two windows may be nearest to one station
                np.add.at(sums[k], (part["i"].to_numpy(dtype=int) - low, part["j"].to_numpy(dtype=int)), part[x].to_numpy(dtype=float))
            sums[k] = np.apply_along_axis(np.convolve, 1, sums[k], over, "same")
            sums[k] = np.apply_along_axis(np.convolve, 0, sums[k], along, "same")
        low_pass = np.where(sums[1] > 0.05, sums[0] / np.maximum(sums[1], 1e-12), 0.0)
        own = np.minimum(np.arange(window * core, min(stations, (window + 1) * core) + 1), stations - 1)
        return pd.DataFrame({key: [road], "window": window, "low_pass": [low_pass[own - low].ravel()]})

    kind = pixels.schema[key].dataType.simpleString()
    lent = _lent(grid.where(F.col("stations") > core), core, halo)
    lent = lent.select(*(F.col(x).alias(x) for x in lent.columns))  # columns of its own beside those of the grid
    rows = grid.groupBy(key, "window").cogroup(lent.groupBy(key, "window")).applyInPandas(smooth, f"{key} {kind}, window long, low_pass array<double>")
    j = F.greatest(F.lit(0), F.least(F.floor(place), F.lit(across - 2))).cast("int")
    g = place - j
    cell = ((F.col("i") - F.col("window") * core) * across).cast("int") + j
    row = lambda at: F.element_at("low_pass", at + 1) * (1 - g) + F.element_at("low_pass", at + 2) * g
    kept = row(cell) * (1 - F.col("f")) + row(cell + across) * F.col("f")
    return pixels.join(rows.hint("shuffle_hash"), [key, "window"]).withColumn("kept", kept).select(*pixels.columns, "kept")


def surface_model(pixels: DataFrame, roads: DataFrame, key: str = "road_id", core: int = CORE, halo: int = HALO) -> tuple[DataFrame, DataFrame]:
    """Smoothed pixels (key, pixel, model, kept, height, w) and a report per road.

    Report: pixels, stations, sigma, support_share, fit_share (bearing pixels that keep weight), clamped (crossfalls beyond 0.15, of both sides), unfit
    (fit_share under 0.35: such a road gives no pixels), outliers (pixels 8 cm and more from the model). A road of too few pixels has neither.
    """
    placed, fittable = located(pixels, roads, key, core)
    told, stations = robust_fit(placed, fittable, key, ROUNDS, core, halo)
    weighed = reweighted(placed, told, stations, key, core).where("bears")
    share = weighed.groupBy(key, "window").agg(F.sum((F.col("w") > 0).cast("double")).alias("held"), F.count("w").alias("of")).groupBy(key).agg((F.sum("held") / F.sum("of")).alias("fit_share"))
    steep = lambda x: F.size(F.filter(F.slice(x, 1, F.size(x) - 1), lambda v: F.abs(v) > CROSSFALL))  # noqa: E731 - without the next window's first station
    beyond = stations.groupBy(key).agg(F.sum((steep("left") + steep("right")).cast("long")).alias("clamped"))
    facts = told.join(share, key).join(beyond, key).withColumn("unfit", F.col("fit_share") < FIT_SHARE)
    facts = cut(facts.withColumnRenamed("n", "pixels"), "roads")
    good = bearing(placed, facts.where("not unfit").select(key, "stations", "bearing_edge", "grade0", "grade1"), key, core)
    good = modelled(good, stations, key, CROSSFALL)
    out = kept_remainder(good, key, core).withColumn("w", biweight(F.col("r"), F.lit(KEEP)))
    out = out.select(key, "pixel", "edge", "model", "kept", (F.col("model") + F.col("kept")).alias("height"), "w")
    outliers = good.groupBy(key, "window").agg(F.sum((biweight(F.col("r"), F.lit(KEEP)) <= 0).cast("long")).alias("outliers")).groupBy(key).agg(F.sum("outliers").alias("outliers"))
    return out, facts.select(key, "pixels", "stations", "sigma", "support_share", "fit_share", "clamped", "unfit").join(outliers, key, "left")


def overlap_blend(models: DataFrame, cells: DataFrame, key: list[str], height: str = "height", edge: str = "edge", z: str = "z") -> DataFrame:
    """Cells with blended: heights of all models of a cell, weighted by min(edge distance, 2 m) squared; null where there is none.

    Where the highest and the lowest model are more than 8 cm apart, the blend fades back to the cell's own height over the next 8 cm. conflict: more than 8 cm.
    """
    weight = F.pow(F.least(F.col(edge), F.lit(REACH)), F.lit(2)) + 0.001
    found = models.groupBy(*key).agg((F.sum(weight * F.col(height)) / F.sum(weight)).alias("_mean"), (F.max(height) - F.min(height)).alias("_spread"))
    fade = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col("_spread") - KEEP) / KEEP))
    own = F.col("_mean") * (1 - fade) + F.col(z) * fade
    return cells.join(found, key).withColumn("blended", F.when(F.col(z).isNull(), F.col("_mean")).otherwise(own)).withColumn("conflict", F.col("_spread") > KEEP).drop("_mean", "_spread")
