"""Focal operators on cell tables (r, c, value): windows along rows, then along columns; halo joins for sparse cells only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .iterate import cut
from .quantiles import percentiles


def by_row():
    return Window.partitionBy("r").orderBy("c")


def by_column():
    return Window.partitionBy("c").orderBy("r")



def near(window, reach: int):
    return window.rangeBetween(-reach, reach)


def gradient(cells: DataFrame, z: str, size: float) -> DataFrame:
    """Adds dz_dx (east) and dz_dy (north): central differences, one-sided at borders; row 0 is north."""

    def d(w):
        a, b = F.lag(z).over(w), F.lead(z).over(w)
        first, last = F.row_number().over(w) == 1, F.lead(F.lit(1)).over(w).isNull()
        return F.when(first, (b - F.col(z)) / size).when(last, (F.col(z) - a) / size).otherwise((b - a) / (2 * size))

    return cells.withColumn("dz_dx", d(by_row())).withColumn("dz_dy", -d(by_column()))


def slope_aspect(cells: DataFrame, z: str, size: float, flat: float = 0.5) -> DataFrame:
    """Adds slope and downhill aspect (0 north, clockwise) in degrees; the aspect of flats is 0."""
    t = gradient(cells, z, size).withColumn("slope", F.degrees(F.atan(F.hypot("dz_dx", "dz_dy"))))
    aspect = F.pmod(F.degrees(F.atan2(-F.col("dz_dx"), -F.col("dz_dy"))), F.lit(360.0))
    return t.withColumn("aspect", F.when(F.col("slope") < flat, 0.0).otherwise(aspect))


def box_sums(cells: DataFrame, value: str, reach: int) -> DataFrame:
    """Adds sum and count of the valid cells of a square, by two one-dimensional passes."""
    t = cells.withColumns({"_s": F.sum(value).over(near(by_row(), reach)), "_n": F.count(value).over(near(by_row(), reach))})
    return t.withColumns({"box_sum": F.sum("_s").over(near(by_column(), reach)), "box_count": F.sum("_n").over(near(by_column(), reach))}).drop("_s", "_n")


def roughness(cells: DataFrame, z: str, least: int = 6, cap: float | None = None) -> DataFrame:
    """Adds rough: distance from the 3x3 mean of valid cells, where at least `least` of the nine are valid."""
    d = F.abs(F.col(z) - F.col("box_sum") / F.col("box_count"))
    d = F.when(d > cap, F.lit(cap)).otherwise(d) if cap else d  # a null cell stays null
    return box_sums(cells, z, 1).withColumn("rough", F.when(F.col("box_count") >= least, d)).drop("box_sum", "box_count")


def fill_from_neighbours(cells: DataFrame, z: str) -> DataFrame:
    """Nulls take the 3x3 mean of valid neighbours (border cells repeat), else the median of all. Only nulls are joined.

    The median is taken only if some hole has no neighbour, and from counts, not from a buffer of all heights.
    """
    size = F.broadcast(cells.agg(F.max("r").alias("mr"), F.max("c").alias("mc")))
    steps = F.array(*(F.struct(F.lit(i).alias("dr"), F.lit(j).alias("dc")) for i in (-1, 0, 1) for j in (-1, 0, 1)))
    clamp = lambda v, top: F.greatest(F.lit(0), F.least(v, top))
    holes = cells.where(F.col(z).isNull()).join(size).select("r", "c", "mr", "mc", F.explode(steps).alias("d"))
    holes = holes.select("r", "c", clamp(F.col("r") + F.col("d.dr"), F.col("mr")).alias("tr"), clamp(F.col("c") + F.col("d.dc"), F.col("mc")).alias("tc"))
    taps = cells.select(F.col("r").alias("tr"), F.col("c").alias("tc"), F.col(z).alias("_v"))
    found = cut(holes.join(taps, ["tr", "tc"], "left").groupBy("r", "c").agg(F.avg("_v").alias("_fill")), "holes")
    if found.where("_fill is null").limit(1).count():
        middle = percentiles(cells, [], z, {"middle": 0.5})
        found = found.join(F.broadcast(middle), how="left").select("r", "c", F.coalesce("_fill", "middle").alias("_fill"))  # one row
    return cells.join(found, ["r", "c"], "left").withColumn(z, F.coalesce(z, "_fill")).drop("_fill")


def square(cells: DataFrame, value: str, reach: int, f, out: str) -> DataFrame:
    """Adds the minimum or maximum (f) over a square of 2 * reach + 1 cells."""
    return cells.withColumn("_v", f(value).over(near(by_row(), reach))).withColumn(out, f("_v").over(near(by_column(), reach))).drop("_v")


def cross(cells: DataFrame, value: str, f, out: str) -> DataFrame:
    """Adds the minimum or maximum (f: greatest or least) over the cell and its four neighbours inside the grid."""
    own = F.col(value)
    around = [F.coalesce(g(value).over(w), own) for w in (by_row(), by_column()) for g in (F.lag, F.lead)]
    return cells.withColumn(out, f(own, *around))


def kernel(sigma: float, truncate: float = 4.0) -> list[float]:
    k = int(truncate * sigma + 0.5)
    w = [math.exp(-0.5 * (i / sigma) ** 2) for i in range(-k, k + 1)]
    return [x / sum(w) for x in w]


def blur(cells: DataFrame, value: str, sigma: float, out: str, truncate: float = 4.0) -> DataFrame:
    """Adds a Gaussian mean; the border's cells repeat. Two one-dimensional passes of lags and leads."""
    weights = kernel(sigma, truncate)
    k = len(weights) // 2

    def one(column: str, w) -> Column:
        whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        first, last = F.first(column).over(whole), F.last(column).over(whole)
        total = weights[k] * F.col(column)
        for i in range(1, k + 1):
            total = total + weights[k] * 0 + weights[k - i] * (F.coalesce(F.lag(column, i).over(w), first) + F.coalesce(F.lead(column, i).over(w), last))
        return total

    return cells.withColumn("_b", one(value, by_row())).withColumn(out, one("_b", by_column())).drop("_b")


#: Eight neighbours in the order in which the first of equal drops wins: name, row step, column step.
NEIGHBOURS = (("nw", -1, -1), ("n", -1, 0), ("ne", -1, 1), ("w", 0, -1), ("e", 0, 1), ("sw", 1, -1), ("s", 1, 0), ("se", 1, 1))


def d8(cells: DataFrame, z: str, size: float = 1.0) -> DataFrame:
    """Adds to (0..7 in the order of NEIGHBOURS, -1 for a sink) and drop, the steepest fall per metre."""
    t = cells.withColumns({"_w": F.lag(z).over(by_row()), "_e": F.lead(z).over(by_row())}).withColumn("_row", F.struct(F.col("_w").alias("w"), F.col(z).alias("m"), F.col("_e").alias("e")))
    t = t.withColumns({"_up": F.lag("_row").over(by_column()), "_down": F.lead("_row").over(by_column())})
    value = {"nw": "_up.w", "n": "_up.m", "ne": "_up.e", "w": "_w", "e": "_e", "sw": "_down.w", "s": "_down.m", "se": "_down.e"}
    falls = [F.struct((F.coalesce((F.col(z) - F.col(value[n])) / (size * math.hypot(i, j)), F.lit(float("-inf")))).alias("d"), F.lit(-k).alias("k")) for k, (n, i, j) in enumerate(NEIGHBOURS)]
    best = F.greatest(*falls)
    t = t.withColumn("_best", best)
    return t.withColumns({"to": F.when(F.col("_best.d") > 0, -F.col("_best.k")).otherwise(-1), "drop": F.greatest(F.col("_best.d"), F.lit(0.0))}).drop("_w", "_e", "_row", "_up", "_down", "_best")


def bilinear(cells: DataFrame, points: DataFrame, z: str, key: list[str], row: str = "row", col: str = "col", renormalise: bool = False) -> DataFrame:
    """Adds the bilinear sample at fractional (row, col) to the points' keys: null where a tap is missing, unless weights are renormalised.

    The four taps are gathered by cell first, so that a point is dealt once, with its keys, and never grouped.
    """
    taps = [(i, j) for i in (0, 1) for j in (0, 1)]
    corner = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in taps)))
    own = cells.where(F.col(z).isNotNull()).select("r", "c", F.col(z).alias("_z"), corner.alias("_t")).select((F.col("r") - F.col("_t.i")).alias("_r"), (F.col("c") - F.col("_t.j")).alias("_c"), "_z", "_t")
    at = {(i, j): F.when((F.col("_t.i") == i) & (F.col("_t.j") == j), F.col("_z")) for i, j in taps}
    quads = own.groupBy("_r", "_c").agg(*(f(x).alias(f"_{n}{i}{j}") for (i, j), x in at.items() for n, f in (("s", F.sum), ("n", F.count))))
    p = points.select(*key, F.col(row).alias("_row"), F.col(col).alias("_col")).where("_row is not null and _col is not null").withColumns({"_r": F.floor("_row"), "_c": F.floor("_col")})
    t = p.join(quads.hint("merge"), ["_r", "_c"], "left")
    fr, fc = F.col("_row") - F.col("_r"), F.col("_col") - F.col("_c")
    known = total = F.lit(0.0)
    for i, j in taps:
        w = (fr if i else 1 - fr) * (fc if j else 1 - fc)
        known = known + F.when((w > 0) & (F.col(f"_n{i}{j}") > 0), w * F.col(f"_n{i}{j}")).otherwise(0.0)
        total = total + F.when((w > 0) & (F.col(f"_n{i}{j}") > 0), w * F.col(f"_s{i}{j}")).otherwise(0.0)
    value = F.when(known > 0, total / known) if renormalise else F.when(known >= 1 - 1e-9, total)
    return t.select(*key, value.alias("sample"))


def nearest_fill(cells: DataFrame, z: str, reach: float) -> DataFrame:
    """Nulls take the nearest valid cell within `reach` cells; ties to the smaller row, then column."""
    k = int(reach)
    steps = [(i * i + j * j, i, j) for i in range(-k, k + 1) for j in range(-k, k + 1) if 0 < i * i + j * j <= reach * reach]
    table = F.array(*(F.struct(F.lit(d).alias("d"), F.lit(i).alias("i"), F.lit(j).alias("j")) for d, i, j in steps))
    holes = cells.where(F.col(z).isNull()).select("r", "c", F.explode(table).alias("t")).select("r", "c", F.col("t.d").alias("d"), (F.col("r") + F.col("t.i")).alias("sr"), (F.col("c") + F.col("t.j")).alias("sc"))
    source = cells.where(F.col(z).isNotNull()).select(F.col("r").alias("sr"), F.col("c").alias("sc"), F.col(z).alias("_v"))
    best = holes.join(source, ["sr", "sc"]).groupBy("r", "c").agg(F.min_by("_v", F.struct("d", "sr", "sc")).alias("_fill"))
    return cells.join(best, ["r", "c"], "left").withColumn(z, F.coalesce(z, "_fill")).drop("_fill")


def cells_in_rings(rings: DataFrame, key: str = "poly_id") -> DataFrame:
    """(key, r, c) of the cells whose centre (c + 0.5, -(r + 0.5)) lies inside a polygon, by the even-odd rule."""
    w = Window.partitionBy(key).orderBy("seq")
    nxt = lambda a: F.coalesce(F.lead(a).over(w), F.first(a).over(w))
    edges = rings.withColumns({"x1": nxt("x"), "y1": nxt("y")})
    # each edge meets only the rows that it spans
    top, low = F.floor(-F.greatest("y", "y1") - 0.5), F.ceil(-F.least("y", "y1") - 0.5)
    spanned = edges.where(F.col("y") != F.col("y1")).withColumn("r", F.explode(F.sequence(top, low)))
    cross_x = F.col("x") + (-(F.col("r") + 0.5) - F.col("y")) / (F.col("y1") - F.col("y")) * (F.col("x1") - F.col("x"))
    hit = spanned.where((F.col("y") > -(F.col("r") + 0.5)) != (F.col("y1") > -(F.col("r") + 0.5)))
    crossed = hit.select(key, "r", cross_x.alias("cx")).groupBy(key, "r").agg(F.array_sort(F.collect_list("cx")).alias("cx"))
    pairs = crossed.select(key, "r", F.explode(F.sequence(F.lit(0), F.size("cx") - 2, F.lit(2))).alias("i"), "cx").where("size(cx) > 1")
    spans = pairs.select(key, "r", F.ceil(F.element_at("cx", F.col("i") + 1) - 0.5).alias("c0"), (F.ceil(F.element_at("cx", F.col("i") + 2) - 0.5) - 1).alias("c1")).where("c1 >= c0")
    return spans.select(key, "r", F.explode(F.sequence("c0", "c1")).alias("c"))
