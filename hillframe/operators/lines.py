"""Linear referencing: stations, offsets, runs, gap fills, windows along an axis, segment joins.

A road is rows (road_id, seq, x, y, z, w); a window partitioned by road spreads over executors by road.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def along(key: str = "road_id", order: str = "seq"):
    return Window.partitionBy(key).orderBy(order)


def stations(nodes: DataFrame, key: str = "road_id", order: str = "seq") -> DataFrame:
    """Adds s, the length from the first node."""
    w = along(key, order)
    step = F.coalesce(F.hypot(F.col("x") - F.lag("x").over(w), F.col("y") - F.lag("y").over(w)), F.lit(0.0))
    return nodes.withColumn("step", step).withColumn("s", F.sum("step").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("step")


def tangents(nodes: DataFrame, key: str = "road_id", order: str = "seq") -> DataFrame:
    """Adds the unit tangent (tx, ty) by central differences and the left normal (nx, ny)."""
    w = along(key, order)
    d = {a: F.coalesce(F.lead(a).over(w), F.col(a)) - F.coalesce(F.lag(a).over(w), F.col(a)) for a in ("x", "y")}
    t = nodes.withColumns({"dx": d["x"], "dy": d["y"]}).withColumn("n", F.hypot("dx", "dy"))
    t = t.withColumns({"tx": F.when(F.col("n") > 0, F.col("dx") / F.col("n")), "ty": F.when(F.col("n") > 0, F.col("dy") / F.col("n"))})
    return t.withColumns({"nx": -F.col("ty"), "ny": F.col("tx")}).drop("dx", "dy", "n")


def runs(df: DataFrame, key: str, order: str, flag: str, measure: str | None = None) -> DataFrame:
    """Maximal runs of consecutive rows where flag holds: (key, first, last, n, length)."""
    w = along(key, order)
    change = (F.col(flag) & ~F.coalesce(F.lag(flag).over(w), F.lit(False))).cast("long")
    t = df.withColumn("run", F.sum(change).over(w.rowsBetween(Window.unboundedPreceding, 0))).where(flag)
    length = (F.max(measure) - F.min(measure)) if measure else F.lit(0.0)
    return t.groupBy(key, "run").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count(F.lit(1)).alias("n"), length.alias("length")).drop("run")


def baseline(value: Column, rows: int, w) -> tuple[Column, Column]:
    """Rolling maxima over the last and the next `rows` samples, own one included."""
    return F.max(value).over(w.rowsBetween(-(rows - 1), 0)), F.max(value).over(w.rowsBetween(0, rows - 1))


def fill_gaps(df: DataFrame, key: str, order: str, measure: str, value: str, limit: float) -> Column:
    """Linear between the next known values before and after, where they are at most `limit` apart; no extrapolation."""
    w = along(key, order)
    known = F.when(F.col(value).isNotNull(), F.struct(F.col(measure).alias("s"), F.col(value).alias("v")))
    before = F.last(known, True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    after = F.first(known, True).over(w.rowsBetween(0, Window.unboundedFollowing))
    gap = after["s"] - before["s"]
    inner = before["v"] + (after["v"] - before["v"]) * (F.col(measure) - before["s"]) / gap
    return F.when(F.col(value).isNotNull(), F.col(value)).when((gap > 0) & (gap <= limit), inner)


def segments(nodes: DataFrame, key: str = "road_id", order: str = "seq") -> DataFrame:
    """One row per pair of neighbouring nodes: (key, seg, x0, y0, z0, x1, y1, z1, s0, s1)."""
    w = along(key, order)
    t = stations(nodes, key, order)
    nxt = {f"{a}1": F.lead(a).over(w) for a in ("x", "y", "z", "s", "w")}
    return t.withColumns(nxt).where("x1 is not null").select(key, F.col(order).alias("seg"), *(F.col(a).alias(f"{a}0") for a in ("x", "y", "z", "s", "w")), *nxt)


def sample_at(segs: DataFrame, points: DataFrame, key: str = "road_id", at: str = "at", bin_m: float = 25.0, direction: bool = False) -> DataFrame:
    """x, y, z, w at stations: the bracketing segment (s0 <= at < s1, the last one closed) by an equi-join on bins of s.

    With direction the segment's left unit normal (nx, ny) too.
    """
    low, high = F.floor(F.col("s0") / bin_m), F.floor(F.col("s1") / bin_m)
    last = F.max("seg").over(Window.partitionBy(key))
    s = segs.withColumn("closed", F.col("seg") == last).withColumn("bin", F.explode(F.sequence(low, high)))
    p = points.withColumn("bin", F.floor(F.col(at) / bin_m))
    j = p.join(s, [key, "bin"]).where((F.col(at) >= F.col("s0")) & ((F.col(at) < F.col("s1")) | (F.col("closed") & (F.col(at) <= F.col("s1")))))
    t = (F.col(at) - F.col("s0")) / (F.col("s1") - F.col("s0"))
    dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    normal = [(-dy / F.hypot(dx, dy)).alias("nx"), (dx / F.hypot(dx, dy)).alias("ny")] if direction else []
    return j.select(*points.columns, *((F.col(f"{a}0") + t * (F.col(f"{a}1") - F.col(f"{a}0"))).alias(a) for a in ("x", "y", "z", "w")), *normal)


def every(df: DataFrame, step: float, key: str = "road_id", length: str = "length") -> DataFrame:
    """Stations 0, step, ... below the length; the end is added if it is more than 0.25 m on, else the last snaps to it."""
    n = F.floor(F.col(length) / step)
    regular = df.select(key, length, F.explode(F.sequence(F.lit(0).cast("long"), n)).alias("i")).withColumn("at", F.col("i") * F.lit(step))
    rest = F.col(length) - n * step
    snapped = regular.withColumn("at", F.when((F.col("i") == n) & (n > 0) & (rest <= 0.25), F.col(length)).otherwise(F.col("at")))
    ends = df.where(rest > 0.25).select(key, length, (n + 1).alias("i"), F.col(length).alias("at"))
    return snapped.unionByName(ends).select(key, "i", "at")


def crossings(segs: DataFrame, cell: float, key: str = "road_id", least_t: float = 0.02) -> DataFrame:
    """Pairs of segments of different roads that cross inside both: (key, other, s, dz), dz = own height minus the other's.

    Segments meet in cells of their boxes; a pair that shares several cells counts once, in the first cell of the boxes' overlap.
    """
    box = segs.select(
        F.col(key).alias("k"), "seg", "x0", "y0", "z0", "x1", "y1", "z1", "s0", "s1",
        *(F.floor(f(a, b) / cell).alias(n) for n, f, a, b in (("cx0", F.least, "x0", "x1"), ("cx1", F.greatest, "x0", "x1"), ("cy0", F.least, "y0", "y1"), ("cy1", F.greatest, "y0", "y1"))),
    )
    grid = box.withColumn("cx", F.explode(F.sequence("cx0", "cx1"))).withColumn("cy", F.explode(F.sequence("cy0", "cy1")))
    other = grid.select(*(F.col(n).alias(f"o_{n}") if n not in ("cx", "cy") else F.col(n) for n in grid.columns))
    j = grid.join(other, ["cx", "cy"]).where("k <> o_k").where((F.col("cx") == F.greatest("cx0", "o_cx0")) & (F.col("cy") == F.greatest("cy0", "o_cy0")))
    ax, ay, bx, by = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"), F.col("o_x1") - F.col("o_x0"), F.col("o_y1") - F.col("o_y0")
    den, px, py = ax * by - ay * bx, F.col("o_x0") - F.col("x0"), F.col("o_y0") - F.col("y0")
    den = F.when(F.abs(den) > 1e-9, den)  # parallel segments don't cross
    j = j.withColumns({"t": (px * by - py * bx) / den, "u": (px * ay - py * ax) / den})
    j = j.where((F.col("t") > least_t) & (F.col("t") < 1 - least_t) & (F.col("u") > least_t) & (F.col("u") < 1 - least_t))
    z = lambda p, t: F.col(f"{p}z0") + F.col(t) * (F.col(f"{p}z1") - F.col(f"{p}z0"))
    return j.select(F.col("k").alias(key), F.col("o_k").alias("other"), (F.col("s0") + F.col("t") * (F.col("s1") - F.col("s0"))).alias("s"), (z("", "t") - z("o_", "u")).alias("dz"))


def nearest_on_line(points: DataFrame, segs: DataFrame, point_key: str, reach: float, key: str = "road_id") -> DataFrame:
    """Per point the nearest foot on any segment within reach: (point_key, key, s, d); ties to the smaller road, then segment."""
    lo, hi = (lambda a: F.floor((F.least(f"{a}0", f"{a}1") - reach) / reach)), (lambda a: F.floor((F.greatest(f"{a}0", f"{a}1") + reach) / reach))
    grid = segs.withColumn("cx", F.explode(F.sequence(lo("x"), hi("x")))).withColumn("cy", F.explode(F.sequence(lo("y"), hi("y"))))
    p = points.withColumns({"cx": F.floor(F.col("px") / reach), "cy": F.floor(F.col("py") / reach)})
    dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((F.col("px") - F.col("x0")) * dx + (F.col("py") - F.col("y0")) * dy) / (dx * dx + dy * dy)))
    j = p.join(grid, ["cx", "cy"]).withColumn("t", t)
    d2 = F.pow(F.col("x0") + F.col("t") * dx - F.col("px"), F.lit(2)) + F.pow(F.col("y0") + F.col("t") * dy - F.col("py"), F.lit(2))
    j = j.withColumn("d2", d2).where(F.col("d2") <= reach * reach)
    best = j.groupBy(point_key).agg(F.min(F.struct(F.round("d2", 9).alias("d2"), F.col(key).alias("k"), "seg", (F.col("s0") + F.col("t") * (F.col("s1") - F.col("s0"))).alias("s"))).alias("b"))
    return best.select(point_key, F.col("b.k").alias(key), F.col("b.seg").alias("seg"), F.col("b.s").alias("s"), F.sqrt("b.d2").alias("d"))


def slew_limit(df: DataFrame, key: str, measure: str, value: str, rate: float) -> DataFrame:
    """Forward, then backward clamp of a value to +-rate per unit of the measure; a null starts anew. Folds a sorted array per key."""
    rows = df.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(measure).alias("s"), F.col(value).alias("v")))).alias("a"))

    def fold(a):
        start = F.array().cast("array<struct<s:double,v:double>>")

        def step(acc, x):
            last = F.try_element_at(acc, F.lit(-1))
            room = rate * F.abs(x["s"] - last["s"])
            v = F.when(x["v"].isNull() | last["v"].isNull(), x["v"]).otherwise(F.greatest(last["v"] - room, F.least(last["v"] + room, x["v"])))
            return F.concat(acc, F.array(F.struct(x["s"].alias("s"), v.alias("v"))))

        return F.aggregate(a, start, step)

    back = F.reverse(fold(F.reverse(fold(F.col("a")))))
    return rows.select(key, F.explode(back).alias("x")).select(key, F.col("x.s").alias(measure), F.col("x.v").alias(value))
