"""Viewshed: a polar sweep of rays around each observer, the horizon as a running maximum, observers counted per cell."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

EARTH = 6371000.0
c = F.col


def observers(cells: DataFrame, grid: int = 5, margin: float = 0.1) -> DataFrame:
    """spot, row, col: a grid over the raster without its margins, and the highest cell of each quarter (ties: smaller row, then column)."""
    size = cells.agg(F.max("r").alias("mr"), F.max("c").alias("mc"))
    steps = F.array(*(F.lit(i) for i in range(grid)))
    place = lambda top, i: top * (margin + (1 - 2 * margin) * c(i) / (grid - 1))
    even = size.withColumn("i", F.explode(steps)).withColumn("j", F.explode(steps)).select((c("i") * grid + c("j")).cast("long").alias("spot"), place(c("mr"), "i").alias("row"), place(c("mc"), "j").alias("col"))
    quarter = ((2 * c("r") > c("mr")).cast("long") * 2 + (2 * c("c") > c("mc")).cast("long")).alias("quarter")
    known = cells.where("z is not null").crossJoin(F.broadcast(size)).select("r", "c", "z", quarter)
    peaks = known.groupBy("quarter").agg(F.max_by(F.struct("r", "c"), F.struct("z", -c("r"), -c("c"))).alias("p"))
    return even.unionByName(peaks.select((c("quarter") + grid * grid).alias("spot"), c("p.r").cast("double").alias("row"), c("p.c").cast("double").alias("col")))


def visible(cells: DataFrame, spots: DataFrame, size: float = 50.0, radius: float = 40_000.0, rays: int = 2048, above: float = 10.0, curvature: float = 0.85714) -> DataFrame:
    """(spot, r, c) of every cell that a spot sees, its own included; spots without a height see nothing.

    Along a ray a sample a cell's length apart is seen if its slope from the observer, less the drop of the earth's curve, is as high as any before it. Samples
    are made up to the raster's edge only, and none beyond the radius.
    """
    bounds = cells.agg(F.max("r").alias("mr"), F.max("c").alias("mc"))
    own = spots.crossJoin(F.broadcast(bounds)).withColumns({"r": F.greatest(F.lit(0), F.least(F.rint("row").cast("long"), c("mr"))), "c": F.greatest(F.lit(0), F.least(F.rint("col").cast("long"), c("mc")))})
    own = own.join(cells.where("z is not null").select("r", "c", (c("z") + above).alias("height")), ["r", "c"])
    angle = c("ray") * (2.0 * math.pi / rays)
    rayed = own.withColumn("ray", F.explode(F.sequence(F.lit(0), F.lit(rays - 1)))).withColumns({"dc": F.round(F.cos(angle), 12), "dr": -F.round(F.sin(angle), 12)})
    edge = lambda at, step, top: F.when(c(step) > 0, (c(top) + 0.5 - c(at)) / c(step)).when(c(step) < 0, (c(at) + 0.5) / -c(step)).otherwise(float("inf"))
    most = F.least(F.lit(float(max(2, math.ceil(radius / size)))), F.greatest(F.lit(1.0), F.ceil(F.least(edge("col", "dc", "mc"), edge("row", "dr", "mr")))))
    samples = rayed.withColumn("t", F.explode(F.sequence(F.lit(1), most.cast("int"))))
    samples = samples.select("spot", "ray", "t", "height", "mr", "mc", F.rint(c("row") + c("dr") * c("t")).cast("long").alias("r"), F.rint(c("col") + c("dc") * c("t")).cast("long").alias("c"))
    samples = samples.where("r between 0 and mr and c between 0 and mc")
    d = c("t") * size
    slope = F.coalesce((c("z") - curvature * (d * d) / (2.0 * EARTH) - c("height")) / d, F.lit(float("-inf")))
    met = samples.join(cells.select("r", "c", "z"), ["r", "c"]).withColumn("slope", slope)
    horizon = F.max("slope").over(Window.partitionBy("spot", "ray").orderBy("t").rowsBetween(Window.unboundedPreceding, 0))
    seen = met.withColumn("horizon", horizon).where(c("slope") >= c("horizon") - 1e-15).select("spot", "r", "c")
    return seen.unionByName(own.select("spot", "r", "c")).distinct()


def view_counts(seen: DataFrame, cap: int = 255) -> DataFrame:
    """r, c and how many spots see the cell, at most cap."""
    return seen.groupBy("r", "c").agg(F.least(F.count(F.lit(1)), F.lit(cap)).alias("views"))
