"""Water surfaces as boxes: exact overlap of polygons with tiles, fit to the terrain, adaptive subdivision.

Boxes meet the terrain once, in blocks of cells that come with the cells around them as one array; samples, shrunk boxes and quarters are tried on
the box's own row. Boxes that reach beyond such an array have their samples joined with the cells instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .iterate import cut

c = F.col
BLOCK, AROUND = 8, 8  # cells of a block, and those after it, along either axis
BOXES = 50_000  # of a task


def _clamped(y: Column, low: Column, high: Column) -> Column:
    """A function of y whose derivative is y, held within low and high."""
    return F.when(y < low, low * y).when(y > high, (high * high + low * low) / 2 + high * (y - high)).otherwise((y * y + low * low) / 2)


def overlap_areas(rings: DataFrame, boxes: DataFrame, key: str = "poly_id") -> DataFrame:
    """boxes (key, box, x0, y0, x1, y1) with area, that of the polygon's part within the box: exact for simple rings, convex or not.

    At every x the polygon's length within [y0, y1] is the signed sum of its edges' heights held within y0 and y1, so each edge adds a closed integral over the
    columns that it spans. Edges meet the boxes of their polygon only.
    """
    w = Window.partitionBy(key).orderBy("seq")
    nxt = lambda a: F.coalesce(F.lead(a).over(w), F.first(a).over(w))
    edges = rings.select(key, c("x").alias("ax"), c("y").alias("ay"), nxt("x").alias("bx"), nxt("y").alias("by")).where("ax <> bx")
    edges = edges.withColumnRenamed(key, "edge_key")
    met = boxes.join(edges, (c(key) == c("edge_key")) & (F.least("ax", "bx") < c("x1")) & (F.greatest("ax", "bx") > c("x0")), "left")
    u, v = F.greatest(c("x0"), F.least("ax", "bx")), F.least(c("x1"), F.greatest("ax", "bx"))
    at = lambda x: c("ay") + (x - c("ax")) / (c("bx") - c("ax")) * (c("by") - c("ay"))
    yu, yv = at(u), at(v)
    flat = F.greatest(c("y0"), F.least(c("y1"), (yu + yv) / 2))
    mean = F.when(F.abs(yv - yu) < 1e-9, flat).otherwise((_clamped(yv, c("y0"), c("y1")) - _clamped(yu, c("y0"), c("y1"))) / (yv - yu))
    # by the box's own columns: rows that are dealt by key already aren't dealt again
    area = F.abs(F.sum(F.when(c("bx") > c("ax"), 1.0).otherwise(-1.0) * (v - u) * mean))
    return met.groupBy(*boxes.columns).agg(F.coalesce(area, F.lit(0.0)).alias("area"))


def water_tiles(rings: DataFrame, surface: DataFrame, max_side: float, tile: float, least: float = 0.25, key: str = "poly_id") -> DataFrame:
    """(key, box, x0, y0, x1, y1, level): one box around each polygon, or equal tiles of about `tile` where a side exceeds max_side.

    Tiles of which the polygon covers less than `least` are dropped. surface: key, level. Boxes are named t<column>_<row>, whole ones whole.
    """
    around = rings.groupBy(key).agg(F.min("x").alias("ax"), F.max("x").alias("bx"), F.min("y").alias("ay"), F.max("y").alias("by")).join(surface, key)
    sx, sy = c("bx") - c("ax"), c("by") - c("ay")
    large = F.greatest(sx, sy) > max_side
    whole = around.where(~large).select(key, F.lit("whole").alias("box"), c("ax").alias("x0"), c("ay").alias("y0"), c("bx").alias("x1"), c("by").alias("y1"), "level")
    cut_ = around.where(large).withColumns({"nx": F.greatest(F.lit(1), F.ceil(sx / tile)), "ny": F.greatest(F.lit(1), F.ceil(sy / tile))})
    cut_ = cut_.withColumn("ix", F.explode(F.sequence(F.lit(0).cast("long"), c("nx") - 1))).withColumn("iy", F.explode(F.sequence(F.lit(0).cast("long"), c("ny") - 1)))
    corner = lambda a, b, i, n: c(a) + (c(b) - c(a)) * i / c(n)
    tiles = cut_.select(
        key, F.concat(F.lit("t"), c("ix").cast("string"), F.lit("_"), c("iy").cast("string")).alias("box"), corner("ax", "bx", c("ix"), "nx").alias("x0"), corner("ay", "by", c("iy"), "ny").alias("y0"),
        corner("ax", "bx", c("ix") + 1, "nx").alias("x1"), corner("ay", "by", c("iy") + 1, "ny").alias("y1"), "level",
    )
    kept = overlap_areas(rings, tiles, key).where(c("area") >= least * (c("x1") - c("x0")) * (c("y1") - c("y0"))).drop("area")
    return whole.unionByName(kept)


def _counts(t: DataFrame, spacing: float, most: int) -> DataFrame:
    count = lambda size: F.least(F.lit(most), F.greatest(F.lit(2), F.ceil(size / max(2.0, spacing)) + 1)).cast("long")
    return t.withColumns({"nx": count(c("x1") - c("x0")), "ny": count(c("y1") - c("y0"))})


def _good(z: Column, hang: float, bank: float) -> Column:
    return ~F.coalesce((c("level") - z > hang) | (z - c("level") > bank), F.lit(False))


def _inner() -> list[Column]:
    """gx0, gy0, gx1, gy1 of the good samples' cells i0 to i1 and j0 to j1."""
    side = lambda a, b, i, n: c(a) + (c(b) - c(a)) * c(i) / c(n)
    return [side("x0", "x1", "i0", "nx").alias("gx0"), side("y0", "y1", "j0", "ny").alias("gy0"), side("x0", "x1", "i1", "nx").alias("gx1"), side("y0", "y1", "j1", "ny").alias("gy1")]


def _joined_shares(boxes: DataFrame, cells: DataFrame, hang: float, bank: float, spacing: float, most: int, key: str) -> DataFrame:
    """fit_shares of boxes of any size: every sample is a row that is joined with its cell."""
    t = _counts(boxes, spacing, most)
    t = t.withColumn("ix", F.explode(F.sequence(F.lit(0).cast("long"), c("nx") - 1))).withColumn("iy", F.explode(F.sequence(F.lit(0).cast("long"), c("ny") - 1)))
    x, y = c("x0") + (c("x1") - c("x0")) * (c("ix") + 0.5) / c("nx"), c("y0") + (c("y1") - c("y0")) * (c("iy") + 0.5) / c("ny")
    t = t.withColumns({"c": F.floor(x), "r": F.floor(-y)}).join(cells.groupBy("r", "c").agg(F.min("z").alias("z")), ["r", "c"], "left")
    good = _good(c("z"), hang, bank)
    edge = lambda f, i, step: f(F.when(good, c(i) + step))
    m = t.groupBy(key, "box").agg(F.avg((~good).cast("double")).alias("bad"), edge(F.min, "ix", 0).alias("i0"), edge(F.max, "ix", 1).alias("i1"), edge(F.min, "iy", 0).alias("j0"), edge(F.max, "iy", 1).alias("j1"), F.first("nx").alias("nx"), F.first("ny").alias("ny"))
    return boxes.join(m, [key, "box"]).select(*boxes.columns, "bad", *_inner())


def _blocks(cells: DataFrame, parts: int) -> DataFrame:
    """(br, bc, patch): the heights of every block and the cells after it, row by row; null where there is no cell."""
    side, step = BLOCK + AROUND, F.array(F.lit(0), F.lit(1))
    reach = lambda a: F.explode(F.transform(step, lambda k: F.floor(c(a) / BLOCK) - k))
    t = cells.select("r", "c", "z").withColumn("br", reach("r")).withColumn("bc", reach("c")).select("br", "bc", ((c("r") - c("br") * BLOCK) * side + c("c") - c("bc") * BLOCK).cast("int").alias("at"), "z")
    t = t.repartition(parts, "br", "bc").groupBy("br", "bc", "at").agg(F.min("z").alias("z")).groupBy("br", "bc").agg(F.map_from_entries(F.collect_list(F.struct("at", "z"))).alias("held"))
    return t.select("br", "bc", F.transform(F.sequence(F.lit(0), F.lit(side * side - 1)), lambda i: c("held")[i]).alias("patch"))


def _is_small() -> Column:
    """Whether a box lies within the block of its north-western cell and the cells after it."""
    return (F.floor("x1") - F.floor("x0") <= AROUND) & (F.floor(-c("y0")) - F.floor(-c("y1")) <= AROUND)


def _patched(boxes: DataFrame, cells: DataFrame) -> DataFrame:
    """Small boxes with br, bc and the patch of their block. Their rows are small and their work isn't, so the number of tasks goes by the count of boxes."""
    parts = max(boxes.sparkSession.sparkContext.defaultParallelism, boxes.count() // BOXES + 1)
    t = boxes.withColumns({"br": F.floor(F.floor(-c("y1")) / BLOCK), "bc": F.floor(F.floor("x0") / BLOCK)})
    return t.repartition(parts, "br", "bc").join(_blocks(cells, parts), ["br", "bc"], "left").select(*boxes.columns, "br", "bc", "patch")


def _measured(t: DataFrame, hang: float, bank: float, spacing: float, most: int = 24, only: Column | None = None) -> DataFrame:
    """Adds bad, gx0, gy0, gx1 and gy1 to patched boxes, each from its own row; `only` says for which ones they are asked."""
    names, side = t.columns, BLOCK + AROUND
    t = _counts(t, spacing, most)
    ix, iy = lambda i: F.pmod(i, c("nx")), lambda i: F.floor(i / c("nx"))
    x, y = lambda i: c("x0") + (c("x1") - c("x0")) * (ix(i) + 0.5) / c("nx"), lambda i: c("y0") + (c("y1") - c("y0")) * (iy(i) + 0.5) / c("ny")
    z = lambda i: F.get(c("patch"), ((F.floor(-y(i)) - c("br") * BLOCK) * side + F.floor(x(i)) - c("bc") * BLOCK).cast("int"))
    good = F.filter(F.sequence(F.lit(0).cast("long"), c("nx") * c("ny") - 1), lambda i: _good(z(i), hang, bank))
    t = t.withColumn("good", good if only is None else F.when(only, good))
    t = t.withColumns({"px": F.transform("good", ix), "py": F.transform("good", iy)})
    t = t.withColumns({"i0": F.array_min("px"), "i1": F.array_max("px") + 1, "j0": F.array_min("py"), "j1": F.array_max("py") + 1})
    return t.select(*names, ((c("nx") * c("ny") - F.size("good")) / (c("nx") * c("ny"))).alias("bad"), *_inner())


def fit_shares(boxes: DataFrame, cells: DataFrame, hang: float, bank: float, spacing: float, most: int = 24, key: str = "poly_id") -> DataFrame:
    """Boxes with bad, the share of samples where the level hangs more than `hang` above the terrain or the terrain stands more than `bank` above it,
    and the box of the good samples' cells (gx0, gy0, gx1, gy1; null without any).

    Samples are the centres of at least two and at most `most` cells a side of about `spacing`; a sample takes the terrain cell it lies in (row 0 is
    north: x = column, y = -row), and is good where there is none. Of rows of one cell the lowest counts.
    """
    boxes = cut(boxes, "boxes")
    found = _measured(_patched(boxes.where(_is_small()), cells), hang, bank, spacing, most).drop("br", "bc", "patch")
    large = boxes.where(~_is_small())
    return found.unionByName(_joined_shares(large, cells, hang, bank, spacing, most, key)) if large.limit(1).count() else found


def fitted_tiles(
    boxes: DataFrame, cells: DataFrame, hang: float, bank: float, spacing: float, bad_most: float, side_least: float, area_least: float, depth: int = 3, key: str = "poly_id"
) -> DataFrame:
    """Boxes (key, box, x0, y0, x1, y1, level, depth) that fit the terrain: kept, shrunk to their good samples, quartered, or dropped.

    A box with at most bad_most bad samples stays, shrunk if it has any and the shrunk one fits as well. Another one whose shorter side is twice side_least
    is cut into quarters (q0 to q3: south-west, south-east, north-west, north-east), up to `depth` times; what can't be cut is shrunk, if that fits, or dropped. A shrunk box
    of less than a quarter of area_least, or with a side under side_least, doesn't count. A box that lies within a block's array goes down all levels where
    it is; the others are measured a level at once.
    """
    names = [key, "box", "x0", "y0", "x1", "y1", "level"]
    boxes = cut(boxes.select(*names), "boxes")
    found = _fitted_in_place(boxes.where(_is_small()), cells, hang, bank, spacing, bad_most, side_least, area_least, depth).select(*names, "depth")
    large = boxes.where(~_is_small())
    return found.unionByName(_fitted_by_levels(large, cells, hang, bank, spacing, bad_most, side_least, area_least, depth, key)) if large.limit(1).count() else found


def _quarters() -> Column:
    mx, my = (c("x0") + c("x1")) / 2, (c("y0") + c("y1")) / 2
    return F.array(*(F.struct(F.concat("box", F.lit(f"_q{q}")).alias("box"), (mx if q % 2 else c("x0")).alias("x0"), (my if q > 1 else c("y0")).alias("y0"), (c("x1") if q % 2 else mx).alias("x1"), (c("y1") if q > 1 else my).alias("y1")) for q in range(4)))


def _fitted_in_place(boxes: DataFrame, cells: DataFrame, hang: float, bank: float, spacing: float, bad_most: float, side_least: float, area_least: float, depth: int) -> DataFrame:
    """fitted_tiles of small boxes: after the one join every level is a step from rows to rows, in which a box becomes its result, its quarters or nothing."""
    corners = ["x0", "y0", "x1", "y1"]
    rest = [x for x in boxes.columns if x not in ("box", *corners)] + ["br", "bc", "patch"]
    t = _patched(boxes, cells).withColumn("depth", F.lit(None).cast("int"))  # null: not settled
    fits = lambda bad: c(bad) <= bad_most
    for level in range(depth + 1):
        m = _measured(t, hang, bank, spacing, only=c("depth").isNull())
        able = (F.least(c("x1") - c("x0"), c("y1") - c("y0")) >= 2 * side_least) if level < depth else F.lit(False)
        wide, high = c("gx1") - c("gx0"), c("gy1") - c("gy0")
        tried = ((fits("bad") & (c("bad") > 0)) | (~fits("bad") & ~able)) & (wide * high >= area_least * 0.25) & (wide >= side_least) & (high >= side_least)
        # the shrunk box where it may count, else the box again
        m = m.select(*rest, "box", *(c(x).alias(f"own_{x}") for x in corners), "depth", c("bad").alias("own_bad"), able.alias("able"), F.coalesce(tried, F.lit(False)).alias("tried"), *(F.when(tried, c(f"g{x}")).otherwise(c(x)).alias(x) for x in corners))
        m = _measured(m, hang, bank, spacing, only=c("tried"))
        shrunk = c("tried") & fits("bad")
        one = F.array(F.struct("box", *corners))
        m = m.select(*rest, "box", "depth", "own_bad", "able", shrunk.alias("shrunk"), *((F.when(shrunk, c(x)).otherwise(c(f"own_{x}"))).alias(x) for x in corners))
        settled = c("depth").isNotNull()
        done = settled | c("shrunk") | fits("own_bad")
        out = F.when(settled, F.array(F.struct("box", *corners))).when(done, one).when(c("able"), _quarters())
        # the outer form: a filter on the array's size would be pushed down, and measure every box again
        m = m.select(*rest, F.when(settled, c("depth")).when(done, F.lit(level)).alias("depth"), F.explode_outer(out).alias("k")).where("k is not null")
        t = m.select(*rest, "depth", "k.*")
    return t


def _fitted_by_levels(boxes: DataFrame, cells: DataFrame, hang: float, bank: float, spacing: float, bad_most: float, side_least: float, area_least: float, depth: int, key: str) -> DataFrame:
    """fitted_tiles of boxes of any size."""
    names = boxes.columns
    share = lambda t: cut(fit_shares(t, cells, hang, bank, spacing, key=key), "fit")
    active, kept = boxes, None
    for level in range(depth + 1):
        m = share(active)
        fits = c("bad") <= bad_most
        able = (F.least(c("x1") - c("x0"), c("y1") - c("y0")) >= 2 * side_least) if level < depth else F.lit(False)
        smaller = m.where((fits & (c("bad") > 0)) | (~fits & ~able)).where("gx0 is not null")
        smaller = smaller.select(key, "box", c("gx0").alias("x0"), c("gy0").alias("y0"), c("gx1").alias("x1"), c("gy1").alias("y1"), "level")
        wide, high = c("x1") - c("x0"), c("y1") - c("y0")
        smaller = smaller.where((wide * high >= area_least * 0.25) & (wide >= side_least) & (high >= side_least))
        shrunk = share(smaller).where(fits).select(*names)
        plain = m.where(fits).join(shrunk.select(key, "box"), [key, "box"], "left_anti").select(*names)
        out = shrunk.unionByName(plain).withColumn("depth", F.lit(level))
        kept = out if kept is None else kept.unionByName(out)
        if level == depth:
            break
        active = m.where(~fits & able).select(key, "level", F.explode(_quarters()).alias("k"))
        active = cut(active.select(key, "k.box", "k.x0", "k.y0", "k.x1", "k.y1", "level"), "quarters")
    return kept
