"""Points and cells that choose among near ones: greedy dedupe, exact nearest cells, rims of masks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .iterate import components, cut
from .networks import ranked_to_end

c = F.col


def kept_apart(points: DataFrame, reach: float, kind: str = "kind", order: str = "id", most_rounds: int = 100) -> DataFrame:
    """The points that no earlier kept point of their kind stands within reach of, as a scan in the order would keep them.

    Pairs within reach are found once, by grid cells. A point without an earlier undecided neighbour is kept, its later neighbours go, and so on on what is
    left: a round decides every local minimum at once. Ends when no pair is left; more than most_rounds rounds are an error.
    """
    own = points.select(order, kind, "x", "y", F.floor(c("x") / reach).alias("cx"), F.floor(c("y") / reach).alias("cy"))
    step = F.array(*(F.lit(i) for i in (-1, 0, 1)))
    around = own.withColumn("cx", F.explode(F.transform(step, lambda i: c("cx") + i))).withColumn("cy", F.explode(F.transform(step, lambda i: c("cy") + i)))
    other = own.select(c(order).alias("later"), kind, "cx", "cy", c("x").alias("x2"), c("y").alias("y2"))
    near = F.pow(c("x") - c("x2"), F.lit(2)) + F.pow(c("y") - c("y2"), F.lit(2)) <= reach * reach
    pairs = cut(around.join(other, [kind, "cx", "cy"]).where((c(order) < c("later")) & near).select(c(order).alias("first"), "later"), "near-pairs")
    gone = None
    for _ in range(most_rounds):
        if not pairs.limit(1).count():
            break
        waiting = pairs.select("later").distinct()
        free = pairs.select("first").distinct().join(waiting, c("first") == c("later"), "left_anti")
        out = cut(pairs.join(free, "first", "left_semi").select("later").distinct(), "dropped")
        gone = out if gone is None else gone.unionByName(out)
        dead = out.select(c("later").alias("dead"))
        pairs = pairs.join(free, "first", "left_anti").join(dead, c("later") == c("dead"), "left_anti").join(dead, c("first") == c("dead"), "left_anti")
        pairs = cut(pairs, "near-pairs")
    else:
        raise RuntimeError(f"dedupe after {most_rounds} rounds isn't complete")
    return points if gone is None else points.join(gone.select(c("later").alias(order)), order, "left_anti")


def nearest_cells(holes: DataFrame, cells: DataFrame, k: int, block: int = 4, most_levels: int = 16) -> DataFrame:
    """(r, c, nr, nc, d2): the k nearest of cells for every hole (ties: smaller row, then column); all of them, if there are fewer.

    Cells stand in square blocks that are counted first. A hole looks at its own block and the eight around it: their counts bound how far the
    k-th cell can be, and only blocks that reach nearer are searched. It is done if k cells are nearer than anything outside the nine blocks can be; other holes go on
    with blocks four times as large, until the nine hold everything. There is no fixed reach.
    """
    left = cut(holes.select("r", "c").distinct(), "holes")
    stock = cut(cells.select(c("r").alias("nr"), c("c").alias("nc")), "stock")
    span = stock.agg(*(f(x).alias(f"{x}_{n}") for x in ("nr", "nc") for n, f in (("low", F.min), ("high", F.max))))
    square = lambda x: x * x
    found = left.select("r", "c", c("r").alias("nr"), c("c").alias("nc"), F.lit(0).cast("long").alias("d2")).where("false")
    if not stock.limit(1).count():
        return found
    near = F.array(*(F.lit(i) for i in (-1, 0, 1)))
    for _ in range(most_levels):
        if not left.limit(1).count():
            return found
        dealt = stock.withColumns({"br": F.floor(c("nr") / block), "bc": F.floor(c("nc") / block)})
        counts = dealt.groupBy("br", "bc").agg(F.count(F.lit(1)).alias("n"))
        asked = left.withColumns({"hr": F.floor(c("r") / block), "hc": F.floor(c("c") / block)})
        blocks = asked.withColumn("br", F.explode(F.transform(near, lambda i: c("hr") + i))).withColumn("bc", F.explode(F.transform(near, lambda i: c("hc") + i))).join(counts, ["br", "bc"])
        low, high = (lambda x, b: F.greatest(c(b) * block - c(x), c(x) - ((c(b) + 1) * block - 1), F.lit(0))), (lambda x, b: F.greatest(c(x) - c(b) * block, (c(b) + 1) * block - 1 - c(x)))
        blocks = blocks.withColumns({"low": square(low("r", "br")) + square(low("c", "bc")), "high": square(high("r", "br")) + square(high("c", "bc"))})
        w = Window.partitionBy("r", "c")
        upto = F.sum("n").over(w.orderBy("high", "br", "bc").rowsBetween(Window.unboundedPreceding, 0))
        bound = F.min(F.when(c("upto") >= k, c("high"))).over(w)
        blocks = blocks.withColumn("upto", upto).withColumn("bound", bound).where("bound is null or low <= bound").select("r", "c", "hr", "hc", "br", "bc")
        met = blocks.join(dealt, ["br", "bc"]).withColumn("d2", (square(c("nr") - c("r")) + square(c("nc") - c("c"))).cast("long"))
        ranked = met.withColumn("rank", F.row_number().over(w.orderBy("d2", "nr", "nc"))).where(c("rank") <= k)
        ranked = cut(ranked.select("r", "c", "nr", "nc", "d2"), "nearest")
        tally = asked.join(ranked.groupBy("r", "c").agg(F.count(F.lit(1)).alias("n"), F.max("d2").alias("far")), ["r", "c"], "left").crossJoin(F.broadcast(span))  # one row
        edges = [(c("hr") - 1) * block, (c("hr") + 2) * block - 1, (c("hc") - 1) * block, (c("hc") + 2) * block - 1]
        clear = F.least(c("r") - edges[0], edges[1] - c("r"), c("c") - edges[2], edges[3] - c("c")) + 1
        everything = (edges[0] <= c("nr_low")) & (edges[1] >= c("nr_high")) & (edges[2] <= c("nc_low")) & (edges[3] >= c("nc_high"))
        sure = cut(tally.where(((c("n") == k) & (c("far") < square(clear))) | everything).select("r", "c"), "sure")
        found = found.unionByName(ranked.join(sure, ["r", "c"], "left_semi"))
        left = cut(left.join(sure, ["r", "c"], "left_anti"), "holes")
        block *= 4
    raise RuntimeError(f"the nearest cells aren't all found after {most_levels} levels")


def filled_from_nearest(holes: DataFrame, clean: DataFrame, edges: DataFrame, size: float, k: int = 8, least: float = 0.05) -> DataFrame:
    """Holes (r, c) with z: the k nearest clean cells by inverse squared distance, mixed with the nearest edge sample by inverse distance.

    clean, edges: r, c, z. Distances are in metres and at least `least`. Where one of both is missing the other stands alone; where both are, z is null.
    """
    d = F.greatest(F.sqrt("d2") * size, F.lit(least))
    value = lambda t: t.select(c("r").alias("nr"), c("c").alias("nc"), "z")
    road = nearest_cells(holes, clean, k).join(value(clean), ["nr", "nc"]).withColumn("w", 1 / (d * d))
    road = road.groupBy("r", "c").agg((F.sum(c("w") * c("z")) / F.sum("w")).alias("road"), (1 / F.min(d)).alias("wr"))
    edge = nearest_cells(holes, edges, 1).join(value(edges), ["nr", "nc"]).select("r", "c", c("z").alias("edge"), (1 / d).alias("we"))
    both = (c("wr") * c("road") + c("we") * c("edge")) / (c("wr") + c("we"))
    return holes.join(road, ["r", "c"], "left").join(edge, ["r", "c"], "left").select("r", "c", F.coalesce(both, "road", "edge").alias("z"))


def rim_rings(mask: DataFrame) -> DataFrame:
    """(ring, pos, x, y, area) of the corners of a mask's rims; mask: its cells (r, c). Row 0 is north: x = column, y = -row.

    Every side of a cell without a neighbour in the mask is an edge that has the cell on its right. An edge's successor begins where it ends;
    where two begin there, cells touch at a corner, and the one that turns right keeps to its cell. Rings are numbered by their smallest
    edge and run from there; area is positive for outer rims and negative for holes.
    """
    width = mask.agg((F.max("c") + 1).alias("width"))
    own = mask.select("r", "c").distinct()
    sides = F.array(*(F.struct(F.lit(k).alias("side"), F.lit(i).alias("dr"), F.lit(j).alias("dc")) for k, (i, j) in enumerate(((-1, 0), (0, 1), (1, 0), (0, -1)))))
    around = own.withColumn("s", F.explode(sides)).select("r", "c", "s.side", (c("r") + c("s.dr")).alias("nr"), (c("c") + c("s.dc")).alias("nc"))
    open_ = around.join(own.select(c("r").alias("nr"), c("c").alias("nc")), ["nr", "nc"], "left_anti").crossJoin(F.broadcast(width))  # one row
    step = lambda *v: F.element_at(F.array(*(F.lit(x) for x in v)), c("side") + 1)
    edge = open_.select(
        ((c("r") * c("width") + c("c")) * 4 + c("side")).alias("edge"), "side", (c("r") + step(0, 0, 1, 1)).alias("r0"), (c("c") + step(0, 1, 1, 0)).alias("c0"), (c("r") + step(0, 1, 1, 0)).alias("r1"), (c("c") + step(1, 1, 0, 0)).alias("c1")
    )
    edge = cut(edge, "rim-edges")
    after = edge.select(c("edge").alias("next"), c("side").alias("side2"), c("r0").alias("r1"), c("c0").alias("c1"))
    turn = F.pmod(c("side2") - c("side"), F.lit(4))  # 1: right, 0: on, 3: left
    follow = edge.join(after, ["r1", "c1"]).groupBy("edge").agg(F.min_by("next", F.when(turn == 1, 0).otherwise(turn + 1)).alias("next"))
    follow = cut(follow, "rim-successors")
    ring = cut(components(follow.select(c("edge").alias("u"), c("next").alias("v"))), "rims")
    lists = follow.join(ring, c("edge") == c("node")).select(c("edge").alias("state"), F.when(c("next") != c("component"), c("next")).alias("to"))
    hops = ranked_to_end(lists).join(ring, c("state") == c("node")).select(c("state").alias("edge"), c("component").alias("ring"), "hops")
    w = Window.partitionBy("ring").orderBy(F.desc("hops"))
    t = edge.join(hops, "edge").withColumn("pos", F.max("hops").over(Window.partitionBy("ring")) - c("hops"))
    area = t.groupBy("ring").agg((F.sum(c("c0") * -c("r1") - c("c1") * -c("r0")) / -2.0).alias("area"))
    last = F.last("side").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    corners = t.withColumn("before", F.coalesce(F.lag("side").over(w), last)).where("before <> side")
    return corners.join(area, "ring").select("ring", "pos", c("c0").cast("double").alias("x"), (-c("r0")).cast("double").alias("y"), "area")
