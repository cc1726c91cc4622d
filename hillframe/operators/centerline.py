"""Moving a road's axis to calmer ground: pieces, lateral search, links of pieces, locked offsets, the shifted axis, tapered widths.

Offsets are whole tenths of a metre, positive to the left of a piece's chord; roughness is counted in whole micrometres, so that sums
don't depend on their order. A piece is (road_id, i); nodes: road_id, seq, x, y, z, w (one width a road).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hillframe.operators import lines as L
from hillframe.operators.focal import roughness
from hillframe.operators.iterate import cut

c = F.col
PIECE = ["road_id", "i"]
MITRE = 1.5  # a bend's outer corner reaches this many half widths from its vertex


def piece_segments(nodes: DataFrame, most: float = 20.0, rest: float = 2.0) -> DataFrame:
    """Segments cut where pieces of `most` metres end: road_id, i, n (pieces of the road), a, b (stations), xa, ya, xb, yb, w.

    A rest shorter than `rest` stays with the piece before it. Repeated nodes give no segment; a road without length has no piece.
    """
    segs = L.segments(nodes).where("s1 > s0").withColumn("len", F.max("s1").over(Window.partitionBy("road_id")))
    whole = F.floor(c("len") / most)
    segs = segs.withColumn("n", F.greatest(F.lit(1), whole + (c("len") - whole * most >= rest).cast("long")).cast("long"))
    first, last = F.floor(c("s0") / most), F.greatest(F.ceil(c("s1") / most) - 1, F.floor(c("s0") / most))
    t = segs.withColumn("i", F.explode(F.sequence(F.least(first, c("n") - 1), F.least(last, c("n") - 1))))
    t = t.withColumns({"a": F.greatest(c("s0"), c("i") * most), "b": F.least(c("s1"), F.when(c("i") == c("n") - 1, c("len")).otherwise((c("i") + 1) * most))}).where("b > a + 1e-9")
    at = lambda p, s: c(f"{p}0") + (c(s) - c("s0")) / (c("s1") - c("s0")) * (c(f"{p}1") - c(f"{p}0"))
    return t.select("road_id", "i", "n", "a", "b", *(at(p, s).alias(p + s) for s in ("a", "b") for p in ("x", "y")), c("w0").alias("w"))


def pieces(segs: DataFrame) -> DataFrame:
    """Per piece: n, s0, s1, w, its ends (x0, y0, x1, y1) and the unit direction of its chord (ux, uy; null where the ends meet)."""
    t = segs.groupBy(*PIECE).agg(
        F.first("n").alias("n"), F.min("a").alias("s0"), F.max("b").alias("s1"), F.first("w").alias("w"),
        F.min_by("xa", "a").alias("x0"), F.min_by("ya", "a").alias("y0"), F.max_by("xb", "b").alias("x1"), F.max_by("yb", "b").alias("y1"),
    )
    dx, dy = c("x1") - c("x0"), c("y1") - c("y0")
    span = F.sqrt(dx * dx + dy * dy)
    return t.withColumns({"ux": F.when(span >= 1e-6, dx / span), "uy": F.when(span >= 1e-6, dy / span)})


def micro_roughness(cells: DataFrame, cap: float = 0.019, size: float = 1.0) -> DataFrame:
    """r, c, um: distance from the 3x3 mean in whole micrometres, capped; cells without six valid ones about them are left out."""
    t = roughness(cells.select("r", "c", "z"), "z", cap=cap).where("rough is not null")
    return t.select("r", "c", F.floor(c("rough") * 1e6 + 0.5001).alias("um"))


def lateral_scores(segs: DataFrame, rough: DataFrame, size: float = 1.0, reach: int = 10, narrow: int = 20, hot_um: int = 18990) -> DataFrame:
    """Band statistics per piece, offset (tenths) and level (tenths by which the band is narrower): n, um (sum) and hot (cells at the cap).

    A band is the piece moved along its chord's normal and widened by half its width to both sides, flat at the ends, mitred at bends.
    Each cell goes to a piece once, by rows of the piece's box, and all else happens where the piece is, so that offsets and segments never multiply what is dealt; per offset
    the least half width that covers a cell tells all levels it counts for.
    Bands under a metre wide aren't tried; a band without a valid cell has no row.
    """
    w = Window.partitionBy(*PIECE).orderBy("a")
    length = F.sqrt((c("xb") - c("xa")) * (c("xb") - c("xa")) + (c("yb") - c("ya")) * (c("yb") - c("ya")))
    t = segs.withColumn("len", length).withColumns({"tx": (c("xb") - c("xa")) / c("len"), "ty": (c("yb") - c("ya")) / c("len")})
    t = t.withColumns({"vx": F.lead("tx").over(w), "vy": F.lead("ty").over(w)})
    t = t.join(pieces(segs).where("ux is not null").select(*PIECE, "ux", "uy"), PIECE)
    pad = c("w") / 2 * MITRE + reach / 10
    low, high = (lambda p: F.least(f"{p}a", f"{p}b") - pad), (lambda p: F.greatest(f"{p}a", f"{p}b") + pad)
    t = t.withColumns({"c0": F.floor(low("x") / size), "c1": F.floor(high("x") / size), "r0": F.floor(-high("y") / size), "r1": F.floor(-low("y") / size)})
    rows = t.select(*PIECE, "c0", "c1", F.explode(F.sequence("r0", "r1")).alias("r")).groupBy(*PIECE, "r").agg(F.min("c0").alias("c0"), F.max("c1").alias("c1"))
    met = rows.select(*PIECE, "r", F.explode(F.sequence("c0", "c1")).alias("c")).join(rough.hint("merge"), ["r", "c"])
    t = met.join(t.hint("merge"), PIECE).where(c("r").between(c("r0"), c("r1")) & c("c").between(c("c0"), c("c1")))
    t = t.withColumn("off", F.explode(F.sequence(F.lit(-reach), F.lit(reach))))
    t = t.withColumns({"px": (c("c") + 0.5) * size + c("off") / 10 * c("uy") - c("xa"), "py": -(c("r") + 0.5) * size - c("off") / 10 * c("ux") - c("ya")})
    t = t.withColumns({"along": c("px") * c("tx") + c("py") * c("ty"), "lat": F.abs(c("px") * c("ty") - c("py") * c("tx")), "qx": c("px") - (c("xb") - c("xa")), "qy": c("py") - (c("yb") - c("ya"))})
    beside = F.when((c("along") >= 0) & (c("along") <= c("len")), c("lat"))
    corner = F.greatest(c("lat"), F.abs(c("qx") * c("vy") - c("qy") * c("vx")), F.sqrt(c("qx") * c("qx") + c("qy") * c("qy")) / MITRE)
    corner = F.when((c("along") > c("len")) & (c("qx") * c("vx") + c("qy") * c("vy") < 0), corner)
    t = t.withColumn("half", F.least(beside, corner)).where("2 * half <= w + 1e-10")
    t = t.groupBy(*PIECE, "off", "r", "c").agg(F.min("half").alias("half"), F.first("w").alias("w"), F.first("um").alias("um"))
    least = F.least(F.lit(narrow), F.floor((c("w") - 1.0) * 10 + 1e-9))
    t = t.withColumn("k", F.least(F.floor((c("w") - 2 * c("half")) * 10 + 1e-9), least)).where("k >= 0")
    t = t.groupBy(*PIECE, "off", "k").agg(F.count(F.lit(1)).alias("n"), F.sum("um").alias("um"), F.sum((c("um") >= hot_um).cast("long")).alias("hot"))
    t = t.withColumn("level", F.explode(F.sequence(F.lit(0).cast("long"), c("k"))))
    return t.groupBy(*PIECE, "level", "off").agg(*(F.sum(x).alias(x) for x in ("n", "um", "hot")))


def searched(axis: DataFrame, scores: DataFrame, good_um: float = 8000.0, gap_um: float = 2000.0, most_hot: float = 1.0, narrow: int = 20) -> DataFrame:
    """Per piece of axis (pieces with a boolean column structure): kind, chosen, best (tenths), level, width_used, span_um, good (acceptable offsets).

    A band is acceptable if its mean roughness is at most good_um and its share of cells at the cap at most most_hot. Kinds: flat (all offsets alike, none
    or the axis itself acceptable), unique, several, none, no_sample, structure, degenerate. The band narrows by a tenth while no offset is acceptable.
    """
    t = scores.withColumns({"mean": c("um") / c("n"), "share": c("hot") / c("n")})
    fine = (c("mean") <= good_um) & (c("share") <= most_hot)
    t = t.groupBy(*PIECE, "level").agg(
        (F.max("mean") - F.min("mean")).alias("span_um"), F.min_by("off", F.struct("mean", F.abs("off"), -c("off"))).alias("best"),
        F.sort_array(F.collect_list(F.when(fine, F.struct("off", "mean")))).alias("fine"),  # at most one entry an offset
    )
    first = lambda key: F.array_min(F.transform("fine", key))["off"]
    nearest = first(lambda x: F.struct(F.abs(x["off"]).alias("d"), x["off"].alias("off")))
    calmest = first(lambda x: F.struct(x["mean"].alias("m"), F.abs(x["off"]).alias("d"), (-x["off"]).alias("neg"), x["off"].alias("off")))
    low = F.array_min(F.transform("fine", lambda x: x["mean"]))
    t = t.withColumns({"some": F.size("fine") > 0, "alike": c("span_um") < gap_um, "nearest": nearest, "calmest": calmest, "low": low})
    t = t.withColumn("close", F.size(F.filter("fine", lambda x: x["mean"] <= c("low") + gap_um)))
    count = F.when(c("alike"), F.size("fine")).otherwise(c("close"))
    kind = F.when(~c("some"), F.when(c("alike"), "flat").otherwise("none")).when(c("alike") & (c("nearest") == 0), "flat").when(count == 1, "unique").otherwise("several")
    t = t.withColumns({"kind": kind, "chosen": F.when(~c("some"), 0).when(c("alike"), c("nearest")).otherwise(c("calmest")), "good": F.transform("fine", lambda x: x["off"])})
    row = F.struct("level", "kind", "chosen", "best", "span_um", "good")
    found = t.groupBy(*PIECE).agg(F.min(F.when(c("some"), c("level"))).alias("pass"), F.min_by(row, F.when(c("some"), c("level"))).alias("hit"), F.max_by(row, "level").alias("end"))
    j = axis.join(found, PIECE, "left")
    tried = F.least(F.lit(narrow).cast("long"), F.floor((c("w") - 1.0) * 10 + 1e-9))
    own = ~c("structure") & c("ux").isNotNull()
    # without an acceptable band the search ends at the last width tried, or at the first one without a valid cell
    ran_out = own & c("pass").isNull() & (F.coalesce(c("end.level"), F.lit(-1)) < tried)
    pick = F.when(own & ~ran_out, F.coalesce(c("hit"), c("end")))
    level = F.when(~own, 0).when(ran_out, F.coalesce(c("end.level") + 1, F.lit(0))).when(c("pass").isNull(), F.least(F.lit(narrow).cast("long"), tried + 1)).otherwise(c("pass"))
    j = j.withColumns({"pick": pick, "level": level.cast("long"), "kind": F.when(c("structure"), "structure").when(c("ux").isNull(), "degenerate").when(ran_out, "no_sample").otherwise(pick["kind"])})
    out = j.select(*axis.columns, "kind", F.coalesce(c("pick.chosen"), F.lit(0)).alias("chosen"), c("pick.best").alias("best"), "level", (c("w") - c("level") / 10).alias("width_used"), c("pick.span_um").alias("span_um"), F.coalesce(c("pick.good"), F.array().cast("array<int>")).alias("good"))
    return cut(out, "lateral-search")  # links, locks and widths read it again


def road_links(axis: DataFrame, reach: float = 3.0, align: float = 0.85, most_rounds: int = 200) -> DataFrame:
    """road_id, i, road_id2, i2: the end of the first piece goes on at the start of the second, a piece of another road.

    An end and a start meet in the box of +-reach, nearer than reach + 1, if their directions agree. Pairs are taken from the nearest on (ties: earlier
    roads first), each end and start once: a round takes every pair that is the first of both its members, which gives that same result. Structures
    and pieces without direction take no part. Choosing in the order of distance, not of roads, lets far parts of a network decide at once.
    """
    own = axis.where("not structure and ux is not null")
    outs = own.where("i = n - 1").select(*PIECE, c("x1").alias("x"), c("y1").alias("y"), "ux", "uy")
    ins = own.where("i = 0").select(c("road_id").alias("road_id2"), c("i").alias("i2"), c("x0").alias("x2"), c("y0").alias("y2"), c("ux").alias("ux2"), c("uy").alias("uy2"))
    step = F.array(*(F.lit(k) for k in (-1, 0, 1)))
    around = outs.withColumn("gx", F.explode(F.transform(step, lambda k: F.floor(c("x") / reach) + k))).withColumn("gy", F.explode(F.transform(step, lambda k: F.floor(c("y") / reach) + k)))
    dx, dy = c("x2") - c("x"), c("y2") - c("y")
    met = around.join(ins.withColumns({"gx": F.floor(c("x2") / reach), "gy": F.floor(c("y2") / reach)}), ["gx", "gy"]).withColumn("d", F.sqrt(dx * dx + dy * dy))
    met = met.where((c("road_id") != c("road_id2")) & (F.abs(dx) <= reach) & (F.abs(dy) <= reach) & (c("d") < reach + 1) & (c("ux") * c("ux2") + c("uy") * c("uy2") >= align))
    left = met.select(*PIECE, "road_id2", "i2", "d")
    rank = F.struct("d", "road_id", "road_id2")
    done = []
    for _ in range(most_rounds):
        firsts = [F.min(rank).over(Window.partitionBy(k)) == rank for k in ("road_id", "road_id2")]  # a road has one end and one start
        marked = cut(left.withColumn("best", firsts[0] & firsts[1]), "link-pairs")
        best = marked.where("best")
        done.append(best.select(*PIECE, "road_id2", "i2"))
        if not best.limit(1).count():
            return reduce(DataFrame.unionByName, done)
        rest = marked.where("not best").drop("best")
        left = rest.join(best.select("road_id"), "road_id", "left_anti").join(best.select("road_id2"), "road_id2", "left_anti").select(*left.columns)
    raise RuntimeError(f"ends after {most_rounds} rounds still contest each other")


def locked(found: DataFrame, links: DataFrame, most_rounds: int = 12) -> DataFrame:
    """found with kind and chosen decided: a piece with several good offsets takes the one nearest the mean of its fixed neighbours' offsets.

    Unique pieces are fixed from the start; neighbours are the pieces before and after on the road, and those linked to. An offset is turned
    about where directions oppose. All pieces of a round look at the round before. After most_rounds rounds pieces without a fixed neighbour
    are several_unanchored and keep 0.
    """
    inner = found.where("not structure and i < n - 1").select(*PIECE, c("road_id").alias("road_id2"), (c("i") + 1).alias("i2"))
    one = inner.unionByName(links)
    pairs = one.unionByName(one.select(c("road_id2").alias("road_id"), c("i2").alias("i"), c("road_id").alias("road_id2"), c("i").alias("i2")))
    own = found.where("kind in ('unique', 'several')").select(*PIECE, "kind", "chosen", "ux", "uy", "good")
    other = own.select(c("road_id").alias("road_id2"), c("i").alias("i2"), c("ux").alias("ux2"), c("uy").alias("uy2"))
    sign = F.when(c("ux") * c("ux2") + c("uy") * c("uy2") >= 0, 1).otherwise(-1)
    pairs = cut(pairs.join(own.where("kind = 'several'").select(*PIECE, "ux", "uy", "good"), PIECE).join(other, ["road_id2", "i2"]).select(*PIECE, "road_id2", "i2", "good", sign.alias("sign")), "lock-pairs")
    fixed = cut(own.where("kind = 'unique'").select(*PIECE, "chosen"), "lock-fixed")
    news = fixed
    for _ in range(most_rounds):
        last = news.select(c("road_id").alias("road_id2"), c("i").alias("i2"))
        open_ = pairs.join(fixed.select(*PIECE), PIECE, "left_anti")
        # only neighbours of pieces fixed in the last round can be decided now
        near = open_.join(last, ["road_id2", "i2"], "left_semi").select(*PIECE).distinct()
        known = open_.join(near, PIECE, "left_semi").join(fixed.select(c("road_id").alias("road_id2"), c("i").alias("i2"), "chosen"), ["road_id2", "i2"])
        t = known.groupBy(*PIECE).agg(F.avg(c("sign") * c("chosen")).alias("target"), F.first("good").alias("good"))
        pick = F.array_min(F.transform("good", lambda g: F.struct(F.abs(g - c("target")).alias("d"), F.abs(g).alias("a"), g.alias("g"))))["g"]
        news = cut(t.select(*PIECE, pick.alias("chosen")), "lock-new")
        if not news.limit(1).count():
            break
        fixed = cut(fixed.unionByName(news), "lock-fixed")
    several = c("kind") == "several"
    j = found.join(fixed.withColumnRenamed("chosen", "lock"), PIECE, "left")
    return j.withColumns({"chosen": F.when(several, F.coalesce("lock", F.lit(0))).otherwise(c("chosen")), "kind": F.when(several & c("lock").isNull(), "several_unanchored").otherwise(c("kind"))}).drop("lock")


def _neighbours(placed: DataFrame, *values: Column) -> DataFrame:
    """Adds before and after: the named values of the road's pieces on either side."""
    w = Window.partitionBy("road_id").orderBy("i")
    here = F.struct(*values)
    return placed.withColumns({"before": F.lag(here).over(w), "after": F.lead(here).over(w)})


def shifted_axis(segs: DataFrame, placed: DataFrame) -> DataFrame:
    """road_id, s, x, y, off (metres): nodes and cuts, moved along their normals by the offset interpolated between the middles of pieces."""
    starts = segs.select(*PIECE, c("a").alias("s"), c("xa").alias("x"), c("ya").alias("y"))
    ends = segs.where("i = n - 1").groupBy(*PIECE).agg(F.max("b").alias("s"), F.max_by("xb", "b").alias("x"), F.max_by("yb", "b").alias("y"))
    points = L.tangents(starts.unionByName(ends), order="s")
    mid = (c("s0") + c("s1")) / 2
    near = _neighbours(placed.select(*PIECE, mid.alias("mid"), "chosen"), "mid", "chosen").select(*PIECE, "mid", "chosen", "before", "after")
    t = points.join(near, PIECE)
    between = lambda a, b: a["chosen"] * (1 - (c("s") - a["mid"]) / (b["mid"] - a["mid"])) + b["chosen"] * ((c("s") - a["mid"]) / (b["mid"] - a["mid"]))
    here = F.struct("mid", "chosen")
    off = F.when((c("s") < c("mid")) & c("before").isNotNull(), between(c("before"), here)).when((c("s") > c("mid")) & c("after").isNotNull(), between(here, c("after"))).otherwise(c("chosen")) / 10
    return t.withColumn("off", off).select("road_id", "s", (c("x") + c("off") * F.coalesce("nx", F.lit(0.0))).alias("x"), (c("y") + c("off") * F.coalesce("ny", F.lit(0.0))).alias("y"), "off")


def tapered_widths(points: DataFrame, placed: DataFrame, over: float = 20.0) -> DataFrame:
    """points (road_id, i, s) with width: a piece's own, ramped down over at most `over` metres to a neighbour narrower by 0.05 m or more.

    Ramps lie on the wider piece; where both of its ramps meet, the narrower counts. Pieces under half a metre have no ramp.
    """
    t = _neighbours(placed.select(*PIECE, "s0", "s1", "width_used"), "width_used")
    t = t.select(*PIECE, "s0", "s1", "width_used", c("before.width_used").alias("wb"), c("after.width_used").alias("wa"))
    span = F.least(F.lit(over), c("s1") - c("s0"))
    ramp = lambda w, away: F.when((c("width_used") - c(w) >= 0.05) & (span >= 0.5) & (away <= span), c(w) + (c("width_used") - c(w)) * (away / span))
    return points.join(t, PIECE).select(*points.columns, F.least("width_used", ramp("wb", c("s") - c("s0")), ramp("wa", c("s1") - c("s"))).alias("width"))
