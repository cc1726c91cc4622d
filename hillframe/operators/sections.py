"""Cross-section repair: straight profiles fitted inwards from an edge, borrowed along it, and carried over gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .iterate import cut

c = F.col
# fixed values of the repair
SPANS, LOCAL = (1.5, 2.5, 4.0, 6.0), 1.5
SMOOTH, RMSE_MAX, SLOPE_MAX, SPAN_MIN, CHORD, ROUGH = 0.02, 0.04, 0.25, 0.5, 0.25, 0.015
HALVES = (1, 2, 4, 8, 12, 16, 24, 32, 48)
SHORT_GAP, PARABOLA = 20.0, 40.0


def fitted_spans(samples: DataFrame) -> DataFrame:
    """line, i, xa, za, fits: per station the first clean sample and, for every span from there, slope and rmse of the line through it, where valid.

    samples: line, i (station), off, z, rough, inside. Clean: inside, with a height, rough under 1.5 cm. Valid: three samples and more, at least
    half a metre apart in all, slope within 0.25, rmse within 4 cm. Sums of products do it all; a station is at most one ray of samples.
    """
    clean = samples.where("inside and z is not null and rough is not null").where(c("rough") < ROUGH)
    first = clean.groupBy("line", "i").agg(F.min(F.struct("off", "z")).alias("p")).select("line", "i", c("p.off").alias("xa"), c("p.z").alias("za"))
    t = clean.join(first, ["line", "i"]).withColumns({"dx": c("off") - c("xa"), "dz": c("z") - c("za")})
    sums = []
    for k, span in enumerate(SPANS):
        within = c("dx") <= span + 1e-9
        for name, v in (("n", F.lit(1.0)), ("xx", c("dx") * c("dx")), ("xz", c("dx") * c("dz")), ("zz", c("dz") * c("dz"))):
            sums.append(F.sum(F.when(within, v).otherwise(0.0)).alias(f"{name}{k}"))
        sums.append(F.max(F.when(within, c("dx"))).alias(f"reach{k}"))
    t = t.groupBy("line", "i").agg(F.first("xa").alias("xa"), F.first("za").alias("za"), *sums)
    fits = []
    for k, _ in enumerate(SPANS):
        slope = F.when(c(f"xx{k}") > 1e-4, c(f"xz{k}") / c(f"xx{k}"))
        rmse = F.sqrt(F.greatest(F.lit(0.0), c(f"zz{k}") - slope * c(f"xz{k}")) / c(f"n{k}"))
        valid = (c(f"n{k}") >= 3) & (c(f"reach{k}") >= SPAN_MIN) & (F.abs(slope) <= SLOPE_MAX) & (rmse <= RMSE_MAX)
        fits.append(F.when(valid, F.struct(rmse.alias("rmse"), F.lit(k).alias("k"), slope.alias("slope"))))
    return t.select("line", "i", "xa", "za", F.array(*fits).alias("fits"))


def bent(points: DataFrame) -> DataFrame:
    """Adds half: the largest half window at whose middle the station lies at most 0.25 m off the chord of its ends, or 0."""
    w, out = Window.partitionBy("line").orderBy("i"), F.lit(0)
    for k in HALVES:
        ax, ay, bx, by = (f(v, k).over(w) for f in (F.lag, F.lead) for v in ("x", "y"))
        off = F.abs((c("x") - ax) * (by - ay) - (c("y") - ay) * (bx - ax)) / F.greatest(F.sqrt((bx - ax) * (bx - ax) + (by - ay) * (by - ay)), F.lit(1e-6))
        out = F.when(off <= CHORD, k).otherwise(out)
    return points.withColumn("half", out)


def chosen_profiles(fits: DataFrame, points: DataFrame) -> DataFrame:
    """line, i, s, x, y, xa, za, slope, source of every station: 1 for the shortest span, 2 for a longer, borrowed or rougher one, 0 for none.

    The first span with an rmse of at most 2 cm is taken. Else the best valid one is held: the smoothest station within the straight stretch around
    lends its slope, if it is smoother, or the held slope stands. points: line, i (0, 1, ...), s, x, y.
    """
    smooth = F.filter("fits", lambda f: f["rmse"] <= SMOOTH)
    held = F.array_min(F.filter("fits", lambda f: f.isNotNull()))
    one = F.when(F.size(smooth) > 0, F.element_at(smooth, 1)).otherwise(held)
    t = bent(points).join(fits.select("line", "i", "xa", "za", one.alias("f"), (F.size(smooth) > 0).alias("good")), ["line", "i"], "left")
    w = Window.partitionBy("line").orderBy("i").rangeBetween(-max(HALVES), max(HALVES))
    donors = F.collect_list(F.when(c("good"), F.struct(c("f.rmse").alias("rmse"), c("i").alias("i"), c("f.slope").alias("slope")))).over(w)
    best = F.array_min(F.filter("donors", lambda d: F.abs(d["i"] - c("i")) <= c("half")))
    t = t.withColumn("donors", donors).withColumn("donor", F.when((c("half") > 0) & ~c("good") & c("f").isNotNull(), best))
    borrowed = c("donor").isNotNull() & (c("donor.rmse") < c("f.rmse"))
    source = F.when(c("f").isNull(), 0).when(c("good") & (c("f.k") == SPANS.index(LOCAL)), 1).otherwise(2)
    return t.select("line", "i", "s", "x", "y", "xa", "za", F.when(borrowed, c("donor.slope")).otherwise(c("f.slope")).alias("slope"), source.alias("source"))


def over_gaps(profiles: DataFrame) -> DataFrame:
    """Profiles with the stations between valid ones filled where the axis is straight there: source 3 linear, 4 on a parabola.

    A gap's ends lend slope and first clean offset by station. The height of the edge is linear in gaps of 20 m at most; in longer ones it lies on the
    least-squares parabola of the edge heights of at least four valid stations within 40 m of the gap, else it is linear as well.
    """
    w = Window.partitionBy("line").orderBy("i")
    known = profiles.where("source > 0").withColumn("edge", c("za") - c("slope") * c("xa"))
    keep = ("i", "s", "x", "y", "xa", "slope", "edge")
    gaps = known.select("line", *(c(v).alias(f"{v}0") for v in keep), *(F.lead(v).over(w).alias(f"{v}1") for v in keep)).where((c("i1") > c("i0") + 1) & (c("s1") - c("s0") >= 1e-6))
    middle = profiles.select("line", c("i").alias("mid"), c("x").alias("mx"), c("y").alias("my"))
    gaps = gaps.withColumn("mid", F.floor((c("i0") + c("i1")) / 2)).join(middle, ["line", "mid"])
    ax, ay = c("x1") - c("x0"), c("y1") - c("y0")
    gaps = gaps.where(F.abs((c("mx") - c("x0")) * ay - (c("my") - c("y0")) * ax) / F.greatest(F.sqrt(ax * ax + ay * ay), F.lit(1e-6)) <= CHORD)
    gaps = cut(gaps.select("line", *(f"{v}{k}" for k in "01" for v in ("i", "s", "xa", "slope", "edge"))), "gaps")
    # parabolas: sums over the valid stations around each long gap, which meet it in bins of stations
    bin_ = lambda v: F.floor(v / PARABOLA)
    long_ = gaps.where(c("s1") - c("s0") > SHORT_GAP).select("line", "i0", "s0", "s1", F.explode(F.sequence(bin_(c("s0") - PARABOLA), bin_(c("s1") + PARABOLA))).alias("bin"))
    near = long_.join(known.select("line", "s", "edge", bin_(c("s")).alias("bin")), ["line", "bin"]).where((c("s") >= c("s0") - PARABOLA) & (c("s") <= c("s1") + PARABOLA))
    u = (c("s") - c("s0")) / (c("s1") - c("s0"))
    powers = [F.sum(F.pow(u, F.lit(k))).alias(f"p{k}") for k in range(5)] + [F.sum(F.pow(u, F.lit(k)) * (c("edge"))).alias(f"q{k}") for k in range(3)]
    fit = near.groupBy("line", "i0").agg(*powers).where("p0 >= 4")
    m = [[c(f"p{i + j}") for j in range(3)] for i in range(3)]
    q = [c(f"q{i}") for i in range(3)]
    det = lambda a: a[0][0] * (a[1][1] * a[2][2] - a[1][2] * a[2][1]) - a[0][1] * (a[1][0] * a[2][2] - a[1][2] * a[2][0]) + a[0][2] * (a[1][0] * a[2][1] - a[1][1] * a[2][0])
    whole = det(m)
    coefficient = [F.when(F.abs(whole) > 1e-12, det([[q[i] if j == k else m[i][j] for j in range(3)] for i in range(3)]) / whole).alias(f"c{k}") for k in range(3)]
    fit = fit.select("line", "i0", *coefficient)
    inner = gaps.join(fit, ["line", "i0"], "left").withColumn("i", F.explode(F.sequence(c("i0") + 1, c("i1") - 1))).join(profiles.select("line", "i", "s"), ["line", "i"])
    share = (c("s") - c("s0")) / (c("s1") - c("s0"))
    between = lambda v: c(f"{v}0") * (1 - share) + c(f"{v}1") * share
    curve = c("c0") + c("c1") * share + c("c2") * share * share
    height = F.coalesce(curve, between("edge"))
    filled = inner.select("line", "i", between("xa").alias("fxa"), (height + between("slope") * between("xa")).alias("fza"), between("slope").alias("fslope"), F.when(curve.isNotNull(), 4).otherwise(3).alias("fsource"))
    t = profiles.join(filled, ["line", "i"], "left")
    new = c("fsource").isNotNull()
    return t.select("line", "i", "s", *(F.when(new, c(f"f{v}")).otherwise(c(v)).alias(v) for v in ("xa", "za", "slope", "source")))


def repaired_cells(samples: DataFrame, profiles: DataFrame) -> DataFrame:
    """r, c, z, source of rough cells outside a profile's first clean sample: the height of the profile that reaches the cell by the shortest way.

    Ties go to the smaller line, then station. samples also carry r, c.
    """
    t = samples.where("inside and rough is not null").where(c("rough") >= ROUGH).join(profiles.where("source > 0 and slope is not null and za is not null"), ["line", "i"])
    t = t.where(c("off") + 1e-6 < c("xa")).withColumn("height", c("za") + c("slope") * (c("off") - c("xa")))
    best = F.min_by(F.struct("height", "source"), F.struct("off", "line", "i")).alias("b")
    return t.groupBy("r", "c").agg(best).select("r", "c", c("b.height").alias("z"), "b.source")


def repair(samples: DataFrame, points: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The profiles of all stations, and the cells that they replace."""
    profiles = cut(over_gaps(cut(chosen_profiles(fitted_spans(samples), points), "profiles")), "filled-profiles")
    return profiles, repaired_cells(samples, profiles)
