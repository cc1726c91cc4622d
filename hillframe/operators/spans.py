"""Spans over gaps: abutments from five terrain lines, cross profiles, heights by monotone cubic or linear interpolation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lines import baseline

c = F.col
# fixed values of spans
FRACTIONS = (0.0, 0.1, 0.3, 0.5, 0.7, 0.9, 1.0)  # across the carriageway, left to right
CROSSFALL, CORNER_UP, CORNER_DOWN, CORNER_BAND = 0.12, 0.25, 0.06, 0.2
DIP, SOLID = 0.45, 3.0


def abutments(terrain: DataFrame, spans: DataFrame, step: float = 1.0, dip: float = DIP, solid: float = SOLID) -> DataFrame:
    """span, a0, a1, method: where solid ground begins and ends around a gap.

    terrain: span, line, j (0, 1, ...), s, z of five lines across the width; spans: span, g0, g1 (the mapped ends), o0, o1 (given ends or null). A sample is
    unstable if the highest one within `solid` before or behind it on its line is at least dip above it. The first and the last unstable station of any
    line, `solid` further out, are the abutments (lateral); given ends win (override); without five stations or a dip the mapped ends stand (fallback).
    """
    rows = max(1, round(solid / step))
    back, ahead = baseline(c("z"), rows, Window.partitionBy("span", "line").orderBy("j"))
    u = terrain.withColumn("unstable", F.greatest(back, ahead) - c("z") >= dip)
    found = u.groupBy("span").agg(F.min(F.when(c("unstable"), c("j"))).alias("j0"), F.max(F.when(c("unstable"), c("j"))).alias("j1"), F.max("j").alias("top"))
    found = found.where("top >= 4 and j0 is not null").select("span", F.greatest(F.lit(0), c("j0") - rows).alias("j0"), F.least(c("top"), c("j1") + rows).alias("j1"))
    station = terrain.groupBy("span", "j").agg(F.min("s").alias("s"))
    ends = found.join(station.select("span", c("j").alias("j0"), c("s").alias("l0")), ["span", "j0"]).join(station.select("span", c("j").alias("j1"), c("s").alias("l1")), ["span", "j1"])
    t = spans.join(ends.select("span", "l0", "l1"), "span", "left")
    given, low, high = c("o0").isNotNull() & c("o1").isNotNull(), F.least("g0", "g1"), F.greatest("g0", "g1")
    return t.select(
        "span", F.when(given, F.least("o0", "o1")).otherwise(F.coalesce("l0", low)).alias("a0"), F.when(given, F.greatest("o0", "o1")).otherwise(F.coalesce("l1", high)).alias("a1"), F.when(given, "override").when(c("l0").isNotNull(), "lateral").otherwise("fallback").alias("method")
    )


def cross_profile(z: list[Column], width: Column) -> tuple[list[Column], Column]:
    """Heights at FRACTIONS of a carriageway of the width, and its crossfall, from raw samples there.

    A plane through the centre with the crossfall of the 0.3 and 0.7 samples, at most 12 %; towards the edges it is pulled to the raw sample, by at most 25 cm up
    and 6 cm down, in full at the edge itself.
    """
    at = dict(zip(FRACTIONS, z, strict=True))
    fall = F.greatest(F.lit(-CROSSFALL), F.least(F.lit(CROSSFALL), (at[0.7] - at[0.3]) / F.greatest(width * (0.7 - 0.3), F.lit(1e-6))))
    out = []
    for f, raw in at.items():
        plane = at[0.5] + fall * (f - 0.5) * width
        pull = max(0.0, min(1.0, (CORNER_BAND - min(f, 1.0 - f)) / CORNER_BAND))
        out.append(plane + pull * F.greatest(F.lit(-CORNER_DOWN), F.least(F.lit(CORNER_UP), raw - plane)) if pull else plane)
    return out, fall


def monotone_slopes(knots: DataFrame, key: str = "span") -> DataFrame:
    """Knots (key, s, z) with next ones (s1, z1) and slopes m, m1 of the monotone cubic: harmonic means of neighbouring chords, 0 at their extremes.

    An end takes the three-point slope, or 0 where it turns against its chord, or three times the chord where it would overshoot. Two knots are a line;
    equal stations count once (the smaller height).
    """
    w = Window.partitionBy(key).orderBy("s")
    t = knots.groupBy(key, "s").agg(F.min("z").alias("z"))
    t = t.withColumns({"s1": F.lead("s").over(w), "z1": F.lead("z").over(w)}).withColumn("h", c("s1") - c("s")).withColumn("d", (c("z1") - c("z")) / c("h"))
    t = t.withColumns({"h0": F.lag("h").over(w), "d0": F.lag("d").over(w), "h2": F.lead("h").over(w), "d2": F.lead("d").over(w), "hb": F.lag("h", 2).over(w), "db": F.lag("d", 2).over(w)})

    def end(h, d, h_next, d_next):
        """The slope at an end from its chord and the next one inwards."""
        m = ((2 * h + h_next) * d - h * d_next) / (h + h_next)
        return F.when(h_next.isNull(), d).when(F.signum(m) != F.signum(d), 0.0).when((F.signum(d) != F.signum(d_next)) & (F.abs(m) > 3 * F.abs(d)), 3 * d).otherwise(m)

    w1, w2 = 2 * c("h") + c("h0"), c("h") + 2 * c("h0")
    inner = F.when(c("d0") * c("d") <= 0, 0.0).otherwise((w1 + w2) / (w1 / c("d0") + w2 / c("d")))
    m = F.when(c("h0").isNull(), end(c("h"), c("d"), c("h2"), c("d2"))).when(c("h").isNull(), end(c("h0"), c("d0"), c("hb"), c("db"))).otherwise(inner)
    t = t.withColumn("m", m).withColumn("m1", F.lead("m").over(w))
    return t.where("s1 is not null").select(key, "s", "z", "s1", "z1", "m", "m1")


def on_curve(pieces: DataFrame, points: DataFrame, key: str = "span", bin_m: float = 25.0) -> DataFrame:
    """Points (key, at) with z on the cubic pieces of monotone_slopes; outside the knots there is none. They meet in bins of stations."""
    last = F.max("s1").over(Window.partitionBy(key))
    p = pieces.withColumn("closed", c("s1") == last).withColumn("bin", F.explode(F.sequence(F.floor(c("s") / bin_m), F.floor(c("s1") / bin_m))))
    j = points.withColumn("bin", F.floor(c("at") / bin_m)).join(p, [key, "bin"]).where((c("at") >= c("s")) & ((c("at") < c("s1")) | (c("closed") & (c("at") <= c("s1")))))
    h = c("s1") - c("s")
    t = (c("at") - c("s")) / h
    z = c("z") * (1 + 2 * t) * (1 - t) * (1 - t) + c("m") * h * t * (1 - t) * (1 - t) + c("z1") * t * t * (3 - 2 * t) + c("m1") * h * t * t * (t - 1)
    return j.select(*points.columns, z.alias("z"))


def span_profile(stations: DataFrame, ends: DataFrame, lift: float = 0.0) -> DataFrame:
    """Stations of spans with centre and the heights at FRACTIONS (p0 ... p6).

    stations: span, s, width and raw samples z0 ... z6; ends: span, a0, a1. On the ground, up to a0 and from a1 on, a station has its own cross profile. Over
    the gap the centre is linear between the profiles at a0 and a1 (the stations nearest to them), and the offsets from it go linearly from one to the other.
    """
    profile, _ = cross_profile([c(f"z{i}") for i in range(7)], c("width"))
    own = stations.select("span", "s", F.array(*profile).alias("p"))
    t = own.join(ends.select("span", "a0", "a1"), "span")
    near = lambda a: F.min_by("p", F.struct(F.abs(c("s") - c(a)), "s"))
    feet = t.groupBy("span").agg(near("a0").alias("q0"), near("a1").alias("q1"))
    t = t.join(feet, "span")
    over = (c("s") > c("a0") + 1e-9) & (c("s") < c("a1") - 1e-9)
    share = (c("s") - c("a0")) / F.greatest(c("a1") - c("a0"), F.lit(1e-6))
    heights = [F.when(over, c("q0")[i] + share * (c("q1")[i] - c("q0")[i])).otherwise(c("p")[i]) + lift for i in range(7)]
    return t.select("span", "s", over.alias("over"), heights[3].alias("centre"), *(x.alias(f"p{i}") for i, x in enumerate(heights)))
