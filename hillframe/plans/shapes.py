"""Queries of shapes on grids and axes: tiles, exports, painting, strokes, stamps, coverage, spans, fills, ribbons, trims."""

from pyspark.sql import functions as F

from hillframe.functions import scalars as S
from hillframe.operators import focal as Fo
from hillframe.operators import lines as L

from .grids import _IN
from .lines import _LEN, _SEG, _ST, _TAN
from .registry import Registry

R = Registry()
QUERIES, ORACLES = R.queries, R.oracles
c = F.col
r6 = S.r6


def whole(lo, hi):
    """The whole numbers from lo to hi, one a row."""
    return F.explode(F.sequence(lo, hi))


@R.add("a15_corridor_tiles", "road_node", f"""
WITH {_LEN}, k AS (SELECT road_id, len, ls, unnest(generate_series(0, CAST(ceil(len / 10) AS BIGINT))) AS k FROM ln), p AS (SELECT *, least(k * 10.0::DOUBLE, len) AS pos FROM k),
q AS (SELECT x0 + (pos - s0) / (s1 - s0) * (x1 - x0) AS x, y0 + (pos - s0) / (s1 - s0) * (y1 - y0) AS y FROM p JOIN sg USING (road_id) WHERE pos >= s0 AND (pos < s1 OR (seg = ls AND pos <= s1)))
SELECT DISTINCT CAST(floor(round(x + dx, 6) / 64) AS BIGINT) AS tx, CAST(floor(round(y + dy, 6) / 64) AS BIGINT) AS ty FROM q, (VALUES (-15.0::DOUBLE), (15.0::DOUBLE)) a(dx), (VALUES (-15.0::DOUBLE), (15.0::DOUBLE)) b(dy)""")
def a15(n):
    segs = L.segments(n)
    at = segs.groupBy("road_id").agg(F.max("s1").alias("len")).select("road_id", "len", whole(F.lit(0).cast("long"), F.ceil(c("len") / 10)).alias("k"))
    p = L.sample_at(segs, at.select("road_id", "k", F.least(c("k") * 10.0, c("len")).alias("at")))
    sides = F.explode(F.array(F.lit(-15.0), F.lit(15.0)))
    tile = lambda a: F.floor(F.round(c(a) + c("d" + a), 6) / 64)
    return p.withColumn("dx", sides).withColumn("dy", sides).select(tile("x").alias("tx"), tile("y").alias("ty")).distinct()


@R.add("a19_ring_export", "ring", """
SELECT poly_id, any_value(objekt) AS objekt, '{"type":"Polygon","coordinates":[[' || string_agg(printf('[%.3f,%.3f]', x, y), ',' ORDER BY seq) || ',' || printf('[%.3f,%.3f]', arg_min(x, seq), arg_min(y, seq)) || ']]}' AS geometry FROM ring GROUP BY 1""")
def a19(ring):
    line = F.transform(F.array_sort(F.collect_list(F.struct("seq", "x", "y"))), lambda p: F.format_string("[%.3f,%.3f]", p["x"], p["y"]))
    rings = ring.groupBy("poly_id").agg(F.min("objekt").alias("objekt"), line.alias("line"))
    closed = F.concat("line", F.slice("line", 1, 1))
    return rings.select("poly_id", "objekt", F.concat(F.lit('{"type":"Polygon","coordinates":[['), F.array_join(closed, ","), F.lit("]]}")).alias("geometry"))


@R.add("a20_draft_layers", "road_node", f"""
WITH {_TAN}, o AS (SELECT * FROM (VALUES ('axis', 0, 0.0, 0.0), ('edge', 1, 0.5, 0.0), ('edge', -1, 0.5, 0.0), ('rail', 1, 0.5, 0.5), ('rail', -1, 0.5, 0.5)) v(layer, side, share, more))
SELECT layer, CAST(side AS BIGINT) AS side, road_id, seq, round(x - side * dy / sqrt(dx*dx + dy*dy) * (w * share + more), 6) + 0.0 AS x, round(y + side * dx / sqrt(dx*dx + dy*dy) * (w * share + more), 6) + 0.0 AS y FROM t, o""")
def a20(n):
    """Axis, both edges and both rails of every road; a write with mode "errorifexists" keeps drafts that are there."""
    kinds = F.array(*(F.struct(F.lit(k).alias("layer"), F.lit(s).cast("long").alias("side"), F.lit(a).alias("share"), F.lit(m).alias("more")) for k, s, a, m in (("axis", 0, 0.0, 0.0), ("edge", 1, 0.5, 0.0), ("edge", -1, 0.5, 0.0), ("rail", 1, 0.5, 0.5), ("rail", -1, 0.5, 0.5))))
    t = L.tangents(n).withColumn("o", F.explode(kinds))
    off = c("o.side") * (c("w") * c("o.share") + c("o.more"))
    return t.select("o.layer", "o.side", "road_id", "seq", r6(c("x") + c("nx") * off).alias("x"), r6(c("y") + c("ny") * off).alias("y"))


@R.add("c4_first_wins", "cells", """
WITH s AS (SELECT r, c, 0 AS o, z AS v FROM cells UNION ALL SELECT r, c, 1, dom FROM cells UNION ALL SELECT r, c, 2, twi FROM cells)
SELECT 2 * r + i AS r, 2 * c + j AS c, CAST(min(o) AS BIGINT) AS source, round(arg_min(v, o), 6) AS v FROM s, (VALUES (0), (1)) a(i), (VALUES (0), (1)) b(j) WHERE v IS NOT NULL GROUP BY 1, 2""")
def c4(cells):
    """A grid of half the cell size takes the first source, in order, with a value in the nearest cell."""
    sources = F.array(*(F.struct(F.lit(o).cast("long").alias("o"), c(v).alias("v")) for o, v in enumerate(("z", "dom", "twi"))))
    first = F.filter(sources, lambda s: s["v"].isNotNull())
    t = cells.select("r", "c", F.explode(first).alias("s")).groupBy("r", "c").agg(F.min("s").alias("s"))
    half = F.explode(F.array(F.lit(0), F.lit(1)))
    return t.withColumn("i", half).withColumn("j", half).select((2 * c("r") + c("i")).alias("r"), (2 * c("c") + c("j")).alias("c"), c("s.o").alias("source"), r6(c("s.v")).alias("v"))


#: Paint order of the classes; what isn't listed is not painted.
PAINT = {"LN-VFW": 1, "LN-VPR": 2, "LN-VSO": 3}


@R.add("c6_paint_polygons", "cells ring", f"""
WITH {_IN}, k AS (SELECT DISTINCT poly_id, objekt, CASE objekt WHEN 'LN-VFW' THEN 1 WHEN 'LN-VPR' THEN 2 WHEN 'LN-VSO' THEN 3 END AS o FROM ring)
SELECT r, c, objekt, poly_id FROM ins JOIN k USING (poly_id) WHERE o IS NOT NULL QUALIFY row_number() OVER (PARTITION BY r, c ORDER BY o DESC, poly_id DESC) = 1""")
def c6(cells, ring):
    order = F.create_map(*(F.lit(x) for kv in PAINT.items() for x in kv))
    kinds = ring.select("poly_id", "objekt", F.try_element_at(order, c("objekt")).alias("o")).where("o is not null").distinct()
    t = Fo.cells_in_rings(ring).join(cells.select("r", "c").hint("merge"), ["r", "c"], "left_semi").join(kinds, "poly_id")
    return t.groupBy("r", "c").agg(F.max(F.struct("o", "poly_id", "objekt")).alias("m")).select("r", "c", "m.objekt", "m.poly_id")


@R.add("c7_road_strokes", "road_node road", f"""
WITH {_SEG}, h AS (SELECT sg.*, w0 / 2 AS half, objekt IN ('S-F', 'S-G') AS loose FROM sg JOIN road USING (road_id)),
a AS (SELECT *, unnest(generate_series(CAST(floor((least(x0, x1) - half - 2) / 4) AS BIGINT), CAST(floor((greatest(x0, x1) + half + 2) / 4) AS BIGINT))) AS c FROM h),
b AS (SELECT *, unnest(generate_series(CAST(floor((least(y0, y1) - half - 2) / 4) AS BIGINT), CAST(floor((greatest(y0, y1) + half + 2) / 4) AS BIGINT))) AS r FROM a),
u AS (SELECT *, greatest(0, least(1, (((c + 0.5::DOUBLE) * 4 - x0) * (x1 - x0) + ((r + 0.5::DOUBLE) * 4 - y0) * (y1 - y0)) / (pow(x1 - x0, 2) + pow(y1 - y0, 2)))) AS t FROM b),
d AS (SELECT *, round(sqrt(pow(x0 + t * (x1 - x0) - (c + 0.5::DOUBLE) * 4, 2) + pow(y0 + t * (y1 - y0) - (r + 0.5::DOUBLE) * 4, 2)), 9) AS d FROM u),
g AS (SELECT r, c, bool_or(NOT loose AND d <= half) AS hard, bool_or(NOT loose) AS beside, bool_or(loose AND d <= half) AS gravel, bool_or(loose) AS by_gravel FROM d WHERE d <= half + 2 GROUP BY 1, 2)
SELECT r, c, hard AND NOT by_gravel AS asphalt, beside AND NOT hard AS shoulder, gravel FROM g WHERE (hard AND NOT by_gravel) OR (beside AND NOT hard) OR gravel""")
def c7(n, road):
    """Cells of 4 m under the roads: asphalt, a shoulder of 2 m beside it, gravel; asphalt within 2 m of gravel goes."""
    segs = L.segments(n).join(road.select("road_id", c("objekt").isin("S-F", "S-G").alias("loose")), "road_id").withColumn("half", c("w0") / 2)
    reach = c("half") + 2
    span = lambda a: whole(F.floor((F.least(a + "0", a + "1") - reach) / 4), F.floor((F.greatest(a + "0", a + "1") + reach) / 4))
    t = segs.withColumn("c", span("x")).withColumn("r", span("y")).withColumns({"px": (c("c") + 0.5) * 4, "py": (c("r") + 0.5) * 4})
    dx, dy = c("x1") - c("x0"), c("y1") - c("y0")
    along = F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((c("px") - c("x0")) * dx + (c("py") - c("y0")) * dy) / (dx * dx + dy * dy)))
    t = t.withColumn("t", along).withColumn("d", F.round(F.hypot(c("x0") + c("t") * dx - c("px"), c("y0") + c("t") * dy - c("py")), 9)).where(c("d") <= reach)
    on = c("d") <= c("half")
    g = t.groupBy("r", "c").agg(F.bool_or(~c("loose") & on).alias("hard"), F.bool_or(~c("loose")).alias("beside"), F.bool_or(c("loose") & on).alias("gravel"), F.bool_or("loose").alias("by_gravel"))
    g = g.select("r", "c", (c("hard") & ~c("by_gravel")).alias("asphalt"), (c("beside") & ~c("hard")).alias("shoulder"), "gravel")
    return g.where("asphalt or shoulder or gravel")


_COVER = _IN + ", k AS (SELECT DISTINCT poly_id, objekt FROM ring), u AS (SELECT DISTINCT objekt, r, c FROM ins JOIN k USING (poly_id)), n AS (SELECT count(*) AS n FROM cells), cov AS (SELECT count(*) AS cov FROM (SELECT DISTINCT r, c FROM u))"


def covered(cells, ring):
    """(objekt, r, c) of the grid's cells inside a polygon of that kind."""
    kinds = ring.select("poly_id", "objekt").distinct()
    return Fo.cells_in_rings(ring).join(cells.select("r", "c").hint("merge"), ["r", "c"], "left_semi").join(kinds, "poly_id").select("objekt", "r", "c").distinct()


@R.add("c28_coverage", "cells ring", f"""
WITH {_COVER} SELECT objekt, count(*) AS cells, round(count(*) / any_value(n), 6) AS share, round(1 - any_value(cov) / any_value(n), 6) AS uncovered, 1 - any_value(cov) / any_value(n) <= 0.02 AS complete FROM u, n, cov GROUP BY 1 HAVING count(*) / any_value(n) >= 0.0005""")
def c28(cells, ring):
    """Areas as counts of cells; the exact clipping of polygons is left out."""
    u = covered(cells, ring)
    # two one-row tables
    size = cells.agg(F.count(F.lit(1)).alias("n")).join(u.select("r", "c").distinct().agg(F.count(F.lit(1)).alias("cov")))
    t = u.groupBy("objekt").agg(F.count(F.lit(1)).alias("cells")).join(F.broadcast(size)).where("cells / n >= 0.0005")
    rest = 1 - c("cov") / c("n")
    return t.select("objekt", "cells", F.round(c("cells") / c("n"), 6).alias("share"), F.round(rest, 6).alias("uncovered"), (rest <= 0.02).alias("complete"))


@R.add("c29_majority", "cells ring", f"WITH {_COVER} SELECT objekt, count(*) AS cells FROM u GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1")
def c29(cells, ring):
    return covered(cells, ring).groupBy("objekt").agg(F.count(F.lit(1)).alias("cells")).orderBy(F.desc("cells"), "objekt").limit(1)


_DISK = """a AS (SELECT *, unnest(generate_series(CAST(floor((x - w / 2 - 2) / 2) AS BIGINT), CAST(floor((x + w / 2 + 2) / 2) AS BIGINT))) AS c FROM road_node),
b AS (SELECT *, unnest(generate_series(CAST(floor((y - w / 2 - 2) / 2) AS BIGINT), CAST(floor((y + w / 2 + 2) / 2) AS BIGINT))) AS r FROM a),
d AS (SELECT *, round(sqrt(pow((c + 0.5::DOUBLE) * 2 - x, 2) + pow((r + 0.5::DOUBLE) * 2 - y, 2)), 9) AS d FROM b)"""


NODES = 50_000  # of a task


def disks(n):
    """The 2 m cells around every node, up to 2 m beyond its half width, with the distance d of their centres.

    A node makes some twenty rows, so the number of tasks goes by the count of nodes: by their bytes one task would get millions, and group or sort all their cells
    at once. Runs of a road stay together.
    """
    parts = max(n.sparkSession.sparkContext.defaultParallelism, n.count() // NODES + 1)
    n = n.repartition(parts, "road_id", F.floor(c("seq") / 64))
    reach = c("w") / 2 + 2
    span = lambda a: whole(F.floor((c(a) - reach) / 2), F.floor((c(a) + reach) / 2))
    t = n.withColumn("c", span("x")).withColumn("r", span("y"))
    return t.withColumn("d", F.round(F.hypot((c("c") + 0.5) * 2 - c("x"), (c("r") + 0.5) * 2 - c("y")), 9)).where(c("d") < reach)


@R.add("c33_soft_stamp", "road_node", f"""
WITH {_DISK}, e AS (SELECT *, CASE WHEN d <= w / 2 THEN 1 ELSE 1 - (d - w / 2) / 2 END AS k FROM d WHERE d < w / 2 + 2)
SELECT r, c, round(sum(z * k) / sum(k), 6) AS z, round(max(k), 6) AS opacity, max(w) AS w FROM e GROUP BY 1, 2""")
def c33(n):
    t = disks(n).withColumn("k", F.when(c("d") <= c("w") / 2, 1.0).otherwise(1 - (c("d") - c("w") / 2) / 2))
    return t.groupBy("r", "c").agg(r6(F.sum(c("z") * c("k")) / F.sum("k")).alias("z"), r6(F.max("k")).alias("opacity"), F.max("w").alias("w"))


@R.add("c40_nearest_claim", "road_node", f"""
WITH {_DISK} SELECT r, c, round(z, 6) AS z, road_id, seq FROM d WHERE d < w / 2 + 2 QUALIFY row_number() OVER (PARTITION BY r, c ORDER BY d, road_id, seq) = 1""")
def c40(n):
    best = F.min(F.struct("d", "road_id", "seq", "z")).alias("b")
    return disks(n).groupBy("r", "c").agg(best).select("r", "c", r6(c("b.z")).alias("z"), "b.road_id", "b.seq")


@R.add("c36_hold_deck", "road_node road", f"""
WITH {_ST}, sp AS (SELECT road_id, min(s) AS a, max(s) AS b, arg_min(z, seq) AS za, arg_max(z, seq) AS zb FROM st JOIN road USING (road_id) WHERE kunstbauten IS NOT NULL AND seq BETWEEN 5 AND 9 GROUP BY 1 HAVING max(s) > min(s))
SELECT st.road_id, seq, a IS NOT NULL AS hold, round(CASE WHEN a IS NULL THEN z ELSE za + (zb - za) * greatest(0, least(1, (s - a) / (b - a))) END, 6) AS z FROM st LEFT JOIN sp ON sp.road_id = st.road_id AND s BETWEEN a - 0.5 AND b + 0.5""")
def c36(n, road):
    st = L.stations(n)
    named = st.join(road.where("kunstbauten is not null").select("road_id"), "road_id").where(c("seq").between(5, 9))
    spans = named.groupBy("road_id").agg(F.min("s").alias("a"), F.max("s").alias("b"), F.min_by("z", "seq").alias("za"), F.max_by("z", "seq").alias("zb")).where("b > a")
    t = st.join(spans, "road_id", "left").withColumn("hold", F.coalesce(c("s").between(c("a") - 0.5, c("b") + 0.5), F.lit(False)))
    share = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (c("s") - c("a")) / (c("b") - c("a"))))
    return t.select("road_id", "seq", "hold", r6(F.when(c("hold"), c("za") + (c("zb") - c("za")) * share).otherwise(c("z"))).alias("z"))


@R.add("d22_median_per_bin", "road_node", f"""
WITH {_ST}, m AS (SELECT road_id, CAST(floor(round(s, 6) / 5) AS BIGINT) AS bin, median(z) AS h FROM st GROUP BY 1, 2),
k AS (SELECT road_id, unnest(generate_series(min(bin), max(bin))) AS bin FROM m GROUP BY 1),
f AS (SELECT k.road_id, k.bin, h, max(CASE WHEN h IS NOT NULL THEN k.bin END) OVER (PARTITION BY k.road_id ORDER BY k.bin) AS lo, min(CASE WHEN h IS NOT NULL THEN k.bin END) OVER (PARTITION BY k.road_id ORDER BY k.bin ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS hi FROM k LEFT JOIN m USING (road_id, bin))
SELECT f.road_id, f.bin, f.h IS NOT NULL AS measured, round(CASE WHEN lo = hi THEN a.h ELSE a.h + (b.h - a.h) * (f.bin - lo) / (hi - lo) END, 6) AS h FROM f JOIN m a ON a.road_id = f.road_id AND a.bin = lo JOIN m b ON b.road_id = f.road_id AND b.bin = hi""")
def d22(n):
    m = L.stations(n).groupBy("road_id", F.floor(F.round("s", 6) / 5).alias("bin")).agg(F.median("z").alias("h"))
    k = m.groupBy("road_id").agg(F.min("bin").alias("a"), F.max("bin").alias("b")).select("road_id", whole(c("a"), c("b")).alias("bin"))
    t = k.join(m, ["road_id", "bin"], "left")
    return t.select("road_id", "bin", c("h").isNotNull().alias("measured"), r6(L.fill_gaps(t, "road_id", "bin", "bin", "h", 1e12)).alias("h"))


@R.add("d33_representative_point", "road_node road cells", f"""
WITH {_ST}, f AS (SELECT *, round(sqrt(pow(x - 400, 2) + pow(y - 150, 2)), 6) AS d FROM st WHERE x BETWEEN 100 AND 700 AND y BETWEEN 0 AND 300),
g AS (SELECT road_id, min(d) AS d, round(max(s) - min(s), 6) AS len, count(*) AS n FROM f GROUP BY 1),
best AS (SELECT road_id FROM g JOIN road USING (road_id) ORDER BY CASE objekt WHEN 'S-B' THEN 3 WHEN 'S-L' THEN 2 ELSE 1 END DESC, d, len DESC, n DESC, road_id LIMIT 1),
p AS (SELECT road_id, x, y FROM f JOIN best USING (road_id) ORDER BY d, seq LIMIT 1)
SELECT road_id, x, y, round(max(cells.z) + 8, 6) AS height FROM p LEFT JOIN cells ON cells.r BETWEEN floor(y / 12) - 1 AND floor(y / 12) + 1 AND cells.c BETWEEN floor(x / 12) - 1 AND floor(x / 12) + 1 GROUP BY 1, 2, 3""")
def d33(n, road, cells):
    f = L.stations(n).where(c("x").between(100, 700) & c("y").between(0, 300)).withColumn("d", F.round(F.hypot(c("x") - 400, c("y") - 150), 6))
    rank = F.when(c("objekt") == "S-B", 3).when(c("objekt") == "S-L", 2).otherwise(1)
    per_road = f.groupBy("road_id").agg(F.min(F.struct("d", "seq", "x", "y")).alias("p"), F.round(F.max("s") - F.min("s"), 6).alias("len"), F.count(F.lit(1)).alias("n"))
    best = per_road.join(road, "road_id").agg(F.max(F.struct(rank.alias("rank"), -c("p.d"), "len", "n", -c("road_id"), "road_id", "p")).alias("b")).select("b.road_id", "b.p.x", "b.p.y")
    near = F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1)))
    around = best.withColumn("i", near).withColumn("j", near).select("road_id", "x", "y", (F.floor(c("y") / 12) + c("i")).alias("r"), (F.floor(c("x") / 12) + c("j")).alias("c"))
    found = around.where("road_id is not null").join(cells.select("r", "c", "z"), ["r", "c"], "left")
    return found.groupBy("road_id", "x", "y").agg(r6(F.max("z") + 8).alias("height"))


@R.add("d34_span_ends", "road_node", """
WITH n AS (SELECT *, 'deck ' || CAST(road_id // 2 AS VARCHAR) || CASE WHEN w > 6 THEN ' left' ELSE ' right' END AS name FROM road_node),
e AS (SELECT name, regexp_extract(name, '^(.*) (left|right)$', 1) AS span, road_id, arg_min(x, seq) AS x0, arg_min(y, seq) AS y0, arg_max(x, seq) AS x1, arg_max(y, seq) AS y1 FROM n GROUP BY ALL)
SELECT span, count(*) AS strips, round(avg(x0), 6) AS x0, round(avg(y0), 6) AS y0, round(avg(x1), 6) AS x1, round(avg(y1), 6) AS y1 FROM e GROUP BY 1""")
def d34(n):
    name = F.concat(F.lit("deck "), F.floor(c("road_id") / 2).cast("string"), F.when(c("w") > 6, " left").otherwise(" right"))
    ends = n.withColumn("name", name).groupBy("name", "road_id").agg(*(f(a, "seq").alias(a + i) for a in ("x", "y") for f, i in ((F.min_by, "0"), (F.max_by, "1"))))
    span = F.regexp_extract("name", "^(.*) (left|right)$", 1).alias("span")
    return ends.groupBy(span).agg(F.count(F.lit(1)).alias("strips"), *(r6(F.avg(a)).alias(a) for a in ("x0", "y0", "x1", "y1")))


@R.add("e20_portal_jump", "road_node", f"""
WITH {_ST}, g AS (SELECT road_id, seq, s, round(abs(z - lag(z) OVER q) / (s - lag(s) OVER q), 9) AS g FROM st WINDOW q AS (PARTITION BY road_id ORDER BY seq)),
b AS (SELECT *, avg(g) OVER (PARTITION BY road_id ORDER BY seq ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS base FROM g)
SELECT road_id, min(seq) AS seq, round(min(s), 6) AS s FROM b WHERE g >= round(base + 0.04, 9) AND g >= 0.12 GROUP BY 1""")
def e20(n):
    """The first node whose grade is 0.04 above the mean of the three before and 0.12 at least."""
    w = L.along()
    g = L.stations(n).withColumn("g", F.round(F.abs(c("z") - F.lag("z").over(w)) / (c("s") - F.lag("s").over(w)), 9))
    b = g.withColumn("base", F.avg("g").over(w.rowsBetween(-3, -1))).where((c("g") >= F.round(c("base") + 0.04, 9)) & (c("g") >= 0.12))
    return b.groupBy("road_id").agg(F.min("seq").alias("seq"), r6(F.min("s")).alias("s"))


@R.add("f15_growing_median", "cells", """
WITH j AS (SELECT a.r, a.c, greatest(abs(a.r - b.r), abs(a.c - b.c)) AS k, b.z FROM cells a JOIN cells b ON b.r BETWEEN a.r - 3 AND a.r + 3 AND b.c BETWEEN a.c - 3 AND a.c + 3 WHERE a.rock AND NOT b.rock AND b.z IS NOT NULL),
m AS (SELECT r, c, CASE WHEN count(*) FILTER (k <= 1) >= 3 THEN median(z) FILTER (k <= 1) WHEN count(*) FILTER (k <= 2) >= 3 THEN median(z) FILTER (k <= 2) WHEN count(*) >= 3 THEN median(z) END AS m FROM j GROUP BY 1, 2)
SELECT r, c, round(coalesce(m, z), 6) AS z FROM cells LEFT JOIN m USING (r, c)""")
def f15(cells):
    """Marked cells take the median of the unmarked ones in the first square, of radius 1 to 3, that holds three."""
    steps = F.array(*(F.struct(F.lit(max(abs(i), abs(j))).alias("k"), F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(-3, 4) for j in range(-3, 4) if i or j))
    spikes = cells.where("rock").select("r", "c", F.explode(steps).alias("t")).select("r", "c", "t.k", (c("r") + c("t.i")).alias("sr"), (c("c") + c("t.j")).alias("sc"))
    good = cells.where("not rock and z is not null").select(c("r").alias("sr"), c("c").alias("sc"), c("z").alias("v"))
    inside = {k: F.when(c("k") <= k, c("v")) for k in (1, 2, 3)}
    middle = F.coalesce(*(F.when(F.count(v) >= 3, F.median(v)) for v in inside.values()))
    found = spikes.join(good, ["sr", "sc"]).groupBy("r", "c").agg(middle.alias("m"))
    return cells.join(found, ["r", "c"], "left").select("r", "c", r6(F.coalesce("m", "z")).alias("z"))


@R.add("f28_split_channel", "cells", """
WITH k AS (SELECT r, c, z, z IS NOT NULL AND (code = 0 OR asphalt) AS keep FROM cells), m AS (SELECT (max(r) + 1) // 2 AS mr, (max(c) + 1) // 2 AS mc FROM cells),
ro AS (SELECT r, max(c) FILTER (keep AND c < mc) AS a, min(c) FILTER (keep AND c >= mc) AS b FROM k, m GROUP BY 1), co AS (SELECT c, max(r) FILTER (keep AND r < mr) AS a, min(r) FILTER (keep AND r >= mr) AS b FROM k, m GROUP BY 1)
SELECT k.r, k.c, keep FROM k JOIN ro USING (r) JOIN co USING (c) WHERE z IS NOT NULL AND (keep OR coalesce(k.c > ro.a AND k.c < ro.b AND ro.b - ro.a - 1 <= 6, false) OR coalesce(k.r > co.a AND k.r < co.b AND co.b - co.a - 1 <= 6, false))""")
def f28(cells):
    """Kept cells and those of a gap of at most 6 around the middle, by row and by column."""
    middle = cells.agg(*(F.floor((F.max(a) + 1) / 2).alias("m" + a) for a in "rc"))  # one row
    k = cells.join(F.broadcast(middle)).withColumn("keep", c("z").isNotNull() & ((c("code") == 0) | c("asphalt")))

    def gap(line, a):
        ends = (F.max(F.when(c("keep") & (c(a) < c("m" + a)), c(a))).alias(a + "0"), F.min(F.when(c("keep") & (c(a) >= c("m" + a)), c(a))).alias(a + "1"))
        return k.groupBy(line).agg(*ends)

    inside = lambda a: F.coalesce((c(a) > c(a + "0")) & (c(a) < c(a + "1")) & (c(a + "1") - c(a + "0") - 1 <= 6), F.lit(False))
    t = k.join(gap("r", "c"), "r").join(gap("c", "r"), "c").where("z is not null")
    return t.where(c("keep") | inside("c") | inside("r")).select("r", "c", "keep")


@R.add("g11_ribbon", "road_node", f"""
WITH {_TAN}, e AS (SELECT road_id, seq, side, round(x - side * dy / sqrt(dx*dx + dy*dy) * w / 2, 6) + 0.0 AS x, round(y + side * dx / sqrt(dx*dx + dy*dy) * w / 2, 6) + 0.0 AS y FROM t, (VALUES (1), (-1)) v(side))
SELECT road_id, row_number() OVER (PARTITION BY road_id ORDER BY side DESC, side * seq) - 1 AS i, x, y FROM e""")
def g11(n):
    """The ring of a carriageway: left points, then right ones backwards."""
    t = L.tangents(n)
    side = lambda s: F.transform(F.array_sort(F.collect_list(F.struct("seq", (c("x") + s * c("nx") * c("w") / 2).alias("x"), (c("y") + s * c("ny") * c("w") / 2).alias("y")))), lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
    rings = t.groupBy("road_id").agg(F.concat(side(1), F.reverse(side(-1))).alias("ring"))
    return rings.select("road_id", F.posexplode("ring").alias("i", "p")).select("road_id", c("i").cast("long").alias("i"), r6(c("p.x")).alias("x"), r6(c("p.y")).alias("y"))


@R.add("g37_end_trims", "road_node", f"""
WITH {_LEN}, wd AS (SELECT road_id, max(w) AS w FROM road_node GROUP BY 1), tr AS (SELECT road_id, len, ls, 9 * w AS a, len - 8 * w AS b FROM ln JOIN wd USING (road_id)),
e AS (SELECT road_id, ls, a >= b AS stub, CASE WHEN a < b THEN a ELSE greatest(0, len / 2 - 0.5) END AS p0, CASE WHEN a < b THEN b ELSE least(len, len / 2 + 0.5) END AS p1 FROM tr),
q AS (SELECT road_id, ls, stub, 0 AS k, p0 AS pos FROM e UNION ALL SELECT road_id, ls, stub, 1, p1 FROM e)
SELECT road_id, stub, CAST(k AS BIGINT) AS k, round(pos, 6) AS "at", round(x0 + (pos - s0) / (s1 - s0) * (x1 - x0), 6) + 0.0 AS x, round(z0 + (pos - s0) / (s1 - s0) * (z1 - z0), 6) + 0.0 AS z FROM q JOIN sg USING (road_id) WHERE pos >= s0 AND (pos < s1 OR (seg = ls AND pos <= s1))""")
def g37(n):
    """Both ends of a road after trims in proportion to its width; where nothing is left a stub of a metre in the middle stays."""
    segs = L.segments(n)
    t = segs.groupBy("road_id").agg(F.max("s1").alias("len")).join(n.groupBy("road_id").agg(F.max("w").alias("w")), "road_id")
    a, b, middle = 9 * c("w"), c("len") - 8 * c("w"), c("len") / 2
    p0, p1 = F.when(a < b, a).otherwise(F.greatest(F.lit(0.0), middle - 0.5)), F.when(a < b, b).otherwise(F.least(c("len"), middle + 0.5))
    ends = t.select("road_id", (a >= b).alias("stub"), F.posexplode(F.array(p0, p1)).alias("k", "at")).withColumn("k", c("k").cast("long"))
    return L.sample_at(segs, ends).select("road_id", "stub", "k", r6(c("at")).alias("at"), r6(c("x")).alias("x"), r6(c("z")).alias("z"))
