"""Queries of cell tables: focal statistics, sampling, fills, flow, components, surface classes, layers."""

from pyspark.sql import functions as F

from hillframe.functions.scalars import r6
from hillframe.operators import focal as Fo
from hillframe.operators import iterate, surface
from hillframe.operators.iterate import cut
from hillframe.operators.quantiles import percentiles

from .registry import Registry

R = Registry()
QUERIES, ORACLES = R.queries, R.oracles
c = F.col

# nulls filled: 3x3 mean with repeated borders, else the median
_FILLED = """mm AS (SELECT max(r) AS mr, max(c) AS mc, median(z) AS md FROM cells),
hole AS (SELECT h.r, h.c, avg(t.z) AS v FROM (SELECT r, c, greatest(0, least(mr, r + i)) AS tr, greatest(0, least(mc, c + j)) AS tc FROM cells, mm, (VALUES (-1), (0), (1)) a(i), (VALUES (-1), (0), (1)) b(j) WHERE z IS NULL) h
  JOIN cells t ON t.r = tr AND t.c = tc GROUP BY 1, 2),
fz AS (SELECT k.r, k.c, coalesce(k.z, hole.v, md) AS z, k.dom, k.code, k.twi, k.rock, k.asphalt FROM cells k LEFT JOIN hole ON k.r = hole.r AND k.c = hole.c, mm)"""
_GRAD = _FILLED + """, g AS (SELECT *, CASE WHEN lag(z) OVER rw IS NULL THEN lead(z) OVER rw - z WHEN lead(z) OVER rw IS NULL THEN z - lag(z) OVER rw ELSE (lead(z) OVER rw - lag(z) OVER rw) / 2 END / 10 AS dx,
  -(CASE WHEN lag(z) OVER cl IS NULL THEN lead(z) OVER cl - z WHEN lead(z) OVER cl IS NULL THEN z - lag(z) OVER cl ELSE (lead(z) OVER cl - lag(z) OVER cl) / 2 END / 10) AS dy FROM fz
  WINDOW rw AS (PARTITION BY r ORDER BY c), cl AS (PARTITION BY c ORDER BY r)),
sl AS (SELECT *, degrees(atan(sqrt(dx * dx + dy * dy))) AS slope FROM g),
sa AS (SELECT *, CASE WHEN slope < 0.5 THEN 0 ELSE ((degrees(atan2(-dx, -dy)) % 360) + 360) % 360 END AS aspect FROM sl)"""


def _sloped(cells):
    return Fo.slope_aspect(Fo.fill_from_neighbours(cells, "z"), "z", 10.0)


@R.add("f6_fill", "cells", f"WITH {_FILLED} SELECT r, c, round(z, 6) AS z FROM fz")
def f6(cells):
    return Fo.fill_from_neighbours(cells, "z").select("r", "c", F.round("z", 6).alias("z"))


@R.add("f1_slope_aspect", "cells", f"WITH {_GRAD} SELECT r, c, round(slope, 6) + 0.0 AS slope, round(aspect, 5) + 0.0 AS aspect FROM sa")
def f1(cells):
    return _sloped(cells).select("r", "c", r6(c("slope")).alias("slope"), (F.round("aspect", 5) + F.lit(0.0)).alias("aspect"))


@R.add("f2_hillshade", "cells", f"""
WITH {_GRAD} SELECT r, c, round(greatest(0, least(1, sin(radians(45)) * cos(radians(slope)) + cos(radians(45)) * sin(radians(slope)) * cos(radians(315) - atan2(-dx, dy)))), 6) + 0.0 AS shade FROM sa""")
def f2(cells):
    s = F.radians("slope")
    d45 = F.radians(F.lit(45.0))
    shade = F.sin(d45) * F.cos(s) + F.cos(d45) * F.sin(s) * F.cos(F.radians(F.lit(315.0)) - F.atan2(-c("dz_dx"), c("dz_dy")))
    return _sloped(cells).select("r", "c", r6(F.greatest(F.lit(0.0), F.least(F.lit(1.0), shade))).alias("shade"))


_ROUGH = """b AS (SELECT a.r, a.c, a.z, avg(n.z) AS m, count(n.z) AS k FROM cells a JOIN cells n ON n.r BETWEEN a.r - 1 AND a.r + 1 AND n.c BETWEEN a.c - 1 AND a.c + 1 GROUP BY 1, 2, 3),
ro AS (SELECT r, c, CASE WHEN k >= 6 THEN abs(z - m) END AS rough FROM b)"""


@R.add("f4_roughness", "cells", f"WITH {_ROUGH} SELECT r, c, round(rough, 6) + 0.0 AS rough FROM ro")
def f4(cells):
    return Fo.roughness(cells, "z").select("r", "c", r6(c("rough")).alias("rough"))


@R.add("f5_masked_roughness", "cells", """
WITH m AS (SELECT r, c, z FROM cells WHERE code <= 1), b AS (SELECT a.r, a.c, a.z, avg(n.z) AS m, count(n.z) AS k FROM m a JOIN m n ON n.r BETWEEN a.r - 1 AND a.r + 1 AND n.c BETWEEN a.c - 1 AND a.c + 1 GROUP BY 1, 2, 3)
SELECT r, c, round(CASE WHEN k >= 6 THEN abs(z - m) END, 6) + 0.0 AS rough FROM b""")
def f5(cells):
    masked = cells.withColumn("z", F.when(c("code") <= 1, c("z")))
    return Fo.roughness(masked, "z").where("code <= 1").select("r", "c", r6(c("rough")).alias("rough"))


_D8 = _FILLED + """, nb AS (SELECT a.r, a.c, a.z, v.k, a.r + v.i AS tr, a.c + v.j AS tc, (a.z - n.z) / sqrt(v.i * v.i + v.j * v.j) AS d FROM fz a, (VALUES (0,-1,-1),(1,-1,0),(2,-1,1),(3,0,-1),(4,0,1),(5,1,-1),(6,1,0),(7,1,1)) v(k, i, j) JOIN fz n ON n.r = a.r + v.i AND n.c = a.c + v.j),
rc AS (SELECT r, c, k, tr, tc, d FROM (SELECT *, row_number() OVER (PARTITION BY r, c ORDER BY d DESC, k) AS q FROM nb) WHERE q = 1)"""


def _flow(cells):
    return Fo.d8(Fo.fill_from_neighbours(cells, "z"), "z")


@R.add("f7_d8", "cells", f"WITH {_D8} SELECT r, c, CAST(CASE WHEN d > 0 THEN k ELSE -1 END AS BIGINT) AS receiver, round(greatest(d, 0), 6) + 0.0 AS fall FROM rc")
def f7(cells):
    return _flow(cells).select("r", "c", c("to").cast("long").alias("receiver"), r6(c("drop")).alias("fall"))


def _accumulated(cells, size=1.0):
    t = Fo.d8(Fo.fill_from_neighbours(cells, "z"), "z", size)
    dr, dc = F.array(*(F.lit(i) for _, i, _ in Fo.NEIGHBOURS)), F.array(*(F.lit(j) for _, _, j in Fo.NEIGHBOURS))
    to = F.when(c("to") >= 0, iterate.cell_id(c("r") + F.element_at(dr, c("to") + 1), c("c") + F.element_at(dc, c("to") + 1)))
    t = iterate.cut(t.select("r", "c", "drop", iterate.cell_id(c("r"), c("c")).alias("cell"), to.alias("to")), "receivers")
    return t.join(iterate.flow_accumulation(t.select("cell", "to")), "cell")


_ACC = _D8.replace("WITH ", "") + """, w AS (SELECT r * 4294967296 + c AS src, r * 4294967296 + c AS pos FROM fz UNION ALL SELECT w.src, rc.tr * 4294967296 + rc.tc FROM w JOIN rc ON rc.r * 4294967296 + rc.c = w.pos WHERE rc.d > 0), ac AS (SELECT pos, count(*) AS acc FROM w GROUP BY 1)"""


@R.add("f8_flow_accumulation", "cells", None)
def f8(cells):
    return _accumulated(cells).select("r", "c", "acc")


@R.add("f9_twi", "cells", None)
def f9(cells):
    t = _accumulated(cells, 10.0).select("r", "c", F.log(c("acc") * 10.0 / F.greatest(c("drop"), F.lit(1e-3))).alias("raw"))
    return t.select("r", "c", r6(c("raw")).alias("twi"))


@R.add("f10_ndsm", "cells", f"WITH {_FILLED} SELECT r, c, round(greatest(coalesce(dom, z) - z, 0), 6) + 0.0 AS ndsm FROM fz")
def f10(cells):
    return Fo.fill_from_neighbours(cells, "z").select("r", "c", r6(F.greatest(F.coalesce("dom", "z") - c("z"), F.lit(0.0))).alias("ndsm"))


@R.add("f11_morphology", "cells", """
WITH m AS (SELECT r, c, CASE WHEN rock THEN 1 ELSE 0 END AS v FROM cells),
e AS (SELECT a.r, a.c, a.v, min(n.v) AS er, max(n.v) AS di FROM m a JOIN m n ON n.r BETWEEN a.r - 1 AND a.r + 1 AND n.c BETWEEN a.c - 1 AND a.c + 1 GROUP BY 1, 2, 3),
o AS (SELECT a.r, a.c, a.er, a.di, max(n.er) AS op, min(n.di) AS cl FROM e a JOIN e n ON n.r BETWEEN a.r - 1 AND a.r + 1 AND n.c BETWEEN a.c - 1 AND a.c + 1 GROUP BY 1, 2, 3, 4)
SELECT r, c, CAST(er AS BIGINT) AS eroded, CAST(di AS BIGINT) AS dilated, CAST(op AS BIGINT) AS opened, CAST(cl AS BIGINT) AS closed FROM o""")
def f11(cells):
    t = cells.select("r", "c", c("rock").cast("long").alias("v"))
    t = Fo.square(Fo.square(t, "v", 1, F.min, "eroded"), "v", 1, F.max, "dilated")
    t = Fo.square(Fo.square(t, "eroded", 1, F.max, "opened"), "dilated", 1, F.min, "closed")
    return t.select("r", "c", "eroded", "dilated", "opened", "closed")


@R.add("f12_blur", "cells", """
WITH mm AS (SELECT max(r) AS mr, max(c) AS mc FROM cells), w AS (SELECT i, exp(-0.5 * i * i) AS e FROM (SELECT unnest(generate_series(-4, 4)) AS i)), k AS (SELECT i, e / (SELECT sum(e) FROM w) AS w FROM w),
x AS (SELECT a.r, a.c, sum(n.twi * k.w) AS v FROM cells a, mm, k JOIN cells n ON n.r = a.r AND n.c = greatest(0, least(mm.mc, a.c + k.i)) GROUP BY 1, 2)
SELECT a.r, a.c, round(sum(n.v * k.w), 6) + 0.0 AS twi FROM x a, mm, k JOIN x n ON n.c = a.c AND n.r = greatest(0, least(mm.mr, a.r + k.i)) GROUP BY 1, 2""")
def f12(cells):
    return Fo.blur(cells.select("r", "c", "twi"), "twi", 1.0, "b").select("r", "c", r6(c("b")).alias("twi"))


_SNOW = """sn AS (SELECT *, greatest(coalesce(dom, z) - z, 0) AS ndsm,
  greatest(0, least(1, (1 - (SELECT t * t * (3 - 2 * t) FROM (SELECT greatest(0, least(1, (1.5 - 0.0065 * (z - 1200.0) + 4.0) / 5.0)) AS t) q))
    * CASE WHEN slope < 0.5 THEN 1 ELSE greatest(0.05, least(2, 1 + 0.4 * cos(radians(aspect)))) END * (1 - 0.75 * greatest(0, least(1, slope / 48.0))))) AS snow FROM sa)"""


def _snowed(cells):
    t = _sloped(cells).withColumn("ndsm", F.greatest(F.coalesce("dom", "z") - c("z"), F.lit(0.0)))
    return t.withColumn("snow", surface.snow_share(c("z"), c("slope"), c("aspect")))


@R.add("f16_snow", "cells", f"WITH {_GRAD}, {_SNOW} SELECT r, c, round(snow, 6) + 0.0 AS snow FROM sn")
def f16(cells):
    return _snowed(cells).select("r", "c", r6(c("snow")).alias("snow"))


@R.add("f17_scene_composite", "scene", """
SELECT cell, CAST(coalesce(max(code) FILTER (code <= 100), CASE WHEN max(CASE WHEN code = 210 THEN 1 ELSE 0 END) = 1 THEN 210 WHEN max(CASE WHEN code = 205 THEN 1 ELSE 0 END) = 1 THEN 205 ELSE 255 END) AS BIGINT) AS code,
  arg_max(code, (ts, k1, k2)) FILTER (code <= 100) AS latest FROM (SELECT DISTINCT cell, ts, k1, k2, max(code) FILTER (code <= 100) OVER (PARTITION BY cell, ts, k1, k2) AS m, code FROM scene) GROUP BY 1""")
def f17(scene):
    has = lambda v: F.max((c("code") == v).cast("int")) == 1
    clear = F.max(F.when(c("code") <= 100, c("code")))
    latest = F.max_by("code", F.when(c("code") <= 100, F.struct("ts", "k1", "k2")))
    return scene.groupBy("cell").agg(F.coalesce(clear, F.when(has(210), 210).when(has(205), 205).otherwise(255)).cast("long").alias("code"), F.when(clear.isNotNull(), latest).alias("latest"))


_BIOME = """so AS (SELECT *, CASE WHEN code = 5 THEN 'water' WHEN rock THEN 'rock' WHEN code = 0 AND ndsm >= 5 THEN 'forest_tall' WHEN code IN (0, 1) AND ndsm < 1 THEN 'forest_gap' WHEN code IN (0, 1) THEN 'forest_scrub'
  WHEN code = 2 THEN CASE WHEN twi >= 5 THEN 'meadow_wet' ELSE 'meadow_dry' END WHEN code = 3 AND twi >= 5 THEN 'bare_wet' ELSE 'bare_dry' END AS soft FROM sn),
bi AS (SELECT *, CASE WHEN soft = 'water' THEN 'water' WHEN asphalt OR code = 4 THEN 'kill' WHEN snow >= 0.55 AND ndsm < 5 THEN 'snow_heavy' WHEN snow >= 0.25 THEN 'snow_light' ELSE soft END AS biome FROM so),
ma AS (SELECT *, CASE WHEN code = 4 THEN 'concrete' WHEN asphalt THEN 'asphalt' WHEN soft = 'water' THEN 'water' WHEN biome LIKE 'snow%' THEN 'snow' WHEN soft = 'meadow_dry' THEN 'dry_grass' WHEN soft IN ('forest_gap', 'meadow_wet') THEN 'grass'
  WHEN soft IN ('forest_tall', 'forest_scrub') THEN 'forest' WHEN soft = 'bare_wet' THEN 'water' WHEN soft = 'rock' THEN 'rock' ELSE 'dirt' END AS material FROM bi)"""


def _biomes(cells):
    t = _snowed(cells).withColumn("soft", surface.soft_biome(c("code"), c("ndsm"), c("twi"), c("rock")))
    t = t.withColumn("biome", surface.biome(c("soft"), c("ndsm"), c("snow"), c("asphalt") | (c("code") == 4)))
    return t.withColumn("material", surface.material(c("biome"), c("soft"), c("asphalt"), c("code") == 4, F.lit(False)))


@R.add("f18_soft_biome", "cells", f"WITH {_GRAD}, {_SNOW}, {_BIOME} SELECT r, c, soft FROM bi")
def f18(cells):
    return _biomes(cells).select("r", "c", "soft")


@R.add("f19_biome", "cells", f"WITH {_GRAD}, {_SNOW}, {_BIOME} SELECT r, c, biome FROM bi")
def f19(cells):
    return _biomes(cells).select("r", "c", "biome")


@R.add("f20_material", "cells", f"WITH {_GRAD}, {_SNOW}, {_BIOME} SELECT r, c, material FROM ma")
def f20(cells):
    return _biomes(cells).select("r", "c", "material")


@R.add("d4_biome_share", "cells", f"WITH {_GRAD}, {_SNOW}, {_BIOME} SELECT biome, material, count(*) AS cells, round(100.0 * count(*) / (SELECT count(*) FROM cells), 6) AS percent FROM ma GROUP BY 1, 2")
def d4(cells):
    total = F.broadcast(cells.agg(F.count(F.lit(1)).alias("total")))
    return _biomes(cells).groupBy("biome", "material").agg(F.count(F.lit(1)).alias("cells")).join(total).select("biome", "material", "cells", F.round(100.0 * c("cells") / c("total"), 6).alias("percent"))


_BLOB = """b AS (SELECT r * 4294967296 + c AS id, r, c FROM cells WHERE code = 1), l AS (SELECT x.id AS u, y.id AS v FROM b x JOIN b y ON (y.r = x.r AND y.c = x.c + 1) OR (y.c = x.c AND y.r = x.r + 1)),
e AS (SELECT u, v FROM l UNION ALL SELECT v, u FROM l), w AS (SELECT id AS a, id AS z FROM b UNION SELECT w.a, e.v FROM w JOIN e ON e.u = w.z), cc AS (SELECT a AS id, min(z) AS component FROM w GROUP BY 1)"""


def _blobs(cells):
    b = cells.where("code = 1").select("r", "c", iterate.cell_id(c("r"), c("c")).alias("id"))
    right = b.select(iterate.cell_id(c("r"), c("c") + 1).alias("v"), c("id").alias("u"))
    down = b.select(iterate.cell_id(c("r") + 1, c("c")).alias("v"), c("id").alias("u"))
    links = right.unionByName(down).join(b.select(c("id").alias("v")), "v", "left_semi").select("u", "v")
    label = iterate.components(links)
    return b.join(label, c("id") == c("node"), "left").select("r", "c", F.coalesce("component", "id").alias("component"))


@R.add("f22_components", "cells", None)
def f22(cells):
    return _blobs(cells)


@R.add("f23_small_components", "cells", None)
def f23(cells):
    b = iterate.cut(_blobs(cells), "blobs")
    return b.join(b.groupBy("component").agg(F.count(F.lit(1)).alias("n")).where("n >= 4"), "component").select("r", "c", "component", "n")


for _k, _v in (("f8_flow_accumulation", f"{_ACC} SELECT r, c, acc FROM fz JOIN ac ON pos = r * 4294967296 + c"),
               ("f9_twi", f"{_ACC} SELECT fz.r, fz.c, round(ln(acc * 10.0 / greatest(greatest(d / 10, 0), 1e-3)), 6) + 0.0 AS twi FROM fz JOIN ac ON pos = fz.r * 4294967296 + fz.c JOIN rc ON rc.r = fz.r AND rc.c = fz.c"),
               ("f22_components", f"{_BLOB} SELECT b.r, b.c, component FROM b JOIN cc USING (id)"),
               ("f23_small_components", f"{_BLOB}, s AS (SELECT component, count(*) AS n FROM cc GROUP BY 1 HAVING count(*) >= 4) SELECT b.r, b.c, component, n FROM b JOIN cc USING (id) JOIN s USING (component)")):
    from hillframe.sources.fixtures import ctes as _ctes

    ORACLES[_k] = _ctes("cells").replace("WITH ", "WITH RECURSIVE ", 1) + ",\n" + _v

_MODES = {"corridor_dgm": (10, "replace"), "road_bed": (20, "replace"), "water": (30, "add"), "span": (40, "replace")}
_COMPOSE = """ba AS (SELECT r * 100 + c AS cell, coalesce(z, 1000) AS z FROM cells),
mg AS (SELECT cell, name, arg_max(v, (weight, part)) AS v, greatest(0, least(1, max(weight))) AS w FROM layer GROUP BY 1, 2),
pv AS (SELECT cell, max(v) FILTER (name = 'corridor_dgm') AS cv, max(w) FILTER (name = 'corridor_dgm') AS cw, max(v) FILTER (name = 'road_bed') AS rv, max(w) FILTER (name = 'road_bed') AS rw,
  max(v) FILTER (name = 'water') AS wv, max(w) FILTER (name = 'water') AS ww, max(v) FILTER (name = 'span') AS sv, max(w) FILTER (name = 'span') AS sw FROM mg GROUP BY 1),
s1 AS (SELECT ba.cell, CASE WHEN cw IS NULL THEN z ELSE (1 - cw) * z + cw * cv END AS z, rv, rw, wv, ww, sv, sw FROM ba LEFT JOIN pv USING (cell)),
s2 AS (SELECT cell, CASE WHEN rw IS NULL THEN z ELSE (1 - rw) * z + rw * rv END AS z, wv, ww, sv, sw FROM s1), s3 AS (SELECT cell, CASE WHEN ww IS NULL THEN z ELSE z + wv * ww END AS z, sv, sw FROM s2),
s4 AS (SELECT cell, CASE WHEN sw IS NULL THEN z ELSE (1 - sw) * z + sw * sv END AS z FROM s3)"""


@R.add("f24_compose", "cells layer", f"WITH {_COMPOSE} SELECT cell, round(greatest(0, least(2000, z)), 6) + 0.0 AS z FROM s4")
def f24(cells, layer):
    base = cells.select((c("r") * 100 + c("c")).alias("cell"), F.coalesce("z", F.lit(1000.0)).alias("z"))
    return surface.compose(base, layer, _MODES, 2000.0).select("cell", r6(c("z")).alias("z"))


@R.add("f25_proposal", "cells", "SELECT r, c, round(dom - z, 6) + 0.0 AS dz FROM cells WHERE abs(dom - z) > 1e-4")
def f25(cells):
    return cells.where("abs(dom - z) > 1e-4").select("r", "c", r6(c("dom") - c("z")).alias("dz"))


@R.add("f30_orphans", "cells", """
WITH m AS (SELECT r, c FROM cells WHERE code <= 1), b AS (SELECT a.r AS br, a.c AS bc, count(*) AS n FROM (SELECT r + i AS r, c + j AS c FROM m, (VALUES (0), (-1)) x(i), (VALUES (0), (-1)) y(j)) a GROUP BY 1, 2 HAVING count(*) >= 3)
SELECT DISTINCT m.r, m.c FROM m JOIN b ON m.r - b.br IN (0, 1) AND m.c - b.bc IN (0, 1)""")
def f30(cells):
    t = cells.select("r", "c", F.when(c("code") <= 1, 1).otherwise(0).alias("m"))
    w = lambda a, b, k: k.rangeBetween(a, b)
    t = t.withColumn("_p", F.sum("m").over(w(0, 1, Fo.by_row()))).withColumn("block", F.sum("_p").over(w(0, 1, Fo.by_column())))
    t = t.withColumn("_q", F.max("block").over(w(-1, 0, Fo.by_row()))).withColumn("best", F.max("_q").over(w(-1, 0, Fo.by_column())))
    # blocks whose corner lies outside the first row or column have two cells at most
    return t.where("m = 1 and best >= 3").select("r", "c")


@R.add("f34_densest_window", "cells", """
WITH m AS (SELECT r, c, CASE WHEN rock THEN 1 ELSE 0 END AS v FROM cells), s AS (SELECT a.r, a.c, sum(n.v) AS k FROM m a JOIN m n ON n.r BETWEEN a.r - 2 AND a.r + 2 AND n.c BETWEEN a.c - 2 AND a.c + 2 GROUP BY 1, 2)
SELECT r, c, CAST(k AS BIGINT) AS k FROM s ORDER BY k DESC, r, c LIMIT 1""")
def f34(cells):
    t = Fo.box_sums(cells.select("r", "c", c("rock").cast("long").alias("v")), "v", 2)
    return t.orderBy(c("box_sum").desc(), "r", "c").limit(1).select("r", "c", c("box_sum").alias("k"))


@R.add("f37_normalise", "cells", """
WITH e AS (SELECT min(z) AS a, max(z) AS b, greatest(5, (max(z) - min(z)) * 0.05) AS p FROM cells) SELECT r, c, CAST(trunc((z - (a - p)) / ((b + p) - (a - p)) * 65535) AS BIGINT) AS u16 FROM cells, e WHERE z IS NOT NULL""")
def f37(cells):
    e = F.broadcast(cells.agg(F.min("z").alias("a"), F.max("z").alias("b")).withColumn("p", F.greatest(F.lit(5.0), (c("b") - c("a")) * 0.05)))
    low, high = c("a") - c("p"), c("b") + c("p")
    return cells.where("z is not null").join(e).select("r", "c", ((c("z") - low) / (high - low) * 65535).cast("long").alias("u16"))


@R.add("f38_comparison", "cells", """
SELECT code, count(*) AS n, count(*) FILTER (abs(dom - z) > 0.0) AS changed, round(quantile_cont(abs(dom - z), 0.5), 6) AS p50, round(quantile_cont(abs(dom - z), 0.9), 6) AS p90, round(max(abs(dom - z)), 6) AS worst FROM cells WHERE dom IS NOT NULL AND z IS NOT NULL GROUP BY 1""")
def f38(cells):
    t = cells.where("dom is not null and z is not null").withColumn("d", F.abs(c("dom") - c("z")))
    n = t.groupBy("code").agg(F.count(F.lit(1)).alias("n"), F.count_if(c("d") > 0).alias("changed"), F.round(F.max("d"), 6).alias("worst"))
    p = percentiles(t, ["code"], "d", {"p50": 0.5, "p90": 0.9})
    return n.join(p, "code").select("code", "n", "changed", *(F.round(k, 6).alias(k) for k in ("p50", "p90")), "worst")


@R.add("c1_nearest", "cells", """
WITH d AS (SELECT i, j, CAST(floor((i + 0.5) * 0.7) AS BIGINT) AS r, CAST(floor((j + 0.5) * 0.7) AS BIGINT) AS c FROM (SELECT r AS i, c AS j FROM cells)) SELECT i, j, coalesce(code, 6) AS code FROM d LEFT JOIN cells USING (r, c)""")
def c1(cells):
    d = cells.select(c("r").alias("i"), c("c").alias("j"), F.floor((c("r") + 0.5) * 0.7).alias("r"), F.floor((c("c") + 0.5) * 0.7).alias("c"))
    return d.join(cells.select("r", "c", "code"), ["r", "c"], "left").select("i", "j", F.coalesce("code", F.lit(6).cast("long")).alias("code"))


_TAPS = """p AS (SELECT r AS i, c AS j, CAST(r AS DOUBLE) * 0.9123457 + 0.2718281 AS row, CAST(c AS DOUBLE) * 0.9123457 + 0.4142135 AS col FROM cells), t AS (SELECT i, j, CASE WHEN a = 1 THEN row - floor(row) ELSE 1 - row + floor(row) END * CASE WHEN b = 1 THEN col - floor(col) ELSE 1 - col + floor(col) END AS w,
  CAST(floor(row) + a AS BIGINT) AS r, CAST(floor(col) + b AS BIGINT) AS c FROM p, (VALUES (0), (1)) x(a), (VALUES (0), (1)) y(b)), s AS (SELECT i, j, sum(w * z) AS v, sum(CASE WHEN z IS NOT NULL THEN w END) AS k FROM t LEFT JOIN cells USING (r, c) WHERE w > 0 GROUP BY 1, 2)"""


@R.add("c2_bilinear", "cells", f"WITH {_TAPS} SELECT i, j, round(CASE WHEN k >= 1 - 1e-9 THEN v END, 6) AS strict, round(v / k, 6) AS renormalised FROM s")
def c2(cells):
    p = cells.select(c("r").alias("i"), c("c").alias("j"), (c("r") * 0.9123457 + 0.2718281).alias("row"), (c("c") * 0.9123457 + 0.4142135).alias("col"))
    a = Fo.bilinear(cells, p, "z", ["i", "j"]).withColumnRenamed("sample", "strict")
    b = Fo.bilinear(cells, p, "z", ["i", "j"], renormalise=True).withColumnRenamed("sample", "renormalised")
    return a.join(b, ["i", "j"]).select("i", "j", F.round("strict", 6).alias("strict"), F.round("renormalised", 6).alias("renormalised"))


@R.add("c18_nearest_fill", "cells", """
WITH h AS (SELECT a.r, a.c, n.z, row_number() OVER (PARTITION BY a.r, a.c ORDER BY pow(n.r - a.r, 2) + pow(n.c - a.c, 2), n.r, n.c) AS q FROM cells a JOIN cells n ON a.z IS NULL AND n.z IS NOT NULL AND n.r BETWEEN a.r - 2 AND a.r + 2 AND n.c BETWEEN a.c - 2 AND a.c + 2 AND pow(n.r - a.r, 2) + pow(n.c - a.c, 2) <= 4)
SELECT k.r, k.c, round(coalesce(k.z, h.z), 6) AS z FROM cells k LEFT JOIN h ON h.r = k.r AND h.c = k.c AND h.q = 1""")
def c18(cells):
    return Fo.nearest_fill(cells, "z", 2.0).select("r", "c", F.round("z", 6).alias("z"))


_IN = """ed AS (SELECT poly_id, x, y, coalesce(lead(x) OVER q, first_value(x) OVER q) AS x1, coalesce(lead(y) OVER q, first_value(y) OVER q) AS y1 FROM ring WINDOW q AS (PARTITION BY poly_id ORDER BY seq)),
bx AS (SELECT poly_id, min(x) AS ax, max(x) AS bx, min(y) AS ay, max(y) AS b_y FROM ring GROUP BY 1),
pc AS (SELECT poly_id, r, c FROM cells JOIN bx ON c + 0.5 BETWEEN ax AND bx AND -(r + 0.5) BETWEEN ay AND b_y),
ins AS (SELECT poly_id, r, c FROM pc JOIN ed USING (poly_id) WHERE (y > -(r + 0.5)) <> (y1 > -(r + 0.5)) AND x + (-(r + 0.5) - y) / (y1 - y) * (x1 - x) > c + 0.5 GROUP BY 1, 2, 3 HAVING count(*) % 2 = 1)"""


@R.add("c5_point_in_polygon", "cells ring", f"WITH {_IN} SELECT poly_id, r, c FROM ins")
def c5(cells, ring):
    return Fo.cells_in_rings(ring).join(cells.select("r", "c").hint("merge"), ["r", "c"], "left_semi").select("poly_id", "r", "c")


@R.add("d1_zonal", "cells ring", f"WITH {_IN} SELECT poly_id, count(z) AS n, round(avg(z) + 1e-9, 6) AS mean, round(quantile_cont(z, 0.9), 6) AS p90, round(avg(CASE WHEN z >= 1030 THEN 1.0 ELSE 0.0 END), 6) AS share FROM ins JOIN cells USING (r, c) WHERE z IS NOT NULL GROUP BY 1")
def d1(cells, ring):
    # a small file may hold many cells: they are never broadcast; what lies inside is read several times
    t = cut(Fo.cells_in_rings(ring).join(cells.where("z is not null").select("r", "c", "z").hint("merge"), ["r", "c"]).select("poly_id", "z"), "zones")
    n = t.groupBy("poly_id").agg(F.count("z").alias("n"), F.round(F.avg("z") + 1e-9, 6).alias("mean"), F.round(F.avg((c("z") >= 1030).cast("double")), 6).alias("share"))
    return n.join(percentiles(t, ["poly_id"], "z", {"p90": 0.9}), "poly_id").withColumn("p90", F.round("p90", 6))


@R.add("c31_ceiling", "cells", "SELECT r, c, round(least(z, 1000 + 0.5 * r + 0.3 * c), 6) AS z FROM cells WHERE z IS NOT NULL")
def c31(cells):
    return cells.where("z is not null").select("r", "c", F.round(F.least("z", 1000 + 0.5 * c("r") + 0.3 * c("c")), 6).alias("z"))


@R.add("f35_clear_mask", "cells", """
WITH m AS (SELECT r, c, code, CASE WHEN asphalt OR code = 4 THEN 1 ELSE 0 END AS k FROM cells), d AS (SELECT a.r, a.c, a.code, max(n.k) AS k FROM m a JOIN m n ON n.r BETWEEN a.r - 1 AND a.r + 1 AND n.c BETWEEN a.c - 1 AND a.c + 1 GROUP BY 1, 2, 3)
SELECT r, c, k = 1 AS clear, CASE WHEN k = 1 THEN NULL WHEN code = 0 THEN 'high' WHEN code = 1 THEN 'scrub' WHEN code = 2 THEN 'meadow' END AS target FROM d""")
def f35(cells):
    t = Fo.square(cells.select("r", "c", "code", (c("asphalt") | (c("code") == 4)).cast("int").alias("k")), "k", 1, F.max, "clear")
    return t.select("r", "c", (c("clear") == 1).alias("clear"), F.when(c("clear") == 1, None).when(c("code") == 0, "high").when(c("code") == 1, "scrub").when(c("code") == 2, "meadow").alias("target"))
