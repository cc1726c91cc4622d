"""Queries of scalar functions over tags, roads, ids and pixels."""

from pyspark.sql import functions as F

from hillframe.functions import scalars as S

from .registry import Registry

R = Registry()
QUERIES, ORACLES = R.queries, R.oracles
c = F.col
r6 = S.r6


@R.add("b1_codec", "cells", """
SELECT r, c, CAST(greatest(0, least(65535, round_even(z / 2000 * 65535, 0))) AS BIGINT) AS u16,
  CAST(greatest(0, least(65535, round_even((dom - z) * 1000, 0) + 32768)) AS BIGINT) AS dz,
  CAST(round_even(greatest(0, least(1, twi / 10)) * 255, 0) AS BIGINT) AS w FROM cells WHERE z IS NOT NULL AND dom IS NOT NULL""")
def b1(cells):
    return cells.where("z is not null and dom is not null").select("r", "c", S.encode_height(c("z"), 2000.0).alias("u16"), S.encode_delta(c("dom") - c("z")).alias("dz"), S.encode_weight(c("twi") / 10).alias("w"))


@R.add("b2_affine", "road_node", """
SELECT road_id, seq, round(x / 1024 * 512, 6) + 0.0 AS object_x, round((x - 10) / (1023 * 2.0) * 1023, 6) + 0.0 AS lattice_x, round((1024 - y) / 2, 6) + 0.0 AS lattice_y FROM road_node""")
def b2(n):
    return n.select("road_id", "seq", r6(c("x") / 1024 * 512).alias("object_x"), r6((c("x") - 10) / (1023 * 2.0) * 1023).alias("lattice_x"), r6((1024 - c("y")) / 2).alias("lattice_y"))


@R.add("b3_cell_of", "road_node", """
SELECT road_id, seq, round(x / 2.5 - 0.5, 6) + 0.0 AS col, round((-y) / 2.5 - 0.5, 6) + 0.0 AS row, CAST(floor(x / 2.5) AS BIGINT) AS col_cell, CAST(floor(-y / 2.5) AS BIGINT) AS row_cell FROM road_node""")
def b3(n):
    return n.select("road_id", "seq", r6(c("x") / 2.5 - 0.5).alias("col"), r6(-c("y") / 2.5 - 0.5).alias("row"), F.floor(c("x") / 2.5).alias("col_cell"), F.floor(-c("y") / 2.5).alias("row_cell"))


@R.add("b4_sanitise", "cells", "SELECT r, c, CASE WHEN z > 50 AND z < 1020 THEN round(z, 6) END AS z FROM cells")
def b4(cells):
    return cells.select("r", "c", F.round(S.sane_height(c("z"), 50.0, 1020.0), 6).alias("z"))


@R.add("b5_smoothstep", "cells", """
WITH t AS (SELECT r, c, greatest(0, least(1, (twi - 4) / 3.0)) AS t FROM cells) SELECT r, c, round(t * t * (3 - 2 * t), 6) + 0.0 AS s FROM t""")
def b5(cells):
    return cells.select("r", "c", r6(S.smoothstep(4.0, 7.0, c("twi"))).alias("s"))


@R.add("b6_hermite", "cells", """
WITH t AS (SELECT r, c, c / 99.0 AS t FROM cells)
SELECT r, c, round((2*t*t*t - 3*t*t + 1) * 10 + (t*t*t - 2*t*t + t) * 50 * 0.1 + (3*t*t - 2*t*t*t) * 14 + (t*t*t - t*t) * 50 * -0.05, 6) + 0.0 AS z,
  round((6*t*t - 6*t) / 50 * (10 - 14) + (3*t*t - 4*t + 1) * 0.1 + (3*t*t - 2*t) * -0.05, 6) + 0.0 AS dz FROM t""")
def b6(cells):
    a = (c("c") / 99.0, F.lit(10.0), F.lit(14.0), F.lit(0.1), F.lit(-0.05), F.lit(50.0))
    return cells.select("r", "c", r6(S.hermite(*a)).alias("z"), r6(S.hermite_slope(*a)).alias("dz"))


_NUM = "CASE WHEN try_cast(trim(regexp_split_to_array(replace(replace(lower(trim({0})), 'm', ''), ',', '.'), '[;|/-]')[1]) AS DOUBLE) > 0 THEN try_cast(trim(regexp_split_to_array(replace(replace(lower(trim({0})), 'm', ''), ',', '.'), '[;|/-]')[1]) AS DOUBLE) END".format
_LANES = f"coalesce({_NUM('lanes')}, {_NUM('lanes_forward')} + {_NUM('lanes_backward')})"


@R.add("b7_first_number", "tags", f"SELECT way_id, {_NUM('width')} AS width_m FROM tags")
def b7(tags):
    return tags.select("way_id", S.first_number(c("width")).alias("width_m"))


@R.add("b8_lanes", "tags", f"SELECT way_id, {_LANES} AS n FROM tags")
def b8(tags):
    return tags.select("way_id", S.lane_count(c("lanes"), c("lanes_forward"), c("lanes_backward")).alias("n"))


@R.add("b9_width", "tags", f"""
WITH t AS (SELECT way_id, {_NUM('width')} AS w, {_LANES} AS n, CASE coalesce(highway, 'unclassified') WHEN 'primary' THEN 2.0 WHEN 'residential' THEN 2.0 WHEN 'track' THEN 1.0 WHEN 'unclassified' THEN 2.0 END AS k FROM tags)
SELECT way_id, greatest(1.5, coalesce(w, coalesce(n, k, 2.0) * 3.75)) AS width_m, CAST(coalesce(n, k, 2.0) AS DOUBLE) AS n,
  CASE WHEN w IS NOT NULL THEN 'osm_width' WHEN n IS NOT NULL THEN 'osm_lanes' WHEN k IS NOT NULL THEN 'class_lanes' ELSE 'default_lanes' END AS source FROM t""")
def b9(tags):
    w, n, s = S.tagged_width(c("width"), S.lane_count(c("lanes"), c("lanes_forward"), c("lanes_backward")), c("highway"))
    return tags.select("way_id", w.alias("width_m"), n.cast("double").alias("n"), s.alias("source"))


@R.add("b10_class_width", "road", """
SELECT road_id, CAST(CASE WHEN objekt IN ('S-FRW', 'S-STRAIL') THEN 2.5 WHEN objekt IN ('S-F', 'S-GW') THEN 4 WHEN objekt = 'S-G' THEN 5 WHEN objekt IN ('S-BR', 'S-LR', 'S-AR') THEN 3.75
  WHEN str_code = '' THEN 5.5 WHEN regexp_matches(str_code, '^[Bb][0-9]') THEN CASE WHEN road_id % 5 >= 3 THEN (road_id % 5) * 3.75 ELSE 8 END ELSE 6.5 END AS DOUBLE) AS width_m FROM road""")
def b10(road):
    return road.select("road_id", S.class_width(c("objekt"), c("str_code"), (c("road_id") % 5).cast("double")).cast("double").alias("width_m"))


@R.add("b13_structure_kind", "road", """
SELECT road_id, CASE WHEN kunstbauten IS NULL OR kunstbauten = '' THEN NULL WHEN lower(kunstbauten) LIKE '%galerie%' THEN 'gallery' WHEN lower(kunstbauten) LIKE '%tunnel%' OR lower(kunstbauten) LIKE '%unterführung%' THEN 'tunnel'
  WHEN lower(kunstbauten) LIKE '%brücke%' THEN 'bridge' WHEN lower(kunstbauten) LIKE '%durchlass%' THEN 'culvert' ELSE 'structure' END AS kind FROM road""")
def b13(road):
    return road.select("road_id", S.structure_kind(c("kunstbauten")).alias("kind"))


@R.add("b14_predicates", "road", """
SELECT road_id, str_code <> '' OR objekt IN ('S-A', 'S-AR') AS named, objekt IN ('S-BR', 'S-LR', 'S-AR') AS ramp, regexp_matches(str_code, '^[Bb][0-9]') AS federal,
  objekt = 'S-BG' OR (coalesce(lower(kunstbauten), '') LIKE '%galerie%' AND coalesce(lower(kunstbauten), '') NOT LIKE '%tunnel%') AS open_gallery, str_code = '' OR objekt IN ('S-BR', 'S-LR', 'S-AR') AS no_rail FROM road""")
def b14(road):
    kunst = F.coalesce(F.lower("kunstbauten"), F.lit(""))
    ramp = c("objekt").isin("S-BR", "S-LR", "S-AR")
    return road.select("road_id", ((c("str_code") != "") | c("objekt").isin("S-A", "S-AR")).alias("named"), ramp.alias("ramp"), S.is_federal(c("str_code")).alias("federal"),
                       ((c("objekt") == "S-BG") | (kunst.contains("galerie") & ~kunst.contains("tunnel"))).alias("open_gallery"), ((c("str_code") == "") | ramp).alias("no_rail"))


_BAND = "CASE authority WHEN 'tirol' THEN 0 ELSE 10000000 END"


def _interpreted(t):
    level, local, bad = S.interpret_id(c("raw"), F.when(c("authority") == "tirol", 0).otherwise(S.STRIDE))
    return t.select("k", "raw", "authority", level.cast("long").alias("level_id"), local.cast("long").alias("local_id"), bad.alias("foreign_band"))


@R.add("b22_interpret_id", "raw_id", f"""
WITH t AS (SELECT *, {_BAND} AS o FROM raw_id)
SELECT k, raw, authority, CAST(CASE WHEN raw >= o AND raw < o + 10000000 THEN raw WHEN raw < 10000000 THEN o + raw END AS BIGINT) AS level_id,
  CAST(CASE WHEN raw >= o AND raw < o + 10000000 THEN raw - o WHEN raw < 10000000 THEN raw END AS BIGINT) AS local_id, NOT (raw >= o AND raw < o + 10000000 OR raw < 10000000) AS foreign_band FROM t""")
def b22(t):
    return _interpreted(t)


@R.add("b23_stamp", "raw_id", f"""
WITH t AS (SELECT k, authority, raw, {_BAND} AS o FROM raw_id) SELECT k, authority, CAST(o + raw % 10000000 AS BIGINT) AS level_id, CAST(raw % 10000000 AS BIGINT) AS source_id FROM t WHERE raw < 10000000 OR (raw >= o AND raw < o + 10000000)""")
def b23(t):
    return _interpreted(t).where("not foreign_band").select("k", "authority", "level_id", c("local_id").alias("source_id"))


@R.add("b24_validate_band", "raw_id", f"""
WITH t AS (SELECT authority, raw, {_BAND} AS o FROM raw_id) SELECT authority, count(*) AS n, CAST(sum(CASE WHEN raw >= o AND raw < o + 10000000 THEN 0 ELSE 1 END) AS BIGINT) AS outside FROM t GROUP BY 1""")
def b24(t):
    o = F.when(c("authority") == "tirol", 0).otherwise(S.STRIDE)
    return t.groupBy("authority").agg(F.count(F.lit(1)).alias("n"), F.count_if(~((c("raw") >= o) & (c("raw") < o + S.STRIDE))).alias("outside"))


@R.add("b26_heading", "road_node", """
WITH d AS (SELECT road_id, seq, x - lag(x) OVER w AS dx, y - lag(y) OVER w AS dy FROM road_node WINDOW w AS (PARTITION BY road_id ORDER BY seq)),
h AS (SELECT road_id, seq, ((degrees(atan2(dx, dy)) % 180) + 180) % 180 AS h FROM d WHERE dx IS NOT NULL)
SELECT road_id, seq, round(h, 6) + 0.0 AS heading, round(least(abs(h - 30) % 180, 180 - abs(h - 30) % 180), 6) + 0.0 AS off30 FROM h""")
def b26(n):
    from pyspark.sql import Window

    w = Window.partitionBy("road_id").orderBy("seq")
    d = n.select("road_id", "seq", (c("x") - F.lag("x").over(w)).alias("dx"), (c("y") - F.lag("y").over(w)).alias("dy")).where("dx is not null")
    h = S.heading(c("dx"), c("dy"))
    return d.select("road_id", "seq", r6(h).alias("heading"), r6(S.angle_difference(h, F.lit(30.0), 180.0)).alias("off30"))


_LIN = "CASE WHEN {0} / 255.0 <= 0.04045 THEN {0} / 255.0 / 12.92 ELSE pow(({0} / 255.0 + 0.055) / 1.055, 2.4) END".format
_F = "CASE WHEN {0} > 216.0 / 24389.0 THEN pow({0}, 1.0 / 3.0) ELSE (24389.0 / 27.0 * {0} + 16.0) / 116.0 END".format


@R.add("b28_lab", "pixel", f"""
WITH l AS (SELECT red, green, blue, {_LIN('red')} AS lr, {_LIN('green')} AS lg, {_LIN('blue')} AS lb FROM (SELECT DISTINCT red, green, blue FROM pixel)),
x AS (SELECT red, green, blue, (0.4124564 * lr + 0.3575761 * lg + 0.1804375 * lb) / 0.95047 AS x, 0.2126729 * lr + 0.7151522 * lg + 0.0721750 * lb AS y, (0.0193339 * lr + 0.1191920 * lg + 0.9503041 * lb) / 1.08883 AS z FROM l),
f AS (SELECT red, green, blue, {_F('x')} AS fx, {_F('y')} AS fy, {_F('z')} AS fz FROM x)
SELECT red, green, blue, round(116 * fy - 16, 5) + 0.0 AS l, round(500 * (fx - fy), 5) + 0.0 AS a, round(200 * (fy - fz), 5) + 0.0 AS b FROM f""")
def b28(px):
    l, a, b = S.lab(c("red"), c("green"), c("blue"))  # noqa: E741
    return px.select("red", "green", "blue").distinct().select("red", "green", "blue", *((F.round(v, 5) + F.lit(0.0)).alias(n) for v, n in ((l, "l"), (a, "a"), (b, "b"))))


@R.add("b29_road_colour", "pixel", """
SELECT masked, count(*) AS n, CAST(sum(CASE WHEN 0.3 * red + 0.5 * green + 0.2 * blue BETWEEN 65 AND 230 AND (greatest(red, green, blue) - least(red, green, blue)) / greatest(greatest(red, green, blue), 1) < 0.12 THEN 1 ELSE 0 END) AS BIGINT) AS road FROM pixel GROUP BY 1""")
def b29(px):
    return px.groupBy("masked").agg(F.count(F.lit(1)).alias("n"), F.count_if(S.road_colour(c("red"), c("green"), c("blue"))).alias("road"))


@R.add("b30_green", "pixel", """
SELECT masked, round(avg(greatest(0, least(1, (green / greatest(red + green + blue, 1) - 1.0 / 3) / 0.03))), 6) AS strong, round(avg(greatest(0, least(1, (green / greatest(red + green + blue, 1) + 0.010) / 0.075))), 6) AS soft FROM pixel GROUP BY 1""")
def b30(px):
    rgb = (c("red"), c("green"), c("blue"))
    return px.groupBy("masked").agg(F.round(F.avg(S.green_weight(*rgb)), 6).alias("strong"), F.round(F.avg(S.green_weight(*rgb, -0.010, 0.075)), 6).alias("soft"))


@R.add("b34_bridge_claim", "road", """
WITH t AS (SELECT road_id, objekt, NOT objekt IN ('S-AT', 'S-BT', 'S-LT', 'S-BG') AND (objekt IN ('S-AB', 'S-BB', 'S-LB') OR coalesce(lower(kunstbauten) LIKE '%brücke%', false)) AS claim FROM road)
SELECT road_id, claim, CASE WHEN claim THEN CASE objekt WHEN 'S-A' THEN 'S-AB' WHEN 'S-B' THEN 'S-BB' WHEN 'S-L' THEN 'S-LB' ELSE objekt END
  ELSE CASE objekt WHEN 'S-AB' THEN 'S-A' WHEN 'S-BB' THEN 'S-B' WHEN 'S-LB' THEN 'S-L' ELSE objekt END END AS corrected FROM t""")
def b34(road):
    claim = S.claims_bridge(c("objekt"), c("kunstbauten"))
    return road.select("road_id", claim.alias("claim"), S.corrected_objekt(c("objekt"), claim).alias("corrected"))


@R.add("b35_bed_rank", "road", """
SELECT road_id, CAST(CASE WHEN str_code LIKE 'A%' THEN 4 WHEN regexp_matches(str_code, '^B[0-9]') THEN 3 WHEN str_code LIKE 'L%' THEN 2 ELSE 0 END AS BIGINT) AS rank FROM road""")
def b35(road):
    return road.select("road_id", S.bed_rank(c("str_code"), F.lit(None).cast("string")).cast("long").alias("rank"))


@R.add("b33_normal", "cells", """
WITH g AS (SELECT r, c, (c - 50) / 200.0 AS g, (r % 21 - 10) / 100.0 AS k FROM cells)
SELECT r, c, round(-g / sqrt(1 + g*g + k*k*0 + (1+g*g)*0) * 1 / sqrt(1 + k*k) / sqrt((g*g + k*k + 1) / ((1 + g*g) * (1 + k*k))), 6) + 0.0 AS nx,
  round(k / sqrt(g*g + k*k + 1), 6) + 0.0 AS ny, round(1 / sqrt(g*g + k*k + 1), 6) + 0.0 AS nz FROM g""")
def b33(cells):
    x, y, z = S.normal((c("c") - 50) / 200.0, (c("r") % 21 - 10) / 100.0)
    return cells.select("r", "c", r6(x).alias("nx"), r6(y).alias("ny"), r6(z).alias("nz"))


@R.add("b36_step", "cells", """
SELECT r, c, round(CASE WHEN c <= 10 THEN 1.0 WHEN c <= 15 THEN 2.0 WHEN c < 40 THEN 2.0 + (c - 15) / 25.0 * (4.0 - 2.0) ELSE 4.0 END, 6) + 0.0 AS step FROM cells""")
def b36(cells):
    return cells.select("r", "c", r6(S.step_for_radius(c("c").cast("double"), 4.0)).alias("step"))


@R.add("b38_box_distance", "road_node", """
WITH d AS (SELECT road_id, seq, sqrt(pow(greatest(100 - x, 0, x - 600), 2) + pow(greatest(50 - y, 0, y - 300), 2)) AS d FROM road_node)
SELECT road_id, seq, round(d, 6) + 0.0 AS d, round(greatest(0, least(1, 1 - d / 80)), 6) + 0.0 AS weight FROM d""")
def b38(n):
    d = S.box_distance(c("x"), c("y"), 100.0, 50.0, 600.0, 300.0)
    return n.select("road_id", "seq", r6(d).alias("d"), r6(S.clip(1 - d / 80, 0.0, 1.0)).alias("weight"))


@R.add("b32_nearest_palette", "pixel", """
WITH d AS (SELECT DISTINCT red, green, blue FROM pixel),
p AS (SELECT red, green, blue, k, pow(red - pr, 2) + pow(green - pg, 2) + pow(blue - pb, 2) AS d FROM d, (VALUES (0, 200, 180, 160), (1, 120, 60, 50), (2, 90, 90, 95)) v(k, pr, pg, pb))
SELECT red, green, blue, CAST(arg_min(k, d * 10 + k) AS BIGINT) AS palette FROM p GROUP BY 1, 2, 3""")
def b32(px):
    palette = [(0, 200, 180, 160), (1, 120, 60, 50), (2, 90, 90, 95)]
    options = F.array(*(F.struct(((c("red") - r) * (c("red") - r) + (c("green") - g) * (c("green") - g) + (c("blue") - b) * (c("blue") - b)).alias("d"), F.lit(k).cast("long").alias("k")) for k, r, g, b in palette))
    return px.select("red", "green", "blue").distinct().select("red", "green", "blue", F.array_min(options)["k"].alias("palette"))
