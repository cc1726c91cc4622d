"""Queries of feature attributes: text repair, overrides, way lists, class tables, id ranges, predicates, styles, samples."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from hillframe.functions import scalars as S

from .registry import Registry

R = Registry()
QUERIES, ORACLES = R.queries, R.oracles
c = F.col
r6 = S.r6


def repaired(text):
    """UTF-8 that was read as Latin-1, decoded again where that is possible and leaves no such mark; else as it is."""
    again = F.try_validate_utf8(F.encode(text, "ISO-8859-1").cast("string"))
    fixed = F.when(text.rlike("^[\\u0000-\\u00ff]*$"), again)
    return F.when(fixed.isNotNull() & (((fixed != text) & ~fixed.contains("Ã")) | text.contains("Ã") | text.contains("Â")), fixed).otherwise(text)


@R.add("a8_text_repair", "label", """
WITH b AS (SELECT id, name, CASE WHEN regexp_full_match(name, '[\\x{00}-\\x{ff}]*') THEN TRY(decode(unhex(list_aggregate(list_transform(string_split(name, ''), lambda x: printf('%02x', unicode(x))), 'string_agg', '')))) END AS fixed FROM label)
SELECT id, CASE WHEN fixed IS NOT NULL AND ((fixed <> name AND NOT contains(fixed, 'Ã')) OR contains(name, 'Ã') OR contains(name, 'Â')) THEN fixed ELSE name END AS name FROM b""")
def a8(label):
    return label.select("id", repaired(c("name")).alias("name"))


_EXTRA = """extra AS (SELECT objectid, CASE WHEN authority = 'tirol' THEN 'bridge' WHEN y < 20 THEN 'gallery' ELSE 'tunnel' END AS kind, CASE WHEN x < 10 THEN 'Name ' || CAST(objectid AS VARCHAR) END AS name FROM road_end),
lab AS (SELECT objectid, kind, coalesce(name, CASE kind WHEN 'bridge' THEN 'Brücke ' WHEN 'gallery' THEN 'Galerie ' WHEN 'tunnel' THEN 'Tunnel ' ELSE kind || ' ' END || CAST(objectid AS VARCHAR)) AS label FROM extra)"""


@R.add("a9_override_merge", "road road_end", f"""
WITH {_EXTRA}, present AS (SELECT * FROM road WHERE str_code <> '')
SELECT road_id, coalesce(label, kunstbauten) AS kunstbauten, kind AS extra_kind, CASE WHEN label IS NULL THEN 'kept' ELSE 'labelled' END AS state FROM present LEFT JOIN lab ON objectid = road_id
UNION ALL SELECT objectid, label, kind, CASE WHEN r.road_id IS NULL THEN 'unknown' ELSE 'appended' END FROM lab LEFT JOIN road r ON objectid = r.road_id WHERE objectid NOT IN (SELECT road_id FROM present)""")
def a9(road, road_end):
    kind = F.when(c("authority") == "tirol", "bridge").when(c("y") < 20, "gallery").otherwise("tunnel")
    title = F.when(c("kind") == "bridge", "Brücke ").when(c("kind") == "gallery", "Galerie ").when(c("kind") == "tunnel", "Tunnel ").otherwise(F.concat("kind", F.lit(" ")))
    given = F.when(c("x") < 10, F.concat(F.lit("Name "), c("objectid").cast("string")))
    extra = road_end.withColumn("kind", kind).select("objectid", "kind", F.coalesce(given, F.concat(title, c("objectid").cast("string"))).alias("label"))
    present = road.where("str_code <> ''")
    merged = present.join(extra, c("objectid") == c("road_id"), "left").select("road_id", F.coalesce("label", "kunstbauten").alias("kunstbauten"), c("kind").alias("extra_kind"), F.when(c("label").isNull(), "kept").otherwise("labelled").alias("state"))
    absent = extra.join(present.select(c("road_id").alias("objectid")), "objectid", "left_anti").join(road.select("road_id"), c("objectid") == c("road_id"), "left")
    return merged.unionByName(absent.select(c("objectid").alias("road_id"), c("label").alias("kunstbauten"), c("kind").alias("extra_kind"), F.when(c("road_id").isNull(), "unknown").otherwise("appended").alias("state")))


@R.add("a13_way_lines", "element", """
SELECT CAST(json_extract_string(body, '$.id') AS BIGINT) AS osm_id, json_extract_string(body, '$.tags.highway') AS highway, json_extract_string(body, '$.tags.width') AS width, json_extract_string(body, '$.tags.sac') AS sac,
  CAST(json_array_length(body, '$.geometry') AS BIGINT) AS n, CAST(json_extract_string(body, '$.geometry[0].lon') AS DOUBLE) AS lon0, CAST(json_extract_string(body, '$.geometry[1].lat') AS DOUBLE) AS lat1
FROM element WHERE json_extract_string(body, '$.type') = 'way' AND json_array_length(body, '$.geometry') >= 2""")
def a13(element):
    e = element.select(F.from_json("body", "type string, id long, geometry array<struct<lon double, lat double>>, tags map<string, string>").alias("e")).select("e.*")
    return e.where((c("type") == "way") & (F.size("geometry") >= 2)).select(
        c("id").alias("osm_id"), *(F.try_element_at("tags", F.lit(k)).alias(k) for k in ("highway", "width", "sac")), F.size("geometry").cast("long").alias("n"), c("geometry")[0]["lon"].alias("lon0"), c("geometry")[1]["lat"].alias("lat1")
    )


@R.add("a14_road_extract", "road_node road", """
WITH v AS (SELECT n.* FROM road_node n JOIN road USING (road_id) WHERE objekt IN ('S-B', 'S-L', 'S-G') AND x BETWEEN 200 - 50 AND 500 + 50 AND y BETWEEN 60 - 50 AND 240 + 50)
SELECT road_id, count(*) AS n, min(seq) AS first, max(seq) AS last, arg_min(x, seq) AS x0, arg_max(y, seq) AS y1, max(w) AS width FROM v GROUP BY 1 HAVING count(*) >= 2""")
def a14(n, road):
    v = n.join(road.where(c("objekt").isin("S-B", "S-L", "S-G")).select("road_id"), "road_id").where(c("x").between(200 - 50, 500 + 50) & c("y").between(60 - 50, 240 + 50))
    line = v.groupBy("road_id").agg(F.array_sort(F.collect_list(F.struct("seq", "x", "y"))).alias("line"), F.max("w").alias("width")).where(F.size("line") >= 2)
    last = F.element_at("line", -1)
    return line.select("road_id", F.size("line").cast("long").alias("n"), c("line")[0]["seq"].alias("first"), last["seq"].alias("last"), c("line")[0]["x"].alias("x0"), last["y"].alias("y1"), "width")


@R.add("a24_scene_order", "file", """
WITH s AS (SELECT tile, path, coalesce(nullif(regexp_extract(path, '_([0-9]{8}T[0-9]{6})_', 1), ''), path) AS token FROM file WHERE path LIKE '%\\_FSCOG.tif' ESCAPE '\\')
SELECT tile, path, token, row_number() OVER (PARTITION BY tile ORDER BY token, path) AS place FROM s""")
def a24(file):
    token = F.regexp_extract("path", "_(\\d{8}T\\d{6})_", 1)
    s = file.where(c("path").endswith("_FSCOG.tif")).withColumn("token", F.coalesce(F.nullif(token, F.lit("")), "path"))
    return s.withColumn("place", F.row_number().over(Window.partitionBy("tile").orderBy("token", "path")).cast("long")).select("tile", "path", "token", "place")


@R.add("b15_landuse_kind", "landuse_row", """
WITH t AS (SELECT id, lower(coalesce(klasse, '')) AS k, upper(coalesce(objekt, '')) AS o, lower(coalesce(bez, '')) AS b FROM landuse_row)
SELECT id, CASE WHEN o LIKE 'LN-G%' OR b LIKE '%gewässer%' OR b LIKE '%gewasser%' THEN CASE WHEN k LIKE '%stehend%' OR o = 'LN-GWS' THEN 'water_standing' ELSE 'water_flowing' END
  WHEN k LIKE '%straße%' OR k LIKE '%strasse%' OR k LIKE '%weg%' OR o LIKE 'LN-V%' THEN 'road'
  WHEN o LIKE 'LN-S%' OR b LIKE '%siedlung%' OR k LIKE '%anwesen%' OR k LIKE '%industrie%' OR k LIKE '%gewerbe%' OR k LIKE '%wohn%' THEN 'settlement'
  WHEN k LIKE '%hochwald%' OR o = 'LN-WHW' THEN 'forest_high' WHEN k LIKE '%strauch%' OR k LIKE '%krumm%' OR o = 'LN-WST' THEN 'forest_scrub'
  WHEN k LIKE '%alm%' OR b LIKE '%extensiv%' OR k LIKE '%grünland%' OR k LIKE '%gruenland%' THEN 'meadow' WHEN b LIKE '%wald%' OR o LIKE 'LN-W%' THEN 'forest_scrub' END AS kind,
  CASE WHEN o = 'WHOCH' OR b = 'hochwald' THEN 'forest_high' WHEN o = 'WSTRAU' OR b LIKE '%strauch%' OR b LIKE '%krumm%' THEN 'forest_scrub' WHEN b LIKE '%wald%' THEN 'forest_high' END AS forest FROM t""")
def b15(t):
    k, o, b = F.lower(F.coalesce("klasse", F.lit(""))), F.upper(F.coalesce("objekt", F.lit(""))), F.lower(F.coalesce("bez", F.lit("")))

    def has(text, *words):
        found = F.lit(False)
        for w in words:
            found = found | text.contains(w)
        return found

    kind = (
        F.when(o.startswith("LN-G") | has(b, "gewässer", "gewasser"), F.when(has(k, "stehend") | (o == "LN-GWS"), "water_standing").otherwise("water_flowing"))
        .when(has(k, "straße", "strasse", "weg") | o.startswith("LN-V"), "road")
        .when(o.startswith("LN-S") | has(b, "siedlung") | has(k, "anwesen", "industrie", "gewerbe", "wohn"), "settlement")
        .when(has(k, "hochwald") | (o == "LN-WHW"), "forest_high")
        .when(has(k, "strauch", "krumm") | (o == "LN-WST"), "forest_scrub")
        .when(has(k, "alm", "grünland", "gruenland") | has(b, "extensiv"), "meadow")
        .when(has(b, "wald") | o.startswith("LN-W"), "forest_scrub")
    )
    forest = F.when((o == "WHOCH") | (b == "hochwald"), "forest_high").when((o == "WSTRAU") | has(b, "strauch", "krumm"), "forest_scrub").when(has(b, "wald"), "forest_high")
    return t.select("id", kind.alias("kind"), forest.alias("forest"))


@R.add("b17_class_table", "landuse_row", """
WITH m AS (SELECT * FROM (VALUES ('tirol', 'alm', 'meadow'), ('tirol', 'wohnen', 'settlement'), ('tirol', 'ln-whw', 'forest_high'), ('suedtirol', 'krummholz', 'forest_scrub'), ('suedtirol', 'siedlung', 'settlement'), ('suedtirol', 'ln-gws', 'water_standing')) v(a, value, kind))
SELECT id, coalesce(m1.kind, m2.kind, m3.kind) AS kind FROM landuse_row l LEFT JOIN m m1 ON m1.a = authority AND m1.value = lower(trim(klasse)) LEFT JOIN m m2 ON m2.a = authority AND m2.value = lower(trim(objekt)) LEFT JOIN m m3 ON m3.a = authority AND m3.value = lower(trim(bez))""")
def b17(t):
    table = {"tirol": {"alm": "meadow", "wohnen": "settlement", "ln-whw": "forest_high"}, "suedtirol": {"krummholz": "forest_scrub", "siedlung": "settlement", "ln-gws": "water_standing"}}
    maps = F.create_map(*(x for a, m in table.items() for x in (F.lit(a), F.create_map(*(F.lit(v) for kv in m.items() for v in kv)))))
    own = F.coalesce(F.try_element_at(maps, c("authority")), F.raise_error(F.lit("an authority without a class table")))
    return t.withColumn("own", own).select("id", F.coalesce(*(F.try_element_at("own", F.lower(F.trim(x))) for x in ("klasse", "objekt", "bez"))).alias("kind"))


def id_set(token):
    """The ids of a token: a range of whole numbers in either order, or the token itself; nothing for null and blank."""
    a, b = (F.regexp_extract(token, "^\\s*(-?\\d+)\\s*(?:-|\\.\\.)\\s*(-?\\d+)\\s*$", i) for i in (1, 2))
    lo, hi = F.least(a.cast("long"), b.cast("long")), F.greatest(a.cast("long"), b.cast("long"))
    return F.when(a != "", F.transform(F.sequence(lo, hi), lambda x: x.cast("string"))).when(F.trim(token) != "", F.array(F.trim(token))).otherwise(F.array().cast("array<string>"))


@R.add("b18_id_ranges", "id_token", """
WITH t AS (SELECT k, token, regexp_extract(token, '^\\s*(-?\\d+)\\s*(?:-|\\.\\.)\\s*(-?\\d+)\\s*$', 1) AS a, regexp_extract(token, '^\\s*(-?\\d+)\\s*(?:-|\\.\\.)\\s*(-?\\d+)\\s*$', 2) AS b FROM id_token)
SELECT k, CAST(unnest(generate_series(least(CAST(a AS BIGINT), CAST(b AS BIGINT)), greatest(CAST(a AS BIGINT), CAST(b AS BIGINT)))) AS VARCHAR) AS id FROM t WHERE a <> '' UNION ALL SELECT k, trim(token) FROM t WHERE a = '' AND trim(token) <> ''""")
def b18(t):
    return t.select("k", F.explode(id_set(c("token"))).alias("id"))


def holds(predicate, value):
    """Whether a number meets '>2', '>=3', '!=1', '7' and the like; null numbers and odd predicates don't."""
    op, n = (F.regexp_extract(predicate, "^\\s*(>=|<=|!=|==|=|>|<)?\\s*([+-]?\\d+(?:\\.\\d+)?)\\s*$", i) for i in (1, 2))
    n = F.nullif(n, F.lit("")).cast("double")
    met = F.when(op == ">", value > n).when(op == ">=", value >= n).when(op == "<", value < n).when(op == "<=", value <= n).when(op == "!=", value != n).otherwise(value == n)
    return F.coalesce(met, F.lit(False))


@R.add("b19_predicate", "id_token", """
WITH t AS (SELECT *, regexp_extract(predicate, '^\\s*(>=|<=|!=|==|=|>|<)?\\s*([+-]?\\d+(?:\\.\\d+)?)\\s*$', 1) AS op, try_cast(regexp_extract(predicate, '^\\s*(>=|<=|!=|==|=|>|<)?\\s*([+-]?\\d+(?:\\.\\d+)?)\\s*$', 2) AS DOUBLE) AS n FROM id_token)
SELECT k, coalesce(CASE op WHEN '>' THEN value > n WHEN '>=' THEN value >= n WHEN '<' THEN value < n WHEN '<=' THEN value <= n WHEN '!=' THEN value <> n ELSE value = n END, false) AS met FROM t""")
def b19(t):
    return t.select("k", holds(c("predicate"), c("value")).alias("met"))


#: Names of the two styles (fixed values).
POSTS = ("posts", "post", "leitpoller", "delineator", "markers", "marker")
SECTIONS = ("sections", "section", "rail", "rails", "guardrail", "planke", "wbeam")
BOTH = ("both", "all", "posts+sections", "sections+posts", "mixed")


def _listed(words):
    return ", ".join(f"'{w}'" for w in words)


@R.add("b20_styles", "id_token", f"""
WITH t AS (SELECT k, i, lower(trim(w)) AS w FROM (SELECT k, unnest(generate_series(1, len(string_split(coalesce(styles, 'posts'), ',')))) AS i, unnest(string_split(coalesce(styles, 'posts'), ',')) AS w FROM id_token)),
s AS (SELECT k, i * 2 AS o, 'posts' AS s FROM t WHERE w IN ({_listed(POSTS + BOTH)}) UNION ALL SELECT k, i * 2 + 1, 'sections' FROM t WHERE w IN ({_listed(SECTIONS + BOTH)})),
f AS (SELECT k, s, min(o) AS o FROM s GROUP BY 1, 2), g AS (SELECT k, string_agg(s, ',' ORDER BY o) AS styles FROM f GROUP BY 1)
SELECT k, coalesce(g.styles, 'posts') AS styles FROM id_token LEFT JOIN g USING (k)""")
def b20(t):
    words = F.transform(F.split(F.coalesce("styles", F.lit("posts")), ","), lambda w: F.lower(F.trim(w)))
    none = F.array().cast("array<string>")
    each = F.transform(words, lambda w: F.when(w.isin(*BOTH), F.array(F.lit("posts"), F.lit("sections"))).when(w.isin(*POSTS), F.array(F.lit("posts"))).when(w.isin(*SECTIONS), F.array(F.lit("sections"))).otherwise(none))
    found = F.array_join(F.array_distinct(F.flatten(each)), ",")
    return t.select("k", F.coalesce(F.nullif(found, F.lit("")), F.lit("posts")).alias("styles"))


@R.add("b21_id_band", "raw_id", """
WITH u AS (SELECT authority, min(CAST(floor(raw / 10000000) AS BIGINT)) * 10000000 AS "offset" FROM raw_id GROUP BY 1), used AS (SELECT DISTINCT CAST(floor(raw / 10000000) AS BIGINT) * 10000000 AS o FROM raw_id),
n AS (SELECT min(i * 10000000) AS nxt FROM (SELECT unnest(generate_series(0, (SELECT count(*) FROM used))) AS i) WHERE i * 10000000 NOT IN (SELECT o FROM used))
SELECT authority, "offset", CAST(10000000 AS BIGINT) AS stride, CAST(nxt AS BIGINT) AS next_free FROM u, n""")
def b21(t):
    stride = 10_000_000
    band = (F.floor(c("raw") / stride) * stride).cast("long")
    used = t.select(band.alias("o")).distinct()
    free = used.agg(F.count(F.lit(1)).alias("n")).select(F.explode(F.sequence(F.lit(0).cast("long"), c("n"))).alias("i")).select((c("i") * stride).alias("o")).join(used, "o", "left_anti").agg(F.min("o").alias("next_free"))
    own = t.groupBy("authority").agg(F.min(band).alias("offset"))
    return own.join(F.broadcast(free)).select("authority", "offset", F.lit(stride).cast("long").alias("stride"), "next_free")


#: Building types and name parts that make a building special (fixed values).
SPECIAL_TYPES = ("church", "chapel", "cathedral", "mosque", "synagogue", "hotel")
SPECIAL_NAME = ("hotel", "kirche", "stift", "pfarr", "kloster")


@R.add("b27_roof_bins", "building label", f"""
WITH t AS (SELECT way_id, building, lower(coalesce(name, '')) AS n, way_id * 7.0 AS area, CAST(way_id AS DOUBLE) / 5 AS pitch, CAST(way_id AS DOUBLE) / 9 AS h FROM building JOIN label ON id = way_id)
SELECT way_id, CAST(CASE WHEN pitch < 8 THEN 0 WHEN abs(20 - pitch) <= abs(30 - pitch) AND abs(20 - pitch) <= abs(40 - pitch) THEN 20 WHEN abs(30 - pitch) <= abs(40 - pitch) THEN 30 ELSE 40 END AS BIGINT) AS pitch_bin,
  CAST(greatest(1, least(6, round_even(h / 3, 0))) AS BIGINT) AS storeys, coalesce(lower(building) IN ({_listed(SPECIAL_TYPES)}), false) OR area >= 1800 OR regexp_matches(n, '{"|".join(SPECIAL_NAME)}') AS special FROM t""")
def b27(building, label):
    t = building.join(label, c("id") == c("way_id")).select("way_id", "building", F.lower(F.coalesce("name", F.lit(""))).alias("n"), (c("way_id") * 7.0).alias("area"), (c("way_id") / 5.0).alias("pitch"), (c("way_id") / 9.0).alias("h"))
    nearest = F.array_min(F.array(*(F.struct(F.abs(b - c("pitch")).alias("d"), F.lit(b).cast("long").alias("b")) for b in (20, 30, 40))))["b"]
    special = F.coalesce(F.lower("building").isin(*SPECIAL_TYPES), F.lit(False)) | (c("area") >= 1800) | c("n").rlike("|".join(SPECIAL_NAME))
    return t.select("way_id", F.when(c("pitch") < 8, F.lit(0).cast("long")).otherwise(nearest).alias("pitch_bin"), F.greatest(F.lit(1), F.least(F.lit(6), F.bround(c("h") / 3))).cast("long").alias("storeys"), special.alias("special"))


_CLAUSES = """rules AS (SELECT * FROM (VALUES (1, NULL, 'B%', NULL, 'posts', 25.0), (2, 'S-G', NULL, NULL, 'sections', NULL), (3, NULL, NULL, '%brücke%', NULL, 10.0), (4, 'S-L', 'L%', NULL, 'both', 50.0)) v(ord, objekt, code, built, styles, spacing))"""


@R.add("c16_rule_cascade", "road", f"""
WITH {_CLAUSES}, m AS (SELECT road_id, ord, styles, spacing FROM road r JOIN rules u ON (u.objekt IS NULL OR r.objekt = u.objekt) AND (u.code IS NULL OR r.str_code LIKE u.code) AND (u.built IS NULL OR lower(r.kunstbauten) LIKE u.built))
SELECT road_id, count(*) AS n_rules, arg_max(styles, ord) AS styles, arg_max(spacing, ord) AS spacing FROM m GROUP BY 1""")
def c16(road):
    rules = [(1, None, "B%", None, "posts", 25.0), (2, "S-G", None, None, "sections", None), (3, None, None, "%brücke%", None, 10.0), (4, "S-L", "L%", None, "both", 50.0)]
    # the rules are a short list given by the caller: one pass over the roads, no join
    met = []
    for ord_, objekt, code, built, styles, spacing in rules:
        ok = F.lit(True)
        ok = ok & (c("objekt") == objekt) if objekt else ok
        ok = ok & c("str_code").like(code) if code else ok
        ok = ok & F.lower("kunstbauten").like(built) if built else ok
        met.append(F.when(F.coalesce(ok, F.lit(False)), F.struct(F.lit(ord_).alias("ord"), F.lit(styles).cast("string").alias("styles"), F.lit(spacing).cast("double").alias("spacing"))))
    t = road.withColumn("met", F.array_compact(F.array(*met))).where(F.size("met") > 0)
    last = lambda key: F.element_at(F.filter("met", lambda m: m[key].isNotNull()), -1)[key]
    some = lambda key: F.when(F.exists("met", lambda m: m[key].isNotNull()), last(key))
    return t.select("road_id", F.size("met").cast("long").alias("n_rules"), some("styles").alias("styles"), some("spacing").alias("spacing"))


@R.add("c37_source_priority", "cells", """
WITH t AS (SELECT r, code <= 5 AS valid, code <= 1 AS forest, rock OR (code = 6 AND coalesce(dom - z, 0) >= 1) AS other FROM cells)
SELECT r, count(*) AS n, avg(CASE WHEN (valid AND forest) OR (NOT valid AND other) THEN 1.0 ELSE 0.0 END) AS combined, avg(CASE WHEN valid AND forest THEN 1.0 ELSE 0.0 END) AS prime, avg(CASE WHEN other THEN 1.0 ELSE 0.0 END) AS secondary FROM t GROUP BY 1""")
def c37(cells):
    valid, forest, other = c("code") <= 5, c("code") <= 1, c("rock") | ((c("code") == 6) & (F.coalesce(c("dom") - c("z"), F.lit(0.0)) >= 1))
    share = lambda x: F.avg(x.cast("double"))
    return cells.groupBy("r").agg(F.count(F.lit(1)).alias("n"), share((valid & forest) | (~valid & other)).alias("combined"), share(valid & forest).alias("prime"), share(other).alias("secondary"))


@R.add("e23_top_of_group", "road_node road", """
WITH l AS (SELECT objekt, road_id, round(sum(d), 6) + 0.0 AS len FROM (SELECT road_id, sqrt(pow(x - lag(x) OVER q, 2) + pow(y - lag(y) OVER q, 2)) AS d FROM road_node WINDOW q AS (PARTITION BY road_id ORDER BY seq)) JOIN road USING (road_id) GROUP BY 1, 2)
SELECT objekt, road_id, len, place FROM (SELECT *, row_number() OVER (PARTITION BY objekt ORDER BY len DESC, road_id) AS place FROM l) WHERE place <= 8""")
def e23(n, road):
    q = Window.partitionBy("road_id").orderBy("seq")
    d = n.select("road_id", F.hypot(c("x") - F.lag("x").over(q), c("y") - F.lag("y").over(q)).alias("d"))
    length = d.groupBy("road_id").agg(r6(F.sum("d")).alias("len")).join(road.select("road_id", "objekt"), "road_id")
    return length.withColumn("place", F.row_number().over(Window.partitionBy("objekt").orderBy(F.desc("len"), "road_id")).cast("long")).where("place <= 8").select("objekt", "road_id", "len", "place")


@R.add("i1_nearest_k", "road_end road_node", """
WITH p AS (SELECT objectid, road_id, min(sqrt(pow(e.x - n.x, 2) + pow(e.y - n.y, 2))) AS d FROM road_end e JOIN road_node n ON n.x BETWEEN e.x - 40 AND e.x + 40 AND n.y BETWEEN e.y - 40 AND e.y + 40 GROUP BY 1, 2)
SELECT objectid, road_id, round(d, 6) + 0.0 AS d, place FROM (SELECT *, row_number() OVER (PARTITION BY objectid ORDER BY d, road_id) AS place FROM p WHERE d <= 40) WHERE place <= 8""")
def i1(ends, n):
    reach = 40.0
    near = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1))))
    e = ends.select("objectid", c("x").alias("ex"), c("y").alias("ey"), near.alias("s")).select("objectid", "ex", "ey", (F.floor(c("ex") / reach) + c("s.i")).alias("gx"), (F.floor(c("ey") / reach) + c("s.j")).alias("gy"))
    p = e.join(n.select("road_id", "x", "y", F.floor(c("x") / reach).alias("gx"), F.floor(c("y") / reach).alias("gy")), ["gx", "gy"])
    d = p.withColumn("d", F.hypot(c("ex") - c("x"), c("ey") - c("y"))).where(c("d") <= reach).groupBy("objectid", "road_id").agg(F.min("d").alias("d"))
    return d.withColumn("place", F.row_number().over(Window.partitionBy("objectid").orderBy("d", "road_id")).cast("long")).where("place <= 8").select("objectid", "road_id", r6(c("d")).alias("d"), "place")


@R.add("i6_random_sample", "cells", """
SELECT r, c, code FROM cells WHERE rock ORDER BY md5('7/' || CAST(r AS VARCHAR) || '/' || CAST(c AS VARCHAR)), r, c LIMIT 500""")
def i6(cells):
    seeded = F.md5(F.concat_ws("/", F.lit("7"), c("r").cast("string"), c("c").cast("string")))
    return cells.where("rock").orderBy(seeded, "r", "c").limit(500).select("r", "c", "code")
