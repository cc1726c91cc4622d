"""Queries of scans, gates, merges, set operations and rankings."""

from pyspark.sql import functions as F

from hillframe.functions.scalars import r6
from hillframe.sources import tables as T

from .registry import Registry

R = Registry()
QUERIES, ORACLES = R.queries, R.oracles
c = F.col


@R.add("a1_tile_grid", "cells", """
WITH s AS (SELECT max(r) + 500 AS h, max(c) + 201 AS w FROM cells)
SELECT CAST(i AS BIGINT) AS row0, CAST(j AS BIGINT) AS col0, CAST(least(64, h - i) AS BIGINT) AS rows, CAST(least(64, w - j) AS BIGINT) AS cols
FROM (SELECT h, w, unnest(range(0, h, 64)) AS i FROM s) a, LATERAL (SELECT unnest(range(0, a.w, 64)) AS j) b""")
def a1(cells):
    return T.tile_grid(cells.agg((F.max("r") + 500).alias("height"), (F.max("c") + 201).alias("width")), 64)


@R.add("a2_tile_gate", "attempt", """
SELECT tile, attempt, CASE WHEN nodata_share <= 0.3 THEN 'complete' WHEN nodata_share >= 0.999 THEN 'outside' ELSE 'incomplete' END AS state FROM attempt""")
def a2(t):
    return t.select("tile", "attempt", T.tile_state(c("nodata_share"), 0.3, True).alias("state"))


@R.add("a3_mosaic", "attempt", """
SELECT tile, max(attempt) FILTER (nodata_share <= 0.3) AS attempt, arg_max(nodata_share, attempt) FILTER (nodata_share <= 0.3) AS nodata_share, count(*) AS attempts, count(*) FILTER (NOT nodata_share <= 0.3) AS failed FROM attempt GROUP BY 1""")
def a3(t):
    return T.latest_complete(t, 0.3)


@R.add("a4_completeness", "cells", """
SELECT CAST(floor(r / 10) AS BIGINT) AS tile, round(avg(CASE WHEN z IS NULL THEN 1.0 ELSE 0.0 END), 6) AS share, CASE WHEN avg(CASE WHEN z IS NULL THEN 1.0 ELSE 0.0 END) <= 0.01 THEN 'OK' WHEN avg(CASE WHEN z IS NULL THEN 1.0 ELSE 0.0 END) <= 0.011 THEN 'warn' ELSE 'fail' END AS state FROM cells GROUP BY 1""")
def a4(cells):
    t = cells.groupBy(F.floor(c("r") / 10).alias("tile")).agg(F.avg(c("z").isNull().cast("double")).alias("s"))
    return t.select("tile", F.round("s", 6).alias("share"), F.when(c("s") <= 0.01, "OK").when(c("s") <= 0.011, "warn").otherwise("fail").alias("state"))


@R.add("a5_dedupe", "run", """
WITH k AS (SELECT CASE WHEN site % 5 = 0 THEN NULL ELSE site END AS id, step, event_id FROM run)
SELECT id, arg_max(step, event_id) AS step, max(event_id) AS event_id, min(event_id) AS place FROM k WHERE id IS NOT NULL GROUP BY 1 UNION ALL SELECT id, step, event_id, event_id FROM k WHERE id IS NULL""")
def a5(t):
    return T.last_of_each(t.select(F.when(c("site") % 5 != 0, c("site")).alias("id"), "step", "event_id"), "id", "event_id")


@R.add("a6_clip", "ring", "SELECT poly_id, seq, x, y FROM ring WHERE poly_id IN (SELECT poly_id FROM ring WHERE x BETWEEN 20 AND 60 AND y BETWEEN -70 AND -30)")
def a6(ring):
    return T.clip_any_vertex(ring.select("poly_id", "seq", "x", "y"), "poly_id", (20.0, -70.0, 60.0, -30.0))


@R.add("a7_attribute_scan", "road", "SELECT road_id, objekt, str_code FROM road WHERE str_code IN ('B179', 'L13')")
def a7(road):
    return road.where(c("str_code").isin("B179", "L13")).select("road_id", "objekt", "str_code")


@R.add("a10_inventory", "road", "SELECT str_code, objekt, count(*) AS n, count(kunstbauten) AS structures, count(*) FILTER (str_code <> 'B179') AS on_side FROM road GROUP BY GROUPING SETS ((str_code), (objekt), ())")
def a10(road):
    one = lambda *g: road.groupBy(*g).agg(F.count(F.lit(1)).alias("n"), F.count("kunstbauten").alias("structures"), F.count_if(c("str_code") != "B179").alias("on_side"))
    return one("str_code").unionByName(one("objekt"), allowMissingColumns=True).unionByName(one(), allowMissingColumns=True)


@R.add("a11_native_metres", "road_node", "SELECT max(abs(x)) > 180 OR max(abs(y)) > 90 AS projected FROM road_node")
def a11(n):
    return n.agg(((F.max(F.abs("x")) > 180) | (F.max(F.abs("y")) > 90)).alias("projected"))


@R.add("a12_content_key", "road", "SELECT road_id, substr(sha1(concat_ws('|', road_id, objekt, str_code)), 1, 12) AS key FROM road")
def a12(road):
    return road.select("road_id", T.content_key(c("road_id").cast("string"), c("objekt"), c("str_code")).alias("key"))


@R.add("a17_manifest", "layer", """
WITH m AS (SELECT name, part, count(*) AS cells FROM layer WHERE weight >= 0.3 GROUP BY 1, 2), u AS (SELECT name, part, count(*) AS cells FROM layer WHERE v > 1020 AND name <> 'water' GROUP BY 1, 2)
SELECT * FROM m WHERE (name, part) NOT IN (SELECT (name, part) FROM u) UNION ALL SELECT * FROM u""")
def a17(layer):
    m = layer.where("weight >= 0.3").groupBy("name", "part").agg(F.count(F.lit(1)).alias("cells"))
    u = layer.where("v > 1020 and name <> 'water'").groupBy("name", "part").agg(F.count(F.lit(1)).alias("cells"))
    return T.upsert(m, u, ["name", "part"])


@R.add("a22_run_log", "run", "SELECT step, strftime(max(finished_at), '%Y-%m-%d %H:%M:%S') AS finished_at, arg_max(ok, (finished_at, event_id)) AS ok, arg_max(seconds, (finished_at, event_id)) AS seconds FROM run GROUP BY 1")
def a22(run):
    return T.latest_status(run, "step").withColumn("finished_at", F.date_format("finished_at", "yyyy-MM-dd HH:mm:ss"))


@R.add("a29_code_classes", "cells", """
SELECT r, c, CASE code WHEN 0 THEN 'grass' WHEN 1 THEN 'grass' WHEN 2 THEN 'grass' WHEN 3 THEN 'dirt' WHEN 4 THEN 'concrete' WHEN 5 THEN 'water' ELSE 'nodata' END AS class, code = 0 AS forest_high, code = 1 AS forest_scrub, code = 5 AS water FROM cells""")
def a29(cells):
    spark = cells.sparkSession
    table = spark.createDataFrame([(0, "grass"), (1, "grass"), (2, "grass"), (3, "dirt"), (4, "concrete"), (5, "water"), (6, "nodata")], "code long, class string")
    return cells.join(F.broadcast(table), "code").select("r", "c", "class", (c("code") == 0).alias("forest_high"), (c("code") == 1).alias("forest_scrub"), (c("code") == 5).alias("water"))


@R.add("h1_union", "road", "SELECT road_id, objekt, kunstbauten FROM road WHERE objekt = 'S-B' UNION SELECT road_id, objekt, kunstbauten FROM road WHERE kunstbauten IS NOT NULL")
def h1(road):
    part = road.select("road_id", "objekt", "kunstbauten")
    return part.where("objekt = 'S-B'").unionByName(part.where("kunstbauten is not null")).distinct()


@R.add("h2_id_sets", "road", "SELECT DISTINCT road_id FROM (SELECT road_id FROM road WHERE objekt = 'S-B' UNION ALL SELECT road_id FROM road WHERE str_code = 'L13')")
def h2(road):
    return road.where("objekt = 'S-B'").select("road_id").union(road.where("str_code = 'L13'").select("road_id")).distinct()


@R.add("h3_intersect", "road", "SELECT road_id FROM road WHERE kunstbauten IS NOT NULL INTERSECT SELECT road_id FROM road WHERE str_code = 'B179'")
def h3(road):
    return road.where("kunstbauten is not null").select("road_id").intersect(road.where("str_code = 'B179'").select("road_id"))


@R.add("h4_except", "road", "SELECT road_id FROM road WHERE kunstbauten IS NULL OR objekt NOT IN ('S-BB', 'S-BG')")
def h4(road):
    return road.select("road_id").join(road.where("kunstbauten is not null and objekt in ('S-BB', 'S-BG')").select("road_id"), "road_id", "left_anti")


@R.add("h5_mask_algebra", "cells", "SELECT r, c, rock AND asphalt AS both, rock OR asphalt AS any, rock AND NOT asphalt AS only FROM cells")
def h5(cells):
    return cells.select("r", "c", (c("rock") & c("asphalt")).alias("both"), (c("rock") | c("asphalt")).alias("any"), (c("rock") & ~c("asphalt")).alias("only"))


@R.add("i2_peaks", "cells", """
WITH q AS (SELECT r, c, z, CASE WHEN 2 * r >= (SELECT max(r) + 1 FROM cells) THEN 1 ELSE 0 END AS qr, CASE WHEN c >= 50 THEN 1 ELSE 0 END AS qc FROM cells WHERE z IS NOT NULL),
k AS (SELECT *, row_number() OVER (PARTITION BY qr, qc ORDER BY z DESC, r, c) AS n FROM q) SELECT CAST(qr AS BIGINT) AS qr, CAST(qc AS BIGINT) AS qc, r, c, round(z, 6) AS z FROM k WHERE n = 1""")
def i2(cells):
    top = F.broadcast(cells.agg((F.max("r") + 1).alias("rows")))
    q = cells.where("z is not null").join(top).select("r", "c", "z", (2 * c("r") >= c("rows")).cast("long").alias("qr"), (c("c") >= 50).cast("long").alias("qc"))
    best = q.groupBy("qr", "qc").agg(F.max_by(F.struct("r", "c", "z"), F.struct("z", -c("r"), -c("c"))).alias("b"))
    return best.select("qr", "qc", "b.r", "b.c", F.round("b.z", 6).alias("z"))


@R.add("i3_budget", "cells", "SELECT code, r, c, rank FROM (SELECT code, r, c, row_number() OVER (PARTITION BY code ORDER BY r, c) AS rank FROM cells) t WHERE rank <= 20")
def i3(cells):
    return T.ranked(cells.select("code", "r", "c"), ["code"], [c("r"), c("c")], 20).withColumn("rank", c("rank").cast("long"))


@R.add("i4_worst", "cells", "SELECT r, c, round(abs(dom - z), 6) AS d FROM cells WHERE dom IS NOT NULL AND z IS NOT NULL ORDER BY abs(dom - z) DESC, r, c LIMIT 25")
def i4(cells):
    d = F.abs(c("dom") - c("z"))
    return cells.where("dom is not null and z is not null").orderBy(d.desc(), "r", "c").limit(25).select("r", "c", F.round(d, 6).alias("d"))


@R.add("i5_layer_order", "layer", """
WITH p AS (SELECT DISTINCT name, part, CASE name WHEN 'corridor_dgm' THEN 10 WHEN 'road_bed' THEN 20 WHEN 'water' THEN 30 ELSE 40 END AS priority FROM layer)
SELECT name, part, CAST(priority AS BIGINT) AS priority, row_number() OVER (ORDER BY priority, name, part) AS place FROM p""")
def i5(layer):
    from pyspark.sql import Window

    p = layer.select("name", "part").distinct().withColumn("priority", F.when(c("name") == "corridor_dgm", 10).when(c("name") == "road_bed", 20).when(c("name") == "water", 30).otherwise(40).cast("long"))
    return p.withColumn("place", F.row_number().over(Window.orderBy("priority", "name", "part")).cast("long"))  # one row per layer


@R.add("a16_degree_tiles", "ring", """
WITH b AS (SELECT min(x) / 10 - 0.02 AS x0, max(x) / 10 + 0.02 AS x1, min(y) / 10 - 0.02 AS y0, max(y) / 10 + 0.02 AS y1 FROM ring)
SELECT lon, lat FROM (SELECT unnest(generate_series(CAST(floor(x0) AS BIGINT), CAST(floor(x1 - 1e-12) AS BIGINT))) AS lon, y0, y1 FROM b) a, LATERAL (SELECT unnest(generate_series(CAST(floor(a.y0) AS BIGINT), CAST(floor(a.y1 - 1e-12) AS BIGINT))) AS lat) t""")
def a16(ring):
    b = ring.agg((F.min("x") / 10 - 0.02).alias("x0"), (F.max("x") / 10 + 0.02).alias("x1"), (F.min("y") / 10 - 0.02).alias("y0"), (F.max("y") / 10 + 0.02).alias("y1"))
    span = lambda a, z: F.explode(F.sequence(F.floor(a), F.floor(c(z) - 1e-12)))
    return b.select("y0", "y1", span("x0", "x1").alias("lon")).select("lon", span("y0", "y1").alias("lat"))


@R.add("a18_vertex_measure", "road_node road", """
SELECT n.road_id, n.seq, round(n.x, 6) AS x, round(n.y, 6) AS y, n.w AS m FROM road_node n JOIN road r USING (road_id) WHERE r.objekt <> 'S-F'""")
def a18(n, road):
    return n.join(road.where("objekt <> 'S-F'").select("road_id"), "road_id", "left_semi").select("road_id", "seq", r6(c("x")).alias("x"), r6(c("y")).alias("y"), c("w").alias("m"))
