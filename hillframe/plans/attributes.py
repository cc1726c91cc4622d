"""Queries of road, building and ground attributes."""

from pyspark.sql import functions as F

from hillframe.functions import attributes as A
from hillframe.functions import scalars as S

from .registry import Registry

R = Registry()
QUERIES, ORACLES = R.queries, R.oracles
c = F.col
r6 = S.r6
WIDTHS = {"L13": 6.5, "B*": 7.0, "B17*": 8.0, "L*": 5.5}
CLASS_WIDTHS = {"S-B": 7.5, "S-L": 6.0, "S-G": 4.5}
SITE_WIDTHS = {3: 9.0, 11: 8.5}
DECLARED = ("tirol",)
_BY_CODE = "CASE WHEN str_code = 'L13' THEN 6.5 WHEN starts_with(str_code, 'B17') THEN 8.0 WHEN starts_with(str_code, 'B') THEN 7.0 WHEN starts_with(str_code, 'L') THEN 5.5 END"


@R.add("b11_code_width", "road", f"SELECT road_id, CAST({_BY_CODE} AS DOUBLE) AS width_m FROM road")
def b11(road):
    return road.select("road_id", A.by_code(c("str_code"), WIDTHS).alias("width_m"))


@R.add("b12_width_source", "road road_node", f"""
WITH m AS (SELECT road_id, avg(w) AS measured FROM road_node WHERE w >= 6 GROUP BY 1),
v AS (SELECT road_id, CASE road_id WHEN 3 THEN 9.0 WHEN 11 THEN 8.5 END AS site, measured, {_BY_CODE} AS code, CASE objekt WHEN 'S-B' THEN 7.5 WHEN 'S-L' THEN 6.0 WHEN 'S-G' THEN 4.5 END AS class FROM road LEFT JOIN m USING (road_id))
SELECT road_id, CAST(coalesce(site, measured, code, class, 5.0) AS DOUBLE) AS width_m,
  CASE WHEN site IS NOT NULL THEN 'site' WHEN measured IS NOT NULL THEN 'measured' WHEN code IS NOT NULL THEN 'code' WHEN class IS NOT NULL THEN 'class' ELSE 'default' END AS origin FROM v""")
def b12(road, nodes):
    measured = nodes.where("w >= 6").groupBy("road_id").agg(F.avg("w").alias("measured"))
    table = lambda d: F.create_map(*(F.lit(x) for pair in d.items() for x in pair))
    site = table(SITE_WIDTHS)[c("road_id").cast("int")]
    width, origin = A.first_known(site=site, measured=c("measured"), code=A.by_code(c("str_code"), WIDTHS), **{"class": table(CLASS_WIDTHS)[c("objekt")]}, default=F.lit(5.0))
    return road.join(measured, "road_id", "left").select("road_id", width.alias("width_m"), origin.alias("origin"))


@R.add("b16_ground_class", "ground_tag", """
SELECT way_id, CASE WHEN lower(natural_tag) IN ('bare_rock', 'scree', 'cliff') OR lower(landuse_tag) = 'quarry' THEN 'rock'
  WHEN lower(natural_tag) IN ('wood', 'scrub', 'grassland', 'heath', 'fell') OR lower(landuse_tag) IN ('forest', 'meadow', 'grass', 'farmland') THEN 'grass'
  WHEN lower(landuse_tag) IN ('residential', 'commercial', 'industrial', 'retail', 'construction', 'garages', 'railway') THEN 'concrete' END AS class FROM ground_tag""")
def b16(tags):
    return tags.select("way_id", A.ground_class(c("natural_tag"), c("landuse_tag")).alias("class"))


_LEAD = "try_cast(trim(regexp_split_to_array(replace(trim({0}), ',', '.'), '[;|/]')[1]) AS DOUBLE)".format


@R.add("b25_building_height", "building", f"""
WITH v AS (SELECT way_id, {_LEAD("replace(lower(height), 'm', '')")} AS h, {_LEAD('levels')} * 3.0 AS l,
  CASE lower(coalesce(building, 'yes')) WHEN 'house' THEN 7.0 WHEN 'church' THEN 16.0 WHEN 'garage' THEN 3.0 ELSE 8.0 END AS d FROM building)
SELECT way_id, CAST(CASE WHEN h IS NOT NULL THEN greatest(h, 2.5) WHEN l IS NOT NULL THEN greatest(l, 2.5) ELSE d END AS DOUBLE) AS height_m FROM v""")
def b25(b):
    return b.select("way_id", A.building_height(c("height"), c("levels"), c("building"), 3.0, 8.0).alias("height_m"))


_SNAP = """s AS (SELECT r, c, z, CASE WHEN z < dom + 0.05 - 1e-4 THEN least(dom + 0.05, z + 4.0) ELSE z END AS raised, least(z + 4.0, greatest(z - 4.0, dom + 0.05)) AS followed FROM cells WHERE z IS NOT NULL AND dom IS NOT NULL)"""


def _snapped(cells):
    a = (c("z"), c("dom"), 0.05, 4.0)
    return cells.where("z is not null and dom is not null").select("r", "c", "z", A.snap_height(*a, follow=False).alias("raised"), A.snap_height(*a, follow=True).alias("followed"))


@R.add("b37_snap", "cells", f"WITH {_SNAP} SELECT r, c, round(raised, 6) + 0.0 AS raised, round(followed, 6) + 0.0 AS followed FROM s")
def b37(cells):
    return _snapped(cells).select("r", "c", r6(c("raised")).alias("raised"), r6(c("followed")).alias("followed"))


@R.add("b37_snap_summary", "cells", f"WITH {_SNAP} SELECT round(min(raised - z), 6) + 0.0 AS low, round(max(raised - z), 6) + 0.0 AS high, count(*) FILTER (raised > z) AS raised FROM s")
def b37_summary(cells):
    dz = c("raised") - c("z")
    return _snapped(cells).agg(r6(F.min(dz)).alias("low"), r6(F.max(dz)).alias("high"), F.count_if(dz > 0).alias("raised"))


@R.add("a26_undeclared", "raw_id", "SELECT authority, count(*) AS n FROM raw_id WHERE authority NOT IN ('tirol') GROUP BY 1")
def a26(ids):
    found = ids.groupBy("authority").agg(F.count(F.lit(1)).alias("n"))
    return found.where(~c("authority").isin(*DECLARED))


@R.add("a27_known_structures", "road road_node", """
WITH p AS (SELECT road_id, count(*) AS points FROM road_node GROUP BY 1)
SELECT road_id, kunstbauten, points FROM road JOIN p USING (road_id) WHERE kunstbauten IS NOT NULL AND points >= 2""")
def a27(road, nodes):
    points = nodes.groupBy("road_id").agg(F.count(F.lit(1)).alias("points")).where("points >= 2")
    return road.where(S.structure_kind(c("kunstbauten")).isNotNull()).select("road_id", "kunstbauten").join(points, "road_id")
