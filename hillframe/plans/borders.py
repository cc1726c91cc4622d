"""Queries of road ends at a border of two authorities."""

from pyspark.sql import functions as F

from hillframe.functions import scalars as S
from hillframe.operators import borders as B
from hillframe.operators import lines as L

from .registry import Registry

R = Registry()
QUERIES, ORACLES = R.queries, R.oracles
c = F.col
r6 = S.r6

BORDER = [(0.0, 2.0), (18.0, 24.0), (31.0, 17.0), (50.0, 30.0)]
_GROUPS = f"""bd AS (SELECT * FROM (VALUES {", ".join(f"({x}, {y}, {u}, {v})" for (x, y), (u, v) in zip(BORDER, BORDER[1:], strict=False))}) t(x0, y0, x1, y1)),
ft AS (SELECT e.*, greatest(0, least(1, ((x - x0) * (x1 - x0) + (y - y0) * (y1 - y0)) / ((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)))) AS t, x0, y0, x1, y1 FROM road_end e, bd),
nr AS (SELECT objectid, authority, x, y FROM ft GROUP BY 1, 2, 3, 4 HAVING min(pow(x0 + t * (x1 - x0) - x, 2) + pow(y0 + t * (y1 - y0) - y, 2)) <= 64),
pr AS (SELECT a.objectid AS a, b.objectid AS b FROM nr a JOIN nr b ON sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= 2.5),
cl AS (SELECT a, b FROM pr UNION SELECT cl.a, pr.b FROM cl JOIN pr ON pr.a = cl.b),
gr AS (SELECT nr.*, grp, count(*) OVER (PARTITION BY grp) AS n FROM nr JOIN (SELECT a, min(b) AS grp FROM cl GROUP BY 1) ON a = objectid)"""


def _groups(ends):
    spark = ends.sparkSession
    border = L.segments(spark.createDataFrame([(0, i, x, y, 0.0, 0.0) for i, (x, y) in enumerate(BORDER)], "road_id long, seq long, x double, y double, z double, w double"))
    return B.end_groups(ends.withColumn("end_id", c("objectid")), border, 8.0, 2.5)


@R.add("c30_end_groups", "road_end", f"WITH RECURSIVE {_GROUPS} SELECT objectid, grp, n, n >= 3 AS review FROM gr")
def c30_groups(ends):
    return _groups(ends).select("objectid", "grp", "n", (c("n") >= 3).alias("review"))


@R.add("c30_border_links", "road_end", f"""
WITH RECURSIVE {_GROUPS}, cf AS (SELECT DISTINCT objectid AS f, objectid + 1 AS t FROM road_end WHERE objectid % 40 = 7),
lk AS (SELECT a.objectid AS f, b.objectid AS t, a.authority AS fa, b.authority AS ta, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS d FROM gr a JOIN gr b ON a.grp = b.grp AND a.n = 2 AND a.objectid < b.objectid AND a.authority <> b.authority)
SELECT f AS from_objectid, t AS to_objectid, fa AS from_authority, ta AS to_authority, round(d, 6) + 0.0 AS distance, cf.f IS NOT NULL AS confirmed FROM lk FULL JOIN cf USING (f, t)""")
def c30_links(ends):
    sure = ends.where("objectid % 40 = 7").select((c("objectid") + 1).alias("a"), c("objectid").alias("b"))
    return B.border_links(_groups(ends), sure).select("from_objectid", "to_objectid", "from_authority", "to_authority", r6(c("distance")).alias("distance"), "confirmed")
