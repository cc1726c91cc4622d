"""Queries of water surfaces: exact overlaps, tiles, fit shares, adaptive tiles."""

from pyspark.sql import functions as F

from hillframe.functions import scalars as S
from hillframe.operators import water as W

from .registry import Registry

R = Registry()
QUERIES, ORACLES = R.queries, R.oracles
c = F.col
r6 = S.r6
MAX_SIDE, TILE, HANG, BANK, SPACING = 6.0, 2.5, 6.0, 5.0, 2.0

_TILES = f"""ar AS (SELECT poly_id, min(x) AS ax, max(x) AS bx, min(y) AS ay, max(y) AS b_y, 1010.0 + poly_id % 40 AS level FROM ring GROUP BY 1),
tl AS (SELECT poly_id, 't' || ix || '_' || iy AS box, ax + (bx - ax) * ix / nx AS x0, ay + (b_y - ay) * iy / ny AS y0, ax + (bx - ax) * (ix + 1) / nx AS x1, ay + (b_y - ay) * (iy + 1) / ny AS y1, level
  FROM (SELECT *, unnest(generate_series(0, CAST(ny AS BIGINT) - 1)) AS iy FROM (SELECT *, unnest(generate_series(0, CAST(nx AS BIGINT) - 1)) AS ix FROM (SELECT *, greatest(1, ceil((bx - ax) / {TILE})) AS nx, greatest(1, ceil((b_y - ay) / {TILE})) AS ny FROM ar WHERE greatest(bx - ax, b_y - ay) > {MAX_SIDE})))),
ed AS (SELECT poly_id, x AS px, y AS py, coalesce(lead(x) OVER q, first_value(x) OVER q) AS qx, coalesce(lead(y) OVER q, first_value(y) OVER q) AS qy FROM ring WINDOW q AS (PARTITION BY poly_id ORDER BY seq)),
cl AS (SELECT *, py + (u - px) / (qx - px) * (qy - py) AS yu, py + (v - px) / (qx - px) * (qy - py) AS yv FROM (SELECT tl.*, px, py, qx, qy, greatest(x0, least(px, qx)) AS u, least(x1, greatest(px, qx)) AS v FROM tl JOIN ed USING (poly_id) WHERE px <> qx) WHERE u < v),
oa AS (SELECT poly_id, box, abs(sum(CASE WHEN qx > px THEN 1.0 ELSE -1.0 END * (v - u) * CASE WHEN abs(yv - yu) < 1e-9 THEN greatest(y0, least(y1, (yu + yv) / 2)) ELSE
  (CASE WHEN yv < y0 THEN y0 * yv WHEN yv > y1 THEN (y1 * y1 + y0 * y0) / 2 + y1 * (yv - y1) ELSE (yv * yv + y0 * y0) / 2 END - CASE WHEN yu < y0 THEN y0 * yu WHEN yu > y1 THEN (y1 * y1 + y0 * y0) / 2 + y1 * (yu - y1) ELSE (yu * yu + y0 * y0) / 2 END) / (yv - yu) END)) AS area FROM cl GROUP BY 1, 2),
wt AS (SELECT poly_id, 'whole' AS box, ax AS x0, ay AS y0, bx AS x1, b_y AS y1, level FROM ar WHERE greatest(bx - ax, b_y - ay) <= {MAX_SIDE} UNION ALL SELECT tl.* FROM tl JOIN oa USING (poly_id, box) WHERE round(area, 9) >= round(0.25 * (x1 - x0) * (y1 - y0), 9))"""


def _tiles(ring):
    level = ring.groupBy("poly_id").agg((F.lit(1010.0) + F.first("poly_id") % 40).alias("level"))
    return W.water_tiles(ring, level, MAX_SIDE, TILE)


@R.add("g31_water_tiles", "ring", f"WITH {_TILES} SELECT poly_id, box, round(x0, 6) + 0.0 AS x0, round(y0, 6) + 0.0 AS y0, round(x1, 6) + 0.0 AS x1, round(y1, 6) + 0.0 AS y1 FROM wt")
def g31(ring):
    return _tiles(ring).select("poly_id", "box", *(r6(c(x)).alias(x) for x in ("x0", "y0", "x1", "y1")))


@R.add("d31_fit_share", "ring cells", f"""
WITH {_TILES}, nn AS (SELECT *, CAST(least(24, greatest(2, ceil((x1 - x0) / {SPACING}) + 1)) AS BIGINT) AS nx, CAST(least(24, greatest(2, ceil((y1 - y0) / {SPACING}) + 1)) AS BIGINT) AS ny FROM wt),
sa AS (SELECT *, x0 + (x1 - x0) * (ix + 0.5) / nx AS x, y0 + (y1 - y0) * (iy + 0.5) / ny AS y FROM (SELECT *, unnest(generate_series(0, ny - 1)) AS iy FROM (SELECT *, unnest(generate_series(0, nx - 1)) AS ix FROM nn))),
go AS (SELECT sa.*, NOT coalesce(level - z > {HANG} OR z - level > {BANK}, false) AS good FROM sa LEFT JOIN cells ON cells.r = CAST(floor(-y) AS BIGINT) AND cells.c = CAST(floor(x) AS BIGINT))
SELECT poly_id, box, round(avg(CASE WHEN good THEN 0.0 ELSE 1.0 END), 6) AS bad, round(x0 + (x1 - x0) * min(ix) FILTER (good) / nx, 6) + 0.0 AS gx0, round(y0 + (y1 - y0) * (max(iy) FILTER (good) + 1) / ny, 6) + 0.0 AS gy1 FROM go GROUP BY poly_id, box, x0, x1, y0, y1, nx, ny""")
def d31(ring, cells):
    t = W.fit_shares(_tiles(ring), cells, HANG, BANK, SPACING)
    return t.select("poly_id", "box", F.round("bad", 6).alias("bad"), r6(c("gx0")).alias("gx0"), r6(c("gy1")).alias("gy1"))


@R.add("g31_fitted_tiles", "ring cells", None)
def g31_fitted(ring, cells):
    t = W.fitted_tiles(_tiles(ring), cells, HANG, BANK, SPACING, 0.3, 0.4, 0.5)
    return t.select("poly_id", "box", *(r6(c(x)).alias(x) for x in ("x0", "y0", "x1", "y1", "level")), "depth")
