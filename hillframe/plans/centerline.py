"""Queries of axes moved to calmer ground: lateral search, locked neighbours, shifted axes, tapered widths."""

from pyspark.sql import functions as F

from hillframe.functions import scalars as S
from hillframe.operators import centerline as C

from .registry import Registry

R = Registry()
QUERIES, ORACLES = R.queries, R.oracles
c = F.col
r6 = S.r6

_PIECES = """st AS (SELECT road_id, seq, x, y, w, sum(d) OVER (PARTITION BY road_id ORDER BY seq) AS s FROM (SELECT *, coalesce(sqrt(pow(x - lag(x) OVER q, 2) + pow(y - lag(y) OVER q, 2)), 0) AS d FROM axis_node WINDOW q AS (PARTITION BY road_id ORDER BY seq))),
sg AS (SELECT * FROM (SELECT road_id, x AS x0, y AS y0, s AS s0, w, lead(x) OVER q AS x1, lead(y) OVER q AS y1, lead(s) OVER q AS s1, max(s) OVER (PARTITION BY road_id) AS len FROM st WINDOW q AS (PARTITION BY road_id ORDER BY seq)) WHERE s1 > s0),
pn AS (SELECT road_id, len, unnest(generate_series(0, greatest(0, CAST(ceil(len / 20) AS BIGINT) - 1))) AS i FROM (SELECT DISTINCT road_id, len FROM sg)),
pb AS (SELECT road_id, i, count(*) OVER (PARTITION BY road_id) AS n, i * 20.0 AS p0, coalesce(lead(i) OVER (PARTITION BY road_id ORDER BY i) * 20.0, len) AS p1 FROM pn WHERE i = 0 OR len - i * 20 >= 2),
ps AS (SELECT road_id, i, n, w, a, b, x0 + (a - s0) / (s1 - s0) * (x1 - x0) AS xa, y0 + (a - s0) / (s1 - s0) * (y1 - y0) AS ya, x0 + (b - s0) / (s1 - s0) * (x1 - x0) AS xb, y0 + (b - s0) / (s1 - s0) * (y1 - y0) AS yb
  FROM (SELECT *, greatest(s0, p0) AS a, least(s1, p1) AS b FROM sg JOIN pb USING (road_id)) WHERE b > a + 1e-9),
pc AS (SELECT *, (x1 - x0) / nullif(sqrt((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)), 0) AS ux, (y1 - y0) / nullif(sqrt((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)), 0) AS uy, road_id % 11 = 4 AS structure
  FROM (SELECT road_id, i, min(n) AS n, min(w) AS w, min(a) AS s0, max(b) AS s1, arg_min(xa, a) AS x0, arg_min(ya, a) AS y0, arg_max(xb, b) AS x1, arg_max(yb, b) AS y1 FROM ps GROUP BY 1, 2))"""

_SEARCH = _PIECES + """,
ro AS (SELECT r, c, CAST(floor(least(abs(z - m), 0.019) * 1000000 + 0.5001) AS BIGINT) AS um FROM (SELECT a.r, a.c, a.z, avg(b.z) AS m, count(b.z) AS k FROM fine_cell a JOIN fine_cell b ON b.r BETWEEN a.r - 1 AND a.r + 1 AND b.c BETWEEN a.c - 1 AND a.c + 1 GROUP BY 1, 2, 3) WHERE k >= 6 AND z IS NOT NULL),
di AS (SELECT *, lead(tx) OVER q AS vx, lead(ty) OVER q AS vy FROM (SELECT *, (xb - xa) / l AS tx, (yb - ya) / l AS ty FROM (SELECT *, sqrt((xb - xa) * (xb - xa) + (yb - ya) * (yb - ya)) AS l FROM ps)) WINDOW q AS (PARTITION BY road_id, i ORDER BY a)),
ce AS (SELECT road_id, i, di.w, l, tx, ty, vx, vy, xb - xa AS ex, yb - ya AS ey, r, c, um, off, c + 0.5 + off / 10.0 * uy - xa AS px, -(r + 0.5) - off / 10.0 * ux - ya AS py FROM di JOIN pc USING (road_id, i)
  JOIN ro ON r BETWEEN floor(-greatest(ya, yb) - di.w * 0.75 - 1) AND floor(-least(ya, yb) + di.w * 0.75 + 1) AND c BETWEEN floor(least(xa, xb) - di.w * 0.75 - 1) AND floor(greatest(xa, xb) + di.w * 0.75 + 1), (SELECT CAST(unnest(generate_series(-10, 10)) AS INT) AS off)),
ha AS (SELECT road_id, i, off, r, c, min(um) AS um, min(w) AS w, min(least(CASE WHEN px * tx + py * ty BETWEEN 0 AND l THEN abs(px * ty - py * tx) END,
    CASE WHEN px * tx + py * ty > l AND (px - ex) * vx + (py - ey) * vy < 0 THEN greatest(abs(px * ty - py * tx), abs((px - ex) * vy - (py - ey) * vx), sqrt((px - ex) * (px - ex) + (py - ey) * (py - ey)) / 1.5) END)) AS half FROM ce GROUP BY 1, 2, 3, 4, 5),
sc AS (SELECT road_id, i, level, off, sum(um) / count(*) AS mean, count(*) FILTER (um >= 18990) / count(*) AS share FROM ha JOIN (SELECT CAST(unnest(generate_series(0, 20)) AS BIGINT) AS level) ON 2 * half <= w - level / 10.0 + 1e-10 AND w - level / 10.0 >= 1 - 1e-9 GROUP BY 1, 2, 3, 4),
lv AS (SELECT road_id, i, level, max(mean) - min(mean) AS span, arg_min(off, mean * 1000 + abs(off) + CASE WHEN off < 0 THEN 0.5 ELSE 0 END) FILTER (mean = low) AS best, count(*) FILTER (ok) AS fine, arg_min(off, abs(off) * 2 + CASE WHEN off > 0 THEN 1 ELSE 0 END) FILTER (ok) AS nearest,
    arg_min(off, abs(off) * 2 + CASE WHEN off < 0 THEN 1 ELSE 0 END) FILTER (ok AND mean = okl) AS calmest, count(*) FILTER (ok AND mean <= okl + 2000) AS close, coalesce(list_sort(list(off) FILTER (ok)), []) AS good
  FROM (SELECT *, min(mean) OVER (PARTITION BY road_id, i, level) AS low, min(CASE WHEN ok THEN mean END) OVER (PARTITION BY road_id, i, level) AS okl FROM (SELECT *, mean <= 8000 AND share <= 1 AS ok FROM sc)) GROUP BY 1, 2, 3),
fi AS (SELECT road_id, i, min(level) FILTER (fine > 0) AS pass, max(level) AS last FROM lv GROUP BY 1, 2),
se AS (SELECT p.*, pass, last, ends, NOT structure AND pass IS NULL AND coalesce(last, -1) < ends AS ran FROM (SELECT *, CAST(least(20, floor((w - 1) * 10 + 1e-9)) AS BIGINT) AS ends FROM pc) p LEFT JOIN fi USING (road_id, i)),
fd AS (SELECT se.road_id, se.i, n, w, s0, s1, x0, y0, x1, y1, ux, uy, structure, CASE WHEN structure THEN 'structure' WHEN ran THEN 'no_sample' WHEN fine = 0 THEN CASE WHEN span < 2000 THEN 'flat' ELSE 'none' END
    WHEN span < 2000 AND nearest = 0 THEN 'flat' WHEN CASE WHEN span < 2000 THEN fine ELSE close END = 1 THEN 'unique' ELSE 'several' END AS kind,
  coalesce(CASE WHEN fine = 0 THEN 0 WHEN span < 2000 THEN nearest ELSE calmest END, 0) AS chosen, best, CASE WHEN structure THEN 0 WHEN ran THEN coalesce(last + 1, 0) WHEN pass IS NULL THEN least(20, ends + 1) ELSE pass END AS level, span, coalesce(good, []) AS good
  FROM se LEFT JOIN lv ON NOT structure AND NOT ran AND lv.road_id = se.road_id AND lv.i = se.i AND lv.level = coalesce(pass, last))"""

_LINKS = """cd AS (SELECT *, row_number() OVER (ORDER BY d, road_id, road_id2) AS k FROM (SELECT a.road_id, a.i, b.road_id AS road_id2, b.i AS i2, sqrt((b.x0 - a.x1) * (b.x0 - a.x1) + (b.y0 - a.y1) * (b.y0 - a.y1)) AS d
  FROM fd a JOIN fd b ON NOT a.structure AND NOT b.structure AND a.i = a.n - 1 AND b.i = 0 AND a.road_id <> b.road_id AND abs(b.x0 - a.x1) <= 3 AND abs(b.y0 - a.y1) <= 3 AND a.ux * b.ux + a.uy * b.uy >= 0.85) WHERE d < 4),
wk AS (SELECT CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS ends, CAST([] AS BIGINT[]) AS starts, FALSE AS hit UNION ALL
  SELECT k, CASE WHEN free THEN list_append(ends, road_id) ELSE ends END, CASE WHEN free THEN list_append(starts, road_id2) ELSE starts END, free FROM (SELECT cd.k, ends, starts, road_id, road_id2, NOT list_contains(ends, road_id) AND NOT list_contains(starts, road_id2) AS free FROM wk JOIN cd ON cd.k = wk.k + 1)),
li AS (SELECT road_id, i, road_id2, i2 FROM cd JOIN wk USING (k) WHERE hit)"""

_ONE = """nb AS (SELECT road_id, i, road_id AS road_id2, i + 1 AS i2 FROM fd WHERE NOT structure AND i < n - 1 UNION ALL SELECT * FROM li),
nn AS (SELECT p.*, CASE WHEN a.ux * b.ux + a.uy * b.uy >= 0 THEN 1 ELSE -1 END AS sign FROM (SELECT * FROM nb UNION ALL SELECT road_id2, i2, road_id, i FROM nb) p JOIN fd a USING (road_id, i) JOIN fd b ON b.road_id = road_id2 AND b.i = i2),
k0 AS (SELECT road_id, i, chosen FROM fd WHERE kind = 'unique')"""
_ROUNDS = ",\n".join(
    f"""t{k} AS (SELECT road_id, i, avg(sign * o.chosen) AS target, any_value(fd.good) AS good FROM nn JOIN fd USING (road_id, i) JOIN k{k - 1} o ON o.road_id = road_id2 AND o.i = i2 WHERE fd.kind = 'several' AND NOT EXISTS (SELECT 1 FROM k{k - 1} f WHERE f.road_id = nn.road_id AND f.i = nn.i) GROUP BY 1, 2),
k{k} AS MATERIALIZED (SELECT * FROM k{k - 1} UNION ALL SELECT road_id, i, arg_min(g, abs(g - target) * 1000 + abs(g) * 2 + CASE WHEN g > 0 THEN 1 ELSE 0 END) FROM (SELECT *, unnest(good) AS g FROM t{k}) GROUP BY 1, 2)"""
    for k in range(1, 13)
)
_LOCK = f"""{_SEARCH}, {_LINKS}, {_ONE}, {_ROUNDS},
lo AS (SELECT fd.* EXCLUDE (kind, chosen), CASE WHEN kind = 'several' AND k.chosen IS NULL THEN 'several_unanchored' ELSE kind END AS kind, CASE WHEN kind = 'several' THEN coalesce(k.chosen, 0) ELSE fd.chosen END AS chosen, w - level / 10.0 AS width_used FROM fd LEFT JOIN k12 k USING (road_id, i))"""


def _found(cells, nodes):
    segs = C.piece_segments(nodes)
    axis = C.pieces(segs).withColumn("structure", c("road_id") % 11 == 4)
    return segs, C.searched(axis, C.lateral_scores(segs, C.micro_roughness(cells)))


def _placed(cells, nodes):
    segs, found = _found(cells, nodes)
    return segs, C.locked(found, C.road_links(found))


@R.add("g7_lateral_search", "fine_cell axis_node", f"WITH {_SEARCH} SELECT road_id, i, kind, chosen, best, level, round(span, 3) + 0.0 AS span_um, CAST(len(good) AS INT) AS acceptable FROM fd")
def g7(cells, nodes):
    found = _found(cells, nodes)[1]
    return found.select("road_id", "i", "kind", "chosen", "best", "level", (F.round("span_um", 3) + 0.0).alias("span_um"), F.size("good").alias("acceptable"))


@R.add("g8_road_links", "axis_node", f"WITH RECURSIVE {_PIECES}, fd AS (SELECT * FROM pc), {_LINKS} SELECT * FROM li")
def g8_links(nodes):
    return C.road_links(C.pieces(C.piece_segments(nodes)).withColumn("structure", c("road_id") % 11 == 4))


@R.add("g8_neighbour_locking", "fine_cell axis_node", f"WITH RECURSIVE {_LOCK} SELECT road_id, i, kind, chosen FROM lo")
def g8(cells, nodes):
    return _placed(cells, nodes)[1].select("road_id", "i", "kind", "chosen")


@R.add("g9_shifted_axis", "fine_cell axis_node", f"""
WITH RECURSIVE {_LOCK},
pt AS (SELECT road_id, a AS s, xa AS x, ya AS y FROM ps UNION ALL SELECT road_id, s1, x1, y1 FROM pc WHERE i = n - 1),
no AS (SELECT road_id, s, x, y, dx / sqrt(dx * dx + dy * dy) AS tx, dy / sqrt(dx * dx + dy * dy) AS ty FROM (SELECT *, coalesce(lead(x) OVER q, x) - coalesce(lag(x) OVER q, x) AS dx, coalesce(lead(y) OVER q, y) - coalesce(lag(y) OVER q, y) AS dy FROM pt WINDOW q AS (PARTITION BY road_id ORDER BY s))),
mi AS (SELECT road_id, (s0 + s1) / 2 AS m0, chosen AS c0, lead((s0 + s1) / 2) OVER q AS m1, lead(chosen) OVER q AS c1, row_number() OVER q AS k FROM lo WINDOW q AS (PARTITION BY road_id ORDER BY i)),
ov AS (SELECT no.*, (CASE WHEN s <= m0 OR m1 IS NULL THEN c0 ELSE c0 * (1 - (s - m0) / (m1 - m0)) + c1 * ((s - m0) / (m1 - m0)) END) / 10.0 AS off FROM no JOIN mi ON no.road_id = mi.road_id AND (s >= m0 OR k = 1) AND (s < m1 OR m1 IS NULL))
SELECT road_id, round(s, 6) + 0.0 AS s, round(x - off * ty, 6) + 0.0 AS x, round(y + off * tx, 6) + 0.0 AS y, round(off, 6) + 0.0 AS off FROM ov""")
def g9(cells, nodes):
    return C.shifted_axis(*_placed(cells, nodes)).select("road_id", *(r6(c(x)).alias(x) for x in ("s", "x", "y", "off")))


@R.add("g10_width_taper", "fine_cell axis_node", f"""
WITH {_SEARCH}, wu AS (SELECT road_id, i, s0, s1, w - level / 10.0 AS wu FROM fd),
ra AS (SELECT a.road_id, CASE WHEN a.wu > b.wu THEN b.s0 - least(20, a.s1 - a.s0) ELSE a.s1 END AS q0, CASE WHEN a.wu > b.wu THEN b.s0 ELSE a.s1 + least(20, b.s1 - b.s0) END AS q1, a.wu AS w0, b.wu AS w1 FROM wu a JOIN wu b ON b.road_id = a.road_id AND b.i = a.i + 1
  WHERE abs(a.wu - b.wu) >= 0.05 AND CASE WHEN a.wu > b.wu THEN a.s1 - a.s0 ELSE b.s1 - b.s0 END >= 0.5)
SELECT ps.road_id, round(a, 6) + 0.0 AS s, round(least(min(wu), min(w0 + (w1 - w0) * (a - q0) / (q1 - q0))), 6) + 0.0 AS width FROM ps JOIN wu USING (road_id, i) LEFT JOIN ra ON ra.road_id = ps.road_id AND a BETWEEN q0 AND q1 GROUP BY ps.road_id, a""")
def g10(cells, nodes):
    segs, found = _found(cells, nodes)
    return C.tapered_widths(segs.select(*C.PIECE, c("a").alias("s")), found).select("road_id", r6(c("s")).alias("s"), r6(c("width")).alias("width"))
