"""Queries of sight, nearness and rims: viewshed counts, greedy dedupe, nearest-cell fill, rings of a mask."""

from pyspark.sql import functions as F

from hillframe.functions import scalars as S
from hillframe.operators import scatter, viewshed

from .registry import Registry

R = Registry()
QUERIES, ORACLES = R.queries, R.oracles
c = F.col
r6 = S.r6

_SPOTS = """sz AS (SELECT max(r) AS mr, max(c) AS mc FROM cells),
sp AS (SELECT i * 5 + j AS spot, mr * (0.1 + 0.8 * i / 4) AS row_, mc * (0.1 + 0.8 * j / 4) AS col_ FROM sz, (SELECT unnest(generate_series(0, 4)) AS i), (SELECT unnest(generate_series(0, 4)) AS j)
  UNION ALL SELECT 25 + q, CAST(r AS DOUBLE), CAST(c AS DOUBLE) FROM (SELECT r, c, q, row_number() OVER (PARTITION BY q ORDER BY z DESC, r, c) AS n FROM (SELECT r, c, z, CAST(2 * r > mr AS INT) * 2 + CAST(2 * c > mc AS INT) AS q FROM cells, sz WHERE z IS NOT NULL)) WHERE n = 1)"""


@R.add("d30_view_counts", "cells", f"""
WITH {_SPOTS},
ow AS (SELECT spot, row_, col_, mr, mc, cells.r, cells.c, z + 10.0 AS height FROM sp, sz JOIN cells ON cells.r = greatest(0, least(CAST(round_even(row_, 0) AS BIGINT), mr)) AND cells.c = greatest(0, least(CAST(round_even(col_, 0) AS BIGINT), mc)) WHERE z IS NOT NULL),
ra AS (SELECT *, round(cos(ray * (2 * pi() / 2048)), 12) AS dc, -round(sin(ray * (2 * pi() / 2048)), 12) AS dr FROM ow, (SELECT unnest(generate_series(0, 2047)) AS ray)),
sa AS (SELECT spot, ray, t, height, CAST(round_even(row_ + dr * t, 0) AS BIGINT) AS r, CAST(round_even(col_ + dc * t, 0) AS BIGINT) AS c FROM ra, sz s2, (SELECT unnest(generate_series(1, (SELECT CAST(least(800, ceil(sqrt((mr + 2.0) * (mr + 2.0) + (mc + 2.0) * (mc + 2.0)))) AS BIGINT) FROM sz))) AS t) WHERE row_ + dr * t BETWEEN -0.5 AND s2.mr + 0.5 AND col_ + dc * t BETWEEN -0.5 AND s2.mc + 0.5),
me AS (SELECT spot, ray, t, r, c, coalesce((z - 0.85714 * ((t * 50.0) * (t * 50.0)) / (2.0 * 6371000.0) - height) / (t * 50.0), '-infinity'::DOUBLE) AS slope FROM sa JOIN cells USING (r, c)),
vi AS (SELECT DISTINCT spot, r, c FROM (SELECT *, max(slope) OVER (PARTITION BY spot, ray ORDER BY t) AS horizon FROM me) WHERE slope >= horizon - 1e-15 UNION SELECT spot, r, c FROM ow)
SELECT r, c, least(count(*), 255) AS views FROM vi GROUP BY 1, 2""")
def d30(cells):
    grid = cells.select("r", "c", "z")
    return viewshed.view_counts(viewshed.visible(grid, viewshed.observers(grid)))


@R.add("c24_greedy_dedupe", "post", """
WITH RECURSIVE pr AS (SELECT a.id AS first, b.id AS later FROM post a JOIN post b ON a.kind = b.kind AND a.id < b.id AND floor(a.x) BETWEEN floor(b.x) - 1 AND floor(b.x) + 1 WHERE pow(a.x - b.x, 2) + pow(a.y - b.y, 2) <= 0.35 * 0.35),
eb AS (SELECT first AS a, later AS b FROM pr UNION SELECT later, first FROM pr),
cl AS (SELECT a, b FROM eb UNION SELECT cl.a, eb.b FROM cl JOIN eb ON eb.a = cl.b),
cp AS (SELECT a AS later, least(a, min(b)) AS grp FROM cl GROUP BY a),
li AS (SELECT grp, later, list(first) AS firsts, row_number() OVER (PARTITION BY grp ORDER BY later) AS n FROM pr JOIN cp USING (later) GROUP BY 1, 2),
st AS (SELECT DISTINCT grp, CAST(0 AS BIGINT) AS n, CAST([] AS BIGINT[]) AS gone FROM li UNION ALL SELECT grp, li.n, CASE WHEN len(list_filter(firsts, lambda x: NOT list_contains(gone, x))) > 0 THEN list_append(gone, later) ELSE gone END FROM st JOIN li USING (grp) WHERE li.n = st.n + 1)
SELECT id, kind, x, y FROM post WHERE id NOT IN (SELECT unnest(gone) FROM (SELECT arg_max(gone, n) AS gone FROM st GROUP BY grp))""")
def c24(posts):
    return scatter.kept_apart(posts, 0.35).select("id", "kind", "x", "y")


@R.add("c20_nearest_fill", "cells", """
WITH ho AS (SELECT r, c FROM cells WHERE z IS NULL), cl AS (SELECT r, c, z FROM cells WHERE z IS NOT NULL AND NOT rock), ed AS (SELECT r, c, z FROM cells WHERE z IS NOT NULL AND asphalt),
kn AS (SELECT h.r, h.c, l.z, sqrt((l.r - h.r) * (l.r - h.r) + (l.c - h.c) * (l.c - h.c)) * 0.5 AS d, row_number() OVER (PARTITION BY h.r, h.c ORDER BY (l.r - h.r) * (l.r - h.r) + (l.c - h.c) * (l.c - h.c), l.r, l.c) AS n FROM ho h, cl l),
ro AS (SELECT r, c, sum(z / (greatest(d, 0.05) * greatest(d, 0.05))) / sum(1 / (greatest(d, 0.05) * greatest(d, 0.05))) AS z, 1 / min(greatest(d, 0.05)) AS w FROM kn WHERE n <= 8 GROUP BY 1, 2),
ne AS (SELECT h.r, h.c, l.z, 1 / greatest(0.05, sqrt((l.r - h.r) * (l.r - h.r) + (l.c - h.c) * (l.c - h.c)) * 0.5) AS w, row_number() OVER (PARTITION BY h.r, h.c ORDER BY (l.r - h.r) * (l.r - h.r) + (l.c - h.c) * (l.c - h.c), l.r, l.c) AS n FROM ho h, ed l)
SELECT ho.r, ho.c, round(coalesce((ro.w * ro.z + e.w * e.z) / (ro.w + e.w), ro.z, e.z), 6) + 0.0 AS z FROM ho LEFT JOIN ro USING (r, c) LEFT JOIN (SELECT * FROM ne WHERE n = 1) e ON e.r = ho.r AND e.c = ho.c""")
def c20(cells):
    known = cells.where("z is not null")
    out = scatter.filled_from_nearest(cells.where("z is null").select("r", "c"), known.where("not rock").select("r", "c", "z"), known.where("asphalt").select("r", "c", "z"), 0.5)
    return out.select("r", "c", r6(c("z")).alias("z"))


@R.add("g34_rim_rings", "cells", """
WITH RECURSIVE mk AS (SELECT r, c FROM cells WHERE rock), wd AS (SELECT max(c) + 1 AS width FROM mk),
eg AS (SELECT (m.r * width + m.c) * 4 + side AS edge, side, m.r + ar AS r0, m.c + ac AS c0, m.r + br AS r1, m.c + bc AS c1 FROM mk m, wd, (VALUES (0, -1, 0, 0, 0, 0, 1), (1, 0, 1, 0, 1, 1, 1), (2, 1, 0, 1, 1, 1, 0), (3, 0, -1, 1, 0, 0, 0)) v(side, dr, dc, ar, ac, br, bc)
  WHERE NOT EXISTS (SELECT 1 FROM mk n WHERE n.r = m.r + dr AND n.c = m.c + dc)),
nx AS (SELECT a.edge, arg_min(b.edge, CASE (b.side - a.side + 4) % 4 WHEN 1 THEN 0 WHEN 0 THEN 1 ELSE 4 END) AS nxt FROM eg a JOIN eg b ON b.r0 = a.r1 AND b.c0 = a.c1 GROUP BY 1),
wk AS (SELECT edge AS ring, edge, 0 AS pos FROM nx UNION ALL SELECT ring, nxt, pos + 1 FROM wk JOIN nx USING (edge) WHERE nxt <> ring AND nxt > ring),
fl AS (SELECT ring, max(pos) AS top FROM wk GROUP BY 1), ok AS (SELECT f.ring FROM fl f JOIN wk ON wk.ring = f.ring AND wk.pos = f.top JOIN nx ON nx.edge = wk.edge WHERE nx.nxt = f.ring),
al AS (SELECT wk.ring, wk.pos, eg.* FROM wk JOIN ok USING (ring) JOIN eg USING (edge)),
ar AS (SELECT ring, sum(c0 * -r1 - c1 * -r0) / -2.0 AS area FROM al GROUP BY 1),
co AS (SELECT *, coalesce(lag(side) OVER (PARTITION BY ring ORDER BY pos), last_value(side) OVER (PARTITION BY ring ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS bef FROM al)
SELECT ring, CAST(pos AS BIGINT) AS pos, CAST(c0 AS DOUBLE) AS x, CAST(-r0 AS DOUBLE) + 0.0 AS y, area FROM co JOIN ar USING (ring) WHERE bef <> side""")
def g34(cells):
    return scatter.rim_rings(cells.where("rock").select("r", "c")).withColumn("y", c("y") + 0.0)
