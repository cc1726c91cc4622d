"""Queries of road networks: stitched pieces, corridors and their junctions."""

from pyspark.sql import functions as F

from hillframe.operators import networks as N

from .registry import Registry

R = Registry()
QUERIES, ORACLES = R.queries, R.oracles
c = F.col
TOL = 1.0
#: The trunk, the piece that it begins with, and successors that junctions are forced to.
TRUNK, START, FORCED = "B0", 26, {25: 36, 13: 12, 40: 28, 75: 76}


@R.add("g12_stitch", "net_piece net_node", f"""
WITH RECURSIVE e AS (SELECT piece, 's' AS en, arg_min(x, seq) AS x, arg_min(y, seq) AS y FROM net_node GROUP BY 1 UNION ALL SELECT piece, 'e', arg_max(x, seq), arg_max(y, seq) FROM net_node GROUP BY 1),
m AS (SELECT a.piece, a.en, b.piece AS p2, b.en AS e2, lower(f.highway) = lower(g.highway) AS same FROM e a JOIN e b ON a.piece <> b.piece AND pow(a.x - b.x, 2) + pow(a.y - b.y, 2) <= {TOL * TOL}
  JOIN net_piece f ON f.piece = a.piece JOIN net_piece g ON g.piece = b.piece WHERE coalesce(f.code = g.code, true) AND coalesce(f.objekt = g.objekt, true)),
o AS (SELECT piece, en, max(p2) AS p2, max(e2) AS e2 FROM m GROUP BY 1, 2 HAVING count(DISTINCT p2) = 1 AND bool_and(same)),
u AS (SELECT a.* FROM o a JOIN o b ON b.piece = a.p2 AND b.en = a.e2 AND b.p2 = a.piece AND b.e2 = a.en),
st AS (SELECT piece, en AS entry FROM e), o1 AS (SELECT st.piece, st.entry FROM st LEFT JOIN u ON u.piece = st.piece AND u.en = st.entry WHERE u.piece IS NULL),
w AS (SELECT piece AS head, entry AS se, piece, entry, 0 AS pos FROM o1
  UNION ALL SELECT head, se, u.p2, u.e2, pos + 1 FROM w JOIN u ON u.piece = w.piece AND u.en <> w.entry),
ri AS (SELECT piece AS head, piece, 's' AS entry, 0 AS pos FROM net_piece WHERE piece NOT IN (SELECT piece FROM w)
  UNION ALL SELECT head, u.p2, u.e2, pos + 1 FROM ri JOIN u ON u.piece = ri.piece AND u.en <> ri.entry WHERE u.p2 <> ri.head),
l AS (SELECT head, se, arg_max(piece, pos) AS tail FROM w GROUP BY 1, 2),
t AS (SELECT w.head AS grp, w.piece, w.pos, w.entry FROM w JOIN l USING (head, se) WHERE head < tail OR (head = tail AND se = 's')
  UNION ALL SELECT head, piece, pos, entry FROM ri WHERE head IN (SELECT head FROM ri GROUP BY 1 HAVING min(piece) = head)),
b AS (SELECT grp, t.piece, pos, entry, upper(code) AS a, upper(objekt) AS k, last_value(upper(code) IGNORE NULLS) OVER q AS a0, last_value(upper(objekt) IGNORE NULLS) OVER q AS k0 FROM t JOIN net_piece USING (piece) WINDOW q AS (PARTITION BY grp ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
p AS (SELECT *, sum(CASE WHEN a <> a0 OR k <> k0 THEN 1 ELSE 0 END) OVER (PARTITION BY grp ORDER BY pos) AS part FROM b)
SELECT min(piece) OVER z AS chain, CAST(pos - min(pos) OVER z AS BIGINT) AS pos, piece, entry = 'e' AS reversed FROM p WINDOW z AS (PARTITION BY grp, part)""")
def g12(pieces, nodes):
    return N.stitched(pieces, nodes, TOL)


@R.add("g13_heading_chain", "net_piece net_node", None)
def g13(pieces, nodes):
    _, junctions, _ = N.corridors(pieces, nodes, TOL, TRUNK, START, FORCED)
    return junctions


@R.add("g14_corridors", "net_piece net_node", None)
def g14(pieces, nodes):
    found, _, _ = N.corridors(pieces, nodes, TOL, TRUNK, START, FORCED)
    return found


@R.add("g14_unused_successors", "net_piece net_node", None)
def g14_unused(pieces, nodes):
    _, _, unused = N.corridors(pieces, nodes, TOL, TRUNK, START, FORCED)
    return unused
