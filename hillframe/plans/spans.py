"""Queries of spans: abutments, cross profiles, monotone heights, profiles over gaps."""

from pyspark.sql import functions as F

from hillframe.functions import scalars as S
from hillframe.operators import lines as L
from hillframe.operators import spans as P

from .lines import _ST
from .registry import Registry

R = Registry()
QUERIES, ORACLES = R.queries, R.oracles
c = F.col
r6 = S.r6

_ABUT = """un AS (SELECT span, j, s, greatest(max(z) OVER (PARTITION BY span, line ORDER BY j ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), max(z) OVER (PARTITION BY span, line ORDER BY j ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING)) - z >= 0.45 AS u FROM span_line),
fo AS (SELECT span, greatest(0, min(j) FILTER (u) - 3) AS j0, least(max(j), max(j) FILTER (u) + 3) AS j1 FROM un GROUP BY 1 HAVING max(j) >= 4 AND count(*) FILTER (u) > 0),
en AS (SELECT span, (SELECT min(s) FROM un WHERE un.span = fo.span AND un.j = fo.j0) AS l0, (SELECT min(s) FROM un WHERE un.span = fo.span AND un.j = fo.j1) AS l1 FROM fo),
ab AS (SELECT span, CASE WHEN o0 IS NOT NULL AND o1 IS NOT NULL THEN least(o0, o1) ELSE coalesce(l0, least(g0, g1)) END AS a0, CASE WHEN o0 IS NOT NULL AND o1 IS NOT NULL THEN greatest(o0, o1) ELSE coalesce(l1, greatest(g0, g1)) END AS a1,
  CASE WHEN o0 IS NOT NULL AND o1 IS NOT NULL THEN 'override' WHEN l0 IS NOT NULL THEN 'lateral' ELSE 'fallback' END AS method FROM span_end LEFT JOIN en USING (span))"""
_PULL = {0: 1.0, 1: 0.5, 2: 0.0, 3: 0.0, 4: 0.0, 5: 0.5, 6: 1.0}
_FALL = "greatest(-0.12, least(0.12, (z4 - z2) / greatest(width * (0.7 - 0.3), 1e-6)))"


def _profile_sql(i: int) -> str:
    plane = f"(z3 + cf * ({P.FRACTIONS[i]} - 0.5) * width)"
    return f"{plane} + {_PULL[i]} * greatest(-0.06, least(0.25, z{i} - {plane}))" if _PULL[i] else plane


_PROFILE = f"cp AS (SELECT span, s, width, cf, {', '.join(f'{_profile_sql(i)} AS p{i}' for i in range(7))} FROM (SELECT *, {_FALL} AS cf FROM span_station))"


@R.add("e22_abutments", "span_line span_end", f"WITH {_ABUT} SELECT span, a0, a1, method FROM ab")
def e22(terrain, ends):
    return P.abutments(terrain, ends)


@R.add("g25_cross_profile", "span_station", f"WITH {_PROFILE} SELECT span, s, round(cf, 6) + 0.0 AS crossfall, {', '.join(f'round(p{i}, 6) + 0.0 AS p{i}' for i in range(7))} FROM cp")
def g25(stations):
    profile, fall = P.cross_profile([c(f"z{i}") for i in range(7)], c("width"))
    return stations.select("span", "s", r6(fall).alias("crossfall"), *(r6(x).alias(f"p{i}") for i, x in enumerate(profile)))


@R.add("g26_span_profile", "span_station span_line span_end", f"""
WITH {_ABUT}, {_PROFILE}, t AS (SELECT cp.*, a0, a1 FROM cp JOIN ab USING (span)),
q AS (SELECT span, {', '.join(f'arg_min(p{i}, abs(s - a{k}) * 1000000 + s) AS q{k}{i}' for k in (0, 1) for i in range(7))} FROM t GROUP BY 1),
o AS (SELECT *, s > a0 + 1e-9 AND s < a1 - 1e-9 AS ov, (s - a0) / greatest(a1 - a0, 1e-6) AS sh FROM t JOIN q USING (span))
SELECT span, s, ov AS over, round(CASE WHEN ov THEN q03 + sh * (q13 - q03) ELSE p3 END, 6) + 0.0 AS centre, {', '.join(f'round(CASE WHEN ov THEN q0{i} + sh * (q1{i} - q0{i}) ELSE p{i} END, 6) + 0.0 AS p{i}' for i in range(7))} FROM o""")
def g26(stations, terrain, ends):
    t = P.span_profile(stations, P.abutments(terrain, ends))
    return t.select("span", "s", "over", *(r6(c(x)).alias(x) for x in ("centre", *(f"p{i}" for i in range(7)))))


@R.add("g26_monotone_heights", "road_node", f"""
WITH {_ST}, kn AS (SELECT road_id, s, min(z) AS z FROM st WHERE seq % 4 = 0 AND road_id % 5 > 0 OR seq % 19 = 0 GROUP BY 1, 2),
a AS (SELECT *, lead(s) OVER w AS s1, lead(z) OVER w AS z1 FROM kn WINDOW w AS (PARTITION BY road_id ORDER BY s)), b AS (SELECT *, s1 - s AS h, (z1 - z) / (s1 - s) AS d FROM a),
e AS (SELECT *, lag(h) OVER w AS h0, lag(d) OVER w AS d0, lead(h) OVER w AS h2, lead(d) OVER w AS d2, lag(h, 2) OVER w AS hb, lag(d, 2) OVER w AS db FROM b WINDOW w AS (PARTITION BY road_id ORDER BY s)),
g AS (SELECT *, ((2 * h + h2) * d - h * d2) / (h + h2) AS mf, ((2 * h0 + hb) * d0 - h0 * db) / (h0 + hb) AS ml FROM e),
m AS (SELECT *, CASE WHEN h0 IS NULL THEN CASE WHEN h2 IS NULL THEN d WHEN sign(mf) <> sign(d) THEN 0 WHEN sign(d) <> sign(d2) AND abs(mf) > 3 * abs(d) THEN 3 * d ELSE mf END
  WHEN h IS NULL THEN CASE WHEN hb IS NULL THEN d0 WHEN sign(ml) <> sign(d0) THEN 0 WHEN sign(d0) <> sign(db) AND abs(ml) > 3 * abs(d0) THEN 3 * d0 ELSE ml END
  WHEN d0 * d <= 0 THEN 0 ELSE (3 * h + 3 * h0) / ((2 * h + h0) / d0 + (h + 2 * h0) / d) END AS m FROM g),
f AS (SELECT *, lead(m) OVER (PARTITION BY road_id ORDER BY s) AS m1, max(s1) OVER (PARTITION BY road_id) AS top FROM m), n AS (SELECT road_id, max(s) AS len FROM st GROUP BY 1),
p AS (SELECT road_id, unnest(generate_series(0, CAST(floor(len / 5) AS BIGINT))) AS i FROM n),
j AS (SELECT p.road_id, i, (i * 5.0 - s) / (s1 - s) AS t, s1 - s AS h, z, z1, m, m1 FROM p JOIN f ON p.road_id = f.road_id AND i * 5.0 >= s AND (i * 5.0 < s1 OR (s1 = top AND i * 5.0 <= s1)))
SELECT road_id, i, round(z * (1 + 2 * t) * (1 - t) * (1 - t) + m * h * t * (1 - t) * (1 - t) + z1 * t * t * (3 - 2 * t) + m1 * h * t * t * (t - 1), 6) + 0.0 AS z FROM j""")
def g26_heights(nodes):
    st = L.stations(nodes)
    knots = st.where("seq % 4 = 0 and road_id % 5 > 0 or seq % 19 = 0").select("road_id", "s", "z")
    length = st.groupBy("road_id").agg(F.max("s").alias("len"))
    points = length.select("road_id", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(c("len") / 5))).alias("i")).withColumn("at", c("i") * 5.0)
    return P.on_curve(P.monotone_slopes(knots, "road_id"), points, "road_id").select("road_id", "i", r6(c("z")).alias("z"))
