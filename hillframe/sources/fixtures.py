"""Terrain, road and tag tables derived from the star-schema test tables.

Each is one SELECT that Spark SQL and DuckDB both run. `fixture` gives it as a DataFrame over a folder of Parquet files, `ctes`
as WITH clauses over views of the same names.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

FIXTURES = {
    "cells": """
SELECT CAST(FLOOR(event_id / 100) AS BIGINT) AS r, CAST(event_id % 100 AS BIGINT) AS c,
       CASE WHEN event_id % 97 = 0 THEN NULL
            ELSE CAST(1000.0 AS DOUBLE) + CAST(0.7 AS DOUBLE) * CAST(FLOOR(event_id / 100) AS BIGINT) + CAST(0.3 AS DOUBLE) * (event_id % 100) + value / 10 END AS z,
       CASE WHEN event_id % 89 = 0 THEN NULL
            ELSE CAST(1000.0 AS DOUBLE) + CAST(0.7 AS DOUBLE) * CAST(FLOOR(event_id / 100) AS BIGINT) + CAST(0.3 AS DOUBLE) * (event_id % 100) + value / 10
                 + CASE WHEN event_type IN ('view', 'click') THEN value / 10 ELSE CAST(0.0 AS DOUBLE) END END AS dom,
       CAST(CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 ELSE 4 + event_id % 3 END AS BIGINT) AS code,
       CAST(3.0 AS DOUBLE) + CAST(event_id % 11 AS DOUBLE) / 2 AS twi, user_id % 7 = 0 AS rock, user_id % 13 = 0 AS asphalt
FROM events""",
    "road_node": """
SELECT road_id, seq, CAST((road_id % 25) * 40 + SUM(dx) OVER (PARTITION BY road_id ORDER BY seq) AS DOUBLE) AS x,
       CAST(CAST(FLOOR(road_id / 25) AS BIGINT) * 30 + SUM(dy) OVER (PARTITION BY road_id ORDER BY seq) AS DOUBLE) AS y,
       z, CAST(4 + road_id % 5 AS DOUBLE) AS w
FROM (SELECT CAST(FLOOR(event_id / 20) AS BIGINT) AS road_id, CAST(event_id % 20 AS BIGINT) AS seq, 5 + (event_id * 7) % 5 AS dx, (event_id * 13) % 7 - 3 AS dy,
             CAST(1000.0 AS DOUBLE) + value / 25 AS z FROM events) t""",
    "road": """
SELECT road_id,
       CASE road_id % 9 WHEN 0 THEN 'S-B' WHEN 1 THEN 'S-BB' WHEN 2 THEN 'S-L' WHEN 3 THEN 'S-LB' WHEN 4 THEN 'S-BT'
            WHEN 5 THEN 'S-G' WHEN 6 THEN 'S-F' WHEN 7 THEN 'S-BR' ELSE 'S-BG' END AS objekt,
       CASE WHEN road_id % 4 = 0 THEN '' WHEN road_id % 3 = 0 THEN 'L13' ELSE 'B179' END AS str_code,
       CASE WHEN road_id % 6 = 1 THEN 'Brücke Nord' WHEN road_id % 10 = 4 THEN 'Galerie Ost' WHEN road_id % 15 = 7 THEN 'Unterführung' ELSE NULL END AS kunstbauten
FROM (SELECT DISTINCT CAST(FLOOR(event_id / 20) AS BIGINT) AS road_id FROM events) t""",
    "ring": """
SELECT CAST(p_partkey AS BIGINT) AS poly_id, CAST(k AS BIGINT) AS seq,
       CAST((p_partkey * 37) % 100 AS DOUBLE) + CAST(0.25 AS DOUBLE) + CASE k WHEN 0 THEN CAST(1.0 AS DOUBLE) + CAST(p_size AS DOUBLE) / 10 WHEN 2 THEN CAST(-1.0 AS DOUBLE) - CAST(p_size AS DOUBLE) / 10 ELSE CAST(0.0 AS DOUBLE) END AS x,
       -CAST((p_partkey * 53) % 100 AS DOUBLE) - CAST(0.25 AS DOUBLE) + CASE k WHEN 1 THEN CAST(-1.0 AS DOUBLE) - CAST(p_size AS DOUBLE) / 10 WHEN 3 THEN CAST(1.0 AS DOUBLE) + CAST(p_size AS DOUBLE) / 10 ELSE CAST(0.0 AS DOUBLE) END AS y,
       CASE p_partkey % 4 WHEN 0 THEN 'LN-VSU' WHEN 1 THEN 'LN-VSO' WHEN 2 THEN 'LN-VFW' ELSE 'LN-VPR' END AS objekt
FROM part CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3) v""",
    "pixel": """
SELECT CAST((l_partkey * 7 + l_suppkey) % 256 AS BIGINT) AS red, CAST((l_partkey * 11 + l_linenumber * 31) % 256 AS BIGINT) AS green,
       CAST((l_suppkey * 17 + l_orderkey) % 256 AS BIGINT) AS blue, l_linenumber % 3 = 0 AS masked FROM lineitem""",
    "scene": """
SELECT CAST(l_orderkey % 10000 AS BIGINT) AS cell, l_shipdate AS ts, CAST(l_suppkey AS BIGINT) AS k1, CAST(l_partkey AS BIGINT) AS k2,
       CAST(CASE WHEN l_linenumber = 1 THEN 205 WHEN l_linenumber = 2 THEN 210 WHEN l_linenumber = 3 THEN 255 ELSE CAST(l_quantity * 2 AS INT) END AS BIGINT) AS code FROM lineitem""",
    "layer": """
SELECT CAST(l_orderkey % 10000 AS BIGINT) AS cell,
       CASE WHEN l_linenumber <= 2 THEN 'water' WHEN l_linenumber = 3 THEN 'road_bed' WHEN l_linenumber = 4 THEN 'corridor_dgm' ELSE 'span' END AS name,
       CASE WHEN l_linenumber = 5 THEN 'bridge' WHEN l_linenumber >= 6 THEN 'gallery' ELSE '' END AS part,
       MAX(CAST(l_discount AS DOUBLE) * 10) AS weight,
       MAX(CASE WHEN l_linenumber <= 2 THEN -CAST(l_tax AS DOUBLE) * 10 ELSE CAST(1000.0 AS DOUBLE) + CAST(l_quantity AS DOUBLE) END) AS v
FROM lineitem GROUP BY 1, 2, 3""",
    "tags": """
SELECT CAST(p_partkey AS BIGINT) AS way_id,
       CASE p_partkey % 7 WHEN 0 THEN '7,5 m' WHEN 1 THEN '6.5' WHEN 2 THEN '5;6' WHEN 3 THEN 'wide' ELSE NULL END AS width,
       CASE p_partkey % 5 WHEN 0 THEN '2' WHEN 1 THEN '3|2' ELSE NULL END AS lanes,
       CASE WHEN p_partkey % 3 = 0 THEN '1' ELSE NULL END AS lanes_forward, CASE WHEN p_partkey % 2 = 0 THEN '1' ELSE NULL END AS lanes_backward,
       CASE p_partkey % 4 WHEN 0 THEN 'primary' WHEN 1 THEN 'residential' WHEN 2 THEN 'track' ELSE NULL END AS highway FROM part""",
    "building": """
SELECT CAST(p_partkey AS BIGINT) AS way_id, CASE p_partkey % 6 WHEN 0 THEN '7,5 m' WHEN 1 THEN '12;9' WHEN 2 THEN 'tall' WHEN 3 THEN '1' ELSE NULL END AS height,
       CASE p_partkey % 4 WHEN 0 THEN '3' WHEN 1 THEN '2|1' WHEN 2 THEN 'x' ELSE NULL END AS levels,
       CASE p_partkey % 5 WHEN 0 THEN 'house' WHEN 1 THEN 'Church' WHEN 2 THEN 'garage' WHEN 3 THEN 'yes' ELSE NULL END AS building FROM part""",
    "ground_tag": """
SELECT CAST(p_partkey AS BIGINT) AS way_id, CASE p_partkey % 7 WHEN 0 THEN 'bare_rock' WHEN 1 THEN 'Wood' WHEN 2 THEN 'heath' WHEN 3 THEN 'water' ELSE NULL END AS natural_tag,
       CASE p_partkey % 5 WHEN 0 THEN 'quarry' WHEN 1 THEN 'meadow' WHEN 2 THEN 'Residential' WHEN 3 THEN 'forest' ELSE NULL END AS landuse_tag FROM part""",
    "raw_id": """
SELECT CAST(c_custkey AS BIGINT) AS k, CAST(CASE c_custkey % 3 WHEN 0 THEN c_custkey WHEN 1 THEN 10000000 + c_custkey ELSE 20000000 + c_custkey END AS BIGINT) AS raw,
       CASE c_custkey % 2 WHEN 0 THEN 'tirol' ELSE 'suedtirol' END AS authority FROM customer""",
    "run": """
SELECT CAST(user_id AS BIGINT) AS site, event_type AS step, ts AS finished_at, value < 100 AS ok, value AS seconds, event_id FROM events""",
    "attempt": """
SELECT CAST(event_id % 400 AS BIGINT) AS tile, CAST(FLOOR(event_id / 400) AS BIGINT) AS attempt, value / 500 AS nodata_share FROM events""",
    "label": """
SELECT CAST(p_partkey AS BIGINT) AS id, CASE p_partkey % 7 WHEN 0 THEN 'BrÃ¼cke Nord' WHEN 1 THEN 'Brücke' WHEN 2 THEN 'MÃ¼hlkÃ¶gele' WHEN 3 THEN 'plain' WHEN 4 THEN 'Ã' WHEN 5 THEN '日本 Ã¼' ELSE NULL END AS name FROM part""",
    "id_token": """
SELECT CAST(p_partkey AS BIGINT) AS k, CASE p_partkey % 7 WHEN 0 THEN '2301-2304' WHEN 1 THEN CAST(p_partkey AS STRING) WHEN 2 THEN ' 9 - 7 ' WHEN 3 THEN 'x9' WHEN 4 THEN '5..6' WHEN 5 THEN '' ELSE NULL END AS token,
       CASE p_partkey % 8 WHEN 0 THEN '>20' WHEN 1 THEN '>=25' WHEN 2 THEN '!=7' WHEN 3 THEN ' 12 ' WHEN 4 THEN '<= 30.5' WHEN 5 THEN '==14' WHEN 6 THEN 'about 3' ELSE '<10' END AS predicate,
       CASE WHEN p_partkey % 11 = 3 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS value,
       CASE p_partkey % 6 WHEN 0 THEN 'Both' WHEN 1 THEN 'rail, leitpoller' WHEN 2 THEN ' posts,sections,post' WHEN 3 THEN 'unknown' WHEN 4 THEN 'sections' ELSE NULL END AS styles FROM part""",
    "landuse_row": """
SELECT CAST(p_partkey AS BIGINT) AS id, CASE p_partkey % 2 WHEN 0 THEN 'tirol' ELSE 'suedtirol' END AS authority,
       CASE p_partkey % 9 WHEN 0 THEN 'Stehendes Gewässer' WHEN 1 THEN 'Bundesstraße' WHEN 2 THEN 'Wohnen' WHEN 3 THEN 'Hochwald' WHEN 4 THEN 'Krummholz' WHEN 5 THEN 'Alm' WHEN 6 THEN 'stehend' ELSE NULL END AS klasse,
       CASE p_partkey % 10 WHEN 0 THEN 'LN-GWS' WHEN 1 THEN 'ln-vsu' WHEN 2 THEN 'LN-SWO' WHEN 3 THEN 'LN-WHW' WHEN 4 THEN 'LN-WST' WHEN 5 THEN 'LN-X' WHEN 6 THEN 'WHOCH' WHEN 7 THEN 'LN-GFL' ELSE NULL END AS objekt,
       CASE p_partkey % 11 WHEN 0 THEN 'Gewässer' WHEN 1 THEN 'Siedlung' WHEN 2 THEN 'Mischwald' WHEN 3 THEN 'Extensives Grünland' WHEN 4 THEN 'Strauch' WHEN 5 THEN 'hochwald' ELSE NULL END AS bez FROM part""",
    "element": """
SELECT CONCAT('{"type":"', CASE p_partkey % 5 WHEN 0 THEN 'node' ELSE 'way' END, '","id":', CAST(p_partkey AS STRING), ',"geometry":[',
         CASE WHEN p_size % 4 = 0 THEN '' ELSE CONCAT('{"lon":', CAST(p_size AS STRING), '.5,"lat":47.25}') END, CASE WHEN p_size % 4 >= 2 THEN CONCAT(',{"lon":', CAST(p_size + 1 AS STRING), '.5,"lat":47.5}') ELSE '' END,
         '],"tags":{"highway":"', CASE p_partkey % 3 WHEN 0 THEN 'primary' ELSE 'track' END, '"', CASE WHEN p_partkey % 4 = 1 THEN ',"width":"6.5","sac":"T2"' ELSE '' END, '}}') AS body FROM part""",
    "file": """
SELECT CAST(user_id AS BIGINT) AS tile, CONCAT('/in/T', CAST(user_id AS STRING), '/FSC_2023', CAST(1000 + event_id % 200 AS STRING), 'T10', CAST(1000 + event_id % 8000 AS STRING), CASE event_type WHEN 'view' THEN '_S2A_FSCOG.tif' WHEN 'click' THEN '_S2B_FSCOG-QA.tif' WHEN 'purchase' THEN '_S2B_FSCOG.tif' ELSE '_S2A_QC.tif' END) AS path FROM events""",
    "road_end": """
SELECT CAST(s_suppkey AS BIGINT) AS objectid, CASE s_suppkey % 2 WHEN 0 THEN 'tirol' ELSE 'suedtirol' END AS authority,
       CAST((s_suppkey * 7) % 50 AS DOUBLE) AS x, CAST((s_suppkey * 3) % 40 AS DOUBLE) AS y FROM supplier""",
    "road_axis": """
SELECT road_id, CAST(58.0 AS DOUBLE) + road_id % 3 AS length FROM (SELECT DISTINCT CAST(FLOOR(l_orderkey / 400) AS BIGINT) AS road_id FROM lineitem) t""",
    "road_pixel": """
SELECT road_id, pixel, LEAST(raw, CAST(58.0 AS DOUBLE) + road_id % 3) AS s, t, GREATEST(raw - CAST(58.0 AS DOUBLE) - road_id % 3, CAST(0.0 AS DOUBLE)) AS e, half - ABS(t) AS edge,
       CASE WHEN pixel % 101 = 7 THEN NULL WHEN road_id % 13 = 2 THEN 1000 + price ELSE CAST(1000.0 AS DOUBLE) + raw * 0.04 + t * (road_id % 7 - 3) * 0.07 + noise + CASE WHEN quantity > 47 THEN CAST(0.3 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END END AS z
FROM (SELECT CAST(FLOOR(l_orderkey / 400) AS BIGINT) AS road_id, CAST(l_orderkey * 8 + l_linenumber AS BIGINT) AS pixel, CAST(l_orderkey % 400 AS DOUBLE) * 0.15 + CAST(l_linenumber AS DOUBLE) * 0.02 AS raw,
             CAST((l_partkey * 37 + l_linenumber * 11) % 129 AS DOUBLE) / 8 - 8 AS t, CAST(4 + FLOOR(l_orderkey / 400) % 5 AS DOUBLE) AS half, CAST(l_discount AS DOUBLE) / 5 AS noise, CAST(l_quantity AS DOUBLE) AS quantity, CAST((l_partkey * 7 + l_suppkey) % 400 AS DOUBLE) / 100 AS price
      FROM (SELECT l_orderkey, l_linenumber, MAX(l_partkey) AS l_partkey, MAX(l_suppkey) AS l_suppkey, MAX(l_discount) AS l_discount, MAX(l_quantity) AS l_quantity FROM lineitem GROUP BY 1, 2) q) p
WHERE ABS(t) < half""",
    "model_cell": """
SELECT CAST(FLOOR(l_partkey % 1000 / 100) AS BIGINT) AS r, CAST(l_partkey % 100 AS BIGINT) AS c, CAST(l_quantity AS DOUBLE) / 12 AS edge,
       CAST(1000.0 AS DOUBLE) + CAST(l_partkey % 7 AS DOUBLE) + CASE WHEN l_partkey % 3 = 0 THEN CAST(l_discount AS DOUBLE) * 2 ELSE CAST(l_discount AS DOUBLE) / 2 END AS height FROM lineitem""",
    "net_piece": """
SELECT piece, CASE WHEN piece % 17 = 0 THEN NULL WHEN piece % 29 = 3 THEN 'L7' ELSE CONCAT('B', CAST(CAST(FLOOR(piece / 72) AS BIGINT) AS STRING)) END AS code,
       CASE WHEN piece % 23 = 5 THEN 'bridge' WHEN piece % 4 = 1 THEN NULL ELSE 'road' END AS objekt, CASE WHEN piece % 31 = 8 THEN 'track' ELSE 'primary' END AS highway, CAST(10 + (piece * 37) % 41 AS DOUBLE) AS length
FROM (SELECT CAST(c_custkey AS BIGINT) AS piece FROM customer) t""",
    "net_node": """
SELECT piece, seq, CAST(10 * (u + seq * du) AS DOUBLE) / 2 + CASE seq WHEN 1 THEN CAST((piece * 13) % 5 AS DOUBLE) / 4 ELSE CAST((piece * 11) % 7 AS DOUBLE) / 20 END AS x,
       CAST(10 * (v + seq * dv) AS DOUBLE) / 2 + CASE seq WHEN 1 THEN CAST((piece * 17) % 7 AS DOUBLE) / 4 ELSE CAST((piece * 19) % 5 AS DOUBLE) / 20 END AS y
FROM (SELECT CAST(c_custkey AS BIGINT) AS piece, CAST(q AS BIGINT) AS seq, 2 * (c_custkey % 12) + CASE WHEN c_custkey % 5 = 0 THEN 2 * (1 - CAST(c_custkey % 3 = 1 AS INT)) ELSE 0 END AS u,
             2 * CAST(FLOOR(c_custkey / 12) AS BIGINT) + CASE WHEN c_custkey % 5 = 0 THEN 2 * CAST(c_custkey % 3 > 0 AS INT) ELSE 0 END AS v,
             (CASE WHEN c_custkey % 5 = 0 THEN -1 ELSE 1 END) * (1 - CAST(c_custkey % 3 = 1 AS INT)) AS du, (CASE WHEN c_custkey % 5 = 0 THEN -1 ELSE 1 END) * CAST(c_custkey % 3 > 0 AS INT) AS dv
      FROM customer CROSS JOIN (SELECT 0 AS q UNION ALL SELECT 1 UNION ALL SELECT 2) w) t""",
    "edge_point": """
SELECT line, i, CAST(i AS DOUBLE) / 2 AS s, CAST(i AS DOUBLE) / 2 AS x, CASE line % 3 WHEN 0 THEN CAST(0.0 AS DOUBLE) WHEN 1 THEN CAST(i * i AS DOUBLE) * 0.0005 ELSE CAST(ABS(i % 30 - 15) AS DOUBLE) / 8 END AS y
FROM (SELECT CAST(FLOOR(event_id / 100) AS BIGINT) AS line, CAST(event_id % 100 AS BIGINT) AS i FROM events) t""",
    "edge_sample": """
SELECT line, i, CAST(k AS DOUBLE) / 4 AS off, CASE WHEN (id * 7 + k * 13) % 37 = 0 THEN NULL ELSE CAST(1000.0 AS DOUBLE) + i * 0.02 + CAST(k AS DOUBLE) / 4 * (0.03 + line % 5 * 0.02) + CAST((id * 31 + k * 17) % 11 AS DOUBLE) * (0.0005 + (id * 3) % 8 * 0.001) END AS z,
       CASE WHEN line % 4 = 1 AND i BETWEEN 20 AND 75 OR line % 4 = 2 AND i BETWEEN 40 AND 55 THEN CAST(0.05 AS DOUBLE) WHEN k < (id * 5) % 9 THEN CAST(0.03 AS DOUBLE) WHEN (id + k) % 41 = 0 THEN NULL ELSE CAST((id + k * 3) % 10 AS DOUBLE) / 1000 END AS rough,
       k < 22 AS inside, line * 30 + k AS r, CAST(FLOOR(i / 2) AS BIGINT) AS c
FROM (SELECT CAST(event_id AS BIGINT) AS id, CAST(FLOOR(event_id / 100) AS BIGINT) AS line, CAST(event_id % 100 AS BIGINT) AS i, CAST(q AS BIGINT) AS k FROM events CROSS JOIN (VALUES """+", ".join(f"({k})" for k in range(25))+""") w(q)) t""",
    "fine_cell": """
SELECT CAST(FLOOR(event_id / 100) AS BIGINT) AS r, CAST(event_id % 100 AS BIGINT) AS c,
       CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(1000.0 AS DOUBLE) + CAST(0.02 AS DOUBLE) * (event_id % 100) + CAST(0.01 AS DOUBLE) * CAST(FLOOR(event_id / 100) AS BIGINT)
            + CAST((event_id * 31 + user_id * 17) % 41 AS DOUBLE) / CASE WHEN FLOOR(event_id / 100) % 6 < 3 THEN 1600 ELSE 700 END END AS z FROM events""",
    "axis_node": """
SELECT road_id, seq, CAST(road_id % 2 * 44 + 2 AS DOUBLE) + seq * CAST(2.25 AS DOUBLE) + CAST(road_id % 5 AS DOUBLE) / 5 AS x,
       -CAST(FLOOR(road_id / 2) * 2 + 1 AS DOUBLE) - CAST(ABS(seq % 16 - 8) AS DOUBLE) / 8 - CAST(road_id * 7 % 5 AS DOUBLE) / 4 - CAST(jitter AS DOUBLE) / 20 AS y, CAST(1000.0 AS DOUBLE) AS z, CAST(3 + road_id % 4 AS DOUBLE) / 1.25 AS w
FROM (SELECT CAST(FLOOR(event_id / 100) AS BIGINT) AS road_id, CAST(FLOOR(event_id % 100 / 5) AS BIGINT) AS seq, MAX(user_id) % 5 AS jitter FROM events GROUP BY 1, 2) t""",
    "post": """
SELECT CAST(event_id AS BIGINT) AS id, event_type AS kind, CAST((event_id * 37 + user_id * 11) % 199 AS DOUBLE) / 20 AS x, CAST(FLOOR(event_id / 1000) AS DOUBLE) * 6 + CAST((event_id * 53 + user_id * 7) % 101 AS DOUBLE) / 20 AS y FROM events""",
    "span_line": """
SELECT CAST(FLOOR(event_id / 100) AS BIGINT) AS span, CAST(event_id % 5 AS BIGINT) AS line, CAST(FLOOR(event_id % 100 / 5) AS BIGINT) AS j, CAST(FLOOR(event_id % 100 / 5) AS DOUBLE) AS s,
       CAST(1000.0 AS DOUBLE) + value / 2000 - CASE WHEN FLOOR(event_id / 100) % 4 < 3 AND FLOOR(event_id % 100 / 5) BETWEEN 7 + event_id % 3 AND 11 + event_id % 4 THEN CAST(event_id % 7 AS DOUBLE) / 5 ELSE CAST(0.0 AS DOUBLE) END AS z FROM events""",
    "span_end": """
SELECT span, CAST(13.0 AS DOUBLE) AS g0, CAST(6.0 AS DOUBLE) AS g1, CASE WHEN span % 7 = 3 THEN CAST(12.5 AS DOUBLE) ELSE NULL END AS o0, CASE WHEN span % 7 = 3 THEN CAST(5.0 AS DOUBLE) ELSE NULL END AS o1
FROM (SELECT DISTINCT CAST(FLOOR(event_id / 100) AS BIGINT) AS span FROM events) t""",
    "span_station": """
SELECT CAST(FLOOR(event_id / 100) AS BIGINT) AS span, CAST(event_id % 100 AS DOUBLE) / 5 AS s, CAST(6 + event_id % 3 AS DOUBLE) AS width,
       """ + ", ".join(f"CAST(1000.0 AS DOUBLE) + CAST(event_id % 100 AS DOUBLE) / 40 + CAST((event_id * {7 * k + 3} + user_id * {k + 1}) % 41 AS DOUBLE) / 60 + {k} * (event_id % 5) * CAST(0.04 AS DOUBLE) AS z{k}" for k in range(7)) + """ FROM events""",
}


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The derived table over the Parquet files of a folder."""
    text = re.sub(r"\bFROM (events|part|lineitem|customer|supplier)\b", lambda m: f"FROM parquet.`{sf_dir}/{m[1]}.parquet`", FIXTURES[name])
    return spark.sql(text)


def ctes(*names: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({FIXTURES[n]})" for n in names)
