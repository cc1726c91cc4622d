"""Cells of far rows, plans that broadcast no large table, work that leaves no exchange between cells and pieces."""

import duckdb
import pandas as pd

from hillframe import catalog
from hillframe.plans import profiles, shapes
from hillframe.sources.fixtures import fixture


def test_road_extent_of_far_rows_equals_sql(spark):
    table = pd.DataFrame([(r, k, 1000.0 + 0.7 * r + 0.3 * k + (k % 4 + 118.5 if (r + k) % 3 == 0 else 120.0) / 10, False) for r in range(7_060_000, 7_060_040) for k in range(100)], columns=["r", "c", "z", "rock"])
    sql = profiles.ORACLES["d28_road_extent"]
    con = duckdb.connect()
    con.register("cells", table)
    want = con.execute("WITH " + sql[sql.index("p AS (SELECT CAST(floor(r / 2)") :]).fetchall()
    got = profiles.d28(spark.createDataFrame(table)).select("bin", "lft", "edge").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_cells_inside_rings_broadcast_no_cells(spark, sf_dir):
    plan = catalog.QUERIES["c5_point_in_polygon"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan


def test_disks_are_made_in_tasks_of_bounded_numbers_of_nodes(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(shapes, "NODES", 20)
    nodes = fixture(spark, sf_dir, "road_node")
    least = nodes.count() // 20
    assert shapes.disks(nodes).rdd.getNumPartitions() > least
    assert catalog.QUERIES["c33_soft_stamp"](spark, sf_dir).count() == shapes.disks(nodes).select("r", "c").distinct().count()
