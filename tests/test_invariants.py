"""Invariants that SQL twins don't state."""

import time

import pyspark.sql.functions as F
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from hillframe.operators import focal, iterate, lines, surface
from hillframe.streaming import twins


def _plane(spark, n=12):
    return spark.range(n * n).select((F.col("id") / n).cast("long").alias("r"), (F.col("id") % n).alias("c")).withColumn("z", 2.0 * F.col("c") + 3.0 * F.col("r"))


def test_a_plane_has_no_roughness_and_one_slope(spark):
    inner = focal.roughness(_plane(spark), "z").where("r between 1 and 10 and c between 1 and 10")
    assert inner.where("rough > 1e-9").count() == 0
    assert focal.slope_aspect(_plane(spark), "z", 1.0).select(F.round("slope", 6)).distinct().count() == 1


def test_opening_is_below_the_value(spark):
    t = _plane(spark).withColumn("v", F.pmod(F.hash("r", "c"), F.lit(7)))
    t = focal.square(focal.square(t, "v", 1, F.min, "e"), "e", 1, F.max, "o")
    assert t.where("o > v").count() == 0


def test_flow_ends_in_sinks(spark):
    t = focal.d8(_plane(spark).withColumn("z", F.col("z") + F.pmod(F.hash("r", "c"), F.lit(50))), "z")
    i, j = F.array(*(F.lit(a) for _, a, _ in focal.NEIGHBOURS)), F.array(*(F.lit(b) for _, _, b in focal.NEIGHBOURS))
    to = F.when(F.col("to") >= 0, (F.col("r") + F.element_at(i, F.col("to") + 1)) * 1000 + F.col("c") + F.element_at(j, F.col("to") + 1))
    flow = t.select((F.col("r") * 1000 + F.col("c")).alias("cell"), to.alias("to"))
    acc = iterate.flow_accumulation(flow).join(flow, "cell")
    assert acc.where("to is null").agg(F.sum("acc")).first()[0] == 144


def test_slew_limit_holds(spark):
    rows = [(1, float(s), v) for s, v in enumerate([0.0, 9.0, None, 5.0, 5.0, -3.0, 0.1])]
    got = [r["v"] for r in lines.slew_limit(spark.createDataFrame(rows, "k long, s double, v double"), "k", "s", "v", 0.4).orderBy("s").collect()]
    assert got[2] is None
    known = [(a, b) for a, b in zip(got, got[1:], strict=False) if a is not None and b is not None]
    assert all(abs(a - b) <= 0.4 + 1e-9 for a, b in known)


def test_zero_weights_keep_the_base(spark):
    base = spark.createDataFrame([(1, 5.0), (2, 7.0)], "cell long, z double")
    layers = spark.createDataFrame([(1, "a", "", 0.0, 99.0)], "cell long, name string, part string, weight double, v double")
    got = surface.compose(base, layers, {"a": (1, "replace")}, 100.0)
    assert {(r["cell"], r["z"]) for r in got.collect()} == {(1, 5.0), (2, 7.0)}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(links=st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), min_size=1, max_size=14))
def test_components_equal_union_find(spark, links):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {r["node"]: r["component"] for r in iterate.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {x: find(x) for x in got}
    assert set(got) == {x for link in links for x in link}


def test_streamed_intake_equals_batch(spark, tmp_path):
    schema = "tile long, attempt long, nodata_share double"
    rows = [(t, a, ((t * 7 + a * 3) % 10) / 10) for a in range(6) for t in range(9)]
    source = str(tmp_path / "in")
    for a in range(0, 6, 2):
        spark.createDataFrame([r for r in rows if r[1] in (a, a + 1)], schema).coalesce(1).write.mode("append").parquet(source)
    query = twins.intake_stream(spark, source, schema, str(tmp_path / "state"), str(tmp_path / "check"), 0.3)
    query.awaitTermination(120)
    last = max(int(p.name.partition("=")[2]) for p in (tmp_path / "state").iterdir())
    got = {tuple(r) for r in spark.read.parquet(str(tmp_path / "state" / f"batch={last}")).select("tile", "attempt", "attempts", "failed").collect()}
    want = {tuple(r) for r in twins.intake_batch(spark.createDataFrame(rows, schema), 0.3).select("tile", "attempt", "attempts", "failed").collect()}
    assert got == want


def test_streamed_monitor_drops_late_rows(spark, tmp_path):
    schema = "step string, finished_at timestamp, seconds double, ok boolean, event_id long"
    source = str(tmp_path / "runs")
    # a batch drops what is older than the watermark of the batch before it: two batches pass before the late row
    for rows in ([("a", "2024-01-01 10:10:00", 1.0, True, 1), ("a", "2024-01-01 10:20:00", 3.0, False, 2)], [("a", "2024-01-01 15:00:00", 5.0, True, 3)], [("a", "2024-01-01 15:10:00", 7.0, True, 6)], [("a", "2024-01-01 10:30:00", 99.0, True, 4), ("a", "2024-01-01 19:00:00", 1.0, True, 5)]):
        t = spark.createDataFrame(rows, "step string, at string, seconds double, ok boolean, event_id long")
        t.selectExpr("step", "cast(at as timestamp) as finished_at", "seconds", "ok", "event_id").coalesce(1).write.mode("append").parquet(source)
        time.sleep(1.1)  # files are read in the order of their times
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    query = twins.monitor(stream).writeStream.format("memory").queryName("monitored").option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    got = [(r["n"], r["mean"], r["p50"], r["ok"]) for r in spark.table("monitored").orderBy("window").collect()]
    assert got == [(2, 2.0, 2.0, False), (2, 6.0, 6.0, True)]
