"""Road ends that meet at a border of two authorities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hillframe.operators import lines as L
from hillframe.operators.iterate import cell_id, components, cut

c = F.col


def end_groups(ends: DataFrame, border: DataFrame, band: float, snap: float) -> DataFrame:
    """ends (end_id, objectid, authority, x, y) within band of the border's segments, with grp and n, the size of their group.

    Ends at most snap apart are of one group, and so on. Ends of one cell of side snap / sqrt(2) always are, so that cells are
    the nodes, and a pile of ends at one place is one node; pairs of ends are only looked at between cells. grp: the group's least end_id.
    """
    if band <= 0 or snap <= 0:
        raise ValueError("band and snap must be positive")
    near = L.nearest_on_line(ends.select("end_id", c("x").alias("px"), c("y").alias("py")), border, "end_id", band).select("end_id")
    side = snap / 2**0.5
    own = cut(ends.join(near, "end_id", "left_semi").withColumns({"cx": F.floor(c("x") / side), "cy": F.floor(c("y") / side)}), "border-ends")
    spots = own.select("cx", "cy", "x", "y").distinct()
    step = F.array(*(F.lit(k) for k in range(-2, 3)))
    around = spots.withColumn("ox", F.explode(F.transform(step, lambda k: c("cx") + k))).withColumn("oy", F.explode(F.transform(step, lambda k: c("cy") + k)))
    other = spots.select(c("cx").alias("ox"), c("cy").alias("oy"), c("x").alias("x2"), c("y").alias("y2"))
    u, v = cell_id(c("cx"), c("cy")), cell_id(c("ox"), c("oy"))
    dx, dy = c("x2") - c("x"), c("y2") - c("y")
    met = around.where(u < v).join(other, ["ox", "oy"]).where(F.sqrt(dx * dx + dy * dy) <= snap)
    label = components(met.select(u.alias("u"), v.alias("v")).distinct())
    own = own.withColumn("node", cell_id(c("cx"), c("cy"))).join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
    sizes = own.groupBy("component").agg(F.min("end_id").alias("grp"), F.count(F.lit(1)).alias("n"))
    return own.join(sizes, "component").select("end_id", "objectid", "authority", "x", "y", "grp", "n")


def border_links(groups: DataFrame, confirmed: DataFrame) -> DataFrame:
    """from_objectid, to_objectid (smaller id first), their authorities, distance, confirmed.

    A group of two ends of different authorities is a link; confirmed pairs (a, b) without one are added without a distance. Larger groups are for review.
    """
    two = groups.where("n = 2").groupBy("grp").agg(F.min(F.struct("objectid", "end_id", "authority", "x", "y")).alias("a"), F.max(F.struct("objectid", "end_id", "authority", "x", "y")).alias("b"))
    dx, dy = c("a.x") - c("b.x"), c("a.y") - c("b.y")
    found = two.where("a.authority <> b.authority").select(c("a.objectid").alias("from_objectid"), c("b.objectid").alias("to_objectid"), c("a.authority").alias("from_authority"), c("b.authority").alias("to_authority"), F.sqrt(dx * dx + dy * dy).alias("distance"))
    sure = confirmed.select(F.least("a", "b").alias("from_objectid"), F.greatest("a", "b").alias("to_objectid"), F.lit(True).alias("confirmed")).distinct()
    return found.join(sure, ["from_objectid", "to_objectid"], "full").withColumn("confirmed", F.coalesce("confirmed", F.lit(False)))
