"""Queries of fitted surfaces and clusters: the road surface model, blends, cross-section repair, colour clusters."""

from pyspark.sql import functions as F

from hillframe.functions import scalars as S
from hillframe.operators import colours, roadfit, sections

from .registry import Registry

R = Registry()
QUERIES, ORACLES = R.queries, R.oracles
c = F.col
r6 = S.r6


@R.add("f43_surface_model", "road_pixel road_axis", None)
def f43(pixels, roads):
    surface, _ = roadfit.surface_model(pixels, roads)
    return surface.select("road_id", "pixel", *(r6(c(x)).alias(x) for x in ("model", "kept", "height", "w")))


@R.add("f43_surface_report", "road_pixel road_axis", None)
def f43_report(pixels, roads):
    _, report = roadfit.surface_model(pixels, roads)
    return report.select("road_id", "pixels", "stations", *(r6(c(x)).alias(x) for x in ("sigma", "support_share", "fit_share")), "clamped", "unfit", "outliers")


@R.add("f44_overlap_blend", "model_cell cells", """
WITH w AS (SELECT r, c, height, pow(least(edge, 2), 2) + 0.001 AS w FROM model_cell), m AS (SELECT r, c, sum(w * height) / sum(w) AS mean, max(height) - min(height) AS spread FROM w GROUP BY 1, 2)
SELECT r, c, round(CASE WHEN z IS NULL THEN mean ELSE mean * (1 - greatest(0, least(1, (spread - 0.08) / 0.08))) + z * greatest(0, least(1, (spread - 0.08) / 0.08)) END, 6) + 0.0 AS blended, spread > 0.08 AS conflict FROM m JOIN cells USING (r, c)""")
def f44(models, cells):
    return roadfit.overlap_blend(models, cells.select("r", "c", "z"), ["r", "c"]).select("r", "c", r6(c("blended")).alias("blended"), "conflict")


@R.add("f41_section_profiles", "edge_sample edge_point", None)
def f41(samples, points):
    profiles, _ = sections.repair(samples, points)
    return profiles.select("line", "i", *(r6(c(x)).alias(x) for x in ("xa", "za", "slope")), "source")


@R.add("f41_repaired_cells", "edge_sample edge_point", None)
def f41_cells(samples, points):
    _, cells = sections.repair(samples, points)
    return cells.select("r", "c", r6(c("z")).alias("z"), "source")


@R.add("f31_cluster_colours", "pixel", None)
def f31(pixels):
    found = colours.clustered(pixels.where("masked"), threshold=48.0)
    return found.select("red", "green", "blue", "n", "cluster", r6(c("delta")).alias("delta"), "k")
