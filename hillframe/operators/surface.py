"""Snow, biomes, materials and height layers of cell tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hillframe.functions.scalars import clip, smoothstep

# The November snow preset and the composition thresholds.
NOVEMBER = {"t0": 1.5, "z0": 1200.0, "lapse": 0.0065, "snow": 1.0, "full": -4.0, "aspect": 0.40, "steep": 48.0, "steep_factor": 0.25}
CANOPY_M, CLEARING_M, WET, SNOW_LIGHT, SNOW_HEAVY = 5.0, 1.0, 5.0, 0.25, 0.55


def snow_share(z: Column, slope: Column, aspect: Column, p: dict = NOVEMBER) -> Column:
    """Snow 0 to 1 from temperature by height, aspect (none on flats) and steepness."""
    cold = 1 - smoothstep(p["full"], p["snow"], p["t0"] - p["lapse"] * (z - p["z0"]))
    side = F.when(slope < 0.5, 1.0).otherwise(clip(1 + p["aspect"] * F.cos(F.radians(aspect)), 0.05, 2.0))
    steep = 1 + (p["steep_factor"] - 1) * clip(slope / p["steep"], 0.0, 1.0)
    return clip(cold * side * steep, 0.0, 1.0)


def soft_biome(code: Column, ndsm: Column, twi: Column, rock: Column) -> Column:
    """Biome before snow: water over rock over forest by canopy height over meadow and bare by wetness."""
    wet, canopy, clearing = twi >= WET, ndsm >= CANOPY_M, ndsm < CLEARING_M
    return (
        F.when(code == 5, "water")
        .when(rock, "rock")
        .when((code == 0) & canopy, "forest_tall")
        .when(code.isin(0, 1) & clearing, "forest_gap")
        .when(code.isin(0, 1), "forest_scrub")
        .when(code == 2, F.when(wet, "meadow_wet").otherwise("meadow_dry"))
        .when((code == 3) & wet, "bare_wet")
        .otherwise("bare_dry")
    )


def biome(soft: Column, ndsm: Column, snow: Column, kill: Column) -> Column:
    """Snow and kill over the soft biome; water stays on top, heavy snow only off the canopy."""
    return (
        F.when(soft == "water", "water")
        .when(kill, "kill")
        .when((snow >= SNOW_HEAVY) & (ndsm < CANOPY_M), "snow_heavy")
        .when(snow >= SNOW_LIGHT, "snow_light")
        .otherwise(soft)
    )


def material(final: Column, soft: Column, asphalt: Column, concrete: Column, structure_rock: Column) -> Column:
    """Surface class: concrete over asphalt over water over structure rock over snow over the soft biome's own."""
    own = (
        F.when(soft == "meadow_dry", "dry_grass")
        .when(soft.isin("forest_gap", "meadow_wet"), "grass")
        .when(soft.isin("forest_tall", "forest_scrub"), "forest")
        .when(soft.isin("bare_wet", "water"), "water")
        .when(soft == "rock", "rock")
        .otherwise("dirt")
    )
    return F.when(concrete, "concrete").when(asphalt, "asphalt").when(soft == "water", "water").when(structure_rock, "rock").when(final.isin("snow_light", "snow_heavy"), "snow").otherwise(own)


def compose(base: DataFrame, layers: DataFrame, modes: dict[str, tuple[int, str]], top: float) -> DataFrame:
    """(cell, z): layers folded over the base in order of (priority, name); modes: name -> (priority, add or replace).

    Parts of one layer are merged first: the larger weight wins, then the later part.
    """
    table = base.sparkSession.createDataFrame([(n, p, m) for n, (p, m) in modes.items()], "name string, priority int, mode string")
    merged = layers.groupBy("cell", "name").agg(F.max_by(F.struct("v", "weight"), F.struct("weight", "part")).alias("x"))
    steps = merged.join(F.broadcast(table), "name").groupBy("cell").agg(F.array_sort(F.collect_list(F.struct("priority", "name", "mode", "x"))).alias("steps"))
    w = lambda s: F.greatest(F.lit(0.0), F.least(F.lit(1.0), s["x"]["weight"]))
    fold = F.aggregate("steps", F.col("z"), lambda z, s: F.when(s["mode"] == "add", z + s["x"]["v"] * w(s)).otherwise((1 - w(s)) * z + w(s) * s["x"]["v"]))
    joined = base.join(steps, "cell", "left")
    return joined.select("cell", clip(F.when(F.col("steps").isNull(), F.col("z")).otherwise(fold), 0.0, top).alias("z"))
