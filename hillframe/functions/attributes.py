"""Attributes of roads, buildings and ground tags as column expressions: width tables, heights, classes, snapped heights."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Metres of a building without height and levels, by its type.
TYPE_HEIGHT = {
    "house": 7.0, "detached": 7.0, "semidetached_house": 7.5, "terrace": 8.0, "apartments": 14.0, "residential": 10.0, "hotel": 12.0,
    "commercial": 9.0, "retail": 8.0, "industrial": 9.0, "warehouse": 10.0, "farm": 6.0, "barn": 6.0, "church": 16.0, "chapel": 10.0,
    "school": 10.0, "garage": 3.0, "garages": 3.0, "shed": 3.0, "hut": 3.5, "cabin": 5.0,
}
# Ground classes of natural and landuse tags; rock comes first, then what grows, then what is built.
GROUND = (
    ("rock", ("bare_rock", "scree", "cliff"), ("quarry",)),
    ("grass", ("wood", "scrub", "grassland", "heath", "fell"), ("forest", "meadow", "grass", "farmland")),
    ("concrete", (), ("residential", "commercial", "industrial", "retail", "construction", "garages", "railway")),
)


def by_code(code: Column, table: dict[str, float]) -> Column:
    """The value of a code: its own entry, else that of the longest `prefix*` entry it begins with, else null."""
    code = F.trim(code)
    out = F.when(code == "", None)
    for key, value in table.items():
        if not key.endswith("*"):
            out = out.when(code == key, F.lit(value))
    for key in sorted((k for k in table if k.endswith("*") and len(k) > 1), key=len, reverse=True):
        out = out.when(code.startswith(key[:-1]), F.lit(table[key]))
    return out


def first_known(**sources: Column) -> tuple[Column, Column]:
    """The first value that is there, and the name of where it comes from."""
    name = F.coalesce(*(F.when(v.isNotNull(), F.lit(k)) for k, v in sources.items()))
    return F.coalesce(*sources.values()), name


def _leading(text: Column) -> Column:
    """The number before the first separator of a list; null if it is none."""
    text = F.replace(F.trim(text), F.lit(","), F.lit("."))
    part = F.when(text.contains(";"), F.split_part(text, F.lit(";"), F.lit(1)))
    part = part.when(text.contains("|"), F.split_part(text, F.lit("|"), F.lit(1))).when(text.contains("/"), F.split_part(text, F.lit("/"), F.lit(1)))
    return F.trim(part.otherwise(text)).try_cast("double")


def building_height(height: Column, levels: Column, kind: Column, level_m: float, default_m: float, least_m: float = 2.5) -> Column:
    """The height tag, else levels times their height (both at least least_m), else that of the type, else the default."""
    tagged = _leading(F.replace(F.lower(height), F.lit("m"), F.lit("")))
    types = F.create_map(*(F.lit(x) for pair in TYPE_HEIGHT.items() for x in pair))
    floor = lambda v: F.when(v.isNotNull(), F.greatest(v, F.lit(least_m)))
    return F.coalesce(floor(tagged), floor(_leading(levels) * level_m), types[F.lower(F.coalesce(kind, F.lit("yes")))], F.lit(default_m))


def ground_class(natural: Column, landuse: Column) -> Column:
    """rock, grass, concrete or null by tag."""
    natural, landuse, out = F.lower(natural), F.lower(landuse), None
    for name, ns, ls in GROUND:
        test = F.coalesce(natural.isin(*ns), F.lit(False)) | F.coalesce(landuse.isin(*ls), F.lit(False)) if ns else F.coalesce(landuse.isin(*ls), F.lit(False))
        out = F.when(test, name) if out is None else out.when(test, name)
    return out


def snap_height(z: Column, ground: Column, lift: float, most: float, follow: bool) -> Column:
    """follow: the ground plus lift; else raised to that where below it. `most` above 0 bounds the change."""
    aim = ground + lift
    if follow:
        return F.least(z + most, F.greatest(z - most, aim)) if most > 0 else aim
    return F.when(z < aim - 1e-4, F.least(aim, z + most) if most > 0 else aim).otherwise(z)
