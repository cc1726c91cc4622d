"""Scalar functions on columns: codecs, frames, texts, road attributes, ids, colours, angles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lanes by way class, widths by object code, structure kinds, bridge and tunnel codes.
LANE_WIDTH_M = 3.75
LANES_BY_HIGHWAY = {"motorway": 4, "trunk": 2, "primary": 2, "secondary": 2, "tertiary": 2, "residential": 2, "unclassified": 2, "service": 1, "track": 1}
NARROW_M = {"S-FRW": 2.5, "S-STRAIL": 2.5, "S-F": 4.0, "S-GW": 4.0, "S-G": 5.0, "S-BR": 3.75, "S-LR": 3.75, "S-AR": 3.75}
TUNNEL_OR_GALLERY = ("S-AT", "S-BT", "S-LT", "S-BG")
BRIDGE_OBJEKT = ("S-AB", "S-BB", "S-LB")
ROAD_TO_BRIDGE = {"S-A": "S-AB", "S-B": "S-BB", "S-L": "S-LB"}
STRIDE = 10_000_000


def r6(x: Column) -> Column:
    """Six decimals, and no negative zero."""
    return F.round(x, 6) + F.lit(0.0)


def lookup(table: dict, key: Column) -> Column:
    return F.create_map(*(F.lit(v) for kv in table.items() for v in kv))[key]


def clip(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def encode_height(z: Column, top: float) -> Column:
    return clip(F.rint(z / top * 65535), 0.0, 65535.0).cast("long")


def encode_delta(dz: Column) -> Column:
    return clip(F.rint(dz * 1000) + 32768, 0.0, 65535.0).cast("long")


def encode_weight(w: Column) -> Column:
    return F.rint(clip(w, 0.0, 1.0) * 255).cast("long")


def smoothstep(e0: float, e1: float, x: Column) -> Column:
    if abs(e1 - e0) < 1e-9:
        return (x <= e0).cast("double")
    t = clip((x - e0) / (e1 - e0), 0.0, 1.0)
    return t * t * (3 - 2 * t)


def hermite(t: Column, z0: Column, z1: Column, m0: Column, m1: Column, length: Column) -> Column:
    """Cubic height with end grades m0, m1."""
    t2, t3 = t * t, t * t * t
    return (2 * t3 - 3 * t2 + 1) * z0 + (t3 - 2 * t2 + t) * length * m0 + (3 * t2 - 2 * t3) * z1 + (t3 - t2) * length * m1


def hermite_slope(t: Column, z0: Column, z1: Column, m0: Column, m1: Column, length: Column) -> Column:
    t2 = t * t
    return (6 * t2 - 6 * t) / length * (z0 - z1) + (3 * t2 - 4 * t + 1) * m0 + (3 * t2 - 2 * t) * m1


def sane_height(z: Column, low: float = 50.0, high: float = 4500.0) -> Column:
    return F.when(~F.isnan(z) & (z > low) & (z < high), z)


def first_number(text: Column) -> Column:
    """A positive number at the head of a text with unit m, decimal comma or a list."""
    head = F.split(F.regexp_replace(F.regexp_replace(F.lower(F.trim(text)), "m", ""), ",", "."), r"[;|/-]")[0]
    value = F.trim(head).try_cast("double")
    return F.when(value > 0, value)


def lane_count(total: Column, forward: Column, backward: Column) -> Column:
    return F.coalesce(first_number(total), first_number(forward) + first_number(backward))


def tagged_width(width: Column, lanes: Column, highway: Column, default_lanes: float = 2.0) -> tuple[Column, Column, Column]:
    """(metres, lanes, source): a width tag, else lanes, else lanes of the class, else the default; at least 1.5 m."""
    w, by_class = first_number(width), lookup(LANES_BY_HIGHWAY, F.coalesce(F.lower(highway), F.lit("unclassified"))).cast("double")
    n = F.coalesce(lanes, by_class, F.lit(default_lanes))
    source = F.when(w.isNotNull(), "osm_width").when(lanes.isNotNull(), "osm_lanes").when(by_class.isNotNull(), "class_lanes").otherwise("default_lanes")
    return F.greatest(F.lit(1.5), F.coalesce(w, n * LANE_WIDTH_M)), n, source


def is_federal(code: Column) -> Column:
    return F.coalesce(F.trim(code), F.lit("")).rlike("^[Bb][0-9]")


def class_width(objekt: Column, code: Column, lanes: Column, default: float = 6.5) -> Column:
    code = F.coalesce(F.trim(code), F.lit(""))
    narrow = lookup(NARROW_M, F.upper(F.trim(objekt)))
    return F.when(narrow.isNotNull(), narrow).when(code == "", 5.5).when(is_federal(code), F.when(lanes >= 3, lanes * LANE_WIDTH_M).otherwise(8.0)).otherwise(default)


def structure_kind(kunstbauten: Column) -> Column:
    """By the name of the structure: gallery, tunnel, bridge, culvert, other; none without a name."""
    name = F.lower(F.trim(kunstbauten))
    return (
        F.when(name.isNull() | (name == "") | (name == "none"), None)
        .when(name.contains("galerie"), "gallery")
        .when(name.rlike("tunnel|unterführung|unterfuehrung"), "tunnel")
        .when(name.rlike("brücke|bruecke"), "bridge")
        .when(name.contains("durchlass"), "culvert")
        .otherwise("structure")
    )


def claims_bridge(objekt: Column, kunstbauten: Column) -> Column:
    named = F.coalesce(F.lower(kunstbauten).rlike("brücke|bruecke"), F.lit(False))
    return ~objekt.isin(*TUNNEL_OR_GALLERY) & (objekt.isin(*BRIDGE_OBJEKT) | named)


def corrected_objekt(objekt: Column, bridge: Column) -> Column:
    back = {v: k for k, v in ROAD_TO_BRIDGE.items()}
    return F.when(bridge, F.coalesce(lookup(ROAD_TO_BRIDGE, objekt), objekt)).otherwise(F.coalesce(lookup(back, objekt), objekt))


def bed_rank(code: Column, highway: Column) -> Column:
    code = F.upper(F.coalesce(F.trim(code), F.lit("")))
    h = F.coalesce(F.lower(highway), F.lit(""))
    return (
        F.when(code.startswith("A") | h.isin("motorway", "motorway_link"), 4)
        .when(code.rlike("^B[0-9]"), 3)
        .when(code.startswith("L") | h.isin("trunk", "primary"), 2)
        .when(h.isin("secondary", "tertiary", "residential", "unclassified"), 1)
        .otherwise(0)
    )


def interpret_id(raw: Column, offset: Column) -> tuple[Column, Column, Column]:
    """(level id, local id, error): in the band, local, or in another band."""
    inside, local = (raw >= offset) & (raw < offset + STRIDE), (raw >= 0) & (raw < STRIDE)
    return F.when(inside, raw).when(local, offset + raw), F.when(inside, raw - offset).when(local, raw), ~(inside | local)


def heading(dx: Column, dy: Column) -> Column:
    """Degrees clockwise from north, direction ignored."""
    return F.pmod(F.degrees(F.atan2(dx, dy)), F.lit(180.0))


def angle_difference(a: Column, b: Column, turn: float) -> Column:
    d = F.pmod(F.abs(a - b), F.lit(turn))
    return F.least(d, turn - d)


def _linear(c: Column) -> Column:
    v = c / 255.0
    return F.when(v <= 0.04045, v / 12.92).otherwise(F.pow((v + 0.055) / 1.055, F.lit(2.4)))


def lab(red: Column, green: Column, blue: Column) -> tuple[Column, Column, Column]:
    """CIE L*a*b* of an sRGB colour under D65."""
    r, g, b = map(_linear, (red, green, blue))
    x = (0.4124564 * r + 0.3575761 * g + 0.1804375 * b) / 0.95047
    y = 0.2126729 * r + 0.7151522 * g + 0.0721750 * b
    z = (0.0193339 * r + 0.1191920 * g + 0.9503041 * b) / 1.08883
    f = lambda t: F.when(t > 216.0 / 24389.0, F.pow(t, F.lit(1.0 / 3.0))).otherwise((24389.0 / 27.0 * t + 16.0) / 116.0)
    return 116.0 * f(y) - 16.0, 500.0 * (f(x) - f(y)), 200.0 * (f(y) - f(z))


def road_colour(red: Column, green: Column, blue: Column) -> Column:
    """Grey of middle brightness: luminance 65 to 230, saturation below 0.12."""
    light = 0.3 * red + 0.5 * green + 0.2 * blue
    high, low = F.greatest(red, green, blue), F.least(red, green, blue)
    return (light >= 65) & (light <= 230) & ((high - low) / F.greatest(high, F.lit(1)) < 0.12)


def green_weight(red: Column, green: Column, blue: Column, shift: float = 1 / 3, width: float = 0.03) -> Column:
    share = green / F.greatest(red + green + blue, F.lit(1))
    return clip((share - shift) / width, 0.0, 1.0)


def normal(grade: Column, crossfall: Column) -> tuple[Column, Column, Column]:
    """Upward unit normal of a surface with slope `grade` forward (x) and `crossfall` to the right (-y)."""
    f, r = F.sqrt(1 + grade * grade), F.sqrt(1 + crossfall * crossfall)
    x, y, z = -grade / f / r, crossfall / f / r, 1 / f / r
    n = F.sqrt(x * x + y * y + z * z)
    return x / n, y / n, z / n


def box_distance(x: Column, y: Column, x0: float, y0: float, x1: float, y1: float) -> Column:
    dx, dy = F.greatest(x0 - x, F.lit(0.0), x - x1), F.greatest(y0 - y, F.lit(0.0), y - y1)
    return F.sqrt(dx * dx + dy * dy)


def step_for_radius(radius: Column, length: float, tight: float = 10.0, middle: float = 15.0, tight_step: float = 1.0, middle_step: float = 2.0, straight: float = 40.0) -> Column:
    """Placement step: fixed in tight curves, linear up to `straight`, then the whole section."""
    return (
        F.when(radius <= tight, tight_step)
        .when(radius <= middle, middle_step)
        .when(radius < straight, middle_step + (radius - middle) / (straight - middle) * (length - middle_step))
        .otherwise(length)
    )
