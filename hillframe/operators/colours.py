"""Colour clusters: weighted k-means over counted colours, with as many clusters as the colour difference asks for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hillframe.functions.scalars import lab

from .iterate import cut
from .quantiles import percentiles

c = F.col
LAB = ("l", "a", "b")
Centre = tuple[float, float, float]


def counted_colours(pixels: DataFrame) -> DataFrame:
    """red, green, blue, their Lab values and how many pixels have them: at most 2^24 rows, whatever the number of pixels."""
    t = pixels.groupBy("red", "green", "blue").agg(F.count(F.lit(1)).alias("n"))
    return t.withColumns(dict(zip(LAB, lab(c("red"), c("green"), c("blue")), strict=True)))


def _d2(centre: Centre) -> Column:
    return sum((c(x) - float(v)) * (c(x) - float(v)) for x, v in zip(LAB, centre, strict=True))


def _drawn(colours: DataFrame, weight: Column, seed: int, draw: int) -> Centre | None:
    """A colour drawn by weight: the least of exponential waiting times that seeded hashes of the colours give. None without weight."""
    u = (F.pmod(F.xxhash64(F.lit(seed), F.lit(draw), "red", "green", "blue"), F.lit(1 << 52)) + 1) / float((1 << 52) + 1)
    key = F.when(weight > 0, -F.log(u) / weight)
    best = colours.agg(F.min(F.struct(key.isNull().alias("none"), key.alias("key"), *LAB)).alias("m")).first()["m"]
    return None if best is None or best["none"] else tuple(best[x] for x in LAB)


def seeds(colours: DataFrame, k: int, seed: int) -> list[Centre]:
    """The first centre by pixel count, each next one by pixel count times squared distance from the nearest centre so far; no more than there are colours."""
    out: list[Centre] = []
    for draw in range(k):
        far = F.least(*(_d2(x) for x in out)) if len(out) > 1 else _d2(out[0]) if out else F.lit(1.0)
        found = _drawn(colours, c("n") * far, seed, draw)
        if found is None:
            return out
        out.append(found)
    return out


def assigned(colours: DataFrame, centres: list[Centre]) -> DataFrame:
    """Adds cluster, the nearest centre (the first of equal ones), and delta, the distance from it."""
    near = F.array_min(F.array(*(F.struct(_d2(x).alias("d2"), F.lit(i).alias("i")) for i, x in enumerate(centres))))
    return colours.withColumn("_near", near).withColumns({"cluster": c("_near.i"), "delta": F.sqrt("_near.d2")}).drop("_near")


def lloyd(colours: DataFrame, centres: list[Centre], seed: int, most: int = 40, tol: float = 1e-4) -> list[Centre]:
    """Centres after at most `most` rounds of weighted means, or when they move by no more than tol together. An empty cluster takes a drawn colour."""
    for turn in range(most):
        means = assigned(colours, centres).groupBy("cluster").agg(*((F.sum(c("n") * c(x)) / F.sum("n")).alias(x) for x in LAB)).collect()  # one row a cluster
        found = {r["cluster"]: tuple(r[x] for x in LAB) for r in means}
        new = [found.get(i) or _drawn(colours, c("n").cast("double"), seed, 1000 + turn * len(centres) + i) for i in range(len(centres))]
        shift = sum((x - y) ** 2 for p, q in zip(new, centres, strict=True) for x, y in zip(p, q, strict=True)) ** 0.5
        centres = new
        if shift <= tol:
            break
    return centres


def clustered(pixels: DataFrame, k_start: int = 3, k_max: int = 12, spread: float = 0.95, threshold: float = 10.0, seed: int = 1, most: int = 40) -> DataFrame:
    """Counted colours with cluster, delta and k: the smallest k from k_start on for which no cluster's percentile of delta is above the threshold, or k_max.

    Every k begins with the same draws. No pixel is sampled: rounds go over counted colours. Fewer colours than k are as many clusters; without
    pixels there are no rows.
    """
    colours = cut(counted_colours(pixels), "colours")
    drawn = seeds(colours, k_max, seed)
    if not drawn:
        return assigned(colours, [(0.0, 0.0, 0.0)]).withColumn("k", F.lit(0))
    for k in range(min(k_start, len(drawn)), len(drawn) + 1):
        out = assigned(colours, lloyd(colours, drawn[:k], seed, most))
        worst = percentiles(out, ["cluster"], "delta", {"p": spread}, times="n").agg(F.max("p")).first()[0]
        if worst <= threshold or k == len(drawn):
            return out.withColumn("k", F.lit(k))
    raise AssertionError("unreachable")
