"""Feature and tile tables: grids, gates, mosaics, clips, merges, manifests, logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def tile_grid(size: DataFrame, tile: int, width: str = "width", height: str = "height") -> DataFrame:
    """Tiles (row0, col0, rows, cols) that cover each raster; the last of a row or column may be shorter."""
    tile = max(64, tile)
    rows = size.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col(height) - 1, F.lit(tile).cast("long"))).alias("row0"))
    both = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col(width) - 1, F.lit(tile).cast("long"))).alias("col0"))
    return both.select("row0", "col0", F.least(F.lit(tile), F.col(height) - F.col("row0")).alias("rows"), F.least(F.lit(tile), F.col(width) - F.col("col0")).alias("cols"))


def tile_state(share: Column, limit: float, accept_all_nodata: bool = False) -> Column:
    """complete, outside (nothing but nodata, where that is accepted) or incomplete."""
    out = F.when(share <= limit, "complete")
    if accept_all_nodata:
        out = out.when(share >= 0.999, "outside")
    return out.otherwise("incomplete")


def latest_complete(attempts: DataFrame, limit: float, tile: str = "tile") -> DataFrame:
    """Per tile: the last complete attempt, how many were made and how many failed."""
    good = F.col("nodata_share") <= limit
    return attempts.groupBy(tile).agg(F.max(F.when(good, F.col("attempt"))).alias("attempt"), F.max_by("nodata_share", F.when(good, F.col("attempt"))).alias("nodata_share"), F.count(F.lit(1)).alias("attempts"), F.count_if(~good).alias("failed"))


def last_of_each(features: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of every key at the place of its first; rows without a key all stay. Columns: row's own, place."""
    rest = [F.col(x) for x in features.columns if x != key]
    known = features.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("last"), F.min(order).alias("place"))
    known = known.select(key, "last.*", "place").select(*features.columns, "place")
    return known.unionByName(features.where(F.col(key).isNull()).withColumn("place", F.col(order)))


def clip_any_vertex(nodes: DataFrame, key: str, box: tuple[float, float, float, float]) -> DataFrame:
    """All nodes of the features that have one in the closed box."""
    x0, y0, x1, y1 = box
    inside = nodes.where(F.col("x").between(x0, x1) & F.col("y").between(y0, y1)).select(key).distinct()
    return nodes.join(inside, key, "left_semi")


def upsert(manifest: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """The manifest with rows of the same keys replaced."""
    return manifest.join(rows.select(*keys).distinct(), keys, "left_anti").unionByName(rows)


def latest_status(runs: DataFrame, *keys: str) -> DataFrame:
    """Last finish per step: when, whether it went well, how long it took; the larger event id among equal times."""
    last = F.max_by(F.struct("ok", "seconds"), F.struct("finished_at", "event_id"))
    return runs.groupBy(*keys).agg(F.max("finished_at").alias("finished_at"), last.alias("last")).select(*keys, "finished_at", "last.ok", "last.seconds")


def content_key(*columns: Column) -> Column:
    """The first 12 hexadecimal digits of the SHA-1 of a request's fields."""
    return F.substring(F.sha1(F.concat_ws("|", *columns)), 1, 12)


def ranked(df: DataFrame, partition: list[str], order: list[Column], most: int) -> DataFrame:
    """At most `most` rows of every group in order, numbered from 1."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*partition).orderBy(*order))).where(F.col("rank") <= most)
