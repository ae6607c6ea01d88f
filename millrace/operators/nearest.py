"""Nearest neighbours within a distance, by cells of a grid."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.numbers import EARTH, haversine

CELL = 0.002
#: Metres of a degree of latitude.
DEGREE = 111_320.0


#: Places of a cell that the finest grid aims at, and how often a cell may be halved at most.
PER_CELL, HALVINGS = 4, 12


def _halvings(places: DataFrame, cell: float) -> int:
    """How often cells have to be halved so that the cell of an average place holds about PER_CELL places."""
    in_cell = places.groupBy(*[F.floor(F.col(c) / cell).alias(c) for c in ("__lat2", "__lon2")]).agg(F.count(F.lit(1)).cast("double").alias("n"))
    crowd = in_cell.agg(F.try_divide(F.sum(F.col("n") * F.col("n")), F.sum("n"))).first()[0] or 1.0
    return min(HALVINGS, max(0, round(math.log(crowd / PER_CELL, 4))))


def _around(rings_lat: int, rings_lon: int) -> Column:
    return F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(-rings_lat, rings_lat + 1) for j in range(-rings_lon, rings_lon + 1)])


def _exploded(df: DataFrame, cell: float, lat: str, lon: str, rings_lat: int = 1, rings_lon: int = 1) -> DataFrame:
    """A row for each cell around that of a row."""
    spread = df.withColumn("__d", F.explode(_around(rings_lat, rings_lon)))
    return spread.withColumns({"__i": F.floor(F.col(lat) / cell) + F.col("__d.i"), "__j": F.floor(F.col(lon) / cell) + F.col("__d.j")}).drop("__d")


def _blocks(places: DataFrame) -> DataFrame:
    return places.groupBy("__i", "__j").agg(F.collect_list(F.struct("__lat2", "__lon2", "__place")).alias("__places"))


def _met(points: DataFrame) -> DataFrame:
    """points with __best, distance and __place of the nearest of __places, null if there are none. It is exploded from an
    array of one, so that conditions on it don't have it made again."""
    metres = lambda x: haversine(F.col("__lat"), F.col("__lon"), x["__lat2"], x["__lon2"], EARTH)
    best = F.array_min(F.transform("__places", lambda x: F.struct(metres(x).alias("distance"), x["__place"].alias("__place"))))
    return points.select("__key", "__lat", "__lon", F.explode(F.array(best)).alias("__best"))


def nearest(points: DataFrame, places: DataFrame, point_key: str, place_key: str, reach: float = 100.0, cell: float = CELL, lat: str = "lat", lon: str = "lon", widest: float = 60.0, broadcast_rows: int = 200_000) -> DataFrame:
    """point_key, place_key, distance: of each point with a place in its search area the nearest one (smallest key on ties).

    The search area is the cell of a point and as many around it as `reach` needs at latitudes up to
    `widest` degrees. Places at the same spot count as the one with the smallest key. Where places are dense, points first
    meet those of the 3 by 3 cells around them in a grid halved as often as their density asks for, so a point meets about
    as many places in a large table as in a small one. A place nearer than all that lies outside those cells is the nearest
    of all; points without one go on to cells four times as wide, up to the whole search area. A point meets the places of a
    block as one row, so pairs are neither sorted nor shuffled. Places are broadcast only if their entries in the blocks are
    `broadcast_rows` at most; else both sides are shuffled by cell."""
    rings_lat = max(1, math.ceil(reach / (cell * DEGREE)))
    rings_lon = max(1, math.ceil(reach / (cell * DEGREE * math.cos(math.radians(widest)))))
    spots = places.where(f"{lat} IS NOT NULL AND {lon} IS NOT NULL").groupBy(F.col(lat).alias("__lat2"), F.col(lon).alias("__lon2")).agg(F.min(place_key).alias("__place"))
    small = spots.limit(broadcast_rows // 9 + 1).count() <= broadcast_rows // 9
    hinted = F.broadcast if small else lambda df: df
    rest = points.where(f"{lat} IS NOT NULL AND {lon} IS NOT NULL").select(F.col(point_key).alias("__key"), F.col(lat).alias("__lat"), F.col(lon).alias("__lon"))
    found = []
    levels = range(_halvings(spots, cell), 0, -2)
    for level in levels:
        fine = cell / 2**level
        # the way to the nearest meridian outside the block, which is never longer than that to the parallels
        sure = F.lit(0.999 * EARTH) * F.asin(F.cos(F.radians("__lat")) * F.lit(math.sin(math.radians(fine))))
        at = {"__i": F.floor(F.col("__lat") / fine), "__j": F.floor(F.col("__lon") / fine)}
        if level == levels[0]:
            met = _met(rest.withColumns(at).join(hinted(_blocks(_exploded(spots, fine, "__lat2", "__lon2"))), ["__i", "__j"], "left"))
        else:
            met = _met_by_probes(rest, spots, fine, hinted, 1, 1)
        met = met.select("__key", "__lat", "__lon", "__best", F.coalesce(F.col("__best.distance") <= sure, F.lit(False)).alias("__final"))
        found.append(met.where("__final").select("__key", "__best"))
        rest = met.where("NOT __final").select("__key", "__lat", "__lon")
    found.append(_met_by_probes(rest, spots, cell, hinted, rings_lat, rings_lon).where("__best IS NOT NULL").select("__key", "__best"))
    best = reduce(DataFrame.unionAll, found).groupBy("__key").agg(F.min("__best").alias("__best"))
    return best.select(F.col("__key").alias(point_key), F.col("__best.__place").alias(place_key), F.col("__best.distance").alias("distance"))


def _met_by_probes(points: DataFrame, spots: DataFrame, cell: float, hinted, rings_lat: int, rings_lon: int) -> DataFrame:
    """points with __best of the cells around them, found by a row of each point for each cell: for few points, or few places."""
    build = hinted(_blocks(spots.withColumns({"__i": F.floor(F.col("__lat2") / cell), "__j": F.floor(F.col("__lon2") / cell)})))
    return _met(_exploded(points, cell, "__lat", "__lon", rings_lat, rings_lon).join(build, ["__i", "__j"], "left")).groupBy("__key", "__lat", "__lon").agg(F.min("__best").alias("__best"))


def matched(points: DataFrame, places: DataFrame, point_key: str, place_key: str, reach: float = 100.0) -> DataFrame:
    """All points with place_key, distance and status: the nearest place within reach, else none; distance is that of the nearest candidate in the search area."""
    found = nearest(points, places, point_key, place_key, reach)
    joined = points.join(found, point_key, "left")
    status = (
        F.when(F.col("lat").isNull() | F.col("lon").isNull(), "NO_VALID_COORDINATES")
        .when(F.col("distance") <= reach, "MATCHED")
        .otherwise("NO_PLACE_WITHIN_THRESHOLD")
    )
    return joined.withColumn("match_status", status).withColumn(place_key, F.when(F.col("match_status") == "MATCHED", F.col(place_key)))


def nearby(places: DataFrame, lat: float, lon: float, radius: float, earth: float) -> DataFrame:
    """Places within a radius: a box that reaches the scan's statistics first, then the distance."""
    d_lat = radius / DEGREE
    d_lon = radius / (DEGREE * max(0.01, math.cos(math.radians(lat))))
    box = F.col("lat").between(lat - d_lat, lat + d_lat) & F.col("lon").between(lon - d_lon, lon + d_lon)
    metres = haversine(F.lit(lat), F.lit(lon), F.col("lat"), F.col("lon"), earth)
    return places.where(box).withColumn("distance", metres).where(F.col("distance") <= radius)
