"""Distances, polygons and nearest places as native expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def haversine(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Kilometres on a sphere of radius 6371."""
    a, b = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin((F.radians(lng2) - F.radians(lng1)) / 2), 2)
    return 2 * 6371.0 * F.asin(F.sqrt(h))


def inside(lat: Column, lng: Column, polygon: list[tuple[float, float]]) -> Column:
    """Ray casting over the polygon's (lng, lat) vertices, after its bounding box."""
    xs, ys = [p[0] for p in polygon], [p[1] for p in polygon]
    crossed = F.lit(False)
    for (xi, yi), (xj, yj) in zip(polygon, [polygon[-1], *polygon[:-1]], strict=True):
        if yi != yj:
            crossed = crossed != ((F.lit(yi) > lat) != (F.lit(yj) > lat)) & (lng < (xj - xi) * (lat - yi) / (yj - yi) + xi)
    return F.coalesce(lat.between(min(ys), max(ys)) & lng.between(min(xs), max(xs)) & crossed, F.lit(False))


def nearest(points: DataFrame, centres: list[tuple[str, float, float]], most_km: float = 180.0, lat: str = "lat", lng: str = "lng") -> DataFrame:
    """points with place: the nearest centre's name within most_km, else ''. The centres, some tens, are literals of one
    expression, so nothing is joined; of equal distances the first wins."""
    each = F.array(*(F.struct(haversine(F.col(lat), F.col(lng), F.lit(y), F.lit(x)).alias("d"), F.lit(i).alias("i"), F.lit(name).alias("n")) for i, (name, y, x) in enumerate(centres)))
    best = F.array_min(each)
    return points.withColumn("_best", best).withColumn("place", F.when(F.col("_best.d") <= most_km, F.col("_best.n")).otherwise("")).drop("_best")
