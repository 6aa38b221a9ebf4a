"""Points and single-ring polygons in WKT, as column maths."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?"
_PAIR = rf"\s*{_NUMBER}\s+{_NUMBER}\s*"
POINT = rf"(?i)^\s*POINT\s*\(({_PAIR})\)\s*$"
POLYGON = rf"(?i)^\s*POLYGON\s*\(\s*\(({_PAIR}(?:,{_PAIR}){{3,}})\)\s*\)\s*$"


def coordinates(wkt: Column) -> Column:
    """Vertices as array<struct<x,y>>; null for any other kind of geometry."""
    inner = F.when(wkt.rlike(POINT), F.regexp_extract(wkt, POINT, 1)).when(
        wkt.rlike(POLYGON), F.regexp_extract(wkt, POLYGON, 1)
    )

    def vertex(pair: Column) -> Column:
        xy = F.split(F.trim(pair), r"\s+")
        return F.struct(
            F.get(xy, F.lit(0)).cast("double").alias("x"), F.get(xy, F.lit(1)).cast("double").alias("y")
        )

    return F.transform(F.split(inner, ","), vertex)


def is_supported(wkt: Column) -> Column:
    return wkt.rlike(POINT) | wkt.rlike(POLYGON)


def centroid(points: Column) -> Column:
    """Centroid as struct<x,y>: the point itself, or the area centroid of the ring.

    A ring without area falls back to the mean of its distinct corners.
    """
    origin = F.get(points, F.lit(0))
    first = F.slice(points, 1, F.size(points) - 1)
    second = F.slice(points, 2, F.size(points) - 1)
    ring = F.size(points) > 1

    # Coordinates relative to the first vertex keep the cross products small.
    def edge(a: Column, b: Column) -> Column:
        ax, ay = a["x"] - origin["x"], a["y"] - origin["y"]
        bx, by = b["x"] - origin["x"], b["y"] - origin["y"]
        cross = ax * by - bx * ay
        return F.struct(
            cross.alias("a"), ((ax + bx) * cross).alias("x"), ((ay + by) * cross).alias("y")
        )

    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    total = F.aggregate(
        F.zip_with(first, second, edge),
        zero,
        lambda s, e: F.struct(
            (s["a"] + e["a"]).alias("a"), (s["x"] + e["x"]).alias("x"), (s["y"] + e["y"]).alias("y")
        ),
    )
    mean = F.aggregate(
        first,
        zero,
        lambda s, p: F.struct(
            (s["a"] + 1.0).alias("a"), (s["x"] + p["x"]).alias("x"), (s["y"] + p["y"]).alias("y")
        ),
    )
    area = F.struct(
        (origin["x"] + total["x"] / (3.0 * total["a"])).alias("x"),
        (origin["y"] + total["y"] / (3.0 * total["a"])).alias("y"),
    )
    flat = F.struct((mean["x"] / mean["a"]).alias("x"), (mean["y"] / mean["a"]).alias("y"))
    return (
        F.when(~ring, origin).when(ring & (total["a"] != 0.0), area).when(ring, flat)
    )


def as_text(points: Column) -> Column:
    """WKT of a vertex array."""

    def number(v: Column) -> Column:
        whole = v == F.floor(v)
        return F.when(whole, F.floor(v).cast("string")).otherwise(v.cast("string"))

    body = F.array_join(
        F.transform(points, lambda p: F.concat_ws(" ", number(p["x"]), number(p["y"]))), ","
    )
    return F.when(F.size(points) == 1, F.concat(F.lit("POINT("), body, F.lit(")"))).when(
        F.size(points) > 1, F.concat(F.lit("POLYGON(("), body, F.lit("))"))
    )


# Conic conformal projection of mainland France (EPSG 2154).
LOCAL_SRID = 2154
_ECC = 0.0818191910428158
_LON0 = 3.0
_N = 0.7256077650532670
_C = 11754255.4261
_X0 = 700000.0
_Y0 = 12655612.0499


def to_local(points: Column) -> Column:
    """Vertices in metres of the local projection."""

    def project(p: Column) -> Column:
        lat = F.radians(p["y"])
        iso = F.log(F.tan(F.lit(math.pi / 4) + lat / 2)) - (_ECC / 2) * F.log(
            (1 + _ECC * F.sin(lat)) / (1 - _ECC * F.sin(lat))
        )
        radius = _C * F.exp(-_N * iso)
        angle = _N * F.radians(p["x"] - _LON0)
        return F.struct(
            (_X0 + radius * F.sin(angle)).alias("x"), (_Y0 - radius * F.cos(angle)).alias("y")
        )

    return F.transform(points, project)
