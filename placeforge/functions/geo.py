"""Distances, grid cells and boxes as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6_371_000.0
EARTH_IDENTITY_M = 6_371_008.8
METERS_PER_DEGREE = 111_320.0


def radians(x: Column) -> Column:
    return x * F.pi() / F.lit(180.0)


def haversine(lat1: Column, lng1: Column, lat2: Column, lng2: Column, radius: float = EARTH_M) -> Column:
    a, b = F.sin(radians(lat2 - lat1) / 2.0), F.sin(radians(lng2 - lng1) / 2.0)
    v = a * a + F.cos(radians(lat1)) * F.cos(radians(lat2)) * (b * b)
    return F.lit(2.0 * radius) * F.asin(F.least(F.lit(1.0), F.sqrt(v)))


def cell(x: Column, size: float) -> Column:
    return F.floor(x / F.lit(float(size))).cast("long")


def neighbours(df, lat: str, lng: str, size: float, reach: int, names=("cy", "cx")):
    """A row for each of the (2 reach + 1)^2 cells around a point; the point's side of a grid join."""
    steps = F.array(*(F.lit(k).cast("long") for k in range(-reach, reach + 1)))
    return df.withColumn("_dy", F.explode(steps)).withColumn("_dx", F.explode(steps)).withColumn(names[0], cell(F.col(lat), size) + F.col("_dy")).withColumn(names[1], cell(F.col(lng), size) + F.col("_dx")).drop("_dy", "_dx")


def touched(df, lat: str, lng: str, size: float, metres: float, names=("cy", "cx")):
    """A row for each cell that the box of `metres` around a point meets: one cell for most points where cells are wide."""
    pad = F.lit(1.01 * metres / METERS_PER_DEGREE)
    wide = pad / F.greatest(F.cos(radians(F.least(F.abs(F.col(lat)) + pad, F.lit(90.0)))), F.lit(0.01))
    steps = lambda x, by: F.sequence(cell(x - by, size), cell(x + by, size))
    return df.withColumn(names[0], F.explode(steps(F.col(lat), pad))).withColumn(names[1], F.explode(steps(F.col(lng), wide)))
