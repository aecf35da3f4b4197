"""Scans as arrays or pixels: explode, destagger, gates, voxels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import finite


def explode_scan(df: DataFrame, values: str, *, width: int, keys: Sequence[str]) -> DataFrame:
    """One row per pixel of a row-major image kept in an array: row, col, ord, value."""
    pixels = df.select(*keys, F.posexplode(values).alias("ord", "value"))
    return pixels.select(*keys, F.expr(f"cast(ord div {width} as int)").alias("row"), (F.col("ord") % width).cast("int").alias("col"), F.col("ord").cast("long").alias("ord"), "value")


def destagger(df: DataFrame, shift: Column, width: int) -> DataFrame:
    """Moves every pixel to its column shifted by its row's amount, and renumbers ``ord``."""
    moved = df.withColumn("col", F.pmod(F.col("col") + shift, F.lit(width)).cast("int"))
    return moved.withColumn("ord", (F.col("row") * width + F.col("col")).cast("long"))


def valid_pixels(df: DataFrame, *, xyz: Sequence[str] = ("x", "y", "z"), range_mm: str = "range_mm") -> DataFrame:
    return df.where(finite(*xyz) & (F.col(range_mm) > 0))


def range_gate(df: DataFrame, range_m: Column, low: float = 0.0, high: float = 0.0) -> DataFrame:
    """Ranges within [low, high]; an end that is not positive is open."""
    if low > 0:
        df = df.where(range_m >= low)
    if high > 0:
        df = df.where(range_m <= high)
    return df


def reflectivity_gate(df: DataFrame, least: float, column: str = "reflectivity") -> DataFrame:
    """Points of at least that reflectivity; points without one pass, and so do all if there is no such column."""
    return df.where(F.col(column).isNull() | (F.col(column) >= least)) if column in df.columns else df


def voxel_downsample(df: DataFrame, size: float, *, xyz: Sequence[str] = ("x", "y", "z"), extra: Sequence[str] = (), keep: str = "centroid", order: str | None = None) -> DataFrame:
    """One point per cube of edge ``size``: the centroid, or the first by ``order``; ``extra`` columns alike."""
    if size <= 0:
        raise ValueError("voxel size must be positive")
    cells = {f"v{c}": F.floor(F.col(c) / size).cast("long") for c in xyz}
    values = [*xyz, *extra]
    pick = [F.avg(c).alias(c) for c in values] if keep == "centroid" else [F.min_by(c, order).alias(c) for c in values]
    return df.withColumns(cells).groupBy(*cells).agg(F.count("*").alias("points"), *pick)
