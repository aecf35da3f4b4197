"""Axis flips, rotations, rigid fits, pose application and the projection to UTM, as column expressions."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_local(x: Column, y: Column, z: Column) -> tuple[Column, Column, Column]:
    """Sensor axes to the local frame: x and y point the other way."""
    return -x, -y, z


def rotate(x: Column, y: Column, theta: Column) -> tuple[Column, Column]:
    return F.cos(theta) * x - F.sin(theta) * y, F.sin(theta) * x + F.cos(theta) * y


def translation(m: str = "m") -> tuple[Column, Column, Column]:
    """Last column of a 4x4 matrix kept row by row."""
    return F.col(m)[3], F.col(m)[7], F.col(m)[11]


def apply_pose(x: Column, y: Column, z: Column, m: Column) -> tuple[Column, Column, Column]:
    """The point moved by a 4x4 matrix kept row by row."""
    return tuple(m[4 * r] * x + m[4 * r + 1] * y + m[4 * r + 2] * z + m[4 * r + 3] for r in range(3))


def rotation_deg(r10: Column, r00: Column) -> Column:
    return F.degrees(F.atan2(r10, r00))


def rigid_fit(df: DataFrame, *, src: Sequence[str], dst: Sequence[str], min_motion_m: float, keys: Sequence[str] = ()) -> DataFrame:
    """Least-squares rotation and shift of matched points, one row (per key), in one aggregation.

    The rotation is the angle of the summed cross and dot products of the centred
    points; covariances are these sums over n, accumulated without cancellation.
    If the source hardly moves the rotation is dropped.
    """
    (sx, sy), (dx, dy) = src, dst
    cov = lambda a, b: F.covar_pop(a, b)
    sums = df.groupBy(*keys).agg(
        F.count("*").alias("n"), F.avg(sx).alias("_sx"), F.avg(sy).alias("_sy"), F.avg(dx).alias("_dx"), F.avg(dy).alias("_dy"),
        (cov(sx, dy) - cov(sy, dx)).alias("_cross"), (cov(sx, dx) + cov(sy, dy)).alias("_dot"),
        F.hypot(F.max(sx) - F.min(sx), F.max(sy) - F.min(sy)).alias("motion_m"),
    )
    still = F.col("motion_m") < min_motion_m
    fit = sums.withColumn("theta_rad", F.when(still, F.lit(0.0)).otherwise(F.atan2("_cross", "_dot")))
    rx, ry = rotate(F.col("_sx"), F.col("_sy"), F.col("theta_rad"))
    return fit.select(
        *keys, "n", "theta_rad", (F.col("_dx") - rx).alias("tx"), (F.col("_dy") - ry).alias("ty"), "motion_m",
        F.when(still, "translation_only_low_motion").otherwise("rigid_xy").alias("method"),
    )


def require_samples(fit: DataFrame, least: int = 2) -> DataFrame:
    if fit.where(F.col("n") < least).limit(1).count() or fit.limit(1).count() == 0:
        raise ValueError(f"Need at least {least} matched samples to fit a transform")
    return fit


def apply_rigid(df: DataFrame, fit: DataFrame, *, x: str, y: str, keys: Sequence[str] = ()) -> DataFrame:
    """``df`` moved by the transform in ``fit``: its one row, or its row of the same key."""
    one = fit.select(*keys, F.col("theta_rad").alias("_theta"), F.col("tx").alias("_tx"), F.col("ty").alias("_ty"))
    joined = df.join(one, list(keys)) if keys else df.crossJoin(F.broadcast(one))  # one row of parameters
    rx, ry = rotate(F.col(x), F.col(y), F.col("_theta"))
    return joined.withColumns({x: rx + F.col("_tx"), y: ry + F.col("_ty")}).drop("_theta", "_tx", "_ty")


# WGS84 and the UTM grid.
_A, _F, _K0, _E0, _N0 = 6378137.0, 1 / 298.257223563, 0.9996, 500000.0, 10000000.0
_N = _F / (2 - _F)
_RADIUS = _A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240)


def utm_zone(epsg: int) -> tuple[int, bool]:
    """(zone, south) of a UTM code on WGS84; anything else is an error."""
    zone = epsg % 100
    if epsg // 100 not in (326, 327) or not 1 <= zone <= 60:
        raise ValueError(f"only EPSG 326xx and 327xx are supported, not {epsg}")
    return zone, epsg // 100 == 327


def to_utm(lon: Column, lat: Column, epsg: int) -> tuple[Column, Column]:
    """Easting and northing by the Krueger series to third order."""
    zone, south = utm_zone(epsg)
    phi, lam = F.radians(lat), F.radians(lon) - math.radians(zone * 6 - 183)
    e = 2 * math.sqrt(_N) / (1 + _N)
    atanh = lambda c: 0.5 * F.log((1 + c) / (1 - c))
    t = F.sinh(atanh(F.sin(phi)) - e * atanh(e * F.sin(phi)))
    xi, eta = F.atan2(t, F.cos(lam)), atanh(F.sin(lam) / F.sqrt(1 + t * t))
    north, east = xi, eta
    for j, a in enumerate(_ALPHA, 1):
        north = north + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        east = east + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    return _E0 + _K0 * _RADIUS * east, (_N0 if south else 0.0) + _K0 * _RADIUS * north
