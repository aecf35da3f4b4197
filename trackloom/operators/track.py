"""Cleaning tracks, ordered arithmetic and the order-dependent folds."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import finite, require_columns
from .folds import fold
from .running import PART, in_parts

XY = ("easting", "northing")


def clean(df: DataFrame, *, time: str = "t_ns", coords: Sequence[str] = XY, keys: Sequence[str] = ("session_id",), order: str = "ord") -> DataFrame:
    """Finite rows with a time; of equal times the first in file order stays."""
    require_columns(df, [time, *coords, *keys, order], "track")
    good = df.where(F.col(time).isNotNull() & finite(*coords))
    first = Window.partitionBy(*keys, time).orderBy(order)
    return good.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")


def require_rows(df: DataFrame, least: int = 2, what: str = "finite GPS rows") -> DataFrame:
    n = df.limit(least).count()
    if n < least:
        raise ValueError(f"Need at least {least} {what}, found {n}")
    return df


def _speed_run(cols: list[list], last: list | None, limit: float) -> tuple[list[str], list | None]:
    """'kept', 'time' or 'speed' for each fix, against the ``last`` one kept; the first is kept."""
    out = []
    for t, x, y in zip(*cols, strict=True):
        if last is None:
            verdict = "kept"
        else:
            dt = (t - last[0]) * 1e-9
            verdict = "time" if dt <= 0 else "speed" if math.hypot(x - last[1], y - last[2]) / dt > limit else "kept"
        if verdict == "kept":
            last = [t, x, y]
        out.append(verdict)
    return out, last


def _thin_run(cols: list[list], last: list | None, every: float) -> tuple[list[bool], list | None]:
    """True for samples taken: the first, and each at which the way since the last one taken adds up to ``every``; the state is place and way."""
    out = []
    px, py, way = last or (None, None, 0.0)
    for x, y in zip(*cols, strict=True):
        if px is not None:
            way += math.hypot(x - px, y - py)
        take = px is None or way >= every
        if take:
            way = 0.0
        px, py = x, y
        out.append(take)
    return out, [px, py, way]


def speed_verdict(df: DataFrame, *, max_speed_mps: float, time: str = "t_ns", keys: Sequence[str] = ("session_id",), order: str = "ord") -> DataFrame:
    """Adds ``verdict``: kept, or dropped for its time or its speed, against the last fix kept (speed limit exclusive)."""
    if max_speed_mps <= 0:
        raise ValueError("max_speed_mps must be positive")
    run = lambda cols, last: _speed_run(cols, last, max_speed_mps)
    return fold(df, run, inputs=[time, "easting", "northing"], keys=keys, order=[time, order], column="verdict", kind="string")


def speed_filter(df: DataFrame, **options) -> DataFrame:
    return speed_verdict(df, **options).where("verdict = 'kept'").drop("verdict")


def speed_stats(judged: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return judged.groupBy(*keys).agg(
        F.count("*").alias("input"), F.count_if(F.col("verdict") == "kept").alias("kept"), F.count_if(F.col("verdict") != "kept").alias("dropped"),
        F.count_if(F.col("verdict") == "speed").alias("dropped_speed"), F.count_if(F.col("verdict") == "time").alias("dropped_time"),
    )


def thin_by_distance(df: DataFrame, *, every_m: float, keys: Sequence[str] = ("session_id",), order: Sequence[str] = ("t_ns", "ord"), x: str = "easting", y: str = "northing") -> DataFrame:
    """Samples at least ``every_m`` of way apart; way adds up between neighbours."""
    run = lambda cols, last: _thin_run(cols, last, every_m)
    return fold(df, run, inputs=[x, y], keys=keys, order=order, column="taken", kind="boolean").where("taken").drop("taken")


def gradient(value: str, w) -> Column:
    """Central differences with unit spacing, one-sided at either end."""
    before, after, here = F.lag(value).over(w), F.lead(value).over(w), F.col(value)
    return F.when(before.isNull(), after - here).when(after.isNull(), here - before).otherwise((after - before) / 2)


def heading(df: DataFrame, *, keys: Sequence[str], order: Sequence[str], fallback_rad: float = 0.0, x: str = "easting", y: str = "northing") -> DataFrame:
    """Adds ``heading_rad``, the direction of the path; where it stands still, the one before, else the first there is."""
    w = Window.partitionBy(*keys).orderBy(*order)
    slope = df.withColumn("_dx", gradient(x, w)).withColumn("_dy", gradient(y, w))
    slope = slope.withColumn("_h", F.when(F.hypot("_dx", "_dy") > 1e-9, F.atan2("_dy", "_dx")))
    back = F.last("_h", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    # The first one ahead, as the last one so far of the reverse order: a frame that only grows.
    reverse = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order]).rowsBetween(Window.unboundedPreceding, 0)
    ahead = F.last("_h", ignorenulls=True).over(reverse)
    return slope.withColumn("heading_rad", F.coalesce(back, ahead, F.lit(float(fallback_rad)))).drop("_dx", "_dy", "_h")


def path_length(df: DataFrame, *, keys: Sequence[str], order: Sequence[str], x: str = "easting", y: str = "northing", name: str = "path_length_m") -> DataFrame:
    """Length of the polyline per key; 0 for fewer than two samples."""
    return path_lengths(df, {name: (x, y)}, keys=keys, order=order)


def path_lengths(df: DataFrame, paths: dict[str, tuple[str, str]], *, keys: Sequence[str], order: Sequence[str], rows: int = PART) -> DataFrame:
    """Lengths of several polylines over the same samples, one row per key; equal places in ``order`` go by coordinates.

    Keys of more than ``rows`` samples are cut into parts of the order's first column, if it is a whole number: steps
    are summed within parts, and the steps between parts lead from one's last sample to the next one's first.
    """
    if not keys:
        return path_lengths(df.withColumn("_all", F.lit(0)), paths, keys=["_all"], order=order, rows=rows).drop("_all")
    whole = dict(df.dtypes)[order[0]] in ("tinyint", "smallint", "int", "bigint")
    coords = list(dict.fromkeys(c for xy in paths.values() for c in xy))
    full = list(dict.fromkeys([*order, *coords]))
    lean = df.select(*dict.fromkeys([*keys, *full]))
    cut = in_parts(lean, keys=keys, order=order[0], part="_part", rows=rows) if whole else lean.withColumn("_part", F.lit(0).cast("long"))
    w = Window.partitionBy(*keys, "_part").orderBy(*full)
    step = lambda x, y: F.hypot(F.col(x) - F.lag(x).over(w), F.col(y) - F.lag(y).over(w))
    stepped = cut.withColumns({f"_s{i}": step(*xy) for i, xy in enumerate(paths.values())})
    ends = F.struct(*full)
    parts = stepped.groupBy(*keys, "_part").agg(*[F.sum(f"_s{i}").alias(f"_s{i}") for i in range(len(paths))], F.min(ends).alias("_first"), F.max(ends).alias("_last"))
    before = F.lag("_last").over(Window.partitionBy(*keys).orderBy("_part"))  # one row a part
    parts = parts.withColumn("_before", before)
    between = lambda x, y: F.hypot(F.col("_first")[x] - F.col("_before")[x], F.col("_first")[y] - F.col("_before")[y])
    zero = F.lit(0.0)
    return parts.groupBy(*keys).agg(*[F.sum(F.coalesce(F.col(f"_s{i}"), zero) + F.coalesce(between(*xy), zero)).alias(n) for i, (n, xy) in enumerate(paths.items())])


def middle(df: DataFrame, *, keys: Sequence[str], order: Sequence[str], time: str = "t_ns") -> DataFrame:
    """Of each key's rows with a positive time, the one in the middle (position n div 2 from 0)."""
    part = Window.partitionBy(*keys)
    ranked = df.where(F.col(time) > 0).withColumn("_i", F.row_number().over(part.orderBy(*order)) - 1).withColumn("_n", F.count("*").over(part))
    return ranked.where(F.expr("_i = _n div 2")).drop("_i", "_n")
