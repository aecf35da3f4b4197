"""Alignment metrics, acceptance and severity bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import quantiles, track

#: Largest median and 95th percentile of the residuals, in metres, that are accepted.
MEDIAN_MAX_M, P95_MAX_M = 5.0, 10.0
XY_METRICS = (
    "samples", "xy_mean_m", "xy_rmse_m", "xy_median_m", "xy_p95_m", "xy_max_m", "reference_path_length_m", "estimated_path_length_m",
    "reference_span_x_m", "reference_span_y_m", "estimated_span_x_m", "estimated_span_y_m",
)


def alignment(df: DataFrame, *, ref: Sequence[str], est: Sequence[str], keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Residual statistics (exact median and percentile, see :mod:`quantiles`), path lengths and spans, one row per key."""
    if not keys:
        return alignment(df.withColumn("_all", F.lit(0)), ref=ref, est=est, keys=["_all"], order=order).drop("_all")
    (rx, ry), (ex, ey) = ref, est
    rows = df.withColumn("_r", F.hypot(F.col(ex) - F.col(rx), F.col(ey) - F.col(ry)))
    span = lambda c: F.max(c) - F.min(c)
    middle = {"xy_median_m": 0.5, "xy_p95_m": 0.95}
    paths = {"reference_path_length_m": (rx, ry), "estimated_path_length_m": (ex, ey)}
    names = [n for n in XY_METRICS if n not in paths]
    values = (F.count("*"), F.avg("_r"), F.sqrt(F.avg(F.col("_r") * F.col("_r"))), *[F.percentile("_r", q) for q in middle.values()], F.max("_r"), span(rx), span(ry), span(ex), span(ey))
    made = {n: v.alias(n) for n, v in zip(names, values, strict=True)}
    if df.groupBy(*keys).count().where(F.col("count") > quantiles.SMALL).isEmpty():
        out = rows.groupBy(*keys).agg(*made.values())
    else:
        out = rows.groupBy(*keys).agg(*[v for n, v in made.items() if n not in middle])
        out = out.join(quantiles.exact(rows.select(*keys, "_r"), "_r", middle, keys=keys), list(keys), "left")
    # Few rows, one a key; the rows themselves are never gathered by key.
    lengths = track.path_lengths(df, paths, keys=keys, order=order)
    lengths = lengths.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *paths)
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    return out.join(lengths, same, "left").select(*keys, *XY_METRICS)


def passes(median: str = "xy_median_m", p95: str = "xy_p95_m") -> Column:
    """Accepted; a missing metric counts as infinite."""
    inf = F.lit(float("inf"))
    return (F.coalesce(median, inf) <= MEDIAN_MAX_M) & (F.coalesce(p95, inf) <= P95_MAX_M)


def severity(value: Column, ok: float, bad: float, names: tuple[str, str, str] = ("ok", "warn", "bad")) -> Column:
    """Band of a distance from zero: up to ``ok``, up to ``bad``, beyond; a missing value is the worst."""
    d = F.abs(value)
    return F.when(d <= ok, names[0]).when(d <= bad, names[1]).otherwise(names[2])
