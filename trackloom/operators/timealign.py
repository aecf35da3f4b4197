"""Choice of time column and time mode, and trimming to a reference's coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import require_columns

#: Epoch nanoseconds of the years 2000 and 2100, between which a clock counts as one of epoch time.
EPOCH_FROM_NS, EPOCH_TO_NS = 946684800 * 10**9, 4102444800 * 10**9
DEFAULT_TIME_COLUMNS = ("gps_epoch_ns", "pi_time_ns")
#: A manifest whose clock chain starts like this was timed by the recorder's disciplined clock.
DISCIPLINED_CLOCK = "gps_pps_to_pi__chrony_to_pi_clock__ptp_to_"


def preferred_time_column(timing_architecture: str | None) -> str | None:
    return "pi_time_ns" if (timing_architecture or "").startswith(DISCIPLINED_CLOCK) else None


def pick_time_column(df: DataFrame, requested: str = "auto", preferred: Sequence[str] = DEFAULT_TIME_COLUMNS) -> str:
    """``requested`` if it exists; for 'auto' the first of ``preferred`` with at least two values, in one aggregation."""
    if requested != "auto":
        require_columns(df, [requested], "track")
        return requested
    present = [c for c in preferred if c in df.columns]
    counts = df.agg(*[F.count(c).alias(c) for c in present]).first() if present else {}
    for c in present:
        if counts[c] >= 2:
            return c
    raise ValueError(f"no usable time column among: {', '.join(preferred)}")


def series_stats(df: DataFrame, *, time: str = "t_ns", order: str = "ord", keys: Sequence[str] = (), prefix: str = "") -> DataFrame:
    return df.groupBy(*keys).agg(
        F.min(time).alias(f"{prefix}min"), F.max(time).alias(f"{prefix}max"), F.median(F.col(time).cast("double")).alias(f"{prefix}median"), F.min_by(time, order).alias(f"{prefix}first")
    )


def choose_time_mode(query: DataFrame, ref: DataFrame, mode: str = "auto", *, time: str = "t_ns", order: str = "ord", keys: Sequence[str] = ()) -> DataFrame:
    """One row (per key): the mode used and what is to be subtracted from either series.

    'auto' stays with epoch time if the ranges overlap and both medians look
    like epoch times; otherwise each series starts at its own first element.
    """
    if mode not in ("auto", "unix_ns", "relative_start"):
        raise ValueError(f"unknown time mode: {mode}")
    own = keys if set(keys) <= set(ref.columns) else ()  # a reference without the keys is one series for all of them
    q, r = series_stats(query, time=time, order=order, keys=keys, prefix="q_"), series_stats(ref, time=time, order=order, keys=own, prefix="r_")
    both = q.join(r, list(keys)) if own else q.crossJoin(F.broadcast(r))  # one row of the reference
    epoch = F.lit(True)
    for c in ("q_median", "r_median"):
        epoch = epoch & F.col(c).between(EPOCH_FROM_NS, EPOCH_TO_NS)
    overlap = (F.col("q_min") <= F.col("r_max")) & (F.col("r_min") <= F.col("q_max"))
    used = F.lit(mode) if mode != "auto" else F.when(overlap & epoch, "unix_ns").otherwise("relative_start")
    zero = lambda c: F.when(F.col("mode") == "unix_ns", F.lit(0).cast("long")).otherwise(F.col(c))
    return both.withColumn("mode", used).select(*keys, "mode", zero("q_first").alias("query_origin"), zero("r_first").alias("ref_origin"))


def in_range(query: DataFrame, ref: DataFrame, *, time: str = "t_ns", keys: Sequence[str] = ()) -> DataFrame:
    """Adds ``in_range``: the time lies within the reference's coverage, ends included; false without a reference."""
    span = ref.groupBy(*keys).agg(F.min(time).alias("_lo"), F.max(time).alias("_hi"))
    joined = query.join(span, list(keys), "left") if keys else query.crossJoin(F.broadcast(span))  # one row of parameters
    return joined.withColumn("in_range", F.coalesce(F.col(time).between(F.col("_lo"), F.col("_hi")), F.lit(False))).drop("_lo", "_hi")


def trim(query: DataFrame, ref: DataFrame, *, min_points: int = 0, label: str = "query", time: str = "t_ns", keys: Sequence[str] = ()) -> DataFrame:
    """Rows within coverage; an error if fewer than ``min_points`` remain."""
    kept = in_range(query, ref, time=time, keys=keys).where("in_range").drop("in_range")
    if min_points:
        n = kept.limit(min_points).count()
        if n < min_points:
            raise ValueError(f"{label}: only {n} samples remain within GPS coverage, need {min_points}")
    return kept
