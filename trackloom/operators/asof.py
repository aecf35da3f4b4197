"""As-of joins: interpolating (inner, both ends inclusive) and nearest within a tolerance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import require_columns

#: Bytes of segments up to which the binned variant broadcasts them; estimated from a count before it does.
BROADCAST_BYTES = 256 << 20
#: Knots of a part of time, about.
PART = 4096


def _blend(value: str, t: str) -> Column:
    """Linear interpolation between knots (prev, next); exact on a knot. Times are subtracted as whole numbers."""
    a, b = F.col("_prev"), F.col("_next")
    share = (F.col(t) - a["t"]).cast("double") / (b["t"] - a["t"]).cast("double")
    return F.when(a["t"] == F.col(t), a[value]).otherwise(a[value] + (b[value] - a[value]) * share)


def interpolate(query: DataFrame, ref: DataFrame, values: Sequence[str], *, time: str = "t_ns", keys: Sequence[str] = ()) -> DataFrame:
    """Adds each of ``values``, interpolated at the query's time between reference knots; rows outside are dropped.

    Of knots that share a time, the largest by their values holds at that time and after it, the
    smallest ends the segment before it; each query row gives one row.

    Without keys the reference is one track.  If it is small, which is counted
    first, its segments are cut into time bins and broadcast: an equi-join on
    the bin, no shuffle of the query side.  Otherwise, and with keys, both sides
    are joined by :func:`interpolate_partitioned`.  All ways give the same rows.
    """
    require_columns(ref, [time, *values, *keys], "reference")
    if keys:
        return interpolate_partitioned(query, ref, values, time=time, keys=keys)
    n, lo, hi = ref.agg(F.count(time), F.min(time), F.max(time)).first()
    # Segments hold two knots, and bins repeat each at most once more on average.
    if 2 * n * 16 * (2 * len(values) + 4) > BROADCAST_BYTES:
        # One long track: whole bins of time become the partitions, each with the knots around it.
        return _interpolate_in_parts(query, ref, values, time, lo, _width(n, lo, hi, PART))
    return _interpolate_binned(query, ref, values, time, n, lo or 0, hi or 0)


def _width(n: int, lo: int, hi: int, knots: int) -> int:
    """The length of time bins that hold about ``knots`` of ``n`` knots."""
    return max(1, (hi - lo) // max(1, n // knots) + 1) if n else 1


def _successors(rows: DataFrame, part: str, first: Column) -> DataFrame:
    """(part, _after): for every part of time the first knot of the next part that has any; one entry a part is gathered."""
    heads = rows.groupBy(part).agg(F.min(first).alias("f"))
    line = heads.agg(F.sort_array(F.collect_list(F.struct(part, "f"))).alias("a"))
    rest = F.greatest(F.size("a") - 1, F.lit(0))
    pairs = F.zip_with(F.slice("a", F.lit(1), rest), F.slice("a", F.lit(2), rest), lambda a, b: F.struct(a[part].alias(part), b["f"].alias("_after"), b[part].alias("_to")))
    return line.select(F.explode(pairs).alias("s")).select("s.*")


def _interpolate_binned(query: DataFrame, ref: DataFrame, values: Sequence[str], time: str, n: int, lo: int, hi: int) -> DataFrame:
    """Broadcast segments, each in the time bins that it touches."""
    knot = F.struct(F.col(time).alias("t"), *values)
    knots = ref.where(F.col(time).isNotNull()).groupBy(time).agg(F.min(knot).alias("_low"), F.max(knot).alias("_prev"))
    knots = knots.withColumn("_part", F.expr(f"({time} - {lo}) div {_width(n, lo, hi, PART)}"))
    inner = F.lead("_low").over(Window.partitionBy("_part").orderBy(time))
    segments = knots.withColumn("_inner", inner).join(_successors(knots, "_part", F.col("_low")), "_part", "left")
    # The last knot of all holds for its own time.
    segments = segments.select("_prev", F.coalesce("_inner", "_after", "_prev").alias("_next"))
    width = _width(n, lo, hi, 1)  # about the mean period: all segments together fill at most 2n bins
    bins = F.sequence(F.expr(f"(_prev.t - {lo}) div {width}"), F.expr(f"(_next.t - {lo}) div {width}"))
    segments = segments.select("_prev", "_next", F.explode(bins).alias("_bin"))
    binned = query.withColumn("_bin", F.expr(f"({time} - {lo}) div {width}"))
    inside = (F.col("_prev.t") <= F.col(time)) & ((F.col(time) < F.col("_next.t")) | (F.col("_prev.t") == F.col("_next.t")) & (F.col(time) == F.col("_next.t")))
    joined = binned.join(F.broadcast(segments), "_bin").where(inside)
    return joined.select(*query.columns, *[_blend(v, time).alias(v) for v in values])


def _interpolate_in_parts(query: DataFrame, ref: DataFrame, values: Sequence[str], time: str, lo: int, width: int) -> DataFrame:
    """One long track: parts of time become the keys of :func:`interpolate_partitioned`.

    Every part, empty ones too, also gets the last knot before it and the first one after it, so each point meets two knots.
    """
    part = F.expr(f"({time} - {lo}) div {width}").alias("_part")
    knots = ref.where(F.col(time).isNotNull()).select(part, time, *values)
    knot = F.struct(time, *values)
    gaps = knots.groupBy("_part").agg(F.max(knot).alias("_last")).join(_successors(knots, "_part", knot), "_part")
    lent = [gaps.select(F.explode(F.sequence(F.col("_part") + 1, F.col("_to"))).alias("_part"), F.col("_last").alias("k")),
            gaps.select(F.explode(F.sequence(F.col("_part"), F.col("_to") - 1)).alias("_part"), F.col("_after").alias("k"))]
    for more in lent:
        knots = knots.unionByName(more.select("_part", *[F.col("k")[c].alias(c) for c in (time, *values)]))
    return interpolate_partitioned(query.withColumn("_part", part), knots, values, time=time, keys=["_part"]).drop("_part")


def _neighbours(both: DataFrame, knot: str, keys: Sequence[str], before: Sequence[Column], after: Sequence[Column], names: tuple[str, str]) -> DataFrame:
    """The last ``knot`` up to each row in the order ``before``, and that in the reverse order ``after``: frames that only grow."""
    last = lambda order: F.last(knot, ignorenulls=True).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return both.withColumn(names[0], last(before)).withColumn(names[1], last(after))


def interpolate_partitioned(query: DataFrame, ref: DataFrame, values: Sequence[str], *, time: str = "t_ns", keys: Sequence[str]) -> DataFrame:
    """The same per key, both sides large: one shuffle on the keys, then ordered frames over the union."""
    require_columns(query, [time, *keys], "query")
    ref = ref.where(F.col(time).isNotNull())
    kept = [c for c in query.columns if c not in keys and c != time]
    left = query.select(*keys, time, F.struct(*(kept or [F.lit(1).alias("_one")])).alias("_row"), F.lit(None).cast(ref.select(F.struct(F.col(time).alias("t"), *values).alias("k")).schema["k"].dataType).alias("_knot"))
    right = ref.select(*keys, time, F.lit(None).cast(left.schema["_row"].dataType).alias("_row"), F.struct(F.col(time).alias("t"), *values).alias("_knot"))
    point = F.col("_row").isNotNull()  # at equal times knots come first in either order
    both = _neighbours(left.unionByName(right), "_knot", keys, [F.col(time), point, F.col("_knot")], [F.desc(time), point, F.desc("_knot")], ("_prev", "_next"))
    hit = both.where("_row is not null and _prev is not null and _next is not null")
    return hit.select(*[F.col(c) if c in keys or c == time else F.col("_row")[c].alias(c) for c in query.columns], *[_blend(v, time).alias(v) for v in values])


def nearest(query: DataFrame, ref: DataFrame, *, time: str = "t_ns", order: str = "ord", ref_id: str = "pose_ord", keys: Sequence[str], tolerance: int = 100_000_000) -> DataFrame:
    """Adds the nearest reference row's id, the distance in time, and whether it is an inlier.

    A tie goes to the earlier row; of references of one time the last id counts
    as the one before, the first id as the one at or after.  A time <= 0 is no
    time: such rows borrow the match of the first valid row of their key (the
    first reference row if none is valid), at distance 0, and are never inliers.
    """
    ref_t = F.struct(F.col(time).alias("t"), F.col(ref_id).alias("id"))
    left = query.select(*keys, time, order, F.lit(True).alias("_q"), F.lit(None).cast(ref.select(ref_t.alias("k")).schema["k"].dataType).alias("_ref"))
    right = ref.select(*keys, time, F.lit(None).cast("long").alias(order), F.lit(False).alias("_q"), ref_t.alias("_ref"))
    both = left.unionByName(right)
    # Before: references of smaller times only; at or after: those of the same time as well.
    both = _neighbours(both, "_ref", keys, [F.col(time), F.desc("_q"), F.col("_ref")], [F.desc(time), F.col("_q"), F.desc("_ref")], ("_l", "_r"))
    dl, dr = F.col(time) - F.col("_l.t"), F.col("_r.t") - F.col(time)
    pick = F.when(F.col("_l").isNull(), F.col("_r")).when(F.col("_r").isNull(), F.col("_l")).when(dr < dl, F.col("_r")).otherwise(F.col("_l"))
    both = both.withColumn("_pick", pick)
    # What rows without a time borrow is one row per key; it comes from an aggregate, not from a second ordering.
    valid = F.col("_q") & (F.col(time) > 0)
    first = both.groupBy(*keys).agg(F.min_by(F.when(valid, F.col("_pick.id")), F.when(valid, F.col(order))).alias("_own"), F.min(F.when(~F.col("_q"), F.col("_ref"))).alias("_any"))
    out = both.where("_q").join(first, list(keys))
    delta = F.abs(F.col(time) - F.col("_pick.t"))
    return out.select(
        *keys, time, order,
        F.when(F.col(time) > 0, F.col("_pick.id")).otherwise(F.coalesce("_own", "_any.id")).alias(ref_id),
        F.when(F.col(time) > 0, delta).otherwise(F.lit(0).cast("long")).alias("delta_ns"),
        F.coalesce((F.col(time) > 0) & (delta <= tolerance), F.lit(False)).alias("inlier"),
    )


def lookup_stats(matched: DataFrame, *, time: str = "t_ns", keys: Sequence[str] = ()) -> DataFrame:
    """Counts over the result of :func:`nearest`: columns, valid, inlier, dropped, exact, nearest, largest distance."""
    valid = F.col(time) > 0
    n = lambda c: F.count_if(c)
    return matched.groupBy(*keys).agg(
        F.count("*").alias("columns"), n(valid).alias("valid"), n(F.col("inlier")).alias("inlier"),
        (n(valid) - n(F.col("inlier"))).alias("dropped"), n(valid & (F.col("delta_ns") == 0)).alias("exact"),
        n(valid & (F.col("delta_ns") != 0)).alias("nearest"), F.coalesce(F.max(F.when(valid, F.col("delta_ns"))), F.lit(0).cast("long")).alias("max_delta_ns"),
    )


def carry_last(df: DataFrame, values: Sequence[str], *, keys: Sequence[str], order: str) -> DataFrame:
    """Every value becomes the latest one not null at or before the row, in stream order."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({v: F.last(v, ignorenulls=True).over(w) for v in values})
