"""Running sums over long keys: parts of a key are summed apart, then shifted by the sums before them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a part of a key, about.
PART = 65_536


def in_parts(df: DataFrame, *, keys: Sequence[str], order: str, part: str, rows: int = PART) -> DataFrame:
    """Adds ``part``, a whole number that ascends with ``order`` (a whole number) and cuts keys of more than ``rows`` rows into parts.

    Parts are equal widths of ``order``; where its values are spread evenly, they hold about ``rows`` rows.
    """
    sizes = df.groupBy(*keys).agg(F.count("*").alias("_n"), F.min(order).alias("_lo"), F.max(order).alias("_hi")).where(F.col("_n") > rows)
    width = F.expr(f"greatest(1L, (_hi - _lo) div (_n div {rows}) + 1)")
    long = sizes.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_lo", width.alias("_width"))  # one row for every ``rows`` rows at most
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    long = F.broadcast(long) if rows >= PART else long
    return df.join(long, same, "left").withColumn(part, F.coalesce(F.expr(f"(`{order}` - _lo) div _width"), F.lit(0)).cast("long")).select(*df.columns, part)


def running_sum(df: DataFrame, value: str, *, keys: Sequence[str], order: str, name: str, rows: int = PART) -> DataFrame:
    """Adds ``name``, the sum of ``value`` over the key's rows up to each row in ``order`` (whole, without repeats within a key).

    Two steps: within parts of a key, and over the parts' totals, which are ``rows`` times fewer.
    """
    part = f"_part_{name}"
    cut = in_parts(df, keys=keys, order=order, part=part, rows=rows)
    inner = Window.partitionBy(*keys, part).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    totals = cut.groupBy(*keys, part).agg(F.sum(value).alias("_total"))
    before = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    shift = totals.withColumn("_before", F.coalesce(F.sum("_total").over(before), F.lit(0))).drop("_total")
    shift = shift.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col(part).alias("_p"), "_before")
    same = [*[F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys], F.col(part) == F.col("_p")]
    summed = cut.withColumn(name, F.sum(value).over(inner)).join(shift, same)
    return summed.withColumn(name, F.col(name) + F.col("_before")).select(*df.columns, name)
