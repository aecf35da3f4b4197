"""Exact quantiles of keys of any size, without a buffer that grows with a key.

The engine's own percentile keeps all distinct values of a key.  Here keys beyond a bound are narrowed down by
histograms: every round counts a wanted rank's range in bins, with partial aggregation, and goes on with the one bin
that holds the rank, from its least to its greatest value, until that is a single value.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a key up to which the engine's own percentile is used, and bins of a round.
SMALL, BINS = 1_000_000, 4096


def _bin(v: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Ascends with v over [lo, hi]; infinite values and NaN, the greatest of all, have bins of their own."""
    inf = F.lit(float("inf"))
    share = (v / 2 - lo / 2) / (hi / 2 - lo / 2)  # halves, so that no difference overflows
    inside = F.when(lo == hi, F.lit(0)).otherwise(F.least(F.floor(share * bins), F.lit(bins - 1)))
    wide = F.isnan(hi) | (hi == inf) | (lo == -inf)
    apart = F.when(F.isnan(v), 3).when(v == inf, 2).when(v == -inf, 0).otherwise(1)
    return F.when(F.isnan(lo) | (lo == hi), F.lit(0)).when(wide, apart).otherwise(inside).cast("int")


def at_ranks(df: DataFrame, value: str, wanted: DataFrame, *, keys: Sequence[str], bins: int = BINS) -> DataFrame:
    """(keys, rank, value): the value at each rank (from 0, ascending) that ``wanted`` (keys, rank) asks for; few keys and ranks."""
    v = F.col("_v")
    rows = df.select(*keys, F.col(value).cast("double").alias("_v")).where(v.isNotNull())
    schema = wanted.select(*keys).schema.add("rank", "long").add("lo", "double").add("hi", "double").add("below", "long")
    ends = rows.groupBy(*keys).agg(F.min(v).alias("lo"), F.max(v).alias("hi"))
    todo = [tuple(r) for r in wanted.join(ends, list(keys)).select(*keys, F.col("rank").cast("long"), "lo", "hi", F.lit(0).cast("long")).collect()]
    done: list[tuple] = []
    while todo:
        aim = df.sparkSession.createDataFrame(todo, schema)
        met = rows.join(F.broadcast(aim), list(keys)).where(((v >= F.col("lo")) & (v <= F.col("hi"))))
        hist = met.groupBy(*keys, "rank", "below", _bin(v, F.col("lo"), F.col("hi"), bins).alias("bin")).agg(F.count("*").alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi"))
        upto = F.sum("n").over(Window.partitionBy(*keys, "rank").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))  # ``bins`` rows at most
        placed = hist.withColumn("upto", upto + F.col("below"))
        held = placed.where((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n")))
        found = [tuple(r) for r in held.select(*keys, "rank", "lo", "hi", (F.col("upto") - F.col("n")).alias("below")).collect()]
        same = lambda r: r[-3] == r[-2] or math.isnan(r[-3])
        done += [(*r[:-3], r[-3]) for r in found if same(r)]
        todo = [r for r in found if not same(r)]
    return df.sparkSession.createDataFrame(done, wanted.select(*keys).schema.add("rank", "long").add("value", "double"))


def exact(df: DataFrame, value: str, quantiles: dict[str, float], *, keys: Sequence[str], small: int = SMALL, bins: int = BINS) -> DataFrame:
    """(keys, one column for each of ``quantiles``), interpolated between neighbouring ranks; nulls are left out."""
    if not keys:
        return exact(df.withColumn("_all", F.lit(0)), value, quantiles, keys=["_all"], small=small, bins=bins).drop("_all")
    rows = df.where(F.col(value).isNotNull())
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("_n"))
    large = [tuple(r) for r in sizes.where(F.col("_n") > small).collect()]  # one for every ``small`` rows at most
    own = [F.percentile(value, q).alias(k) for k, q in quantiles.items()]
    if not large:
        return rows.groupBy(*keys).agg(*own)
    schema = sizes.select(*keys).schema
    hot = F.broadcast(df.sparkSession.createDataFrame([r[:-1] for r in large], schema))
    place = {(r[:-1], k): (r[-1] - 1) * q for r in large for k, q in quantiles.items()}
    ranks = sorted({(*key, f(p)) for (key, _), p in place.items() for f in (math.floor, math.ceil)}, key=repr)
    wanted = df.sparkSession.createDataFrame(ranks, sizes.select(*keys).schema.add("rank", "long"))
    got = {tuple(r)[:-1]: r["value"] for r in at_ranks(rows.join(hot, list(keys), "left_semi"), value, wanted, keys=keys, bins=bins).collect()}

    def between(key: tuple, p: float) -> float:
        lo, hi = got[(*key, math.floor(p))], got[(*key, math.ceil(p))]
        return lo if lo == hi else (math.ceil(p) - p) * lo + (p - math.floor(p)) * hi

    narrowed = [(*r[:-1], *[between(r[:-1], place[r[:-1], k]) for k in quantiles]) for r in large]
    for k in quantiles:
        schema = schema.add(k, "double")
    return rows.join(hot, list(keys), "left_anti").groupBy(*keys).agg(*own).unionByName(df.sparkSession.createDataFrame(narrowed, schema))
