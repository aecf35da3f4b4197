"""Quality selection by importance resampling (operator 7).

Two generative models over hashed word uni- and bigrams are counted: one of the
target (documents labelled as good), one of the raw text (all documents).  A
document's log importance weight is the sum of the log ratios of its n-grams;
adding Gumbel noise drawn from its id and keeping the k largest keys samples k
documents without replacement in proportion to their weights.

The raw model covers every document.  The target model covers every
document labelled as good; their ids are joined, by broadcast where at most
``FEW`` are counted, else by a shuffle.  What meets on the driver has ``BUCKETS`` rows, whatever the input.  The k-th largest
key is found by bounded histograms, so no sort of all rows takes place.

Edge cases: null and empty texts have weight 0 in the log; without target labels
all weights are 0 and the sample is uniform; equal keys go to the smaller id;
repeated rows share their noise; null ids count as the smallest id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kit
from .store import settle, small_batches

BUCKETS = 10_000
#: Ids up to which the labelled documents are broadcast; they are counted before.
FEW = 500_000
#: Share of the documents that is sampled.
SHARE = 0.8
SMOOTH = 1.0
SEED = 7
_BINS = 4096
_IN_BIN = 20_000


def grams(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text index, bucket) of every word and every pair of neighbouring words."""
    _, _, d, h = kit.words(data, offs)
    two = kit.windows(h, 2)
    inside = d[: len(two)] == d[1:] if len(two) else np.zeros(0, bool)
    docs = np.concatenate([d, d[: len(two)][inside]])
    hashes = np.concatenate([h, two[inside]])
    return docs, ((hashes >> np.uint64(32)) * np.uint64(BUCKETS) >> np.uint64(32)).astype(np.int64)


def log_ratio(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log of target over raw probability for each bucket, with additive smoothing."""
    if target.sum() == 0:
        return np.zeros(len(raw))
    p = (target + SMOOTH) / (target.sum() + SMOOTH * len(target))
    q = (raw + SMOOTH) / (raw.sum() + SMOOTH * len(raw))
    return np.log(p) - np.log(q)


def fit(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """The table of log ratios."""
    small_batches(docs.sparkSession)
    good = labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").alias("id")).distinct()
    good = settle(good.withColumn("good", F.lit(True)))
    rows = docs.select("doc_id", "text").join(F.broadcast(good) if good.count() <= FEW else good, F.col("doc_id") == F.col("id"), "left").select("text", F.coalesce("good", F.lit(False)).alias("good"))

    def run(batches):
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for b in batches:
            flag = np.array(b.column(1).to_pylist(), bool)
            for lo, hi, block, at in kit.blocks(*kit.as_bytes(b.column(0))):
                d, g = grams(block, at)
                raw += np.bincount(g, minlength=BUCKETS)
                target += np.bincount(g[flag[lo:hi][d]], minlength=BUCKETS)
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw[at]), pa.array(target[at])], ["bucket", "raw", "target"])

    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for b, r, t in rows.mapInArrow(run, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw"), F.sum("target")).collect():
        raw[b], target[b] = r, t
    return log_ratio(raw, target)


def weight(docs: DataFrame, ratio: np.ndarray):
    """A column function: text -> log importance weight."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    @F.arrow_udf(T.DoubleType())
    def log_weight(text: pa.Array) -> pa.Array:
        data, offs = kit.as_bytes(text)
        out = np.zeros(len(offs) - 1)
        for lo, hi, block, at in kit.blocks(data, offs):
            d, g = grams(block, at)
            out[lo:hi] = np.bincount(d, shared.value[g], hi - lo) if len(d) else 0
        return pa.array(out)

    return log_weight.asNondeterministic()


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise that depends on the id alone."""
    u = ((F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.coalesce(doc_id.cast("long"), F.lit(-(1 << 63)))), 11)).cast("double") + 0.5) * F.lit(2.0**-53)
    return -F.log(-F.log(u))


def _narrow(rows: DataFrame, column: str, need: int, place) -> tuple[DataFrame, int]:
    """Rows around the ``need``-th largest of ``column``, few or all equal, and which of them it is.

    ``place(low, high)`` deals values between the two over ``_BINS`` ascending bins, never all into one.
    """
    n, low, high = rows.agg(F.count("*"), F.min(column), F.max(column)).first()
    while n > _IN_BIN and high > low:
        bins = rows.where(F.col(column).between(low, high)).groupBy(place(low, high).alias("bin")).agg(F.count("*"), F.min(column), F.max(column)).collect()
        for _, count, least, most in sorted(bins, reverse=True):
            if need <= count:
                n, low, high = count, least, most
                break
            need -= count
    return rows.where(F.col(column).between(low, high)), need


def cut(rows: DataFrame, k: int) -> tuple[float, int] | None:
    """The k-th largest (key, smaller id first) of ``rows`` (key double, id long); None if all rows belong.

    Histograms of at most ``_BINS`` rows narrow the place down, first by key, then among rows of one key by
    id, until few rows are left to sort; rows alike in both are one value.
    """
    if k >= rows.count():
        return None
    key = F.col("key")
    here, need = _narrow(rows, "key", k, lambda low, high: F.least(F.floor((key - low) / ((high - low) / _BINS)), F.lit(_BINS - 1)))
    # Turned bit by bit, smaller ids are larger numbers; the differences are decimal, since they may pass a long.
    here = here.withColumn("turned", F.bitwise_not("id"))
    here, need = _narrow(here, "turned", need, lambda low, high: F.expr(f"(cast(turned as decimal(20, 0)) - {low}BD) div {(high - low) // _BINS + 1}BD"))
    last = here.orderBy(F.desc("key"), "id").limit(min(need, _IN_BIN)).orderBy("key", F.desc("id")).first()
    return last["key"], last["id"]


def select(docs: DataFrame, labels: DataFrame, share: float = SHARE) -> DataFrame:
    """doc_id, log_weight, key, selected for every row of ``docs``; ``share`` of the rows are selected."""
    udf = weight(docs, fit(docs, labels))
    scored = docs.select("doc_id", "text").select("doc_id", udf("text").alias("log_weight"))
    scored = settle(scored.withColumn("key", F.col("log_weight") + gumbel(F.col("doc_id"))))
    n = scored.count()
    if n == 0:
        return scored.withColumn("selected", F.lit(False))
    id_ = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    at = cut(scored.select("key", id_.alias("id")), max(1, round(share * n)))
    chosen = F.lit(True) if at is None else (F.col("key") > at[0]) | ((F.col("key") == at[0]) & (id_ <= at[1]))
    return scored.withColumn("selected", chosen)
