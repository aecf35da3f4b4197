"""Process logs: state machine, throttling, ids and rings, as ordered frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Texts that set flags, and texts that name a phase.
FLAGS = {
    "gps_fix_ready": r"GPS fix acquired",
    "clock_sync_ready": r"Pi clock synchronized to local|Pi clock synchronized according to chrony\.",
    "ptp_lock_ready": r"PTP lock acquired\.",
}
PHASES = [
    (r"Applying .*sensor config:", "configuring sensor"),
    (r"Waiting for first GPS fix", "waiting for gps fix"),
    (r"Waiting for Pi clock sync", "waiting for pi clock sync"),
    (r"Waiting for .*PTP lock", "waiting for ptp lock"),
    (r"Capture mode: (continuous chunks|single chunk\.)", "capturing"),
    (r"Starting chunk \d+:", "capturing"),
]
FIX_LINE = "GPS fix logged:"


def chunk_of(text: Column) -> Column:
    return F.regexp_extract(text, r"Starting chunk (\d+):", 1).try_cast("int")


def after(text: Column, mark: str) -> Column:
    """What follows ``mark``, trimmed; null without it."""
    return F.when(text.contains(mark), F.trim(F.regexp_extract(text, rf"(?s){mark}(.*)$", 1)))


def states(df: DataFrame, *, keys: Sequence[str], order: str = "ord", text: str = "text") -> DataFrame:
    """The state after every line: flags that stay set, and the latest phase, chunk, paths and fix line."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    t = F.col(text)
    phase = F.lit(None).cast("string")
    for pattern, name in PHASES:  # the last that matches a line holds
        phase = F.when(t.rlike(pattern), name).otherwise(phase)
    values = {"phase": phase, "current_chunk_index": chunk_of(t), "gps_csv_path": after(t, "GPS CSV:"), "manifest_path": after(t, "Manifest:"), "latest_gps_log": F.when(t.contains(FIX_LINE), t)}
    flags = {k: F.max(t.rlike(p)).over(w) for k, p in FLAGS.items()}
    return df.withColumns(flags | {k: F.last(v, ignorenulls=True).over(w) for k, v in values.items()})


def surfaced(df: DataFrame, *, keys: Sequence[str], order: str = "ord", text: str = "text") -> DataFrame:
    """Lines that are shown: all but fix lines, and of those the first in each context (before chunks, or a chunk).

    A context that comes back after another one is a new context.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    t = F.col(text)
    fix = t.contains(FIX_LINE)
    rows = df.withColumn("_chunk", F.coalesce(F.last(chunk_of(t), ignorenulls=True).over(upto), F.lit(-1)))
    seen = F.last(F.when(fix, F.col("_chunk")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("_seen", seen).where(~fix | F.col("_seen").isNull() | (F.col("_seen") != F.col("_chunk"))).drop("_chunk", "_seen")


def numbered(df: DataFrame, *, run: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Line ids from 1, afresh in each run."""
    return df.withColumn("id", F.row_number().over(Window.partitionBy(*run).orderBy(*order)).cast("long"))


def ring(df: DataFrame, *, run: Sequence[str], size: int = 500) -> DataFrame:
    """The newest ``size`` lines of each run."""
    newest = Window.partitionBy(*run).orderBy(F.desc("id"))
    return df.withColumn("_n", F.row_number().over(newest)).where(F.col("_n") <= size).drop("_n")


def logs_after(df: DataFrame, cursor: int) -> DataFrame:
    return df.where(F.col("id") > cursor)


def drop_repeats(df: DataFrame, *, keys: Sequence[str], order: str, sequence: str, signature: Sequence[str]) -> DataFrame:
    """Rows that differ from the one before: by sequence number, or by signature where there is no number.

    A value may come back later; only repeats in a row go.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    sig = F.struct(*signature)
    # Numbers are compared with the latest number there was, signatures with the row before.
    last_number = F.last(sequence, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    same = F.when(F.col(sequence).isNotNull(), F.col(sequence) == last_number).otherwise(sig == F.lag(sig).over(w))
    return df.withColumn("_same", F.coalesce(same, F.lit(False))).where("not _same").drop("_same")
