"""Ordered readiness gates with deadlines, and the manifest of a session that a gate stopped.

Gates open one after another: the first is waited for from a session's first poll on, each
other from the moment at which the one before it opened.  A gate opens with the first poll of its
own that is ready then; one that has not opened by its deadline stops the session, and names the stage.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..store import checkpointed
from .manifest import session_rollup

class Gate(NamedTuple):
    """``stage`` names the gate in results; without a timeout it is waited for without end."""

    stage: str
    timeout_ns: int | None = None
    required: bool = True


#: The stages of a capture in order; a capture that one of them stops is ``aborted_no_<stage>``.
STAGES = ("gps_fix", "pi_clock_sync", "phc_alignment", "ouster_ptp_lock", "ouster_sensor_time_alignment")
#: What each gate but the first waits for at most, in seconds.
TIMEOUT_S = 180


def capture_gates(*, gps_fix: bool = True, pi_clock_sync: bool = True, ptp_lock: bool = True, timeout_s: float = TIMEOUT_S) -> list[Gate]:
    """A capture's gates: two follow from the clock's option and two from the lock's, and the fix has no deadline."""
    wanted = (gps_fix, pi_clock_sync, pi_clock_sync, ptp_lock, ptp_lock)
    return [Gate(s, None if k == 0 else int(timeout_s * 1e9), w) for k, (s, w) in enumerate(zip(STAGES, wanted, strict=True))]


def ordered_gates(polls: DataFrame, gates: Sequence[Gate], *, keys: Sequence[str] = ("session_id",), time: str = "t_ns", gate: str = "gate", ready: str = "ready", until: Column | None = None) -> DataFrame:
    """One row per session: started, <stage>_opened of every gate, state, failed_stage, ended.

    ``polls`` has a row for each poll of a gate.  ``state`` is ready, aborted or waiting; ``until`` is the time up to
    which a session was watched (without it, its end: every deadline has passed).  Gates that are not required count
    as open at once; polls without a key or a time are left out.  Each gate's polls are read once and pre-aggregated: a session is never one task's group.
    Polls stream past hashed rows of one a session; none of the joins sorts them.
    """
    polls = polls.dropna(subset=[*keys, time])
    out = polls.groupBy(*keys).agg(F.min(time).alias("started"), *([until.alias("_until")] if until is not None else []))
    stage = F.lit(None).cast("string")
    ended = F.lit(None).cast("long")
    at = F.col("started")
    for g in gates:
        name = f"{g.stage}_opened"
        if not g.required:
            out = out.withColumn(name, at)
            at = F.col(name)
            continue
        mine = polls.where((F.col(gate) == g.stage) & F.coalesce(F.col(ready), F.lit(False))).select(*keys, F.col(time).alias("_t"))
        since = out.where(at.isNotNull()).select(*keys, at.alias("_since"))
        inside = F.col("_t") >= F.col("_since")
        if g.timeout_ns is not None:
            inside = inside & (F.col("_t") - F.col("_since") <= g.timeout_ns)
        opened = mine.join(since.hint("shuffle_hash"), list(keys)).where(inside).groupBy(*keys).agg(F.min("_t").alias(name))
        out = out.join(opened.hint("shuffle_hash"), list(keys), "left")
        closed = at.isNotNull() & F.col(name).isNull()
        if g.timeout_ns is not None:
            deadline = at + g.timeout_ns
            over = closed if until is None else closed & (F.col("_until") > deadline)
            stage, ended = F.coalesce(stage, F.when(over, g.stage)), F.coalesce(ended, F.when(over, deadline))
        at = F.col(name)
    state = F.when(stage.isNotNull(), "aborted").when(at.isNotNull(), "ready").otherwise("waiting")
    return out.withColumns({"state": state, "failed_stage": stage, "ended": F.coalesce(ended, at)}).drop("_until")


def readiness(gates: Sequence[Gate]) -> Column:
    """The manifest's readiness document: whether each stage was reached and when it opened."""
    return F.struct(*[F.struct(F.col(f"{g.stage}_opened").isNotNull().alias("ready"), F.col(f"{g.stage}_opened").alias("opened_ns")).alias(g.stage) for g in gates])


def abort_manifests(judged: DataFrame, gates: Sequence[Gate], fixes: DataFrame, *, keys: Sequence[str] = ("session_id",), time: str = "t_ns", order: str = "ord", discard: Sequence[str] = STAGES[:1]) -> DataFrame:
    """The manifests of the sessions that a gate stopped, without chunks: mode, end, readiness, and what ``fixes`` logged up to then.

    A session stopped by a stage of ``discard`` leaves no manifest.
    """
    stopped = checkpointed(judged.where((F.col("state") == "aborted") & ~F.col("failed_stage").isin(list(discard))))  # it is read twice
    until = stopped.select(*keys, F.col("ended").alias("_ended"))
    logged = fixes.join(until.hint("shuffle_hash"), list(keys)).where(F.col(time) <= F.col("_ended"))
    rollup = session_rollup(logged.withColumnRenamed(time, "t_ns"), keys=keys, order=order)
    rows = stopped.join(rollup.hint("shuffle_hash"), list(keys), "left")
    return rows.select(
        *keys, F.concat(F.lit("aborted_no_"), "failed_stage").alias("capture_mode"), "failed_stage", F.col("started").alias("run_start_ns"), F.col("ended").alias("run_end_ns"),
        F.coalesce("rows_written", F.lit(0).cast("long")).alias("gps_rows_written"), F.col("first_fix_time_ns").alias("gps_first_fix_time_ns"), F.col("latest_fix_time_ns").alias("gps_latest_fix_time_ns"),
        readiness(gates).alias("readiness"), F.lit(0).alias("chunks_captured"), F.array().cast("array<string>").alias("chunks"),
    )
