"""Ordered gates over a live stream of polls: state with timers, so that a deadline passes even when no poll comes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..operators.gates import Gate

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: The state store that timers need.
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def require_timers(spark: SparkSession) -> None:
    if "RocksDB" not in (spark.conf.get(_PROVIDER, None) or ""):
        raise ValueError(f"gates keep timers, which need {_PROVIDER} = {ROCKS_DB}")


class _Gates(StatefulProcessor):
    """Per session: the gate waited for, since when, and whether the session is decided."""

    def __init__(self, gates: Sequence[Gate], names: list[str], live: bool) -> None:
        self.gates, self.names, self.live = list(gates), names, live

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("gate", "at int, since long, decided boolean")

    def close(self) -> None:
        pass

    def _row(self, key: tuple, stage: str | None, event: str, t: int) -> tuple:
        return (*key, stage, event, t)

    def _wait(self, at: int, since: int) -> int:
        """The first gate from ``at`` on that is required; a deadline gets its timer."""
        while at < len(self.gates) and not self.gates[at].required:
            at += 1
        if at < len(self.gates) and self.gates[at].timeout_ns is not None:
            # A timer stands for whole milliseconds; the first one beyond the deadline.
            self.handle.registerTimer((since + self.gates[at].timeout_ns) // 1_000_000 + 1)
        return at

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        polls = pd.concat(list(rows), ignore_index=True).sort_values("poll_t", kind="stable")  # the polls of one session in one trigger
        now = timerValues.getCurrentProcessingTimeInMs() * 1_000_000 if self.live else None
        found = self.state.get() if self.state.exists() else None
        at, since, decided = found if found is not None else (-1, 0, False)
        out = []
        for t, gate, ready in zip(polls["poll_t"].tolist(), polls["poll_gate"].tolist(), polls["poll_ready"].tolist(), strict=True):
            t = t if now is None else now
            if decided:
                break
            if at < 0:
                since = t
                at = self._wait(0, since)
                out.append(self._row(key, None, "started", t))
            if at < len(self.gates):
                g = self.gates[at]
                if g.timeout_ns is not None and t - since > g.timeout_ns:
                    out.append(self._row(key, g.stage, "aborted", since + g.timeout_ns))
                    decided = True
                elif gate == g.stage and ready and t >= since:
                    self._drop_timers()
                    out.append(self._row(key, g.stage, "opened", t))
                    since = t
                    at = self._wait(at + 1, t)
            if not decided and at >= len(self.gates):
                out.append(self._row(key, None, "ready", since))
                decided = True
        if decided:
            self._drop_timers()
        self.state.update((at, since, decided))
        yield self._frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at, since, decided = self.state.get()
        out = []
        if not decided and at < len(self.gates):
            g = self.gates[at]
            if g.timeout_ns is not None and expiredTimerInfo.getExpiryTimeInMs() * 1_000_000 > since + g.timeout_ns:
                out.append(self._row(key, g.stage, "aborted", since + g.timeout_ns))
                self.state.update((at, since, True))
        yield self._frame(out)

    def _drop_timers(self) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)

    def _frame(self, rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=self.names).astype({self.names[-1]: "int64"})


def watch_gates(polls: DataFrame, gates: Sequence[Gate], *, keys: Sequence[str] = ("session_id",), time: str = "t_ns", gate: str = "gate", ready: str = "ready", late: str | None = "0 seconds") -> DataFrame:
    """(keys, stage, event, t_ns) as it happens: started, opened of each gate, then ready, or aborted with the failing stage and its deadline.

    With ``late`` the polls' own times count: a deadline has passed when the stream's watermark, which waits
    so long for late rows, is beyond it.  With None the clock counts: a poll's time is that of its arrival, and a
    deadline passes with the clock even if no session sends anything.  Times within a trigger are put in order;
    a decided session says nothing more.
    """
    require_timers(polls.sparkSession)
    kinds = dict(polls.dtypes)
    rows = polls.dropna(subset=[*keys, time]).select(*keys, F.col(time).cast("long").alias("poll_t"), F.col(gate).alias("poll_gate"), F.coalesce(F.col(ready), F.lit(False)).alias("poll_ready"), F.timestamp_micros(F.expr(f"`{time}` div 1000")).alias("poll_at"))
    if late is not None:
        rows = rows.withWatermark("poll_at", late)
    schema = ", ".join([*[f"`{k}` {kinds[k]}" for k in keys], "stage string", "event string", f"`{time}` long"])
    processor = _Gates(gates, [*keys, "stage", "event", time], late is None)
    return rows.groupBy(*keys).transformWithStateInPandas(processor, schema, "append", "ProcessingTime" if late is None else "EventTime")
