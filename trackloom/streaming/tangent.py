"""Headings along a live track: a fix is held back until the next one tells where the path leads."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from .gates import require_timers

#: Shorter differences give no direction.
LEAST_M = 1e-9


class _Tangents(StatefulProcessor):
    """Per key: the fix before the held ones, fixes that wait (all but the last for want of any direction so far), the last heading and time."""

    def __init__(self, idle_ms: int, fallback_rad: float) -> None:
        self.idle_ms, self.fallback = idle_ms, fallback_rad

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("track", "before string, held string, heading double, t long")

    def close(self) -> None:
        pass

    def _turn(self, before: list | None, here: list, after: list | None, last: float | None) -> float | None:
        """The direction at ``here`` by central differences, one-sided at the ends; the last one where the track stands still."""
        a, b = before or here, after or here
        scale = 2 if before and after else 1
        dx, dy = (b[0] - a[0]) / scale, (b[1] - a[1]) / scale
        return math.atan2(dy, dx) if math.hypot(dx, dy) > LEAST_M else last

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows), ignore_index=True).sort_values(["fix_t", "fix_order"], kind="stable")  # one key's fixes of one trigger
        before, held, heading, t = self.state.get() if self.state.exists() else (None, "[]", None, 0)
        before, held, out = json.loads(before) if before else None, json.loads(held), []
        for fx, fy, row in zip(new["fix_x"].tolist(), new["fix_y"].tolist(), new["fix_row"].tolist(), strict=True):
            now = [fx, fy, row]
            if held:
                here = held[-1]
                heading = self._turn(before, here, now, heading)
                if heading is not None:
                    out += [(r, heading) for _, _, r in held]
                    held = []
                before = here[:2]
            held.append(now)
        t = max(t, int(new["fix_t"].max()))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(t // 1_000_000 + self.idle_ms + 1)
        self.state.update((json.dumps(before) if before else None, json.dumps(held), heading, t))
        yield pd.DataFrame(out, columns=["fix_row", "heading_rad"]).astype({"heading_rad": "float64"})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        before, held, heading, t = self.state.get()
        before, held = json.loads(before) if before else None, json.loads(held)
        if held:
            heading = self._turn(before, held[-1], None, heading)
        self.state.clear()
        yield pd.DataFrame([(r, self.fallback if heading is None else heading) for _, _, r in held], columns=["fix_row", "heading_rad"]).astype({"heading_rad": "float64"})


def headings(track: DataFrame, *, keys: Sequence[str] = ("session_id",), time: str = "t_ns", order: str = "ord", x: str = "easting", y: str = "northing", late: str = "0 seconds", idle_s: float = 10.0, fallback_rad: float = 0.0) -> DataFrame:
    """The streaming form of :func:`track.heading`: rows of a track with ``heading_rad``, each given out when its successor is there.

    A track is over, and its last fixes are given out, when the stream's watermark is ``idle_s`` beyond its last
    fix; what comes later is a track of its own.  Fixes at which a track has not moved yet wait for its first
    direction, as they take it.  Late fixes that fall behind a given-out one count as following it.
    """
    require_timers(track.sparkSession)
    at = F.timestamp_micros(F.expr(f"`{time}` div 1000"))
    packed = track.dropna(subset=[*keys, time, x, y]).select(
        *keys, F.col(time).cast("long").alias("fix_t"), F.col(order).cast("long").alias("fix_order"), F.col(x).cast("double").alias("fix_x"), F.col(y).cast("double").alias("fix_y"),
        F.to_json(F.struct(*track.columns), {"ignoreNullFields": "false"}).alias("fix_row"), at.alias("fix_at"),
    )
    made = packed.withWatermark("fix_at", late).groupBy(*keys).transformWithStateInPandas(_Tangents(int(idle_s * 1000), fallback_rad), "fix_row string, heading_rad double", "append", "EventTime")
    return made.select(F.from_json("fix_row", track.schema).alias("r"), "heading_rad").select("r.*", "heading_rad")
