"""Counters in the same pass: metrics that a job observes while it writes, a counted stream sink, and throttled status lines."""

from __future__ import annotations

import csv
import json
import os
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..sinks import write_json_atomic


def observed(df: DataFrame, **metrics: Column) -> tuple[DataFrame, Callable[[], dict]]:
    """``df`` and a function that gives the metrics once an action on it has run; no pass of its own, only one row to the driver."""
    seen = Observation(f"observed-{uuid.uuid4().hex}")
    return df.observe(seen, *[c.alias(k) for k, c in metrics.items()]), lambda: dict(seen.get)


def coverage_metrics(inside: str = "in_range") -> dict[str, Column]:
    """Samples beside the reference's coverage, and scans that hold any, of rows marked by :func:`timealign.in_range` and by :func:`first_of_scan`."""
    return {"samples": F.count("*"), "trimmed_samples": F.count_if(~F.col(inside)), "trimmed_scans": F.count_if(F.col("first_trimmed"))}


def first_of_scan(marked: DataFrame, *, scan: list[str], order: str, inside: str = "in_range") -> DataFrame:
    """Adds ``first_trimmed``: the first row of its scan that lies beside the coverage. Scans are small: one revolution of a sensor each."""
    from pyspark.sql import Window

    nth = F.row_number().over(Window.partitionBy(*scan, inside).orderBy(order))
    return marked.withColumn("first_trimmed", ~F.col(inside) & (nth == 1))


def lookup_metrics(*, time: str = "t_ns") -> dict[str, Column]:
    """The counters of a nearest-pose lookup (see :func:`asof.lookup_stats`), to be observed while its rows are written."""
    valid = F.col(time) > 0
    return {
        "columns": F.count("*"), "valid": F.count_if(valid), "inlier": F.count_if(F.col("inlier")), "dropped": F.count_if(valid) - F.count_if(F.col("inlier")),
        "exact": F.count_if(valid & (F.col("delta_ns") == 0)), "nearest": F.count_if(valid & (F.col("delta_ns") != 0)), "max_delta_ns": F.coalesce(F.max(F.when(valid, F.col("delta_ns"))), F.lit(0).cast("long")),
    }


def reflectivity_metrics(column: str = "reflectivity", least: float = 0.0) -> dict[str, Column]:
    """Points without the field, which pass, and points below the bound."""
    return {"missing_reflectivity": F.count_if(F.col(column).isNull()), "below_reflectivity": F.count_if(F.coalesce(F.col(column) < least, F.lit(False)))}


def merged(runs: list[dict], largest: tuple[str, ...] = ("max_delta_ns",)) -> dict:
    """Counters of several files: sums, but the largest of ``largest``."""
    out: dict = {}
    for run in runs:
        for k, v in run.items():
            out[k] = v if k not in out else max(out[k], v) if k in largest else out[k] + v
    return out


@dataclass
class _Wrote(WriterCommitMessage):
    name: str
    rows: int
    first: dict | None
    latest: dict | None


class _FixLogWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str, time: str, names: list[str]) -> None:
        self.path, self.time, self.names = path, time, names

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Wrote:
        os.makedirs(self.path, exist_ok=True)
        done = _Wrote(f".{uuid.uuid4().hex}.tmp", 0, None, None)
        with open(os.path.join(self.path, done.name), "w", newline="", encoding="utf-8") as f:
            out = csv.writer(f)
            out.writerow(self.names)
            for b in iterator:
                rows = b.to_pylist()
                out.writerows([["" if r[c] is None else r[c] for c in self.names] for r in rows])
                done.rows += len(rows)
                for r in rows:
                    if r[self.time] is not None:
                        done.first = r if done.first is None or r[self.time] < done.first[self.time] else done.first
                        done.latest = r if done.latest is None or r[self.time] >= done.latest[self.time] else done.latest
            f.flush()
            os.fsync(f.fileno())
        return done

    def commit(self, messages: list[_Wrote | None], batchId: int) -> None:
        """Files get the batch's name; a batch that is written again after a restart replaces its files and is counted once."""
        state = read_counters(self.path, all_=True) or {"batch": -1, "base": _NONE, "now": _NONE}
        base = state["base"] if state["batch"] == batchId else state["now"]
        stem = f"fixes-{batchId:010d}-"
        for old in os.listdir(self.path):
            if old.startswith(stem):
                os.remove(os.path.join(self.path, old))
        wrote = [m for m in messages if m is not None]
        for k, m in enumerate(wrote):
            os.replace(os.path.join(self.path, m.name), os.path.join(self.path, f"{stem}{k:05d}.csv")) if m.rows else os.remove(os.path.join(self.path, m.name))
        firsts, latest = [m.first for m in wrote if m.first], [m.latest for m in wrote if m.latest]
        now = {
            "rows_written": base["rows_written"] + sum(m.rows for m in wrote),
            "first_fix_time_ns": base["first_fix_time_ns"] if base["first_fix_time_ns"] is not None else min((r[self.time] for r in firsts), default=None),
            "latest_fix": max(latest, key=lambda r: r[self.time], default=base["latest_fix"]),
        }
        write_json_atomic(os.path.join(self.path, COUNTERS), {"batch": batchId, "base": base, "now": now})

    def abort(self, messages: list[_Wrote | None], batchId: int) -> None:
        for m in messages:
            if m is not None and os.path.exists(os.path.join(self.path, m.name)):
                os.remove(os.path.join(self.path, m.name))


_NONE = {"rows_written": 0, "first_fix_time_ns": None, "latest_fix": None}
COUNTERS = "_counters.json"


def read_counters(path: str, all_: bool = False) -> dict | None:
    """rows_written, first_fix_time_ns and latest_fix of a fix log as of its last committed batch."""
    try:
        with open(os.path.join(path, COUNTERS), encoding="utf-8") as f:
            state = json.load(f)
    except FileNotFoundError:
        return None
    return state if all_ else state["now"]


class FixLogSink(DataSource):
    """``df.writeStream.format("fix_log").option("path", folder).option("time", "pi_time_ns")``: CSV files a batch, and counters beside them.

    The folder has to be on a file system that all machines mount; readers take ``fixes-*.csv``.
    """

    @classmethod
    def name(cls) -> str:
        return "fix_log"

    def streamWriter(self, schema, overwrite: bool) -> _FixLogWriter:
        return _FixLogWriter(self.options["path"].removeprefix("file:"), self.options.get("time", "pi_time_ns"), list(schema.names))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FixLogSink)


FIX_METRICS = "fixes"


def count_fixes(df: DataFrame, time: str = "pi_time_ns") -> DataFrame:
    """A stream whose progress carries rows, first and latest time of each trigger; :class:`FixStatus` adds them up."""
    latest = F.max_by(F.to_json(F.struct(*df.columns)), time)
    return df.observe(FIX_METRICS, F.count("*").alias("rows"), F.min(time).alias("first"), F.max(time).alias("last"), latest.alias("latest"))


@dataclass
class FixStatus(StreamingQueryListener):
    """Counters of the streams made by :func:`count_fixes`, and a status line at most every ``every_s`` seconds."""

    say: Callable[[str], None] = print
    every_s: float = 1.0
    clock: Callable[[], float] = time.monotonic
    rows: int = 0
    first_ns: int | None = None
    last_ns: int | None = None
    latest: dict | None = None
    _said: float | None = field(default=None, repr=False)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(FIX_METRICS)
        if seen is None or not seen["rows"]:
            return
        self.rows += seen["rows"]
        self.first_ns = seen["first"] if self.first_ns is None else self.first_ns
        if seen["last"] is not None and (self.last_ns is None or seen["last"] >= self.last_ns):
            self.last_ns, self.latest = seen["last"], json.loads(seen["latest"])
        now = self.clock()
        if self._said is None or now - self._said >= self.every_s:
            self._said = now
            self.say(f"fixes logged: {self.rows}, latest at {self.last_ns}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.say(f"fix log stopped, rows written: {self.rows}")
