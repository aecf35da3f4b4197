"""Writers: text, reports, LAS and safe publication."""

from __future__ import annotations

import json
import os
import shutil
import tempfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.metrics import MEDIAN_MAX_M, P95_MAX_M, passes

GLOBAL = ("timestamp_ns", "x_global", "y_global", "z_global")


def write_points_csv(df: DataFrame, path: str, single: bool = False) -> None:
    (df.select(*GLOBAL).coalesce(1) if single else df.select(*GLOBAL)).write.option("header", True).csv(path)


def write_debug_csv(df: DataFrame, path: str) -> None:
    """Local points per scan, with the axes flipped back to the sensor's."""
    back = df.select("file", "scan_idx", "t_ns", (-F.col("x")).alias("x1"), (-F.col("y")).alias("y1"), F.col("z").alias("z1"))
    back.write.partitionBy("file", "scan_idx").option("header", True).csv(path)


def header_offsets(track: DataFrame, sensor: tuple[float, float, float] = (0.0, 0.0, 0.0), padding: float = 500.0) -> DataFrame:
    """One row: offsets for integer coordinates from the whole track's minima."""
    return track.agg(*[(F.min(c) + s - padding).alias(f"offset_{n}") for c, s, n in zip(("easting", "northing", "altitude_m"), sensor, "xyz", strict=True)])


def qa_report(metrics: DataFrame, *, backend: str, time_mode: str, mode: str = "slam_gps_anchor") -> DataFrame:
    """One JSON document per row of metrics, keys sorted, with thresholds and the verdict."""
    names = sorted(metrics.columns)
    thresholds = F.struct(F.lit(MEDIAN_MAX_M).alias("xy_median_max_m"), F.lit(P95_MAX_M).alias("xy_p95_max_m"))
    doc = F.struct(F.lit(backend).alias("backend"), F.struct(*names).alias("metrics"), F.lit(mode).alias("mode"), passes().alias("pass"), thresholds.alias("thresholds"), F.lit(time_mode).alias("time_mode_used"))
    return metrics.select(F.to_json(doc).alias("value"), passes().alias("pass"))


def qa_path(output: str) -> str:
    return os.path.splitext(output)[0] + "_qa.json"


def write_json_atomic(path: str, payload: dict) -> None:
    """The file is either the old or the new document, never a part of one."""
    with tempfile.NamedTemporaryFile("w", dir=os.path.dirname(path) or ".", delete=False, suffix=".tmp", encoding="utf-8") as f:
        json.dump(payload, f, sort_keys=True)
        f.flush()
        os.fsync(f.fileno())
    os.replace(f.name, path)


def publish_latest(df: DataFrame, path: str, order: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that publishes the newest row of each batch."""

    def run(batch: DataFrame, _: int) -> None:
        row = batch.orderBy(F.desc(order)).limit(1).toJSON().collect()
        if row:
            write_json_atomic(path, json.loads(row[0]))

    return run


def commit(path: str, write: Callable[[str], object]) -> object:
    """Runs ``write`` on path.partial; renames on success, removes on failure."""
    part = path + ".partial"
    try:
        out = write(part)
        os.replace(part, path)
    except BaseException:
        shutil.rmtree(part, ignore_errors=True) if os.path.isdir(part) else os.path.exists(part) and os.remove(part)
        raise
    return out


def next_free(path: str) -> str:
    """``path``, or with _2, _3, ... before its suffix, so that neither it nor its .partial exists."""
    root, ext = os.path.splitext(path)
    n, now = 1, path
    while os.path.exists(now) or os.path.exists(now + ".partial"):
        n += 1
        now = f"{root}_{n}{ext}"
    return now


def las_name(session: str | None, raw_paths: list[str], out_dir: str) -> str:
    """Output name: the session's, else the first input's."""
    label = session or os.path.splitext(os.path.basename(raw_paths[0]))[0]
    return os.path.join(out_dir, f"{label}.las")


def chunk_prefix(out_dir: str, csv_path: str) -> str:
    return os.path.join(out_dir, os.path.splitext(os.path.basename(csv_path))[0])


def clock_sample(ref: Column, sample: Column) -> Column:
    """A clock daemon's sample: whole seconds, microseconds (cut off) and the offset."""
    sec = F.floor(sample).cast("long")
    return F.struct(sec.alias("tv_sec"), F.floor((sample - sec) * 1000000).cast("long").alias("tv_usec"), (ref - sample).alias("offset"))


from .las import LasSink, las_header, las_records, write_las  # noqa: E402  needs GLOBAL and commit

__all__ = [
    "GLOBAL", "LasSink", "chunk_prefix", "clock_sample", "commit", "header_offsets", "las_header", "las_name", "las_records", "next_free", "publish_latest",
    "qa_path", "qa_report", "write_debug_csv", "write_json_atomic", "write_las", "write_points_csv",
]
