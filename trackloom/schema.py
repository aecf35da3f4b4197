"""Declared schemas, column checks and the finite predicate.

Time is BIGINT nanoseconds everywhere: timestamps of the engine hold
microseconds only, and doubles lose digits of epoch nanoseconds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S, _L, _D, _I, _B = T.StringType(), T.LongType(), T.DoubleType(), T.IntegerType(), T.BooleanType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


#: One row of a fix log. Quality, satellite count and hdop arrive as anything, so they stay text until they are cast.
FIX = _struct(
    ("pi_time_ns", _L), ("pi_time_iso", _S), ("gps_epoch_ns", _L), ("gps_utc_time", _S), ("gps_quality", _S), ("num_sats", _S),
    ("hdop", _S), ("latitude", _D), ("longitude", _D), ("altitude_m", _D), ("easting", _D), ("northing", _D),
)
#: A decoded scan, one row per pixel.
POINTS = _struct(
    ("file", _S), ("scan_idx", _I), ("row", _I), ("col", _I), ("ord", _L), ("t_ns", _L),
    ("x", _D), ("y", _D), ("z", _D), ("range_mm", _L), ("reflectivity", _D),
)
#: A trajectory; m is a 4x4 matrix, row by row.
POSES = _struct(("t_ns", _L), ("m", T.ArrayType(_D)))
CHUNK = _struct(
    ("chunk_index", _I), ("capture_start_iso_utc", _S), ("capture_end_iso_utc", _S), ("capture_start_ns", _L), ("capture_end_ns", _L),
    ("duration_sec", _I), ("lidar_output_mode", _S), ("lidar_mode", _S), ("requested_output_path", _S),
    ("produced_files", T.ArrayType(_S)), ("lidar_csv_path", _S), ("lidar_pcap_path", _S),
)
MANIFEST = _struct(
    ("session_id", _S), ("timing_architecture", _S), ("capture_mode", _S), ("run_start_ns", _L), ("run_end_ns", _L), ("lidar_mode", _S),
    ("chunk_duration_sec", _I), ("continuous_chunks", _B), ("gps_input_mode", _S), ("utm_epsg", _I), ("gps_csv_path", _S),
    ("gps_rows_written", _L), ("gps_first_fix_time_ns", _L), ("gps_latest_fix", FIX), ("chunks_captured", _I),
    ("chunks", T.ArrayType(CHUNK)), ("lidar_csv_path", _S),
)


def require_columns(df: DataFrame, names: list[str], label: str = "input") -> DataFrame:
    """``df`` itself; an error that names the missing columns otherwise."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"{label} lacks required columns: {', '.join(missing)}")
    return df


def finite(*cols: Column | str) -> Column:
    """True where all columns are neither null, NaN nor infinite."""
    out = F.lit(True)
    for c in cols:
        c = F.col(c) if isinstance(c, str) else c
        out = out & c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    return F.coalesce(out, F.lit(False))
