"""End-to-end jobs: fusion of points with a track, anchoring of a trajectory, map replay."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import JobConfig
from ..operators import asof, geometry, metrics, scan, timealign, track
from ..schema import finite

TRACK = ("easting", "northing", "altitude_m")


def prepare_track(fixes: DataFrame, cfg: JobConfig, *, preferred: str | None = None, keys: tuple = ()) -> DataFrame:
    """(t_ns, easting, northing, altitude_m, ord): a clean track with its outliers dropped; an error with fewer than two rows."""
    order = [preferred, *timealign.DEFAULT_TIME_COLUMNS] if preferred else timealign.DEFAULT_TIME_COLUMNS
    column = timealign.pick_time_column(fixes, cfg.gps_time_col, order)
    rows = fixes.select(*keys, F.col(column).alias("t_ns"), *TRACK, "ord").withColumn("_all", F.lit(0))
    clean = track.clean(rows, coords=TRACK, keys=[*keys, "_all"])
    if cfg.gps_outlier_filter:
        clean = track.speed_filter(clean, max_speed_mps=cfg.gps_outlier_max_speed_mps, keys=[*keys, "_all"])
    return track.require_rows(clean.drop("_all"))


def gps_fusion(points: DataFrame, gps: DataFrame, cfg: JobConfig, *, scan_keys: tuple = ("file",)) -> DataFrame:
    """Global points from local ones (t_ns, x, y, z, ord) and a clean track: align, trim, interpolate, turn, shift."""
    if cfg.time_mode == "unix_ns":  # nothing to subtract
        return _fuse(points, gps, cfg, scan_keys, points.columns)
    per = scan_keys if cfg.time_mode_scope == "file" else ()
    if per:
        used = timealign.choose_time_mode(points, gps, cfg.time_mode, keys=per)
        aligned = points.join(used, list(per))
        shifts = [r["ref_origin"] for r in used.select("ref_origin").distinct().collect()]  # 0, the track's start, or both
        parts = [_fuse(aligned.where(F.col("ref_origin") == s).withColumn("t_ns", F.col("t_ns") - F.col("query_origin")), gps.withColumn("t_ns", F.col("t_ns") - s), cfg, scan_keys, points.columns) for s in shifts]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out
    first = points if cfg.time_mode_scope == "trajectory" else _first_scan(points, scan_keys)
    mode = timealign.choose_time_mode(first, gps, cfg.time_mode).first()
    return _fuse(points.withColumn("t_ns", F.col("t_ns") - mode["query_origin"]), gps.withColumn("t_ns", F.col("t_ns") - mode["ref_origin"]), cfg, scan_keys, points.columns)


def _first_scan(points: DataFrame, keys: tuple) -> DataFrame:
    head = points.select(*keys).distinct().orderBy(*keys).limit(1)
    return points.join(F.broadcast(head), list(keys), "left_semi")


def _fuse(points: DataFrame, gps: DataFrame, cfg: JobConfig, keys: tuple, columns: list[str]) -> DataFrame:
    joined = asof.interpolate(points.select(*columns), gps, TRACK, keys=_shared(keys, gps))
    yaw = math.radians(cfg.sensor_yaw_deg)
    theta = F.lit(yaw)
    if cfg.orientation == "path_tangent":
        order = ("ord",) if cfg.heading_order == "array" else ("t_ns", "ord")
        joined = track.heading(joined, keys=keys, order=order, fallback_rad=yaw)
        theta = F.col("heading_rad") + yaw
    dx, dy = geometry.rotate(F.col("x"), F.col("y"), theta)
    moved = joined.select(
        *keys, F.col("t_ns").alias("timestamp_ns"), (F.col("easting") + dx + cfg.sensor_offset_x).alias("x_global"), (F.col("northing") + dy + cfg.sensor_offset_y).alias("y_global"),
        (F.col("altitude_m") + F.col("z") + cfg.sensor_offset_z).alias("z_global"), *(["reflectivity"] if "reflectivity" in columns else []),
    ).where(finite("x_global", "y_global", "z_global"))
    return scan.reflectivity_gate(moved, cfg.min_reflectivity) if cfg.reflectivity_filter else moved


def _shared(keys: tuple, gps: DataFrame) -> tuple:
    """The keys if the track has them too: each session meets its own track then, else all meet the one there is."""
    return keys if set(keys) <= set(gps.columns) else ()


def constraints(trajectory: DataFrame, gps: DataFrame, cfg: JobConfig, *, keys: tuple = ("session_id",)) -> DataFrame:
    """Absolute position constraints along a trajectory (t_ns, tx, ty, tz, ord): every so many metres the track's place and the weights."""
    at = asof.interpolate(trajectory, gps, TRACK, keys=_shared(keys, gps))
    thin = track.thin_by_distance(at, every_m=cfg.constraint_every_m, keys=keys, x="tx", y="ty")
    w, z = cfg.constraint_weights, cfg.anchor_z_mode == "offset"
    return thin.select(*keys, "t_ns", F.col("easting").alias("x"), F.col("northing").alias("y"), (F.col("altitude_m") if z else F.lit(0.0)).alias("z"), F.lit(w[0]).alias("wx"), F.lit(w[1]).alias("wy"), F.lit(w[2] if z else 0.0).alias("wz"))


def anchor_rigid(trajectory: DataFrame, gps: DataFrame, cfg: JobConfig, *, keys: tuple = ("session_id",)) -> tuple[DataFrame, DataFrame]:
    """(transform, metrics): the rigid motion that lays a trajectory on the track, and how well it fits, per key."""
    at = asof.interpolate(trajectory, gps, TRACK, keys=_shared(keys, gps))
    fit = geometry.rigid_fit(at, src=("tx", "ty"), dst=("easting", "northing"), min_motion_m=cfg.anchor_min_motion_m, keys=keys)
    if cfg.anchor_z_mode == "offset":
        fit = fit.join(at.groupBy(*keys).agg(F.median(F.col("altitude_m") - F.col("tz")).alias("z_offset")), list(keys))
    else:
        fit = fit.withColumn("z_offset", F.lit(0.0))
    moved = geometry.apply_rigid(at, fit, x="tx", y="ty", keys=keys)
    return fit, metrics.alignment(moved, ref=("easting", "northing"), est=("tx", "ty"), keys=keys, order=("t_ns", "ord"))


def apply_anchor(trajectory: DataFrame, fit: DataFrame, *, keys: tuple = ("session_id",)) -> DataFrame:
    """A trajectory (tx, ty, tz) moved by the transforms of :func:`anchor_rigid` and lifted by their z offsets."""
    moved = geometry.apply_rigid(trajectory, fit, x="tx", y="ty", keys=keys)
    lift = fit.select(*keys, F.col("z_offset").alias("_z"))
    return moved.join(lift, list(keys)).withColumn("tz", F.col("tz") + F.col("_z")).drop("_z")


def replay_map(points: DataFrame, poses: DataFrame, cfg: JobConfig, *, keys: tuple = ("file",)) -> DataFrame:
    """Map points from decoded scans and column poses: nearest pose, transform, gates, one point per voxel."""
    columns = points.select(*keys, "scan_idx", "col", "t_ns").distinct().withColumn("ord", F.col("scan_idx").cast("long") * 1_000_000 + F.col("col"))
    # Of poses of one time the smallest counts: a point meets one pose.
    numbered = poses.groupBy(*keys, "t_ns").agg(F.min("m").alias("m")).withColumn("pose_t", F.col("t_ns"))
    match = asof.nearest(columns, numbered, ref_id="pose_t", keys=keys, tolerance=cfg.max_pose_delta_ns).where("inlier")
    at = match.join(numbered.select(*keys, "pose_t", "m"), [*keys, "pose_t"]).select(*keys, (F.col("ord") / 1_000_000).cast("long").alias("scan_idx"), (F.col("ord") % 1_000_000).cast("int").alias("col"), "m")
    rows = scan.valid_pixels(points).join(at, [*keys, "scan_idx", "col"])
    rows = scan.range_gate(rows, F.col("range_mm") * 0.001, cfg.min_range, cfg.max_range)
    if cfg.reflectivity_filter:
        rows = scan.reflectivity_gate(rows, cfg.min_reflectivity)
    x, y, z = geometry.apply_pose(F.col("x"), F.col("y"), F.col("z"), F.col("m"))
    return scan.voxel_downsample(rows.select(x.alias("x"), y.alias("y"), z.alias("z")), cfg.map_voxel_size)
