"""Job configuration: typed defaults, unknown keys rejected, values checked."""

from __future__ import annotations

from dataclasses import dataclass, fields

MODES = ("gps_fusion", "slam_map", "slam_gps_anchor")
TIME_MODES = ("auto", "unix_ns", "relative_start")
ORIENTATIONS = ("fixed_yaw", "path_tangent")
BACKENDS = ("pose_optimizer", "rigid_fit")
Z_MODES = ("none", "offset")


@dataclass(frozen=True)
class JobConfig:
    mode: str = "gps_fusion"
    time_mode: str = "auto"
    time_mode_scope: str = "first_scan"
    gps_time_col: str = "auto"
    orientation: str = "fixed_yaw"
    heading_order: str = "array"
    sensor_yaw_deg: float = 0.0
    sensor_offset_x: float = 0.0
    sensor_offset_y: float = 0.0
    sensor_offset_z: float = 0.0
    gps_outlier_filter: bool = True
    gps_outlier_max_speed_mps: float = 30.0
    min_range: float = 1.0
    max_range: float = 150.0
    reflectivity_filter: bool = False
    min_reflectivity: float = 0.0
    anchor_backend: str = "pose_optimizer"
    anchor_min_motion_m: float = 1.0
    anchor_z_mode: str = "offset"
    constraint_every_m: float = 10.0
    constraint_weights: tuple[float, float, float] = (0.01, 0.01, 0.001)
    map_voxel_size: float = 0.5
    max_pose_delta_ns: int = 100_000_000
    utm_epsg: int = 32614

    def __post_init__(self) -> None:
        for name, allowed in (("mode", MODES), ("time_mode", TIME_MODES), ("orientation", ORIENTATIONS), ("anchor_backend", BACKENDS), ("anchor_z_mode", Z_MODES),
                              ("time_mode_scope", ("first_scan", "file", "trajectory")), ("heading_order", ("array", "time"))):
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} must be one of: {', '.join(allowed)}")
        if self.gps_outlier_max_speed_mps <= 0:
            raise ValueError("gps_outlier_max_speed_mps must be positive")
        if self.min_range < 0 or self.max_range < 0 or (self.max_range and self.max_range < self.min_range):
            raise ValueError("need 0 <= min_range <= max_range; 0 switches a gate off")
        if self.map_voxel_size <= 0 or self.constraint_every_m <= 0 or self.anchor_min_motion_m < 0:
            raise ValueError("map_voxel_size and constraint_every_m must be positive, anchor_min_motion_m not negative")
        if len(self.constraint_weights) != 3 or min(self.constraint_weights) < 0:
            raise ValueError("constraint_weights are three numbers that are not negative")

    @classmethod
    def of(cls, values: dict) -> JobConfig:
        unknown = sorted(set(values) - {f.name for f in fields(cls)})
        if unknown:
            raise ValueError(f"unknown configuration keys: {', '.join(unknown)}")
        return cls(**values)


def parse_weights(text: str) -> tuple[float, float, float]:
    """'a,b,c' -> three weights that are not negative."""
    values = tuple(float(p) for p in text.replace(" ", "").split(",") if p)
    if len(values) != 3 or min(values) < 0:
        raise ValueError("expected three comma-separated weights that are not negative")
    return values
