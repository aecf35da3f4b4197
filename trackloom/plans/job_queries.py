"""Queries over whole jobs: anchoring of trajectories, their constraints, map replay and header offsets, with their SQL.

``events`` gives both sides: view and click rows are the track, the others a trajectory in a frame of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import JobConfig
from ..sinks import header_offsets as offsets_of
from . import jobs
from .queries import EVENTS, events, is_knot, query, r

EVERY_M, VOXEL_M, TOLERANCE_NS = 300.0, 25.0, 3_600_000_000_000


def _gps(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).where(is_knot()).select("session_id", "ord", "t_ns", "easting", "northing", (F.col("ord") % 50).cast("double").alias("altitude_m"))


def _trajectory(spark: SparkSession, sf: str) -> DataFrame:
    e = events(spark, sf).where(~is_knot())
    return e.select("session_id", "ord", "t_ns", (F.col("ord") * 29 % 500).cast("double").alias("tx"), (F.col("easting") / 2).alias("ty"), (F.col("ord") % 7).cast("double").alias("tz"))


#: The trajectory with the track's place at its times: ``i`` (session_id, ord, t_ns, tx, ty, tz, e, n, a).
AT = f"""{EVENTS},
g AS (SELECT session_id, t_ns, easting, northing, CAST(ord % 50 AS DOUBLE) AS alt, lead(t_ns) OVER w AS t1, lead(easting) OVER w AS e1, lead(northing) OVER w AS n1, lead(CAST(ord % 50 AS DOUBLE)) OVER w AS a1 FROM knots WINDOW w AS (PARTITION BY session_id ORDER BY t_ns)),
s AS (SELECT session_id, ord, t_ns, CAST(ord * 29 % 500 AS DOUBLE) AS tx, easting / 2 AS ty, CAST(ord % 7 AS DOUBLE) AS tz FROM samples),
j AS (SELECT s.*, g.easting AS e0, g.northing AS n0, g.alt AS a0, e1, n1, a1, CASE WHEN g.t_ns = s.t_ns THEN 0 ELSE CAST(s.t_ns - g.t_ns AS DOUBLE) / CAST(t1 - g.t_ns AS DOUBLE) END AS f
  FROM s ASOF JOIN g ON s.session_id = g.session_id AND s.t_ns >= g.t_ns WHERE g.t_ns = s.t_ns OR g.t1 IS NOT NULL),
i AS (SELECT session_id, ord, t_ns, tx, ty, tz, e0 + (coalesce(e1, e0) - e0) * f AS e, n0 + (coalesce(n1, n0) - n0) * f AS n, a0 + (coalesce(a1, a0) - a0) * f AS a FROM j)"""
FITTED = f"""{AT},
c AS (SELECT session_id, count(*) AS n, avg(tx) AS sx, avg(ty) AS sy, avg(e) AS dx, avg(n) AS dy, covar_pop(tx, n) - covar_pop(ty, e) AS crs, covar_pop(tx, e) + covar_pop(ty, n) AS dot, sqrt(power(max(tx) - min(tx), 2) + power(max(ty) - min(ty), 2)) < 1 AS still, median(a - tz) AS z FROM i GROUP BY 1),
t AS (SELECT *, CASE WHEN still THEN 0 ELSE atan2(crs, dot) END AS th FROM c),
u AS (SELECT *, dx - (cos(th) * sx - sin(th) * sy) AS ox, dy - (sin(th) * sx + cos(th) * sy) AS oy FROM t)"""


@query(f"""WITH {FITTED},
d AS (SELECT i.session_id, sqrt(power(cos(th) * tx - sin(th) * ty + ox - e, 2) + power(sin(th) * tx + cos(th) * ty + oy - i.n, 2)) AS d FROM i JOIN u USING (session_id)),
m AS (SELECT session_id, round(avg(d), 5) AS xy_mean_m, round(median(d), 5) AS xy_median_m, round(quantile_cont(d, 0.95), 5) AS xy_p95_m FROM d GROUP BY 1)
SELECT session_id, n, round(th, 6) + 0.0 AS theta_rad, round(ox, 4) + 0.0 AS tx, round(oy, 4) + 0.0 AS ty, round(z, 6) + 0.0 AS z_offset, xy_mean_m, xy_median_m, xy_p95_m FROM u JOIN m USING (session_id)""")
def anchor_rigid(spark: SparkSession, sf: str) -> DataFrame:
    fit, m = jobs.anchor_rigid(_trajectory(spark, sf), _gps(spark, sf), JobConfig())
    both = fit.select("session_id", "n", r("theta_rad").alias("theta_rad"), r("tx", 4).alias("tx"), r("ty", 4).alias("ty"), r("z_offset").alias("z_offset"))
    return both.join(m.select("session_id", *[r(c, 5).alias(c) for c in ("xy_mean_m", "xy_median_m", "xy_p95_m")]), "session_id")


@query(f"""WITH {FITTED} SELECT s.session_id, ord, t_ns, round(cos(th) * tx - sin(th) * ty + ox, 4) + 0.0 AS tx, round(sin(th) * tx + cos(th) * ty + oy, 4) + 0.0 AS ty, round(tz + z, 6) + 0.0 AS tz FROM s JOIN u USING (session_id)""")
def apply_anchor(spark: SparkSession, sf: str) -> DataFrame:
    trajectory = _trajectory(spark, sf)
    fit, _ = jobs.anchor_rigid(trajectory, _gps(spark, sf), JobConfig())
    moved = jobs.apply_anchor(trajectory, fit)
    return moved.select("session_id", "ord", "t_ns", r("tx", 4).alias("tx"), r("ty", 4).alias("ty"), r("tz").alias("tz"))


@query(f"""WITH RECURSIVE {AT}, o AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY t_ns, ord) AS k FROM i),
f(session_id, k, px, py, way, taken) AS (SELECT session_id, k, tx, ty, CAST(0 AS DOUBLE), true FROM o WHERE k = 1
  UNION ALL SELECT session_id, k, tx, ty, CASE WHEN w >= {EVERY_M} THEN 0 ELSE w END, w >= {EVERY_M}
  FROM (SELECT o.session_id, o.k, o.tx, o.ty, f.way + sqrt((o.tx - f.px) * (o.tx - f.px) + (o.ty - f.py) * (o.ty - f.py)) AS w FROM f JOIN o ON o.session_id = f.session_id AND o.k = f.k + 1))
SELECT session_id, t_ns, round(e, 5) + 0.0 AS x, round(n, 5) + 0.0 AS y, round(a, 5) + 0.0 AS z, CAST(0.01 AS DOUBLE) AS wx, CAST(0.01 AS DOUBLE) AS wy, CAST(0.001 AS DOUBLE) AS wz FROM f JOIN o USING (session_id, k) WHERE taken""")
def constraints(spark: SparkSession, sf: str) -> DataFrame:
    c = jobs.constraints(_trajectory(spark, sf), _gps(spark, sf), JobConfig(constraint_every_m=EVERY_M))
    return c.select("session_id", "t_ns", *[r(v, 5).alias(v) for v in "xyz"], "wx", "wy", "wz")


@query(f"""WITH {EVENTS},
p AS (SELECT s.session_id, s.ord, s.t_ns, s.easting, s.northing, a.t_ns AS ta, a.k AS ka FROM samples s ASOF LEFT JOIN (SELECT session_id, t_ns, min(ord % 4) AS k FROM knots GROUP BY 1, 2) a ON s.session_id = a.session_id AND s.t_ns > a.t_ns),
q AS (SELECT p.*, b.t_ns AS tb, b.k AS kb FROM p ASOF LEFT JOIN (SELECT session_id, t_ns, min(ord % 4) AS k FROM knots GROUP BY 1, 2) b ON p.session_id = b.session_id AND p.t_ns <= b.t_ns),
m AS (SELECT easting, northing, ord, CASE WHEN ta IS NULL OR tb - t_ns < t_ns - ta THEN tb - t_ns ELSE t_ns - ta END AS delta, CASE WHEN ta IS NULL OR tb - t_ns < t_ns - ta THEN kb ELSE ka END AS k FROM q),
v AS (SELECT (CASE k WHEN 0 THEN 1 WHEN 2 THEN -1 ELSE 0 END) * easting - (CASE k WHEN 1 THEN 1 WHEN 3 THEN -1 ELSE 0 END) * northing + k * 10 AS x,
  (CASE k WHEN 1 THEN 1 WHEN 3 THEN -1 ELSE 0 END) * easting + (CASE k WHEN 0 THEN 1 WHEN 2 THEN -1 ELSE 0 END) * northing + 7 AS y, CAST(ord % 9 AS DOUBLE) - 1 AS z FROM m WHERE delta <= {TOLERANCE_NS} AND easting BETWEEN 1 AND 150 AND ord % 10 >= 3)
SELECT CAST(floor(x / {VOXEL_M}) AS BIGINT) AS vx, CAST(floor(y / {VOXEL_M}) AS BIGINT) AS vy, CAST(floor(z / {VOXEL_M}) AS BIGINT) AS vz, count(*) AS points, round(avg(x), 5) + 0.0 AS x, round(avg(y), 5) + 0.0 AS y, round(avg(z), 5) + 0.0 AS z FROM v GROUP BY 1, 2, 3""")
def replay_map(spark: SparkSession, sf: str) -> DataFrame:
    """Quarter turns by the knot's number, and shifts; every sample is a scan of one pixel."""
    e, k = events(spark, sf), F.col("ord") % 4
    cos, sin = F.when(k == 0, 1.0).when(k == 2, -1.0).otherwise(0.0), F.when(k == 1, 1.0).when(k == 3, -1.0).otherwise(0.0)
    n = lambda v: F.lit(float(v))
    # The turn's number comes first where poses of one time are compared: their least is that of the least number.
    least = e.where(is_knot()).groupBy("session_id", "t_ns").agg(F.min(k).alias("ord"))
    poses = least.select("session_id", "t_ns", F.array(cos, -sin, n(0), k * 10.0, sin, cos, n(0), n(7), n(0), n(0), n(1), n(-1), n(0), n(0), n(0), n(1)).alias("m"))
    points = e.where(~is_knot()).select(
        "session_id", F.col("ord").cast("int").alias("scan_idx"), F.lit(0).alias("row"), F.lit(0).alias("col"), "ord", "t_ns", F.col("easting").alias("x"), F.col("northing").alias("y"),
        (F.col("ord") % 9).cast("double").alias("z"), F.round(F.col("easting") * 1000).cast("long").alias("range_mm"), (F.col("ord") % 10).cast("double").alias("reflectivity"),
    )
    cfg = JobConfig(map_voxel_size=VOXEL_M, max_pose_delta_ns=TOLERANCE_NS, reflectivity_filter=True, min_reflectivity=3.0, min_range=1.0, max_range=150.0)
    out = jobs.replay_map(points, poses, cfg, keys=("session_id",))
    return out.select("vx", "vy", "vz", "points", r("x", 5).alias("x"), r("y", 5).alias("y"), r("z", 5).alias("z"))


@query(f"WITH {EVENTS} SELECT min(easting) + 1.5 - 500 AS offset_x, min(northing) - 2 - 500 AS offset_y, min(CAST(ord % 50 AS DOUBLE)) - 500 AS offset_z FROM track")
def header_offsets(spark: SparkSession, sf: str) -> DataFrame:
    whole = events(spark, sf).withColumn("altitude_m", (F.col("ord") % 50).cast("double"))
    return offsets_of(whole, (1.5, -2.0, 0.0))
