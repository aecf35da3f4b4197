"""Every operator applied to the driver's tables, with the same in DuckDB SQL.

``events`` plays the track: user_id is the session, easting is the value and
northing is made from the id; view and click rows are knots of the reference,
the others are samples.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import JobConfig
from ..functions import nmea, text
from ..operators import asof, geometry, logs, manifest, metrics, scan, status, timealign, track
from ..schema import finite
from ..sources import sidecars
from ..store import checkpointed
from ..streaming import tumble
from . import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def events(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    return e.select(
        F.col("user_id").alias("session_id"), F.col("event_id").alias("ord"), (F.unix_micros(F.col("ts").cast("timestamp")) * 1000).alias("t_ns"),
        F.col("value").alias("easting"), ((F.col("event_id") * 37 % 1000).cast("double") / 10).alias("northing"), "event_type",
    )


EVENTS = """track AS (SELECT user_id AS session_id, event_id AS ord, epoch_us(ts) * 1000 AS t_ns, value AS easting,
  CAST((event_id * 37) % 1000 AS DOUBLE) / 10 AS northing, event_type FROM events),
knots AS (SELECT * FROM track WHERE event_type IN ('view', 'click')),
samples AS (SELECT * FROM track WHERE event_type NOT IN ('view', 'click'))"""


def is_knot() -> Column:
    return F.col("event_type").isin("view", "click")


def r(c: str | Column, digits: int = 6) -> Column:
    """Rounded, and without a negative zero."""
    return F.round(c, digits) + F.lit(0.0)


@query(f"""WITH {EVENTS},
dirty AS (SELECT session_id, ord, t_ns // 3600000000000 * 3600000000000 AS t_ns, northing,
  CASE WHEN ord % 97 = 0 THEN CAST('nan' AS DOUBLE) WHEN ord % 89 = 0 THEN NULL WHEN ord % 83 = 0 THEN CAST('inf' AS DOUBLE) ELSE easting END AS easting FROM track),
ranked AS (SELECT *, row_number() OVER (PARTITION BY session_id, t_ns ORDER BY ord) AS n FROM dirty WHERE easting IS NOT NULL AND isfinite(easting) AND isfinite(northing))
SELECT session_id, t_ns, ord, easting, northing FROM ranked WHERE n = 1""")
def gps_clean(spark: SparkSession, sf: str) -> DataFrame:
    bad = F.when(F.col("ord") % 97 == 0, float("nan")).when(F.col("ord") % 89 == 0, None).when(F.col("ord") % 83 == 0, float("inf")).otherwise(F.col("easting"))
    dirty = events(spark, sf).withColumn("easting", bad).withColumn("t_ns", F.expr("t_ns div 3600000000000 * 3600000000000"))
    return track.clean(dirty).select("session_id", "t_ns", "ord", "easting", "northing")


@query("""SELECT CASE WHEN count(CASE WHEN event_id = 5 THEN 1 END) >= 2 THEN 'gps_epoch_ns' ELSE 'pi_time_ns' END AS chosen FROM events""")
def pick_time_column(spark: SparkSession, sf: str) -> DataFrame:
    log = events(spark, sf).select(F.when(F.col("ord") == 5, F.col("t_ns")).alias("gps_epoch_ns"), F.col("t_ns").alias("pi_time_ns"))
    return spark.range(1).select(F.lit(timealign.pick_time_column(log)).alias("chosen"))


@query(f"""WITH {EVENTS},
q AS (SELECT session_id, min(t_ns) AS a, max(t_ns) AS b, median(CAST(t_ns AS DOUBLE)) AS m, arg_min(t_ns, ord) AS f FROM samples GROUP BY 1),
g AS (SELECT session_id, min(t_ns) AS a, max(t_ns) AS b, median(CAST(t_ns AS DOUBLE)) AS m, arg_min(t_ns, ord) AS f FROM knots WHERE t_ns % 7 < 3 GROUP BY 1),
u AS (SELECT session_id, q.f AS qf, g.f AS gf, q.a <= g.b AND g.a <= q.b AND q.m BETWEEN 946684800e9 AND 4102444800e9 AND g.m BETWEEN 946684800e9 AND 4102444800e9 AS epoch FROM q JOIN g USING (session_id))
SELECT session_id, CASE WHEN epoch THEN 'unix_ns' ELSE 'relative_start' END AS mode, CASE WHEN epoch THEN 0 ELSE qf END AS query_origin, CASE WHEN epoch THEN 0 ELSE gf END AS ref_origin FROM u""")
def time_mode_auto(spark: SparkSession, sf: str) -> DataFrame:
    e = events(spark, sf)
    return timealign.choose_time_mode(e.where(~is_knot()), e.where(is_knot() & (F.col("t_ns") % 7 < 3)), keys=["session_id"])


@query(f"""WITH {EVENTS}, span AS (SELECT session_id, min(t_ns) AS lo, max(t_ns) AS hi FROM knots GROUP BY 1)
SELECT s.session_id, count(*) AS n, CAST(count(*) FILTER (coalesce(t_ns BETWEEN lo AND hi, false)) AS BIGINT) AS kept,
  CAST(count(*) FILTER (NOT coalesce(t_ns BETWEEN lo AND hi, false)) AS BIGINT) AS dropped FROM samples s LEFT JOIN span USING (session_id) GROUP BY 1""")
def trim_to_range(spark: SparkSession, sf: str) -> DataFrame:
    e = events(spark, sf)
    marked = timealign.in_range(e.where(~is_knot()), e.where(is_knot()), keys=["session_id"])
    return marked.groupBy("session_id").agg(F.count("*").alias("n"), F.count_if("in_range").alias("kept"), F.count_if(~F.col("in_range")).alias("dropped"))


INTERPOLATED = """SELECT s.*, CASE WHEN k.t_ns = s.t_ns THEN k.easting ELSE k.easting + (k.e1 - k.easting) * (CAST(s.t_ns - k.t_ns AS DOUBLE) / CAST(k.t1 - k.t_ns AS DOUBLE)) END AS e,
  CASE WHEN k.t_ns = s.t_ns THEN k.northing ELSE k.northing + (k.n1 - k.northing) * (CAST(s.t_ns - k.t_ns AS DOUBLE) / CAST(k.t1 - k.t_ns AS DOUBLE)) END AS n"""
LED = "SELECT *, lead(t_ns) OVER w AS t1, lead(easting) OVER w AS e1, lead(northing) OVER w AS n1 FROM knots WINDOW w AS"


@query(f"""WITH {EVENTS}, k AS ({LED} (ORDER BY t_ns)),
i AS ({INTERPOLATED} FROM samples s ASOF JOIN k ON s.t_ns >= k.t_ns WHERE k.t_ns = s.t_ns OR k.t1 IS NOT NULL)
SELECT ord, t_ns, round(e, 5) + 0.0 AS easting, round(n, 5) + 0.0 AS northing FROM i""")
def interp_asof(spark: SparkSession, sf: str) -> DataFrame:
    e = events(spark, sf)
    out = asof.interpolate(e.where(~is_knot()).select("ord", "t_ns"), e.where(is_knot()), ["easting", "northing"])
    return out.select("ord", "t_ns", r("easting", 5).alias("easting"), r("northing", 5).alias("northing"))


@query(f"""WITH {EVENTS}, k AS ({LED} (PARTITION BY session_id ORDER BY t_ns)),
i AS ({INTERPOLATED} FROM samples s ASOF JOIN k ON s.session_id = k.session_id AND s.t_ns >= k.t_ns WHERE k.t_ns = s.t_ns OR k.t1 IS NOT NULL)
SELECT session_id, ord, t_ns, round(e, 5) + 0.0 AS easting, round(n, 5) + 0.0 AS northing FROM i""")
def interp_asof_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    e = events(spark, sf)
    out = asof.interpolate(e.where(~is_knot()).select("session_id", "ord", "t_ns"), e.where(is_knot()), ["easting", "northing"], keys=["session_id"])
    return out.select("session_id", "ord", "t_ns", r("easting", 5).alias("easting"), r("northing", 5).alias("northing"))


NEAREST = f"""{EVENTS},
q AS (SELECT session_id, ord, CASE WHEN ord % 50 = 3 THEN 0 ELSE t_ns END AS t_ns FROM samples),
l AS (SELECT q.*, k.t_ns AS lt, k.ord AS lo FROM q ASOF LEFT JOIN knots k ON q.session_id = k.session_id AND q.t_ns > k.t_ns),
b AS (SELECT l.*, k.t_ns AS rt, k.ord AS ro FROM l ASOF LEFT JOIN knots k ON l.session_id = k.session_id AND l.t_ns <= k.t_ns),
p AS (SELECT *, CASE WHEN lt IS NULL THEN ro WHEN rt IS NULL THEN lo WHEN rt - t_ns < t_ns - lt THEN ro ELSE lo END AS pick,
  CASE WHEN lt IS NULL THEN rt - t_ns WHEN rt IS NULL THEN t_ns - lt ELSE least(rt - t_ns, t_ns - lt) END AS d FROM b),
f AS (SELECT session_id, arg_min(pick, ord) FILTER (t_ns > 0) AS own FROM p GROUP BY 1),
a AS (SELECT session_id, arg_min(ord, t_ns) AS first FROM knots GROUP BY 1),
m AS (SELECT p.session_id, p.ord, p.t_ns, CASE WHEN t_ns > 0 THEN pick ELSE coalesce(own, first) END AS pose_ord, CASE WHEN t_ns > 0 THEN d ELSE 0 END AS delta_ns,
  coalesce(t_ns > 0 AND d <= 3600000000000, false) AS inlier FROM p LEFT JOIN f USING (session_id) LEFT JOIN a USING (session_id))"""


def _matched(spark: SparkSession, sf: str) -> DataFrame:
    e = events(spark, sf)
    q = e.where(~is_knot()).withColumn("t_ns", F.when(F.col("ord") % 50 == 3, F.lit(0).cast("long")).otherwise(F.col("t_ns")))
    return asof.nearest(q, e.where(is_knot()).withColumn("pose_ord", F.col("ord")), keys=["session_id"], tolerance=3_600_000_000_000)


@query(f"WITH {NEAREST} SELECT * FROM m")
def nearest_pose(spark: SparkSession, sf: str) -> DataFrame:
    return _matched(spark, sf)


@query(f"""WITH {NEAREST}, c AS (SELECT session_id, count(*) AS columns, count(*) FILTER (t_ns > 0) AS valid, count(*) FILTER (inlier) AS inlier,
  count(*) FILTER (t_ns > 0 AND delta_ns = 0) AS exact, coalesce(max(delta_ns) FILTER (t_ns > 0), 0) AS max_delta_ns FROM m GROUP BY 1)
SELECT session_id, columns, valid, inlier, valid - inlier AS dropped, exact, valid - exact AS nearest, max_delta_ns FROM c""")
def nearest_pose_stats(spark: SparkSession, sf: str) -> DataFrame:
    return asof.lookup_stats(_matched(spark, sf), keys=["session_id"])


HEADING = """g AS (SELECT *, CASE WHEN lag(e) OVER w IS NULL THEN lead(e) OVER w - e WHEN lead(e) OVER w IS NULL THEN e - lag(e) OVER w ELSE (lead(e) OVER w - lag(e) OVER w) / 2 END AS dx,
  CASE WHEN lag(n) OVER w IS NULL THEN lead(n) OVER w - n WHEN lead(n) OVER w IS NULL THEN n - lag(n) OVER w ELSE (lead(n) OVER w - lag(n) OVER w) / 2 END AS dy
  FROM i WINDOW w AS (PARTITION BY session_id ORDER BY t_ns, ord)),
h0 AS (SELECT *, CASE WHEN sqrt(dx * dx + dy * dy) > 1e-9 THEN atan2(dy, dx) END AS h FROM g),
h AS (SELECT * EXCLUDE (h), coalesce(last_value(h IGNORE NULLS) OVER (PARTITION BY session_id ORDER BY t_ns, ord ROWS UNBOUNDED PRECEDING),
  first_value(h IGNORE NULLS) OVER (PARTITION BY session_id ORDER BY t_ns, ord ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0.5) AS heading FROM h0)"""


@query(f"WITH {EVENTS}, i AS (SELECT *, round(easting / 50) AS e, round(northing / 50) AS n FROM track), {HEADING} SELECT session_id, ord, round(heading, 6) + 0.0 AS heading_rad FROM h")
def tangent_heading(spark: SparkSession, sf: str) -> DataFrame:
    # Coarse steps make the path stand still now and then.
    e = events(spark, sf).withColumns({"easting": F.round(F.col("easting") / 50), "northing": F.round(F.col("northing") / 50)})
    out = track.heading(e, keys=["session_id"], order=["t_ns", "ord"], fallback_rad=0.5)
    return out.select("session_id", "ord", r("heading_rad").alias("heading_rad"))


@query(f"""WITH {EVENTS}, s AS (SELECT session_id, sqrt(power(easting - lag(easting) OVER w, 2) + power(northing - lag(northing) OVER w, 2)) AS d FROM track WINDOW w AS (PARTITION BY session_id ORDER BY t_ns, ord))
SELECT session_id, round(coalesce(sum(d), 0), 4) AS path_length_m FROM s GROUP BY 1""")
def path_length(spark: SparkSession, sf: str) -> DataFrame:
    return track.path_length(events(spark, sf), keys=["session_id"], order=["t_ns", "ord"]).select("session_id", r("path_length_m", 4).alias("path_length_m"))


@query("""WITH p AS (SELECT vec_id, -CAST(embedding[1] AS DOUBLE) AS x, -CAST(embedding[2] AS DOUBLE) AS y, CAST(embedding[3] AS DOUBLE) AS z, radians(vec_id % 360) AS a FROM embeddings)
SELECT vec_id, round(cos(a) * x - sin(a) * y + 100, 6) + 0.0 AS x, round(sin(a) * x + cos(a) * y - 50, 6) + 0.0 AS y, round(z + 2, 6) + 0.0 AS z, round(degrees(atan2(sin(a), cos(a))), 6) + 0.0 AS deg FROM p""")
def rotate_translate(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings")
    x, y, z = geometry.to_local(*[F.col("embedding")[i].cast("double") for i in range(3)])
    theta = F.radians(F.col("vec_id") % 360)
    x, y = geometry.rotate(x, y, theta)
    return e.select("vec_id", r(x + 100).alias("x"), r(y - 50).alias("y"), r(z + 2).alias("z"), r(geometry.rotation_deg(F.sin(theta), F.cos(theta))).alias("deg"))


@query(f"""WITH {EVENTS}, k AS ({LED} (PARTITION BY session_id ORDER BY t_ns)),
i AS ({INTERPOLATED} FROM samples s ASOF JOIN k ON s.session_id = k.session_id AND s.t_ns >= k.t_ns WHERE k.t_ns = s.t_ns OR k.t1 IS NOT NULL), {HEADING.replace("0.5)", "0.0)")},
l AS (SELECT *, -CAST(ord % 11 AS DOUBLE) AS x, -CAST(ord % 7 AS DOUBLE) AS y, CAST(ord % 5 AS DOUBLE) AS z, heading AS a FROM h)
SELECT session_id, t_ns AS timestamp_ns, round(e + (cos(a) * x - sin(a) * y) + 1, 4) + 0.0 AS x_global, round(n + (sin(a) * x + cos(a) * y) - 1, 4) + 0.0 AS y_global, z AS z_global FROM l""")
def fuse_end_to_end(spark: SparkSession, sf: str) -> DataFrame:
    e = events(spark, sf)
    n = lambda k: (F.col("ord") % k).cast("double")
    x, y, z = geometry.to_local(n(11), n(7), n(5))
    points = e.where(~is_knot()).select("session_id", "ord", "t_ns", x.alias("x"), y.alias("y"), z.alias("z"))
    gps = e.where(is_knot()).select("session_id", "ord", "t_ns", "easting", "northing", F.lit(0.0).alias("altitude_m"))
    cfg = JobConfig(time_mode="unix_ns", orientation="path_tangent", heading_order="time", sensor_offset_x=1.0, sensor_offset_y=-1.0)
    out = jobs.gps_fusion(points, gps, cfg, scan_keys=("session_id",))
    return out.select("session_id", "timestamp_ns", r("x_global", 4).alias("x_global"), r("y_global", 4).alias("y_global"), "z_global")


@query(f"""WITH RECURSIVE {EVENTS},
s AS (SELECT session_id, t_ns, easting * 1000 AS x, row_number() OVER (PARTITION BY session_id ORDER BY t_ns, ord) AS i FROM track),
f(session_id, i, lt, lx, kept, slow) AS (SELECT session_id, i, t_ns, x, 1, 0 FROM s WHERE i = 1
  UNION ALL SELECT s.session_id, s.i, CASE WHEN ok THEN s.t_ns ELSE lt END, CASE WHEN ok THEN x ELSE lx END, CASE WHEN ok THEN 1 ELSE 0 END, CASE WHEN s.t_ns > lt AND NOT ok THEN 1 ELSE 0 END
  FROM (SELECT s.*, f.lt, f.lx, s.t_ns > f.lt AND NOT (abs(s.x - f.lx) / ((s.t_ns - f.lt) * 1e-9) > 2.0) AS ok FROM f JOIN s ON s.session_id = f.session_id AND s.i = f.i + 1) s)
SELECT session_id, count(*) AS input, CAST(sum(kept) AS BIGINT) AS kept, CAST(sum(1 - kept) AS BIGINT) AS dropped, CAST(sum(slow) AS BIGINT) AS dropped_speed, CAST(sum(1 - kept - slow) AS BIGINT) AS dropped_time FROM f GROUP BY 1""")
def speed_filter(spark: SparkSession, sf: str) -> DataFrame:
    e = events(spark, sf).select("session_id", "ord", "t_ns", (F.col("easting") * 1000).alias("easting"), F.lit(0.0).alias("northing"))
    return track.speed_stats(track.speed_verdict(e, max_speed_mps=2.0), ["session_id"])


@query(f"""WITH RECURSIVE {EVENTS},
s AS (SELECT session_id, ord, easting AS x, row_number() OVER (PARTITION BY session_id ORDER BY t_ns, ord) AS i FROM track),
f(session_id, i, ord, px, way, taken) AS (SELECT session_id, i, ord, x, CAST(0 AS DOUBLE), true FROM s WHERE i = 1
  UNION ALL SELECT s.session_id, s.i, s.ord, s.x, CASE WHEN f.way + abs(s.x - f.px) >= 500 THEN 0 ELSE f.way + abs(s.x - f.px) END, f.way + abs(s.x - f.px) >= 500
  FROM f JOIN s ON s.session_id = f.session_id AND s.i = f.i + 1)
SELECT session_id, ord FROM f WHERE taken""")
def thin_by_distance(spark: SparkSession, sf: str) -> DataFrame:
    e = events(spark, sf).withColumn("northing", F.lit(0.0))
    return track.thin_by_distance(e, every_m=500.0).select("session_id", "ord")


FIT = """c AS (SELECT l_returnflag, count(*) AS n, avg(l_quantity) AS sx, avg(l_tax * 100) AS sy, avg(l_extendedprice / 1000) AS dx, avg(l_discount * 100) AS dy,
  covar_pop(l_quantity, l_discount * 100) - covar_pop(l_tax * 100, l_extendedprice / 1000) AS crs, covar_pop(l_quantity, l_extendedprice / 1000) + covar_pop(l_tax * 100, l_discount * 100) AS dot FROM lineitem GROUP BY 1),
t AS (SELECT *, atan2(crs, dot) AS th FROM c)"""


@query(f"""WITH {FIT} SELECT l_returnflag, n, round(th, 7) + 0.0 AS theta_rad, round(dx - (cos(th) * sx - sin(th) * sy), 5) + 0.0 AS tx, round(dy - (sin(th) * sx + cos(th) * sy), 5) + 0.0 AS ty, 'rigid_xy' AS method FROM t""")
def rigid_fit_2d(spark: SparkSession, sf: str) -> DataFrame:
    fit = geometry.rigid_fit(_matched_lines(spark, sf), src=("sx", "sy"), dst=("dx", "dy"), min_motion_m=1.0, keys=["l_returnflag"])
    return fit.select("l_returnflag", "n", r("theta_rad", 7).alias("theta_rad"), r("tx", 5).alias("tx"), r("ty", 5).alias("ty"), "method")


def _matched_lines(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    return li.select("l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").alias("sx"), (F.col("l_tax") * 100).alias("sy"), (F.col("l_extendedprice") / 1000).alias("dx"), (F.col("l_discount") * 100).alias("dy"))


@query(f"""WITH {FIT}, m AS (SELECT l.l_returnflag, l_quantity AS qx, l_tax * 100 AS qy, l_extendedprice / 1000 AS rx, l_discount * 100 AS ry, th, dx - (cos(th) * sx - sin(th) * sy) AS tx, dy - (sin(th) * sx + cos(th) * sy) AS ty, l_orderkey, l_linenumber, l_partkey
  FROM lineitem l JOIN t USING (l_returnflag)),
a AS (SELECT *, cos(th) * qx - sin(th) * qy + tx AS ex, sin(th) * qx + cos(th) * qy + ty AS ey FROM m),
s AS (SELECT *, sqrt((ex - rx) * (ex - rx) + (ey - ry) * (ey - ry)) AS d, sqrt(power(rx - lag(rx) OVER w, 2) + power(ry - lag(ry) OVER w, 2)) AS rs, sqrt(power(ex - lag(ex) OVER w, 2) + power(ey - lag(ey) OVER w, 2)) AS es
  FROM a WINDOW w AS (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber, l_partkey, rx, qx, qy, ry))
SELECT l_returnflag, count(*) AS samples, round(avg(d), 5) AS xy_mean_m, round(sqrt(avg(d * d)), 5) AS xy_rmse_m, round(median(d), 5) AS xy_median_m, round(quantile_cont(d, 0.95), 5) AS xy_p95_m, round(max(d), 5) AS xy_max_m,
  round(coalesce(sum(rs), 0), 2) AS reference_path_length_m, round(coalesce(sum(es), 0), 2) AS estimated_path_length_m, round(max(rx) - min(rx), 5) AS reference_span_x_m, round(max(ry) - min(ry), 5) AS reference_span_y_m,
  round(max(ex) - min(ex), 5) AS estimated_span_x_m, round(max(ey) - min(ey), 5) AS estimated_span_y_m, median(d) <= 5 AND quantile_cont(d, 0.95) <= 10 AS pass FROM s GROUP BY 1""")
def alignment_metrics(spark: SparkSession, sf: str) -> DataFrame:
    lines = _matched_lines(spark, sf)
    fit = geometry.rigid_fit(lines, src=("sx", "sy"), dst=("dx", "dy"), min_motion_m=1.0, keys=["l_returnflag"])
    fit = F.broadcast(checkpointed(fit))  # three flags; the metrics read it in each of their passes
    moved = geometry.apply_rigid(lines.withColumns({"ex": F.col("sx"), "ey": F.col("sy")}), fit, x="ex", y="ey", keys=["l_returnflag"])
    # Both coordinates move at once, so the second reads the first as it was.
    m = metrics.alignment(moved, ref=("dx", "dy"), est=("ex", "ey"), keys=["l_returnflag"], order=["l_orderkey", "l_linenumber", "l_partkey", "dx", "sx", "sy", "dy"])
    digits = {k: 2 if "path" in k else 5 for k in metrics.XY_METRICS if k != "samples"}
    return m.select("l_returnflag", "samples", *[r(k, d).alias(k) for k, d in digits.items()], metrics.passes().alias("pass"))


@query("""WITH p AS (SELECT CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, CAST(embedding[3] AS DOUBLE) AS z FROM embeddings)
SELECT CAST(floor(x / 0.1) AS BIGINT) AS vx, CAST(floor(y / 0.1) AS BIGINT) AS vy, CAST(floor(z / 0.1) AS BIGINT) AS vz, count(*) AS points, round(avg(x), 6) + 0.0 AS x, round(avg(y), 6) + 0.0 AS y, round(avg(z), 6) + 0.0 AS z FROM p GROUP BY 1, 2, 3""")
def voxel_downsample(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings").select(*[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate("xyz")])
    return scan.voxel_downsample(e, 0.1).select("vx", "vy", "vz", "points", *[r(c).alias(c) for c in "xyz"])


@query("""WITH s AS (SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS i, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders WHERE o_orderkey % 10 > 0)
SELECT o_custkey, o_orderkey, o_totalprice FROM s WHERE i = n // 2""")
def middle_sample(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate", (F.col("o_orderkey") % 10).alias("t_ns"))
    return track.middle(o, keys=["o_custkey"], order=["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


@query(f"""WITH {EVENTS}, w AS (SELECT session_id, arg_min(t_ns, ord) FILTER (ord % 3 = 0) AS first_ns, arg_max(t_ns, ord) FILTER (ord % 3 = 0) AS last_ns, min(t_ns) FILTER (event_type = 'view') / 1e9 AS a, max(t_ns) FILTER (event_type = 'view') / 1e9 AS b,
  count(*) AS scans, count(*) FILTER (ord % 3 = 0) AS valid FROM track GROUP BY 1)
SELECT session_id, first_ns, last_ns, scans, valid, coalesce(first_ns / 1e9 BETWEEN a - 3600 AND b + 3600 AND last_ns / 1e9 BETWEEN a - 3600 AND b + 3600, false) AS inside FROM w""")
def window_containment(spark: SparkSession, sf: str) -> DataFrame:
    ok = F.col("ord") % 3 == 0
    per = events(spark, sf).groupBy("session_id").agg(
        F.min_by("t_ns", F.when(ok, F.col("ord"))).alias("first_ns"), F.max_by("t_ns", F.when(ok, F.col("ord"))).alias("last_ns"), F.count("*").alias("scans"), F.count_if(ok).alias("valid"),
        (F.min(F.when(F.col("event_type") == "view", F.col("t_ns"))).cast("double") / 1e9).alias("a"), (F.max(F.when(F.col("event_type") == "view", F.col("t_ns"))).cast("double") / 1e9).alias("b"),
    )
    per = per.withColumns({c: F.when(F.col("valid") > 0, F.col(c)) for c in ("first_ns", "last_ns")})
    return status.window_contains(per, before="a", after="b", first_ns="first_ns", last_ns="last_ns", slop_s=3600.0).drop("a", "b")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE l_quantity >= 5 AND l_quantity <= 40 AND (l_linenumber = 3 OR l_discount * 100 >= 4.5)""")
def range_reflect_gate(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").withColumn("reflectivity", F.when(F.col("l_linenumber") != 3, F.col("l_discount") * 100))
    return scan.reflectivity_gate(scan.range_gate(li, F.col("l_quantity"), 5.0, 40.0), 4.5).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query("""SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(json_extract(props, '$.k') AS BIGINT) % 4 AS used, json_extract_string(props, '$.missing.deep') IS NULL AS missing FROM events""")
def json_props(spark: SparkSession, sf: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    sats = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.struct((i < F.pmod(k, F.lit(4))).alias("used")))
    used = F.size(F.filter(sats, lambda s: s["used"])).cast("long")
    return table(spark, sf, "events").select("event_id", k.alias("k"), used.alias("used"), F.get_json_object("props", "$.missing.deep").isNull().alias("missing"))


@query("""WITH s AS (SELECT event_id, epoch_us(ts) * 1000 AS t, CAST(event_id % 180 AS DOUBLE) - 90 + 0.25 AS lat, CAST(event_id % 360 AS DOUBLE) - 180 + 0.125 AS lon, event_id % 5 AS q, round(value, 2) AS alt FROM events)
SELECT event_id, t AS gps_epoch_ns, CAST(q AS INTEGER) AS gps_quality, round(lat, 6) AS latitude, round(lon, 6) AS longitude, alt AS altitude_m FROM s WHERE q > 0 AND event_id % 13 <> 0""")
def nmea_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    day, tod = F.to_date("ts"), us % 86400000000
    lat, lon = (F.col("event_id") % 180).cast("double") - 90 + 0.25, (F.col("event_id") % 360).cast("double") - 180 + 0.125
    gga = nmea.gga_sentence(tod, lat, lon, F.col("event_id") % 5, F.lit(9), F.lit(0.8), F.round("value", 2))
    broken = F.when(F.col("event_id") % 13 == 0, F.regexp_replace(gga, ",M,0", ",N,0")).otherwise(gga)
    lines = e.select("event_id", F.posexplode(F.array(nmea.rmc_sentence(day, tod), broken)).alias("ord", "value"))
    out = nmea.fixes(lines, keys=["event_id"])
    return out.select("event_id", "gps_epoch_ns", "gps_quality", F.round("latitude", 6).alias("latitude"), F.round("longitude", 6).alias("longitude"), "altitude_m")


@query(r"""WITH n AS (SELECT page_id, CASE page_id % 3 WHEN 0 THEN '/tmp/raw_gps_202603' || lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0') || '_094022.csv' WHEN 1 THEN '/tmp/run_20260317_' || lpad(CAST(page_id % 1000000 AS VARCHAR), 6, '0') || '_done.PCAP' ELSE url END AS path FROM pages),
s AS (SELECT *, nullif(regexp_extract(list_extract(string_split(path, '/'), -1), '(\d{8}_\d{6})', 1), '') AS session_id FROM n)
SELECT page_id, session_id, regexp_matches(lower(path), '\.(pcap|osf)$') AS raw, list_extract(string_split(path, '/'), -1) AS name FROM s""")
def session_id_extract(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("page_id")
    path = F.when(i % 3 == 0, F.concat(F.lit("/tmp/raw_gps_202603"), F.lpad((i % 28 + 1).cast("string"), 2, "0"), F.lit("_094022.csv")))
    path = path.when(i % 3 == 1, F.concat(F.lit("/tmp/run_20260317_"), F.lpad((i % 1000000).cast("string"), 6, "0"), F.lit("_done.PCAP"))).otherwise(F.col("url"))
    return table(spark, sf, "pages").select("page_id", text.session_id(path).alias("session_id"), manifest.is_raw(path).alias("raw"), text.basename(path).alias("name"))


LOG = """lines AS (SELECT conv_id, turn, CASE turn % 6 WHEN 0 THEN 'GPS fix logged: ' || conv_id WHEN 1 THEN 'Waiting for first GPS fix' WHEN 2 THEN 'GPS fix logged: again' WHEN 3 THEN 'Starting chunk ' || (turn // 6) || ': 30 s' WHEN 4 THEN 'GPS fix acquired' ELSE 'Manifest: /out/' || conv_id || '.json ' END AS text FROM conversations)"""


def _log(spark: SparkSession, sf: str) -> DataFrame:
    t, c = F.col("turn"), F.col("conv_id").cast("string")
    words = [F.concat(F.lit("GPS fix logged: "), c), F.lit("Waiting for first GPS fix"), F.lit("GPS fix logged: again"), F.concat(F.lit("Starting chunk "), F.expr("turn div 6").cast("string"), F.lit(": 30 s")), F.lit("GPS fix acquired"), F.concat(F.lit("Manifest: /out/"), c, F.lit(".json "))]
    line = words[5]
    for k in range(4, -1, -1):
        line = F.when(t % 6 == k, words[k]).otherwise(line)
    return table(spark, sf, "conversations").select("conv_id", "turn", line.alias("text"))


@query(f"""WITH {LOG}, m AS (SELECT *, CASE WHEN text LIKE 'Waiting%' THEN 'waiting for gps fix' WHEN text LIKE 'Starting%' THEN 'capturing' END AS p, TRY_CAST(nullif(regexp_extract(text, 'Starting chunk (\\d+):', 1), '') AS INTEGER) AS c, CASE WHEN text LIKE 'Manifest:%' THEN trim(substr(text, 10)) END AS f FROM lines)
SELECT conv_id, turn, bool_or(text LIKE 'GPS fix acquired%') OVER w AS gps_fix_ready, last_value(p IGNORE NULLS) OVER w AS phase, coalesce(last_value(c IGNORE NULLS) OVER w, -1) AS current_chunk_index, last_value(f IGNORE NULLS) OVER w AS manifest_path,
  last_value(CASE WHEN text LIKE 'GPS fix logged:%' THEN text END IGNORE NULLS) OVER w AS latest_gps_log FROM m WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)""")
def log_state_machine(spark: SparkSession, sf: str) -> DataFrame:
    out = logs.states(_log(spark, sf), keys=["conv_id"], order="turn")
    return out.select("conv_id", "turn", "gps_fix_ready", "phase", F.coalesce("current_chunk_index", F.lit(-1)).alias("current_chunk_index"), "manifest_path", "latest_gps_log")


@query(f"""WITH {LOG}, m AS (SELECT *, coalesce(last_value(TRY_CAST(nullif(regexp_extract(text, 'Starting chunk (\\d+):', 1), '') AS INTEGER) IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING), -1) AS c FROM lines),
s AS (SELECT *, last_value(CASE WHEN text LIKE 'GPS fix logged:%' THEN c END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM m)
SELECT conv_id, turn, text FROM s WHERE text NOT LIKE 'GPS fix logged:%' OR seen IS NULL OR seen <> c""")
def log_throttle(spark: SparkSession, sf: str) -> DataFrame:
    return logs.surfaced(_log(spark, sf), keys=["conv_id"], order="turn").select("conv_id", "turn", "text")


@query("""WITH n AS (SELECT role, conv_id, turn, row_number() OVER (PARTITION BY role ORDER BY conv_id, turn) AS id FROM conversations), r AS (SELECT *, row_number() OVER (PARTITION BY role ORDER BY id DESC) AS k FROM n)
SELECT role, conv_id, turn, id FROM r WHERE k <= 50 AND id > 20""")
def ring_tail(spark: SparkSession, sf: str) -> DataFrame:
    ids = logs.numbered(table(spark, sf, "conversations").select("role", "conv_id", "turn"), run=["role"], order=["conv_id", "turn"])
    return logs.logs_after(logs.ring(ids, run=["role"], size=50), 20).select("role", "conv_id", "turn", "id")


@query("""SELECT event_type, epoch_us(time_bucket(INTERVAL 30 SECOND, ts, TIMESTAMP '1970-01-01')) * 1000 AS start_ns, count(*) AS n, min(epoch_us(ts)) * 1000 AS first_ns, max(epoch_us(ts)) * 1000 AS last_ns FROM events GROUP BY 1, 2""")
def chunk_tumble(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("event_type", F.col("ts").cast("timestamp").alias("ts"))
    ns = lambda c: (F.unix_micros(c) * 1000).alias(f"{c}_ns")
    return tumble(e, "ts", "30 seconds", keys=["event_type"]).select("event_type", ns("start"), "n", ns("first"), ns("last"))


@query(f"""WITH {EVENTS}, s AS (SELECT session_id, ord, t_ns, CASE WHEN ord % 4 = 0 THEN NULL ELSE ord // 40 END AS seq, event_type FROM track JOIN (SELECT session_id, min(t_ns) AS began FROM track WHERE event_type = 'signup' GROUP BY 1) b USING (session_id) WHERE t_ns >= began),
m AS (SELECT *, last_value(seq IGNORE NULLS) OVER (PARTITION BY session_id ORDER BY t_ns ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ls, lag(event_type) OVER (PARTITION BY session_id ORDER BY t_ns) AS le FROM s)
SELECT session_id, ord, coalesce(seq, -1) AS seq, event_type FROM m WHERE NOT coalesce(CASE WHEN seq IS NOT NULL THEN seq = ls ELSE event_type = le END, false)""")
def stale_and_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    began = events(spark, sf).where("event_type = 'signup'").groupBy("session_id").agg(F.min("t_ns").alias("began"))  # each session begins with its first signup
    e = events(spark, sf).join(began, "session_id").where(F.col("t_ns") >= F.col("began")).drop("began")
    e = e.withColumn("seq", F.when(F.col("ord") % 4 != 0, F.expr("ord div 40")))
    return logs.drop_repeats(e, keys=["session_id"], order="t_ns", sequence="seq", signature=["event_type"]).select("session_id", "ord", F.coalesce("seq", F.lit(-1).cast("long")).alias("seq"), "event_type")


@query("""WITH a AS (SELECT DISTINCT l_orderkey AS k FROM lineitem EXCEPT SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'), u AS (SELECT k, 0 AS p FROM a UNION ALL SELECT o_orderkey, 1 FROM orders), d AS (SELECT k, min(p) AS p FROM u GROUP BY 1)
SELECT k, CAST(p AS INTEGER) AS source FROM d""")
def produced_except(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    new = manifest.produced(table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k")), orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("k")))
    both = new.withColumn("source", F.lit(0)).unionByName(orders.select(F.col("o_orderkey").alias("k"), F.lit(1).alias("source")))
    return manifest.distinct_in_order(both, "k", keys=[], order=["source"]).select("k", "source")


@query(r"""WITH l AS (SELECT user_id AS id, event_id AS ord, substr('*+-?x~', CAST(event_id % 6 AS INTEGER) + 1, 1) AS state, CASE event_type WHEN 'view' THEN 'GPS' WHEN 'click' THEN 'PPS' ELSE event_type END AS name FROM events WHERE event_id % 7 <> 0),
p AS (SELECT id, arg_min(name, ord) FILTER (state = '*') AS sel, string_agg(DISTINCT name || ':' || state, ',' ORDER BY name || ':' || state) FILTER (name IN ('GPS', 'PPS')) AS loc FROM l GROUP BY 1),
u AS (SELECT DISTINCT user_id AS id, user_id % 4 = 0 AS failed FROM events)
SELECT u.id, NOT failed AND coalesce(sel IN ('GPS', 'PPS'), false) AS ready, sel AS selected_source, coalesce(loc, '') AS local_states,
  CASE WHEN failed THEN 'chronyc waitsync not yet satisfied' WHEN loc IS NULL THEN 'chrony waitsync passed, but GPS/PPS refclocks were not present in `chronyc sources -v`.' WHEN sel IS NULL THEN 'chrony waitsync passed, but no selected source was reported.'
    WHEN sel NOT IN ('GPS', 'PPS') THEN 'chrony is synchronized to ' || sel || ' instead of GPS/PPS.' ELSE 'chrony synchronized to local source ' || sel || '.' END AS summary
FROM u LEFT JOIN p ON u.id = p.id""")
def chrony_parse(spark: SparkSession, sf: str) -> DataFrame:
    """Each user's events printed as a clock daemon's listing, one line an event, every seventh of them no source line."""
    e, i = table(spark, sf, "events"), F.col("event_id")
    name = F.when(F.col("event_type") == "view", "GPS").when(F.col("event_type") == "click", "PPS").otherwise(F.col("event_type"))
    pick = lambda chars, n: F.substr(F.lit(chars), (i % n).cast("int") + 1, F.lit(1))
    line = F.when(i % 7 == 0, F.lit("MS Name/IP address")).otherwise(F.concat(pick("#^=", 3), pick("*+-?x~", 6), F.lit(" "), name, F.lit("  2   6   377    10   +1ms[  +1ms] +/-   22ms")))
    lines = e.select(F.col("user_id").alias("id"), F.struct(i.alias("i"), line.alias("line")).alias("l")).groupBy("id").agg(F.array_sort(F.collect_list("l")).alias("l"))
    texts = lines.select("id", F.array_join(F.transform("l", lambda x: x["line"]), "\n").alias("body"), F.when(F.col("id") % 4 == 0, 1).otherwise(0).alias("returncode"))
    return status.clock_sync(status.clock_sources(texts, "body", keys=["id"]), texts.select("id", "returncode"), keys=["id"])


@query("""SELECT CASE WHEN abs(c_acctbal) <= 1000 THEN 'PASS' WHEN abs(c_acctbal) <= 5000 THEN 'WARN' ELSE 'FAIL' END AS level, c_mktsegment, count(*) AS n, count(*) FILTER (abs(c_acctbal - 2500) <= 500) AS ready FROM customer GROUP BY 1, 2""")
def severity_bands(spark: SparkSession, sf: str) -> DataFrame:
    level = metrics.severity(F.col("c_acctbal"), 1000.0, 5000.0, ("PASS", "WARN", "FAIL"))
    return table(spark, sf, "customer").groupBy(level.alias("level"), "c_mktsegment").agg(F.count("*").alias("n"), F.count_if(status.aligned(F.col("c_acctbal"), F.lit(2500.0), 500.0)).alias("ready"))


@query("""WITH p AS (SELECT vec_id, CAST(i - 1 AS BIGINT) AS o, CAST(embedding[i] AS DOUBLE) AS v FROM (SELECT vec_id, embedding, unnest(range(1, 65)) AS i FROM embeddings))
SELECT vec_id, CAST(o // 8 AS INTEGER) AS row, CAST((o % 8 + o // 8 * 3) % 8 AS INTEGER) AS col, o // 8 * 8 + (o % 8 + o // 8 * 3) % 8 AS ord, round(v * 0.001, 9) + 0.0 AS range_m FROM p WHERE v > 0""")
def scan_explode(spark: SparkSession, sf: str) -> DataFrame:
    pixels = scan.explode_scan(table(spark, sf, "embeddings"), "embedding", width=8, keys=["vec_id"])
    moved = scan.destagger(pixels, F.col("row") * 3, 8).withColumn("value", F.col("value").cast("double"))
    valid = scan.valid_pixels(moved, xyz=["value"], range_mm="value")
    return valid.select("vec_id", "row", "col", "ord", r(F.col("value") * 0.001, 9).alias("range_m"))


@query("""WITH m AS (SELECT vec_id, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS m FROM embeddings)
SELECT vec_id, round(m[1] * m[17] + m[2] * m[18] + m[3] * m[19] + m[4], 6) + 0.0 AS x, round(m[5] * m[17] + m[6] * m[18] + m[7] * m[19] + m[8], 6) + 0.0 AS y, round(m[9] * m[17] + m[10] * m[18] + m[11] * m[19] + m[12], 6) + 0.0 AS z, m[4] AS tx, m[8] AS ty, m[12] AS tz FROM m""")
def pose_apply(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("m"))
    x, y, z = geometry.apply_pose(F.col("m")[16], F.col("m")[17], F.col("m")[18], F.col("m"))
    tx, ty, tz = geometry.translation()
    return e.select("vec_id", r(x).alias("x"), r(y).alias("y"), r(z).alias("z"), tx.alias("tx"), ty.alias("ty"), tz.alias("tz"))


@query(f"""WITH {EVENTS} SELECT session_id, ord, last_value(CASE WHEN event_type = 'signup' THEN easting END IGNORE NULLS) OVER w AS hdop, coalesce(last_value(CASE WHEN event_type = 'signup' AND ord % 2 = 0 THEN ord END IGNORE NULLS) OVER w, -1) AS num_sats
FROM track WINDOW w AS (PARTITION BY session_id ORDER BY ord ROWS UNBOUNDED PRECEDING)""")
def carry_last(spark: SparkSession, sf: str) -> DataFrame:
    sky = F.col("event_type") == "signup"
    e = events(spark, sf).withColumns({"hdop": F.when(sky, F.col("easting")), "num_sats": F.when(sky & (F.col("ord") % 2 == 0), F.col("ord"))})
    return asof.carry_last(e, ["hdop", "num_sats"], keys=["session_id"], order="ord").select("session_id", "ord", "hdop", F.coalesce("num_sats", F.lit(-1).cast("long")).alias("num_sats"))


@query(f"""WITH {EVENTS}, p AS (SELECT min(easting) + 1 - 500 AS ox, min(northing) + 2 - 500 AS oy, min(t_ns) AS t0 FROM track)
SELECT ord, t_ns - t0 AS rel_ns, CAST(round((easting - ox) / 0.001) AS BIGINT) AS ix, CAST(round((northing - oy) / 0.001) AS BIGINT) AS iy FROM track, p""")
def param_cross(spark: SparkSession, sf: str) -> DataFrame:
    e = events(spark, sf)
    one = e.agg((F.min("easting") + 1 - 500).alias("ox"), (F.min("northing") + 2 - 500).alias("oy"), F.min("t_ns").alias("t0"))
    cell = lambda v, o: F.round((F.col(v) - F.col(o)) / 0.001).cast("long")
    return e.crossJoin(F.broadcast(one)).select("ord", (F.col("t_ns") - F.col("t0")).alias("rel_ns"), cell("easting", "ox").alias("ix"), cell("northing", "oy").alias("iy"))


@query("""WITH a AS (SELECT page_id, 'scan' || page_id || '.pcap' AS path FROM pages), f AS (SELECT 'scan' || page_id || '.pcap' AS p FROM pages WHERE page_id % 5 = 0 UNION SELECT '/m/scan' || page_id || '.pcap' FROM pages WHERE page_id % 3 = 0 UNION SELECT '/base/scan' || page_id || '.pcap' FROM pages WHERE page_id % 2 = 0),
c AS (SELECT page_id, path, 0 AS prio, path AS cand FROM a UNION ALL SELECT page_id, path, 1, '/m/' || path FROM a UNION ALL SELECT page_id, path, 2, '/base/' || path FROM a),
b AS (SELECT page_id, path, arg_min(cand, prio) FILTER (p IS NOT NULL) AS hit FROM c LEFT JOIN f ON cand = p GROUP BY 1, 2)
SELECT page_id, path, coalesce(hit, path) AS resolved, hit IS NOT NULL AS found FROM b""")
def path_resolution(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("page_id")
    name = F.concat(F.lit("scan"), i.cast("string"), F.lit(".pcap"))
    pages = table(spark, sf, "pages").select("page_id", name.alias("path"))
    files = pages.where(i % 5 == 0).select("path").union(pages.where(i % 3 == 0).select(F.concat(F.lit("/m/"), "path"))).union(pages.where(i % 2 == 0).select(F.concat(F.lit("/base/"), "path")))
    return manifest.resolve(pages, files, manifest_dir="/m", base_dir="/base")


@query("""WITH a AS (SELECT page_id, '/d/scan' || page_id AS b FROM pages), f AS (SELECT b || '.json' AS s, page_id, 0 AS r FROM a WHERE page_id % 4 = 0 UNION ALL SELECT b || '_0.json', page_id, 1 FROM a WHERE page_id % 4 <= 1)
SELECT b || '.pcap' AS path, s AS sidecar FROM a LEFT JOIN (SELECT page_id, arg_min(s, r) AS s FROM f GROUP BY 1) USING (page_id)""")
def sidecar_join(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("page_id")
    base = table(spark, sf, "pages").select("page_id", F.concat(F.lit("/d"), i.cast("string"), F.lit("/scan"), i.cast("string")).alias("b"))
    files = base.where(i % 4 == 0).select(F.concat("b", F.lit(".json")).alias("path")).union(base.where(i % 4 <= 1).select(F.concat("b", F.lit("_0.json"))))
    out = sidecars(base.select(F.concat("b", F.lit(".pcap")).alias("path")), files)
    return out.select(*[F.regexp_replace(c, r"^/d\d+/", "/d/").alias(c) for c in ("path", "sidecar")])


@query("""WITH c AS (SELECT l_orderkey AS session_id, l_linenumber AS i, CASE WHEN l_linenumber % 3 = 0 THEN '/r/' || l_partkey || '.OSF' ELSE '/r/' || l_partkey || '.pcap' END AS a, '/r/' || l_suppkey || '.csv' AS b, '/r/' || l_suppkey || '.pcap' AS d FROM lineitem),
u AS (SELECT session_id, i, unnest([a, b, d]) AS path FROM c), v AS (SELECT session_id, path, min(i) AS i FROM u WHERE regexp_matches(lower(path), '\\.(pcap|osf)$') GROUP BY 1, 2)
SELECT session_id, CAST(row_number() OVER (PARTITION BY session_id ORDER BY i, path) AS INTEGER) AS position, path FROM v""".replace("\\\\", "\\"))
def manifest_paths(spark: SparkSession, sf: str) -> DataFrame:
    path = lambda c, s: F.concat(F.lit("/r/"), F.col(c).cast("string"), F.lit(s))
    first = F.when(F.col("l_linenumber") % 3 == 0, path("l_partkey", ".OSF")).otherwise(path("l_partkey", ".pcap"))
    chunks = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("session_id"), F.col("l_linenumber").alias("chunk_index"), F.array(first, path("l_suppkey", ".csv")).alias("produced_files"), path("l_suppkey", ".pcap").alias("lidar_pcap_path"), F.lit(None).cast("string").alias("requested_output_path"),
    )
    return manifest.manifest_paths(manifest.build_manifests(chunks, keys=["session_id"]), "raw", keys=["session_id"])


@query(f"""WITH {EVENTS} SELECT session_id, count(*) AS rows_written, arg_min(t_ns, ord) AS first_fix_time_ns, arg_max(t_ns, ord) AS latest_fix_time_ns FROM track GROUP BY 1""")
def session_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return manifest.session_rollup(events(spark, sf), keys=["session_id"], order="ord")


@query("""WITH p AS (SELECT p_partkey, p_size, CASE p_size % 4 WHEN 0 THEN 1024 WHEN 1 THEN 2048 WHEN 2 THEN 4096 ELSE 512 END AS n, CASE p_size % 3 WHEN 0 THEN 20 WHEN 1 THEN 10 ELSE 5 END AS hz FROM part), m(n, hz, mode) AS (VALUES (1024, 20, '1024x20'), (2048, 10, '2048x10'), (4096, 5, '4096x5'))
SELECT p_partkey, mode, CASE WHEN p.p_size % 5 = 0 THEN NULL ELSE p.n || 'x' || p.hz END AS normal, p.p_size % 7 = 0 AS broken, TRY_CAST(CASE WHEN p.p_size % 2 = 0 THEN 'n/a' ELSE CAST(p.p_size AS VARCHAR) END AS DOUBLE) AS num FROM p LEFT JOIN m ON p.n = m.n AND p.hz = m.hz""")
def mode_lookup(spark: SparkSession, sf: str) -> DataFrame:
    s = F.col("p_size")
    n = F.when(s % 4 == 0, 1024).when(s % 4 == 1, 2048).when(s % 4 == 2, 4096).otherwise(512)
    hz = F.when(s % 3 == 0, 20).when(s % 3 == 1, 10).otherwise(5)
    raw = F.when(s % 5 == 0, "  ").otherwise(F.concat(F.lit(" 0"), n.cast("string"), F.lit("X0"), hz.cast("string"), F.lit(" ")))
    broken = F.when(s % 7 == 0, "1024").otherwise(raw)
    return table(spark, sf, "part").select("p_partkey", text.mode_of(n, hz).alias("mode"), text.lidar_mode(raw).alias("normal"), text.lidar_mode_error(broken).alias("broken"), text.number(F.when(s % 2 == 0, "n/a").otherwise(s.cast("string"))).alias("num"))


LOCKED = "(event_id % 5 NOT IN (0, 1)) AND (event_id % 3 <> 0) AND event_id % 4 IN (0, 3)"


@query(f"""SELECT event_id, {LOCKED} AS locked, value AS sensor_s, abs(value - 50) <= 25 AS aligned,
  CASE WHEN {LOCKED} THEN CASE WHEN abs(value - 50) <= 25 THEN 'PASS' ELSE 'PARTIAL: clock' END WHEN abs(value - 50) <= 25 THEN 'PARTIAL: lock' ELSE 'FAIL' END AS verdict FROM events""")
def ptp_lock(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("event_id")
    mode = F.when(i % 5 == 0, "TIME_FROM_INTERNAL_OSC").when(i % 5 == 1, "TIME_FROM_PTP_1588_OTHER").otherwise("TIME_FROM_PTP_1588")
    port = F.when(i % 3 == 0, "LISTENING").when(i % 3 == 1, "slave").otherwise("SLAVE")
    # Of four kinds one says present, one says absent, one names nothing, one names a grandmaster only.
    gm = F.when(i % 4 == 0, ',"time_status_np":{"gm_present":true}').when(i % 4 == 1, ',"time_status_np":{"gm_present":false}').when(i % 4 == 2, "").otherwise(',"parent_data_set":{"grandmaster_identity":"ab"}')
    doc = F.concat(F.lit('{"timestamp_mode":"'), mode, F.lit('","ptp":{"port_data_set":{"port_state":"'), port, F.lit('"}'), gm, F.lit('},"time":{"sensor":{"timestamp":{"time":'), F.col("value").cast("string"), F.lit("}}}}"))
    st = table(spark, sf, "events").select("event_id", F.from_json(doc, status.STATUS_SCHEMA).alias("s"))
    out = st.select("event_id", status.ptp_locked(F.col("s")).alias("locked"), status.sensor_seconds(F.col("s")).alias("sensor_s"))
    out = out.withColumn("aligned", status.aligned(F.col("sensor_s"), F.lit(50.0), 25.0))
    return out.withColumn("verdict", status.verdict(F.col("locked"), F.col("aligned")))


@query("""SELECT event_id, epoch_us(ts) * 1000 AS exact_ns, CAST(trunc(CAST(epoch_us(ts) AS DOUBLE) / 1e6 * 1e9) AS BIGINT) AS float_ns, epoch_us(ts) * 1000 AS iso_ns, event_id % 10 = 0 AS blank FROM events""")
def epoch_convert(spark: SparkSession, sf: str) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    us = F.unix_micros(ts)
    clock = F.date_format(ts, "HHmmss.SSSSSS")
    day, tod = nmea.date(F.date_format(ts, "ddMMyy")), nmea.time_of_day_us(clock)
    iso = F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    blank = text.iso_epoch_ns(F.when(F.col("event_id") % 10 == 0, " ").otherwise(iso)).isNull()
    return table(spark, sf, "events").select("event_id", nmea.epoch_ns(day, tod).alias("exact_ns"), nmea.epoch_ns_via_float(day, tod).alias("float_ns"), text.iso_epoch_ns(iso).alias("iso_ns"), blank.alias("blank"))


# What a probe may print before a page's own text.
TEXTS = (
    "$GPGGA,194410.00,2925.4472,N,09829.6178,W,4,18,0.6,200.5,M,-24.3,M,,*59",
    "Leap status     : Normal",
    "#* PPS 0 2 377",
    "PTP Hardware Clock: 0",
    '{"port_state": "SLAVE", "n": 3}',
    "phc_ctl: clock time is 1781280168.602482101 or so",
    "AirNet:802-11-wireless:wlan0\nCable:802-3-ethernet:eth0",
    "",
)
RULES = ("nmea", "leap_normal", "selected_source,local_selected", "ptp_clock", "slave")


@query(f"""WITH p AS (SELECT page_id, page_id % {len(TEXTS)} AS k FROM pages), r(i, chk) AS (VALUES {", ".join(f"({i}, '{c}')" for i, names in enumerate(RULES) for c in names.split(","))})
SELECT page_id, chk AS "check", CASE WHEN k = i THEN 'PASS' ELSE 'FAIL' END AS level FROM p, r
UNION ALL SELECT page_id, 'phc', '1781280168.602' FROM p WHERE k = 5
UNION ALL SELECT page_id, 'wifi', split_part(split_part(list_filter(string_split('{TEXTS[6]}', chr(10)), lambda l: contains(l, 'wireless'))[1], ':', 1) || '@' || split_part(list_filter(string_split('{TEXTS[6]}', chr(10)), lambda l: contains(l, 'wireless'))[1], ':', 3), chr(13), 1) FROM p WHERE k = 6""")
def text_probe_rules(spark: SparkSession, sf: str) -> DataFrame:
    """A probe's print by the page's number, with the page behind it; the SQL knows each page's print and does not parse."""
    before = F.get(F.array(*[F.lit(t) for t in TEXTS]), (F.col("page_id") % len(TEXTS)).cast("int"))
    t = table(spark, sf, "pages").select("page_id", F.concat(before, F.lit("\n"), F.coalesce("html", F.lit(""))).alias("body"))
    seconds = text.phc_seconds(F.col("body"))
    clock = t.where(seconds.isNotNull()).select("page_id", F.lit("phc").alias("check"), F.format_string("%.3f", seconds).alias("level"))
    wifi = status.wifi_rows(t, "body", keys=["page_id"]).select("page_id", F.lit("wifi").alias("check"), F.concat_ws("@", "name", "device").alias("level"))
    return status.probe(t, "body", keys=["page_id"]).unionByName(clock).unionByName(wifi)


@query("""WITH a AS (SELECT event_id, CAST(event_id % 35 AS INTEGER) AS s, event_type, value FROM events)
SELECT event_id, s AS seconds, CASE WHEN greatest(1, s) < 10 THEN greatest(1, s) || ',10' ELSE CAST(greatest(1, s) AS VARCHAR) END AS attempts, CASE event_type WHEN 'view' THEN 'gptp' WHEN 'click' THEN 'default' END AS flip,
  CASE WHEN value < 20 THEN true WHEN value < 40 THEN true WHEN value < 60 THEN true ELSE false END AS truthy FROM a""")
def weights_and_attempts(spark: SparkSession, sf: str) -> DataFrame:
    v = F.col("value")
    profile = F.when(F.col("event_type") == "view", " Default").when(F.col("event_type") == "click", "GPTP ").when(F.col("event_type") == "error", "other")
    said = F.when(v < 20, "Yes").when(v < 40, " on ").when(v < 60, "1").when(v < 80, "no").otherwise("")
    t = table(spark, sf, "events").select("event_id", (F.col("event_id") % 35).cast("int").alias("seconds"), profile.alias("profile"), said.alias("flag"))
    return t.select("event_id", "seconds", F.concat_ws(",", text.attempts(F.col("seconds")).cast("array<string>")).alias("attempts"), text.other_profile(F.col("profile")).alias("flip"), text.truthy(F.col("flag")).alias("truthy"))


def _utm_sql() -> str:
    n, a = geometry._N, geometry._ALPHA
    import math

    e = 2 * math.sqrt(n) / (1 + n)
    north = " + ".join(["xi", *[f"{a[j]!r} * sin({2 * (j + 1)} * xi) * cosh({2 * (j + 1)} * eta)" for j in range(3)]])
    east = " + ".join(["eta", *[f"{a[j]!r} * cos({2 * (j + 1)} * xi) * sinh({2 * (j + 1)} * eta)" for j in range(3)]])
    k = 0.9996 * geometry._RADIUS
    return f"""WITH c AS (SELECT c_custkey, radians(CAST(c_custkey % 160 AS DOUBLE) - 80 + 0.3) AS phi, radians(-102.0 + CAST(c_custkey % 60 AS DOUBLE) / 10) - radians(-99.0) AS lam FROM customer),
t AS (SELECT *, sinh(atanh(sin(phi)) - {e!r} * atanh({e!r} * sin(phi))) AS t FROM c), x AS (SELECT *, atan2(t, cos(lam)) AS xi, atanh(sin(lam) / sqrt(1 + t * t)) AS eta FROM t)
SELECT c_custkey, round(500000.0 + {k!r} * ({east}), 3) + 0.0 AS easting, round({k!r} * ({north}), 3) + 0.0 AS northing FROM x"""


@query(_utm_sql())
def utm_project(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    lat, lon = (k % 160).cast("double") - 80 + 0.3, F.lit(-102.0) + (k % 60).cast("double") / 10
    e, n = geometry.to_utm(lon, lat, 32614)
    return table(spark, sf, "customer").select("c_custkey", r(e, 3).alias("easting"), r(n, 3).alias("northing"))


@query("""SELECT o_orderkey, o_orderstatus, part FROM (SELECT o_orderkey, o_orderstatus, 'F' AS part FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_orderkey, o_orderstatus, 'O' FROM orders WHERE o_orderstatus = 'O' UNION ALL SELECT o_orderkey, o_orderstatus, 'P' FROM orders WHERE o_orderstatus = 'P')""")
def union_inputs(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    f, op, p = (o.where(F.col("o_orderstatus") == s).withColumn("part", F.lit(s)) for s in "FOP")
    return f.unionByName(op).unionByName(p).orderBy("o_orderkey")


@query(f"""WITH {EVENTS}, d AS (SELECT ord, t_ns, CASE WHEN ord % 31 = 0 THEN CAST('nan' AS DOUBLE) WHEN ord % 37 = 0 THEN CAST('-inf' AS DOUBLE) WHEN ord % 41 = 0 THEN NULL ELSE easting END AS x, CAST(ord % 6 AS INTEGER) AS quality FROM track)
SELECT ord, x, quality FROM d WHERE x IS NOT NULL AND isfinite(x) AND quality > 0 AND t_ns > 0""")
def finite_and_quality(spark: SparkSession, sf: str) -> DataFrame:
    o = F.col("ord")
    x = F.when(o % 31 == 0, float("nan")).when(o % 37 == 0, float("-inf")).when(o % 41 == 0, None).otherwise(F.col("easting"))
    d = events(spark, sf).select("ord", "t_ns", x.alias("x"), (o % 6).cast("int").alias("quality"))
    return d.where(finite("x") & (F.col("quality") > 0) & (F.col("t_ns") > 0)).select("ord", "x", "quality")


@query(f"""WITH {EVENTS}, g AS (SELECT session_id, min(t_ns) AS started, min(t_ns) FILTER (event_type = 'error') AS o FROM track GROUP BY 1)
SELECT session_id, started, CASE WHEN o - started <= 86400000000000 THEN o ELSE -1 END AS opened, coalesce(o - started <= 86400000000000, false) AS passed FROM g""")
def readiness_gate(spark: SparkSession, sf: str) -> DataFrame:
    polls = events(spark, sf).withColumn("ready", F.col("event_type") == "error")
    return status.gate(polls, keys=["session_id"], time="t_ns", ready="ready", timeout_ns=86_400_000_000_000).withColumn("opened", F.coalesce("opened", F.lit(-1).cast("long")))


@query("""WITH f AS (SELECT event_id, event_id % 2 = 0 AS g, event_id % 3 <> 0 AS p, event_id % 5 <> 0 AS s, event_id % 7 <> 0 AS c, event_id % 11 <> 0 AS b, event_id % 13 <> 0 AS a FROM events),
st AS (SELECT *, CASE WHEN g AND p AND s AND a THEN 1 WHEN NOT g THEN 2 WHEN NOT s THEN 3 WHEN NOT a THEN 4 WHEN NOT (c AND b AND p AND s) THEN 5 ELSE 6 END AS state, CASE WHEN event_id % 17 = 0 THEN NULL WHEN a THEN 'aligned' ELSE 'off by ' || event_id END AS phc FROM f)
SELECT event_id, g AS gps_time_ready, 'clock ' || event_id AS gps_time_summary, p AND s AND a AS pi_time_broadcast_ready, coalesce(phc, 'Pi time broadcast status unavailable.') AS pi_time_broadcast_summary,
  c AND b AND p AND s AS background_services_ready, (CAST(c AS INTEGER) + CAST(b AS INTEGER) + CAST(p AS INTEGER) + CAST(s AS INTEGER)) || '/4 timing services running.' AS background_services_summary,
  CASE state WHEN 1 THEN 'Timing stack looks ready for PTP capture.' WHEN 2 THEN 'clock ' || event_id WHEN 3 THEN 'Pi time broadcast is not running yet.' WHEN 4 THEN coalesce(phc, 'Pi time broadcast is not aligned yet.')
    WHEN 5 THEN 'One or more background timing services are not running.' ELSE 'Timing stack is partially ready.' END AS summary,
  CASE state WHEN 1 THEN 'You can start a PTP capture session.' WHEN 2 THEN 'Move outside for sky view and wait for GPS time to lock before starting capture.' WHEN 3 THEN 'Use the Fix Time Broadcast button once GPS time is ready.'
    WHEN 4 THEN 'Use the Fix Time Broadcast button to restart the broadcast after GPS time is ready.' WHEN 5 THEN 'Check the service details below and restart the missing service.' ELSE 'Refresh timing status after a few seconds.' END AS recommended_action,
  g AS restart_phc2sys_allowed, CASE WHEN g THEN 'GPS time is ready, so the Pi time broadcast can be restarted safely.' ELSE 'Wait for GPS/PPS lock before restarting the Pi time broadcast.' END AS restart_phc2sys_reason FROM st""")
def status_roll_up(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("event_id")
    flags = {"gps_ready": i % 2 == 0, "ptp4l": i % 3 != 0, "phc2sys": i % 5 != 0, "chrony": i % 7 != 0, "bridge": i % 11 != 0, "phc_ready": i % 13 != 0}
    phc = F.when(i % 17 == 0, None).when(F.col("phc_ready"), "aligned").otherwise(F.concat(F.lit("off by "), i.cast("string")))
    rows = table(spark, sf, "events").select("event_id").withColumns(flags).withColumns({"gps_time_summary": F.concat(F.lit("clock "), i.cast("string")), "phc_summary": phc})
    return status.roll_up(rows).drop(*flags, "phc_summary", "state")


@query("""WITH f AS (SELECT event_id, event_id % 2 = 0 AS c1, event_id % 3 <> 0 AS c2, CASE WHEN event_id % 31 = 0 THEN NULL ELSE true END AS c3, event_id % 5 <> 0 AS c4, event_id % 7 <> 0 AS c5, event_id % 11 <> 0 AS c6, value <= 90 AS c7 FROM events)
SELECT event_id, c1 AND c2 AND coalesce(c3, false) AND c4 AND c5 AND c6 AND c7 AS passed,
  concat_ws(',', CASE WHEN NOT c1 THEN 'phc_ready' END, CASE WHEN NOT c2 THEN 'locked_before' END, CASE WHEN c3 IS NULL THEN 'locked_after' END, CASE WHEN NOT c4 THEN 'aligned_before' END, CASE WHEN NOT c5 THEN 'aligned_after' END,
    CASE WHEN NOT c6 THEN 'file_ready' END, CASE WHEN NOT c7 THEN 'window_ready' END) AS failed FROM f""")
def capture_verdict(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("event_id")
    flags = {"phc_ready": i % 2 == 0, "locked_before": i % 3 != 0, "locked_after": F.when(i % 31 != 0, True), "aligned_before": i % 5 != 0, "aligned_after": i % 7 != 0, "file_ready": i % 11 != 0, "window_ready": F.col("value") <= 90}
    return status.capture_verdict(table(spark, sf, "events").withColumns(flags)).select("event_id", "passed", F.concat_ws(",", "failed").alias("failed"))


@query("""WITH t AS (SELECT page_id, repeat('source 0 - assert 1.0, sequence: 1' || chr(10), CAST(page_id % 5 AS INTEGER)) || 'done' AS body FROM pages)
SELECT page_id, CAST(page_id % 5 AS INTEGER) AS asserts, page_id % 5 >= 2 AS pulsing FROM t""")
def pulse_count(spark: SparkSession, sf: str) -> DataFrame:
    line = F.lit("source 0 - assert 1.0, sequence: 1\n")
    body = F.concat(F.repeat(line, (F.col("page_id") % 5).cast("int")), F.lit("done"))
    return status.pulse_count(table(spark, sf, "pages").select("page_id", body.alias("body")), "body").drop("body")
