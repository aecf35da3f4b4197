"""Cleaning, time choice, joins and folds against literal vectors and numpy."""

import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackloom.config import JobConfig, parse_weights
from trackloom.operators import asof, geometry, metrics, scan, timealign, track
from trackloom.plans import jobs
from trackloom.schema import finite, require_columns

NAN, INF = float("nan"), float("inf")


def fixes(spark, rows):
    return spark.createDataFrame([(0, i, *r) for i, r in enumerate(rows)], "session_id int, ord long, gps_epoch_ns long, pi_time_ns long, easting double, northing double, altitude_m double")


def test_clean_drops_unfinite_and_keeps_first_of_equal_times(spark):
    df = fixes(spark, [(300, 30, 630000.0, 3900000.0, 120.0), (100, 10, 629999.0, 3899999.0, NAN), (300, 31, 630100.0, 3900100.0, 121.0), (200, 20, 630010.0, 3900010.0, INF), (250, 25, 630020.0, 3900020.0, 122.5)])
    assert timealign.pick_time_column(df) == "gps_epoch_ns"
    got = jobs.prepare_track(df, JobConfig(gps_outlier_filter=False)).orderBy("t_ns").collect()
    assert [(r.t_ns, r.altitude_m) for r in got] == [(250, 122.5), (300, 120.0)]


def test_preferred_time_column_and_errors(spark):
    df = fixes(spark, [(300, 30, 0.0, 0.0, 0.0), (400, 40, 0.0, 0.0, 0.0)])
    assert timealign.pick_time_column(df, preferred=["pi_time_ns", "gps_epoch_ns"]) == "pi_time_ns"
    assert timealign.pick_time_column(df.withColumn("gps_epoch_ns", F.when(F.col("ord") == 0, 1))) == "pi_time_ns"
    with pytest.raises(ValueError, match="lacks required columns: x"):
        timealign.pick_time_column(df, "x")
    with pytest.raises(ValueError, match="Need at least 2 finite GPS rows"):
        jobs.prepare_track(fixes(spark, [(1, 1, 0.0, 0.0, NAN), (2, 2, 0.0, 0.0, 1.0)]), JobConfig())
    assert timealign.preferred_time_column("gps_pps_to_pi__chrony_to_pi_clock__ptp_to_sensor") == "pi_time_ns"
    assert timealign.preferred_time_column(None) is None


def test_speed_outlier(spark):
    t0 = 1773758460000000000
    df = spark.createDataFrame([(0, i, t0 + i * 10**9, float(e), 0.0) for i, e in enumerate([0, 2, 4, 400, 6])], "session_id int, ord long, t_ns long, easting double, northing double")
    judged = track.speed_verdict(df, max_speed_mps=20.0)
    assert [r.easting for r in judged.where("verdict = 'kept'").orderBy("ord").collect()] == [0, 2, 4, 6]
    assert track.speed_stats(judged).first().asDict() == {"input": 5, "kept": 4, "dropped": 1, "dropped_speed": 1, "dropped_time": 0}
    # Exactly the limit is kept, no time step is not, and a bad first fix rejects what follows.
    speed = lambda t, x: track._speed_run([t, x, [0.0] * len(t)], None, 20.0)[0]
    assert speed([0, 10**9, 10**9, 2 * 10**9], [0.0, 20.0, 20.0, 40.0]) == ["kept", "kept", "time", "kept"]
    assert speed([0, 10**9, 2 * 10**9], [900.0, 0.0, 1.0]) == ["kept", "speed", "speed"]
    assert speed([], []) == []
    with pytest.raises(ValueError):
        track.speed_verdict(df, max_speed_mps=0)


def test_thinning_adds_up_between_neighbours():
    assert track._thin_run([[0.0, 3.0, 0.0, 3.0, 30.0], [0.0] * 5], None, 9.0)[0] == [True, False, False, True, True]


def series(spark, ts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(ts)], "ord long, t_ns long")


def test_time_modes(spark):
    q, g = series(spark, [1000, 1050, 1100]), series(spark, [1020, 1070, 1120])
    m = timealign.choose_time_mode(q, g, "relative_start").first()
    assert (m.mode, m.query_origin, m.ref_origin) == ("relative_start", 1000, 1020)
    q, g = series(spark, [1773758296 * 10**9, 1773758297 * 10**9]), series(spark, [1773758295500000000, 1773758298 * 10**9])
    assert timealign.choose_time_mode(q, g).first().mode == "unix_ns"
    assert timealign.choose_time_mode(q, series(spark, [5, 10])).first().mode == "relative_start"
    far = series(spark, [1873758296 * 10**9, 1873758297 * 10**9])
    assert timealign.choose_time_mode(q, far).first().mode == "relative_start"
    first = timealign.choose_time_mode(series(spark, [30, 10, 20]), series(spark, [5, 1]), "relative_start").first()
    assert (first.query_origin, first.ref_origin) == (30, 5)  # the first in order, not the smallest
    with pytest.raises(ValueError):
        timealign.choose_time_mode(q, g, "other")


def test_trim(spark):
    q, ref = series(spark, [5, 10, 20, 30, 35]), series(spark, [10, 30])
    assert [r.in_range for r in timealign.in_range(q, ref).orderBy("t_ns").collect()] == [False, True, True, True, False]
    assert [r.t_ns for r in timealign.trim(q, ref, min_points=2).orderBy("t_ns").collect()] == [10, 20, 30]
    with pytest.raises(ValueError, match="only 1 samples remain"):
        timealign.trim(series(spark, [5, 10, 35]), ref, min_points=2)
    assert timealign.trim(q, ref.limit(0)).count() == 0


@pytest.mark.parametrize("keyed", [False, True])
def test_interpolation_matches_numpy(spark, keyed):
    rng = np.random.default_rng(1)
    base = 1773758460000000000
    t = np.sort(rng.choice(10**12, 300, replace=False)) + base
    e, n = rng.normal(size=300) * 100, rng.normal(size=300) * 100
    q = np.concatenate([rng.integers(t[0] - 10**10, t[-1] + 10**10, 2000), t[:5], t[-1:]])
    ref = spark.createDataFrame([(1, int(a), float(b), float(c)) for a, b, c in zip(t, e, n, strict=True)], "k int, t_ns long, e double, n double")
    query = spark.createDataFrame([(1, int(x), i) for i, x in enumerate(q)], "k int, t_ns long, i int")
    got = {r.i: (r.e, r.n) for r in asof.interpolate(query, ref, ["e", "n"], keys=["k"] if keyed else ()).collect()}
    inside = (q >= t[0]) & (q <= t[-1])
    assert set(got) == set(np.flatnonzero(inside).tolist())
    for i in np.flatnonzero(inside).tolist():
        want = [np.interp(float(q[i] - base), (t - base).astype(float), v) for v in (e, n)]
        assert got[i] == pytest.approx(want, abs=1e-4)
    assert all(got[len(q) - 1 - k] == pytest.approx((e[j], n[j]), abs=0) for k, j in ((0, 299), (1, 4)))


def test_interpolation_in_parts_equals_broadcast(spark):
    rng = np.random.default_rng(2)
    t = np.sort(rng.choice(10**6, 9000, replace=False))
    ref = spark.createDataFrame([(int(a), float(b)) for a, b in zip(t, rng.normal(size=len(t)), strict=True)], "t_ns long, e double")
    query = spark.createDataFrame([(int(x),) for x in rng.integers(0, 10**6, 3000)], "t_ns long")
    a = asof.interpolate(query, ref, ["e"]).collect()
    b = asof._interpolate_in_parts(query, ref, ["e"], "t_ns", int(t[0]), 50_000).collect()
    assert sorted((r.t_ns, r.e) for r in a) == sorted((r.t_ns, r.e) for r in b)


def test_interpolation_edges(spark):
    one = spark.createDataFrame([(10, 5.0)], "t_ns long, e double")
    q = series(spark, [9, 10, 11])
    assert [r.e for r in asof.interpolate(q, one, ["e"]).collect()] == [5.0]
    assert asof.interpolate(q, one.limit(0), ["e"]).count() == 0
    assert asof.interpolate(q.limit(0), one, ["e"]).count() == 0


def test_nearest_literal(spark):
    ref = spark.createDataFrame([(0, 1000000000, 0), (0, 1000100000, 1)], "k int, t_ns long, pose_ord long")
    q = spark.createDataFrame([(0, 1000000000, 0), (0, 1000050000, 1), (0, 1300000000, 2)], "k int, t_ns long, ord long")
    m = asof.nearest(q, ref, keys=["k"])
    assert [(r.pose_ord, r.delta_ns, r.inlier) for r in m.orderBy("ord").collect()] == [(0, 0, True), (0, 50000, True), (1, 299900000, False)]
    s = asof.lookup_stats(m, keys=["k"]).first()
    assert (s.columns, s.valid, s.inlier, s.dropped, s.exact, s.nearest, s.max_delta_ns) == (3, 3, 2, 1, 1, 2, 299900000)


def test_nearest_matches_numpy(spark):
    rng = np.random.default_rng(4)
    t = np.unique(rng.integers(1, 10**6, 200)) * 2
    q = np.concatenate([rng.integers(1, 2 * 10**6 + 5000, 600), t[:5], (t[:-1] + t[1:])[:20] // 2, [0, -5, 0]])
    ref = spark.createDataFrame([(0, int(x), i) for i, x in enumerate(t)], "k int, t_ns long, pose_ord long")
    query = spark.createDataFrame([(0, int(x), i) for i, x in enumerate(q)], "k int, t_ns long, ord long")
    got = asof.nearest(query, ref, keys=["k"], tolerance=3000).orderBy("ord").collect()
    right = np.clip(np.searchsorted(t, q), 0, len(t) - 1)
    left = np.clip(right - 1, 0, len(t) - 1)
    pick = np.where(np.abs(t[right] - q) < np.abs(q - t[left]), right, left)
    for r in got:
        i = r.ord
        if q[i] <= 0:
            assert (r.pose_ord, r.delta_ns, r.inlier) == (pick[0], 0, False)
        else:
            assert (r.pose_ord, r.delta_ns, r.inlier) == (pick[i], abs(t[pick[i]] - q[i]), abs(t[pick[i]] - q[i]) <= 3000)
    none = asof.nearest(query.where("t_ns <= 0"), ref, keys=["k"]).collect()
    assert {r.pose_ord for r in none} == {0}


def heading_by_numpy(x, y, fallback):
    if len(x) < 2:
        return np.full(len(x), fallback)
    dx, dy = np.gradient(x), np.gradient(y)
    h = np.where(np.hypot(dx, dy) > 1e-9, np.arctan2(dy, dx), np.nan)
    ok = np.flatnonzero(~np.isnan(h))
    if not len(ok):
        return np.full(len(x), fallback)
    at = np.maximum.accumulate(np.where(np.isnan(h), -1, np.arange(len(h))))
    return h[np.where(at < 0, ok[0], at)]


@pytest.mark.parametrize("x", [[], [1.0], [1.0, 1.0, 1.0], [0.0, 0.0, 0.0, 1.0, 2.0, 2.0, 2.0, 2.0, 1.0], [0.0, 1.0]])
def test_heading(spark, x):
    y = [v * 0.5 for v in x]
    df = spark.createDataFrame([(0, i, a, b) for i, (a, b) in enumerate(zip(x, y, strict=True))], "k int, ord long, easting double, northing double")
    got = [r.heading_rad for r in track.heading(df, keys=["k"], order=["ord"], fallback_rad=0.7).orderBy("ord").collect()]
    assert got == pytest.approx(heading_by_numpy(np.array(x), np.array(y), 0.7).tolist())
    length = track.path_length(df, keys=["k"], order=["ord"]).first()
    if x:
        assert length.path_length_m == pytest.approx(float(np.hypot(np.diff(x), np.diff(y)).sum()))


@pytest.mark.parametrize("kind", ["clean", "noisy", "mirrored"])
def test_rigid_fit_against_svd(spark, kind):
    rng = np.random.default_rng(len(kind))
    src = rng.normal(size=(50, 2)) * 30 + 600000
    a = 1.1
    rot = np.array([[math.cos(a), -math.sin(a)], [math.sin(a), math.cos(a)]])
    dst = (src - 600000) @ rot.T + [5, -7]
    dst = dst * [1, -1] if kind == "mirrored" else dst + rng.normal(size=dst.shape) * (20 if kind == "noisy" else 0)
    u, _, vt = np.linalg.svd((src - src.mean(0)).T @ (dst - dst.mean(0)))
    fix = np.diag([1, np.sign(np.linalg.det(vt.T @ u.T))])
    want = vt.T @ fix @ u.T
    df = spark.createDataFrame([tuple(map(float, (*s, *d))) for s, d in zip(src, dst, strict=True)], "sx double, sy double, dx double, dy double")
    fit = geometry.rigid_fit(df, src=("sx", "sy"), dst=("dx", "dy"), min_motion_m=1.0).first()
    assert (math.cos(fit.theta_rad), math.sin(fit.theta_rad)) == pytest.approx((want[0, 0], want[1, 0]), abs=1e-9)
    still = geometry.rigid_fit(df, src=("sx", "sy"), dst=("dx", "dy"), min_motion_m=1e6).first()
    assert (still.method, still.theta_rad) == ("translation_only_low_motion", 0.0)
    assert (still.tx, still.ty) == pytest.approx(tuple(dst.mean(0) - src.mean(0)))
    with pytest.raises(ValueError):
        geometry.require_samples(geometry.rigid_fit(df.limit(1), src=("sx", "sy"), dst=("dx", "dy"), min_motion_m=1.0))


def test_metrics(spark):
    rng = np.random.default_rng(9)
    ref, est = rng.normal(size=(40, 2)), rng.normal(size=(40, 2))
    df = spark.createDataFrame([(0, i, *map(float, (*a, *b))) for i, (a, b) in enumerate(zip(ref, est, strict=True))], "k int, ord long, rx double, ry double, ex double, ey double")
    m = metrics.alignment(df, ref=("rx", "ry"), est=("ex", "ey"), keys=["k"], order=["ord"]).first()
    d = np.linalg.norm(est - ref, axis=1)
    assert (m.xy_median_m, m.xy_p95_m, m.xy_rmse_m) == pytest.approx((np.median(d), np.percentile(d, 95), np.sqrt((d**2).mean())))
    assert m.reference_path_length_m == pytest.approx(np.linalg.norm(np.diff(ref, axis=0), axis=1).sum())
    flags = spark.createDataFrame([(5.0, 10.0), (5.1, 1.0), (None, 1.0)], "xy_median_m double, xy_p95_m double").select(metrics.passes().alias("p"))
    assert [r.p for r in flags.collect()] == [True, False, False]


def test_utm_landmark(spark):
    e, n = geometry.to_utm(F.lit(-79.387139), F.lit(43.642567), 32617)
    row = spark.range(1).select(e.alias("e"), n.alias("n")).first()
    assert (row.e, row.n) == pytest.approx((630084, 4833438), abs=1)  # printed in whole metres
    with pytest.raises(ValueError):
        geometry.utm_zone(4326)


def test_finite_and_columns(spark):
    df = spark.createDataFrame([(1.0,), (NAN,), (INF,), (-INF,), (None,)], "x double")
    assert df.where(finite("x")).count() == 1
    with pytest.raises(ValueError, match="y, z"):
        require_columns(df, ["x", "y", "z"])


def test_gates_and_voxels(spark):
    df = spark.createDataFrame([(0.2, 0.2, 0.2, 0.5, None), (0.4, 0.4, 0.4, 2.0, 3.0), (-0.1, 0.2, 0.2, 200.0, 9.0)], "x double, y double, z double, range_m double, reflectivity double")
    assert scan.range_gate(df, F.col("range_m"), 1.0, 150.0).count() == 1
    assert scan.range_gate(df, F.col("range_m")).count() == 3
    assert scan.reflectivity_gate(df, 5.0).count() == 2
    assert scan.reflectivity_gate(df.drop("reflectivity"), 5.0).count() == 3
    v = {(r.vx, r.vy, r.vz): (r.points, round(r.x, 6)) for r in scan.voxel_downsample(df, 0.5).collect()}
    assert v == {(0, 0, 0): (2, 0.3), (-1, 0, 0): (1, -0.1)}


def test_config():
    assert JobConfig.of({"mode": "slam_gps_anchor", "anchor_backend": "rigid_fit"}).anchor_z_mode == "offset"
    for bad in ({"nope": 1}, {"mode": "x"}, {"gps_outlier_max_speed_mps": 0}, {"anchor_z_mode": "x"}, {"map_voxel_size": 0}, {"min_range": 5, "max_range": 1}):
        with pytest.raises(ValueError):
            JobConfig.of(bad)
    assert parse_weights("0.01, 0.01,0.001") == (0.01, 0.01, 0.001)
    for bad in ("1,2", "1,2,-3"):
        with pytest.raises(ValueError):
            parse_weights(bad)


def gps(spark):
    rows = [(1773758460000000000 + i * 10**9, 600000.0 + i, 4000000.0 + 2 * i, 100.0 + i, i) for i in range(11)]
    return spark.createDataFrame(rows, "t_ns long, easting double, northing double, altitude_m double, ord long")


@pytest.mark.parametrize("scope", ["first_scan", "file", "trajectory"])
def test_fusion(spark, scope):
    t0 = 1773758460000000000
    pts = spark.createDataFrame([("a", i, t0 + i * 500_000_000, 1.0, 0.0, 0.5) for i in range(25)], "file string, ord long, t_ns long, x double, y double, z double")
    pts = pts.withColumn("scan_idx", F.lit(0))
    out = jobs.gps_fusion(pts, gps(spark), JobConfig(orientation="path_tangent", heading_order="time", sensor_offset_z=1.0, time_mode_scope=scope)).orderBy("timestamp_ns").collect()
    assert len(out) == 21  # the rest lies past the track's end
    h = math.atan2(2, 1)
    for i, r in enumerate(out):
        assert (r.x_global, r.y_global, r.z_global) == pytest.approx((600000 + i / 2 + math.cos(h), 4000000 + i + math.sin(h), 100 + i / 2 + 1.5), abs=1e-4)


def test_anchor_and_constraints(spark):
    g = gps(spark)
    a = 0.4
    traj = g.select(F.lit("s").alias("session_id"), "t_ns", "ord", *[e.alias(n) for e, n in zip(geometry.rotate(F.col("easting") - 600000, F.col("northing") - 4000000, F.lit(-a)), ("tx", "ty"), strict=True)], (F.col("altitude_m") - 90).alias("tz"))
    fit, m = jobs.anchor_rigid(traj, g, JobConfig())
    row = fit.first()
    assert (row.theta_rad, row.z_offset) == pytest.approx((a, 90.0))
    assert m.first().xy_max_m == pytest.approx(0, abs=1e-6)
    c = jobs.constraints(traj, g, JobConfig(constraint_every_m=5.0, anchor_z_mode="none"))
    assert [(r.z, r.wz) for r in c.collect()] == [(0.0, 0.0)] * 4


def test_replay(spark):
    ident = [1.0, 0, 0, 5, 0, 1.0, 0, 6, 0, 0, 1.0, 7, 0, 0, 0, 1.0]
    pts = spark.createDataFrame([("a", 0, r, c, r * 2 + c, 1000 + c, float(r), float(c), 0.0, 2000, 5.0) for r in range(2) for c in range(2)], "file string, scan_idx int, row int, col int, ord long, t_ns long, x double, y double, z double, range_mm long, reflectivity double")
    poses = spark.createDataFrame([("a", 1000, [float(v) for v in ident])], "file string, t_ns long, m array<double>")
    got = sorted((r.x, r.y, r.z) for r in jobs.replay_map(pts, poses, JobConfig()).collect())
    assert got == [(5.0, 6.0, 7.0), (5.0, 7.0, 7.0), (6.0, 6.0, 7.0), (6.0, 7.0, 7.0)]


def test_one_long_key_stays_linear(spark):
    """A million rows under one key: frames that only grow, not one scan for each row."""
    n = 500_000
    rows = spark.range(n).select(F.lit(0).alias("k"), (F.col("id") * 1000 + 500).alias("t_ns"), F.col("id").alias("ord"))
    ref = spark.range(n).select(F.lit(0).alias("k"), (F.col("id") * 1000 + 1).alias("t_ns"), F.col("id").alias("pose_ord"), F.col("id").cast("double").alias("v"))
    start = time.perf_counter()
    got = asof.interpolate_partitioned(rows, ref, ["v"], keys=["k"]).agg(F.count("*").alias("n"), F.max(F.abs(F.col("v") - (F.col("t_ns") - 1) / 1000)).alias("off")).first()
    assert got.n == n - 1 and got.off < 1e-6
    near = asof.nearest(rows, ref, keys=["k"]).agg(F.count("*").alias("n"), F.count_if(F.col("pose_ord") == F.col("ord")).alias("same")).first()
    assert near.n == near.same == n
    flat = rows.select("k", "ord", F.lit(0.0).alias("easting"), F.when(F.col("ord") > n - 3, 5.0).otherwise(0.0).alias("northing"))
    assert track.heading(flat, keys=["k"], order=["ord"]).where("heading_rad > 1.5").count() == n
    assert time.perf_counter() - start < 60


def test_references_of_one_time(spark):
    ref = spark.createDataFrame([(0, 100, 3), (0, 100, 1), (0, 200, 7), (0, 200, 5)], "k int, t_ns long, pose_ord long")
    q = spark.createDataFrame([(0, 100, 0), (0, 150, 1), (0, 190, 2), (0, 300, 3)], "k int, t_ns long, ord long")
    assert [r.pose_ord for r in asof.nearest(q, ref, keys=["k"]).orderBy("ord").collect()] == [1, 3, 5, 7]


def test_anchor_of_two_sessions(spark):
    g = [(s, i, i * 10**9, 100.0 * s + i, 50.0 * s, 7.0 + s) for s in (1, 2) for i in range(5)]
    gps = spark.createDataFrame(g, "session_id int, ord long, t_ns long, easting double, northing double, altitude_m double")
    traj = spark.createDataFrame([(s, i, i * 10**9, float(i), 0.0, 1.0) for s in (1, 2) for i in range(5)], "session_id int, ord long, t_ns long, tx double, ty double, tz double")
    fit, _ = jobs.anchor_rigid(traj, gps, JobConfig())
    moved = jobs.apply_anchor(traj, fit).orderBy("session_id", "ord").collect()
    assert [(round(r.tx, 6), round(r.ty, 6), round(r.tz, 6)) for r in moved] == [(x, y, z) for _, _, _, x, y, z in g]
    laid = jobs.constraints(traj, gps, JobConfig(constraint_every_m=2.0))
    assert laid.where("session_id = 2 and y <> 100.0").count() == 0 and laid.where("session_id = 1").count() > 1


def test_interpolation_does_not_depend_on_size_with_clashing_knots(spark, monkeypatch):
    rng = np.random.default_rng(4)
    times = np.sort(rng.integers(0, 400, 300)) * 7
    ref = spark.createDataFrame([(int(t), float(v)) for t, v in zip(times, rng.normal(size=300), strict=True)] + [(None, 1.0)], "t_ns long, v double").repartition(5)
    query = spark.createDataFrame([(i, i) for i in range(-5, 2900)], "q long, t_ns long")
    low, high = {}, {}
    for t, v in sorted((r.t_ns, r.v) for r in ref.where("t_ns is not null").collect()):
        low.setdefault(t, v)
        high[t] = v
    want, knots = {}, sorted(high)
    for q in range(-5, 2900):
        before = [t for t in knots if t <= q]
        after = [t for t in knots if t >= q]
        if before and after:
            a, b = before[-1], after[0]
            want[q] = high[a] if a == q else high[a] + (low[b] - high[a]) * ((q - a) / (b - a))
    for part, most in ((4096, asof.BROADCAST_BYTES), (16, asof.BROADCAST_BYTES), (16, 0), (4096, 0)):
        monkeypatch.setattr(asof, "PART", part)
        monkeypatch.setattr(asof, "BROADCAST_BYTES", most)
        out = asof.interpolate(query, ref, ["v"])
        got = out.collect()
        assert len(got) == len(want)
        assert all(abs(r.v - want[r.q]) < 1e-12 for r in got)
        windows = [w for w in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window" in w]
        assert all("[_part" in w.split("],")[-2] + w for w in windows)
    keyed = asof.interpolate(query.withColumn("k", F.lit(1)), ref.withColumn("k", F.lit(1)), ["v"], keys=["k"]).collect()
    assert {r.q: r.v for r in keyed} == {r.q: r.v for r in got}
