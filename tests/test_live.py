"""Gates with timers, live readers and writers, counters, folds in parts, exact quantiles and cancelled jobs."""

import glob
import json
import math
import os
import random
import struct
import threading
import time

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_io import drain, stream

from trackloom import sinks
from trackloom.operators import folds, gates, nested, quantiles, running, timealign, track
from trackloom.plans.cancel import Cancellation, Cancelled
from trackloom.streaming import counters, sources, tangent
from trackloom.streaming.gates import ROCKS_DB, watch_gates

S = 10**9
POLLS = "session_id long, t_ns long, gate string, ready boolean"


@pytest.fixture
def timers(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    had = spark.conf.get(key, None)
    spark.conf.set(key, ROCKS_DB)
    yield spark
    spark.conf.unset(key) if had is None else spark.conf.set(key, had)


def test_each_gate_times_out_in_turn(timers, tmp_path):
    spark, chain = timers, gates.capture_gates(timeout_s=10)
    batches = []
    for n in range(6):  # session n passes n gates; 5 is ready
        batches.append([(n, (1 + k) * S, s, k < n) for k, s in enumerate(gates.STAGES)])
    rows = [[r for b in batches for r in b if r[1] == t * S] for t in range(1, 6)]
    rows += [[(99, 40 * S, "none", False)], [(99, 41 * S, "none", False)], [(99, 42 * S, "none", False)]]
    live = drain(watch_gates(stream(spark, tmp_path, rows, POLLS), chain), "gates")
    ends = {r.session_id: (r.event, r.stage, r.t_ns) for r in live.where("event in ('ready', 'aborted')").collect()}
    want = {n: ("aborted", gates.STAGES[n], (n + 10) * S) for n in range(1, 5)} | {5: ("ready", None, 5 * S)}
    assert ends == want  # the first gate has no deadline, so sessions 0 and 99 wait on
    polls = spark.createDataFrame([r for b in rows for r in b], POLLS)
    batch = {r.session_id: r for r in gates.ordered_gates(polls, chain).collect()}
    assert {n: (r.state, r.failed_stage, r.ended) for n, r in batch.items() if n in want} == {n: (e, s, t) for n, (e, s, t) in want.items()}
    assert {batch[n].state for n in (0, 99)} == {"waiting"}
    opened = {(r.session_id, r.stage): r.t_ns for r in live.where("event = 'opened'").collect()}
    assert opened == {(n, s): batch[n][f"{s}_opened"] for n in range(1, 6) for s in gates.STAGES[:n]}


def test_deadline_of_the_clock_passes_without_polls(timers, tmp_path):
    rows = [[(1, 0, "a", False)], [(2, 0, "x", False)]]
    q = watch_gates(stream(timers, tmp_path, rows, POLLS), [gates.Gate("a", 300_000_000)], late=None).writeStream.format("memory").queryName("clock").outputMode("append").start()
    try:
        until = time.time() + 60
        while time.time() < until and timers.sql("select * from clock where event = 'aborted'").count() < 2:
            time.sleep(0.5)
    finally:
        q.stop()
    assert sorted((r.session_id, r.stage) for r in timers.table("clock").where("event = 'aborted'").collect()) == [(1, "a"), (2, "a")]


def test_gates_of_whole_sessions(spark):
    g = [gates.Gate("a"), gates.Gate("b", 10), gates.Gate("skip", 1, required=False), gates.Gate("c", 10)]
    rows = [(1, 0, "b", True), (1, 5, "a", True), (1, 15, "b", True), (1, 25, "c", True), (2, 0, "a", True), (2, 11, "b", True), (3, 0, "c", True), (None, 1, "a", True), (4, None, "a", True), (5, 0, "a", True), (5, 0, "b", True), (5, 0, "c", None)]
    out = {r.session_id: (r.state, r.failed_stage, r.ended, r.skip_opened) for r in gates.ordered_gates(spark.createDataFrame(rows, POLLS), g).collect()}
    assert out == {1: ("ready", None, 25, 15), 2: ("aborted", "b", 10, None), 3: ("waiting", None, None, None), 5: ("aborted", "c", 10, 0)}
    part = gates.ordered_gates(spark.createDataFrame(rows, POLLS), g, until=F.max("t_ns"))
    assert {r.session_id: r.state for r in part.collect()} == {1: "ready", 2: "aborted", 3: "waiting", 5: "waiting"}
    assert gates.ordered_gates(spark.createDataFrame([], POLLS), g).count() == 0
    fixes = spark.createDataFrame([(2, 5, 0), (2, 3, 1), (2, 99, 2)], "session_id long, t_ns long, ord long")
    m = gates.abort_manifests(gates.ordered_gates(spark.createDataFrame(rows, POLLS), g), g, fixes).orderBy("session_id").collect()
    assert [(r.capture_mode, r.gps_rows_written, r.gps_first_fix_time_ns, r.gps_latest_fix_time_ns, r.chunks, r.readiness.a.ready, r.readiness.b.ready) for r in m] == [("aborted_no_b", 2, 5, 3, [], True, False), ("aborted_no_c", 0, None, None, [], True, True)]


def put(path, **doc):
    sinks.write_json_atomic(str(path), {"latitude": 1.5, "longitude": 2.5, "pi_time_ns": 1000} | doc)


def run_to(df, where, folder, format_="parquet", **options):
    q = df.writeStream.format(format_).options(**options).option("checkpointLocation", str(folder)).start(str(where))
    try:
        q.processAllAvailable()
    finally:
        q.stop()


def test_latest_fix_survives_a_restart(spark, tmp_path):
    fix, journal, out, state = (tmp_path / n for n in ("fix.json", "journal", "out", "state"))
    sources.register(spark)
    read = lambda: spark.readStream.format("latest_fix").options(path=str(fix), journal=str(journal), since_ns="500").load()
    reader = sources._LatestFixReader(str(fix), str(journal), 500, 1, 0)
    at = reader.initialOffset()
    assert list(reader.read(at)[0]) == []  # no file yet
    fix.write_text("{half")
    assert list(reader.read(at)[0]) == []
    put(fix, sequence=1, pi_time_ns=499)
    assert list(reader.read(at)[0]) == []  # stale
    put(fix, sequence=2)
    run_to(read(), out, state)
    run_to(read(), out, state)  # the same fix after a restart is not a new one
    put(fix, sequence=3, latitude=float("nan"))
    run_to(read(), out, state)
    put(fix, sequence=4, gps_quality=2, hdop="x", altitude_m="high", gps_epoch_ns="7")
    run_to(read(), out, state)
    rows = spark.read.parquet(str(out)).orderBy("gps_quality").collect()
    assert [(r.pi_time_ns, r.gps_quality, r.gps_epoch_ns, math.isnan(r.altitude_m)) for r in rows] == [(1000, None, None, True), (1000, "2", 7, True)]
    # Seen, then stopped before the batch was planned or done: the journal gives the same rows again.
    other = sources._LatestFixReader(str(fix), str(tmp_path / "other"), 0, 1, 0)
    rows, end = other.read(other.initialOffset())
    rows = list(rows)
    put(fix, sequence=5)
    again = sources._LatestFixReader(str(fix), str(tmp_path / "other"), 0, 1, 0)
    assert repr(list(again.readBetweenOffsets(again.initialOffset(), end))) == repr(rows)
    more, later = again.read(again.initialOffset())
    assert repr(list(more)[: len(rows)]) == repr(rows) and later["n"] == 2
    again.commit(end)
    assert len(os.listdir(tmp_path / "other")) == 1
    # Without numbers the contents decide.
    put(fix, pi_time_ns=9)
    _, third = again.read(later)
    put(fix, pi_time_ns=10)
    assert again.read(third)[1] == third


def test_any_cut_of_a_log_gives_the_same_sentences(spark, tmp_path):
    rng = random.Random(3)
    log = b"noise $GPGGA,1*00\r\n\x00\xff$GPRMC,2\xc3\xa9*11\n\n$$GPX\n" + b"z" * 9000 + b"$late\n" + b"$" + b"q" * 9000 + b"$tail\n$open"
    whole = list(sources._frames(bytearray(), log, 4096, (256, 512)))
    slow, buffer = [], bytearray()
    for i in range(len(log)):
        slow += sources._frames(buffer, log[i : i + 1], 4096, (256, 512))
    assert whole == slow and "$GPGGA,1*00" in whole and "$GPRMC,2*11" in whole and whole[-1].endswith("$tail")
    cuts = sorted(rng.sample(range(1, len(log)), 12))
    parts = [(k, i, log[a:b]) for k in ("u", "v") for i, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(log)], strict=True))]
    batches = [parts[:5], parts[5:20], parts[20:]]
    live = drain(sources.sentences(stream(spark, tmp_path, batches, "dev string, ord long, data binary"), keys=["dev"]), "framed")
    for k in ("u", "v"):
        assert [r.value for r in live.where(F.col("dev") == k).orderBy("n").collect()] == whole
    # Recorded logs of text, in any cut.
    text = "noise $a,1\r\nx\n$b $c\n\n$d\r\n$open"
    for seed in range(3):
        at = sorted(random.Random(seed).sample(range(1, len(text)), 6))
        rows = [(k, i, text[a:b]) for k in ("u", None) for i, (a, b) in enumerate(zip([0, *at], [*at, len(text)], strict=True))] + [("w", 0, None), ("w", 1, "")]
        got = sources.sentences_of_log(spark.createDataFrame(rows, "dev string, ord long, data string"), keys=["dev"]).collect()
        assert sorted((str(r.dev), r.n, r.value) for r in got) == sorted((k, n, v) for k in ("u", "None") for n, v in ((0, "$a,1"), (2, "$b $c"), (4, "$d")))


def points(spark, n):
    return spark.range(n).select((F.col("id") * S).alias("timestamp_ns"), (600000 + F.col("id") / 8).alias("x_global"), (4000000 - F.col("id") / 4).alias("y_global"), (F.col("id") % 7).cast("double").alias("z_global"))


def las_points(path):
    raw = open(path, "rb").read()
    at, n = struct.unpack_from("<I", raw, 96)[0], struct.unpack_from("<Q", raw, 247)[0]
    assert raw[:4] == b"LASF" and len(raw) - at == 30 * n
    xs = [struct.unpack_from("<i", raw, at + 30 * i)[0] for i in range(n)]
    return xs, struct.unpack_from("<6d", raw, 179)


def test_las_is_one_file_a_partition_and_merges_by_offsets(spark, tmp_path):
    spark.dataSource.register(sinks.LasSink)
    out, rows = str(tmp_path / "las"), points(spark, 1000)
    write = lambda df, mode="append": df.write.format("las").option("offsets", "600000,4000000,0").mode(mode).save(out)
    write(rows.repartition(5).unionByName(rows.limit(0)))
    index = json.load(open(f"{out}/_las.json"))
    files = sorted(glob.glob(f"{out}/*.las"))
    assert len(files) == 5 and sum(f["n"] for f in index["files"]) == 1000
    assert sorted(x for f in files for x in las_points(f)[0]) == sorted(round(i / 8 * 1000) for i in range(1000))
    assert sinks.las.merge_las(spark, out, str(tmp_path / "one.las")) == 1000
    xs, bounds = las_points(str(tmp_path / "one.las"))
    assert sorted(xs) == sorted(round(i / 8 * 1000) for i in range(1000)) and bounds[:2] == (600000 + 999 / 8, 600000.0)
    with pytest.raises(Exception, match="finished las output"):
        write(rows)
    write(rows.limit(3), "overwrite")
    assert sum(len(las_points(f)[0]) for f in glob.glob(f"{out}/*.las")) == 3


def test_a_failed_las_write_leaves_nothing(spark, tmp_path):
    spark.dataSource.register(sinks.LasSink)
    out = str(tmp_path / "las")
    bad = points(spark, 400).repartition(4).withColumn("z_global", F.when(F.col("timestamp_ns") == 399 * S, F.raise_error(F.lit("lost"))).otherwise(F.col("z_global")))
    with pytest.raises(Exception, match="lost"):
        bad.write.format("las").mode("append").save(out)
    assert not os.path.exists(f"{out}/_las.json") and not glob.glob(f"{out}/*.las")
    with pytest.raises(Exception, match="lacks required columns: z_global"):
        points(spark, 3).drop("z_global").write.format("las").mode("append").save(out)
    assert sinks.write_las(points(spark, 0), str(tmp_path / "none.las"), offsets=(0, 0, 0)) == 0


FIXES = "pi_time_ns long, gps_quality string, latitude double"


def test_counted_fix_log(spark, tmp_path):
    counters.register(spark)
    out = str(tmp_path / "log")
    batches = [[(30, "1", 1.0), (10, None, 2.0)], [(50, "2", 3.0)], []]
    said = []
    status = counters.FixStatus(say=said.append, every_s=3600)
    spark.streams.addListener(status)
    try:
        run_to(counters.count_fixes(stream(spark, tmp_path, batches, FIXES)), out, tmp_path / "state", "fix_log")
        until = time.time() + 20
        while time.time() < until and not (status.rows == 3 and len(said) == 2):
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(status)
    assert (status.rows, status.first_ns, status.last_ns, status.latest["gps_quality"]) == (3, 10, 50, "2")
    assert len(said) == 2 and said[1].endswith("rows written: 3")  # one line for all triggers, one at the end
    assert counters.read_counters(out) == {"rows_written": 3, "first_fix_time_ns": 10, "latest_fix": {"pi_time_ns": 50, "gps_quality": "2", "latitude": 3.0}}
    got = spark.read.schema(FIXES).option("header", True).csv(f"{out}/fixes-*.csv")
    assert sorted((r.pi_time_ns, r.gps_quality) for r in got.collect()) == [(10, None), (30, "1"), (50, "2")]
    # A batch that was written, but not noted as done, is written again: once in the files, once in the counters.
    writer = counters._FixLogWriter(out, "pi_time_ns", ["pi_time_ns", "gps_quality", "latitude"])
    import pyarrow as pa

    batch = pa.RecordBatch.from_pylist([{"pi_time_ns": 70, "gps_quality": "4", "latitude": 1.0}])
    for _ in range(2):
        writer.commit([writer.write(iter([batch])), None], 7)
    lost = writer.write(iter([batch]))
    writer.abort([lost], 8)
    assert counters.read_counters(out)["rows_written"] == 4 and len(glob.glob(f"{out}/fixes-*.csv")) == 3 and not glob.glob(f"{out}/.*.tmp")


def test_metrics_in_the_same_pass(spark, tmp_path):
    rows = spark.createDataFrame([(s, i, i * 10, None if i % 3 else float(i)) for s in range(4) for i in range(8)], "scan long, ord long, t_ns long, reflectivity double")
    ref = spark.createDataFrame([(20,), (50,)], "t_ns long")
    marked = counters.first_of_scan(timealign.in_range(rows.where("scan < 3 or t_ns between 20 and 50"), ref), scan=["scan"], order="ord")
    seen, counts = counters.observed(marked, **counters.coverage_metrics(), **counters.reflectivity_metrics(least=1.0))
    seen.where("in_range").write.parquet(str(tmp_path / "out"))
    assert counts() == {"samples": 28, "trimmed_samples": 12, "trimmed_scans": 3, "missing_reflectivity": 18, "below_reflectivity": 3}
    assert counters.merged([{"columns": 2, "max_delta_ns": 5}, {"columns": 3, "max_delta_ns": 4}]) == {"columns": 5, "max_delta_ns": 5}


def test_nested_documents(spark):
    scan = '{"fields": ["RANGE"], "h": 1, "w": 1, "timestamp": [1], "field": {"RANGE": [1.5, null]}}'
    docs = ["null", "[]", "3", scan, f"[null, {scan}]", f"[[{scan}]]", '{"fields": [], "h": null, "w": 1, "timestamp": 0}', "{bad", '{"metadata": null, "metadatas": {"a": 1}}', '{"infos": [null, []]}', None]
    rows = spark.createDataFrame(list(enumerate(docs)), "i int, d string").withColumn("d", F.try_parse_json("d"))
    near, deep = nested.first_scan(F.col("d")), nested.first_scan(F.col("d"), 2)
    got = {r.i: r for r in rows.select("i", near.isNotNull().alias("near"), deep.isNotNull().alias("deep"), nested.get_field(deep, "RANGE").alias("v"), nested.has_field(deep, "RANGE").alias("has"), nested.first_sensor_info(F.col("d")).cast("string").alias("info")).collect()}
    assert [i for i, r in got.items() if r.near] == [3, 4, 6] and [i for i, r in got.items() if r.deep] == [3, 4, 5, 6]
    assert [i for i, r in got.items() if r.has] == [3, 4, 5] and got[5].v == [1.5, None] and got[6].v is None
    assert {i: r.info for i, r in got.items() if r.info} == {8: '{"a":1}', 9: "[]"}


def long_track(n, seed, wild):
    rng = np.random.default_rng(seed)
    t = np.cumsum(rng.integers(0, 3, n)) * S
    x = np.cumsum(rng.normal(size=n)) + np.where(rng.random(n) < wild, 1e4, 0)
    return t.tolist(), x.tolist(), np.cumsum(rng.normal(size=n)).tolist()


@pytest.mark.parametrize("wild", [0.02, 1.0])
def test_folds_in_parts_equal_the_plain_fold(spark, wild):
    t, x, y = long_track(30_000, 5, wild)
    x[0] += 5e4 if wild == 1.0 else 0  # a first fix that hardly any other agrees with
    rows = spark.createDataFrame([("k", i, *r) for i, r in enumerate(zip(t, x, y, strict=True))] + [(None, i, i * S, 0.0, float(i)) for i in range(9)], "k string, ord long, t_ns long, x double, y double").repartition(4)
    speed = lambda cols, last: track._speed_run(cols, last, 3.0)
    thin = lambda cols, last: track._thin_run(cols, last, 25.0)
    for run, inputs in ((speed, ["t_ns", "x", "y"]), (thin, ["x", "y"])):
        want = run([[*c] for c in ((t, x, y) if run is speed else (x, y))], None)[0]
        out = folds.fold(rows, run, inputs=inputs, keys=["k"], order=["t_ns", "ord"], column="said", kind="string" if run is speed else "boolean", rows=4000)
        got = {(r.k, r.ord): r.said for r in out.collect()}
        assert [got["k", i] for i in range(len(t))] == want and len(got) == len(t) + 9


def test_running_sum_in_parts(spark):
    rng = np.random.default_rng(1)
    v = rng.integers(-9, 9, 5000)
    rows = spark.createDataFrame([("a", int(i), int(x)) for i, x in enumerate(v)] + [("b", -5, 3), (None, 0, 1), (None, 7, 1)], "k string, o long, v long").repartition(5)
    got = {(r.k, r.o): r.s for r in running.running_sum(rows, "v", keys=["k"], order="o", name="s", rows=64).collect()}
    assert [got["a", i] for i in range(5000)] == np.cumsum(v).tolist() and (got["b", -5], got[None, 0], got[None, 7]) == (3, 1, 2)


def test_quantiles_by_narrowing(spark):
    rng = np.random.default_rng(2)
    sets = {"flat": rng.random(3000), "same": np.full(2500, 7.25), "wide": 10.0 ** rng.uniform(-300, 300, 2500), "few": rng.integers(0, 3, 2500).astype(float), "odd": np.concatenate([rng.normal(size=2200), [np.inf, -np.inf] * 60]), "tiny": np.array([1.0, 2.0, 4.0])}
    rows = spark.createDataFrame([(k, float(x)) for k, v in sets.items() for x in v] + [("tiny", None), ("none", None)], "k string, v double").repartition(6)
    q = {"lo": 0.01, "mid": 0.5, "hi": 0.95}
    got = {r.k: r for r in quantiles.exact(rows, "v", q, keys=["k"], small=2000, bins=64).collect()}
    plain = {r.k: r for r in quantiles.exact(rows, "v", q, keys=["k"]).collect()}
    assert got == plain and set(got) == set(sets)
    for k in ("flat", "few", "same", "tiny"):
        assert np.allclose([got[k][n] for n in q], np.quantile(sets[k], list(q.values())))
    assert quantiles.exact(rows.where("k = 'flat'"), "v", q, keys=[], small=10).first().asDict() == {n: plain["flat"][n] for n in q}


def test_live_headings_equal_those_of_the_whole_track(timers, tmp_path):
    rng = random.Random(9)
    xy = [(0.0, 0.0), (0.0, 0.0), (0.0, 0.0), (1.0, 0.0), (2.0, 1.0), (2.0, 1.0), (2.0, 1.0)] + [(rng.uniform(0, 9), rng.uniform(0, 9)) for _ in range(8)]
    rows = [(k, (100 + i) * S, i, *p, f"r{i}") for k in (1, 2) for i, p in enumerate(xy)] + [(3, 102 * S, 0, 5.0, 5.0, "alone")]
    schema = "session_id long, t_ns long, ord long, easting double, northing double, note string"
    batches = [[r for r in rows if lo * S <= r[1] < hi * S] for lo, hi in ((0, 103), (103, 104), (104, 111), (111, 199))]
    batches += [[(9, t * S, 0, 0.0, 0.0, "end")] for t in (150, 200, 250)]
    live = drain(tangent.headings(stream(timers, tmp_path, batches, schema), idle_s=12, fallback_rad=0.25), "turned").where("note <> 'end'").collect()
    want = {(r.session_id, r.ord): r.heading_rad for r in track.heading(timers.createDataFrame(rows, schema), keys=["session_id"], order=["t_ns", "ord"], fallback_rad=0.25).collect()}
    got = {(r.session_id, r.ord): r.heading_rad for r in live}
    assert set(got) == set(want) and len(live) == len(rows) and all(abs(got[k] - want[k]) < 1e-12 for k in want)
    assert all(r.note == (f"r{r.ord}" if r.session_id < 3 else "alone") for r in live)


def test_cancel_removes_partial_output(spark, tmp_path):
    job, out = Cancellation(spark), str(tmp_path / "out")
    slow = spark.range(0, 4, 1, 4).mapInPandas(lambda it: ((time.sleep(20), b)[1] for b in it), "id long")
    threading.Timer(3, job.cancel).start()
    began = time.time()
    with pytest.raises(Cancelled):
        job.write(out, lambda part: slow.write.parquet(part))
    assert time.time() - began < 18 and os.listdir(tmp_path) == []
    with pytest.raises(Cancelled):
        job.run(lambda: spark.range(3).count())
    fine = Cancellation(spark)
    fine.write(out, lambda part: spark.range(5).write.parquet(part))
    assert spark.read.parquet(out).count() == 5
    q = spark.readStream.format("rate").load().writeStream.format("memory").queryName("cancelled").start()
    fine.follow(q)
    fine.cancel()
    assert not q.isActive


def test_live_log_shows_one_fix_line_a_context(spark, tmp_path):
    from trackloom import streaming
    from trackloom.operators import logs

    lines = ["boot", "GPS fix logged: 1", "GPS fix logged: 2", "Starting chunk 0: 30 s", "GPS fix logged: 3", None, "GPS fix logged: 4", "Starting chunk 1: 30 s", "GPS fix logged: 5", "Starting chunk 0: again", "GPS fix logged: 6", "GPS fix logged: 7"]
    rows = [(k, i, t) for k in (1, 2) for i, t in enumerate(lines)]
    batches = [[r for r in rows if r[1] % 12 in range(*b)] for b in ((0, 3), (3, 6), (6, 12))]
    live = drain(streaming.surfaced(stream(spark, tmp_path, batches, "run long, ord long, text string"), keys=["run"]), "shown").where("text is not null").collect()
    whole = logs.surfaced(spark.createDataFrame(rows, "run long, ord long, text string"), keys=["run"]).where("text is not null").collect()
    assert sorted(map(tuple, live)) == sorted(map(tuple, whole)) and len(live) == 2 * 8


def test_capture_loop_ends_with_the_first_failure(spark):
    from trackloom.operators import manifest

    rows = [(1, 0, 1, ["a.pcap"]), (1, 1, 0, []), (1, 2, 1, ["a.csv"]), (1, 3, 0, ["b.pcap"]), (2, 0, None, None), (2, 1, 0, []), (None, 5, 0, []), (None, 6, 2, []), (None, 7, 0, [])]
    df = spark.createDataFrame(rows, "s int, chunk_index int, returncode int, produced_files array<string>")
    got = lambda **k: sorted((str(r.s), r.chunk_index) for r in manifest.taken(df, keys=["s"], **k).collect())
    assert got() == [("1", 0), ("1", 1), ("1", 2), ("2", 0), ("None", 5), ("None", 6)]
    assert got(raw=False) == [("1", 0), ("2", 0), ("None", 5), ("None", 6)]
    assert got(continuous=False) == [("1", 0), ("2", 0), ("None", 5)]
