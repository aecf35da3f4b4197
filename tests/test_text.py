"""Sentences, status texts, names, logs and manifests against literal vectors."""

import pytest
from pyspark.sql import functions as F

from trackloom.functions import nmea, text
from trackloom.operators import logs, manifest, status

GGA = "$GPGGA,194410.00,2925.4472,N,09829.6178,W,4,18,0.6,200.5,M,-24.3,M,,*59"
RMC = "$GPRMC,194410.00,A,2925.4472,N,09829.6178,W,0.1,0.0,090626,,,A*44"


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_checksum(spark):
    lines = spark.createDataFrame([(GGA,), (RMC,), (GGA.replace("*59", "*58"),), (GGA[:-3],), ("no",), (None,)], "s string")
    assert [r.ok for r in lines.select(nmea.checksum_ok(F.col("s")).alias("ok")).collect()] == [True, True, False, False, False, False]


def test_fix(spark):
    lines = spark.createDataFrame([(0, i, s) for i, s in enumerate([GGA, "x" + RMC, GGA, RMC.replace(",A,", ",V,"), GGA.replace(",4,", ",0,")])], "k int, ord long, value string")
    got = nmea.fixes(nmea.frame(lines), keys=["k"]).orderBy("ord").collect()
    assert [r.gps_epoch_ns for r in got] == [None, 1781034250 * 10**9]
    assert (got[1].latitude, got[1].longitude) == pytest.approx((29.42412, -98.49363), abs=1e-6)
    assert (got[1].gps_quality, got[1].num_sats, got[1].hdop, got[1].altitude_m) == (4, "18", "0.6", 200.5)


@pytest.mark.parametrize(("value", "us"), [("194410.00", 71050000000), ("000000", 0), ("235959.1234567", 86399123456), ("1944", None), ("246000", None), ("ab4410", None)])
def test_time_of_day(spark, value, us):
    assert one(spark, nmea.time_of_day_us(F.lit(value))) == us


@pytest.mark.parametrize(("value", "day"), [("090626", "2026-06-09"), ("010180", "1980-01-01"), ("010179", "2079-01-01"), ("320101", None), ("0101", None)])
def test_date(spark, value, day):
    got = one(spark, nmea.date(F.lit(value)))
    assert (str(got) if got else None) == day


@pytest.mark.parametrize(("value", "h", "lat", "deg"), [("2925.4472", "N", True, 29.42412), ("2925.4472", "S", True, -29.42412), ("09829.6178", "E", False, 98.49363), ("2925.4472", "Q", True, None), ("x", "N", True, None)])
def test_coordinate(spark, value, h, lat, deg):
    assert one(spark, nmea.coordinate(F.lit(value), F.lit(h), lat)) == (pytest.approx(deg, abs=1e-6) if deg is not None else None)


def test_names(spark):
    names = ["/tmp/raw_gps_20260317_094022.csv", "/tmp/gps_run_20260317_101058_processed.csv", "/tmp/none.csv"]
    df = spark.createDataFrame([(n,) for n in names], "p string")
    assert [r.s for r in df.select(text.session_id(F.col("p")).alias("s")).collect()] == ["20260317_094022", "20260317_101058", None]
    assert one(spark, text.manifest_label(F.lit("/a/capture_manifest_x.json"))) == "x"
    assert one(spark, text.iso_epoch_ns(F.lit("2026-05-12T13:47:29.123456Z"))) == 1778593649123456000
    assert one(spark, text.iso_epoch_ns(F.lit(" "))) is None
    assert one(spark, text.lidar_mode(F.lit(" 1024X20 "))) == "1024x20"
    assert one(spark, text.lidar_mode_error(F.lit("1024")))
    assert one(spark, text.mode_of(F.lit(1024), F.lit(10))) is None
    assert one(spark, text.first_json_value(F.lit('{"a":{"b":"x"},"b":2}'), "b")) == "x"
    assert one(spark, text.service_state(F.lit(" "), F.lit(None).cast("string"))) == "unknown"


def test_sessions(spark):
    paths = spark.createDataFrame([(f"/d/raw_lidar_20260317_{s}_000{i}.pcap",) for i, s in enumerate(["093703", "093703", "094022"])], "path string")
    assert [r.path for r in manifest.session_paths(paths, "20260317_094022").collect()] == ["/d/raw_lidar_20260317_094022_0002.pcap"]
    with pytest.raises(ValueError):
        manifest.session_paths(paths, "x")


def test_manifest_paths(spark):
    chunk = "array<struct<chunk_index:int,produced_files:array<string>,requested_output_path:string,lidar_csv_path:string,lidar_pcap_path:string>>"
    doc = spark.createDataFrame(
        [(1, [(2, ["b.PCAP", "n.txt"], None, None, None), (None, ["z.pcap", "b.PCAP"], "q.osf", None, None), (0, None, None, None, "a.pcap")], "top.csv"), (2, [], "top.csv")], f"s int, chunks {chunk}, lidar_csv_path string"
    )
    got = manifest.manifest_paths(doc, "raw", keys=["s"]).orderBy("s", "position").collect()
    assert [r.path for r in got] == ["a.pcap", "b.PCAP", "q.osf", "z.pcap"]
    assert [(r.s, r.path) for r in manifest.manifest_paths(doc, "csv", keys=["s"]).orderBy("s").collect()] == [(1, "top.csv"), (2, "top.csv")]


def test_resolution(spark):
    want, have = spark.createDataFrame([("a/x.pcap",), ("y.pcap",)], "path string"), spark.createDataFrame([("/base/x.pcap",), ("/m/a/x.pcap",)], "path string")
    got = {r.path: (r.resolved, r.found) for r in manifest.resolve(want, have, manifest_dir="/m", base_dir="/base").collect()}
    assert got == {"a/x.pcap": ("/m/a/x.pcap", True), "y.pcap": ("y.pcap", False)}
    with pytest.raises(FileNotFoundError, match="y.pcap"):
        manifest.require_found(manifest.resolve(want, have, manifest_dir="/m", base_dir=None))


def lock(spark, doc):
    return one(spark, status.ptp_locked(F.from_json(F.lit(doc), status.STATUS_SCHEMA)))


def test_locks(spark):
    base = '{"timestamp_mode":"%s","ptp":{"port_data_set":{"port_state":"%s"}%s}}'
    assert lock(spark, base % ("TIME_FROM_PTP_1588", "SLAVE", ',"time_status_np":{"gm_present":true}'))
    assert not lock(spark, base % ("TIME_FROM_INTERNAL_OSC", "SLAVE", ',"time_status_np":{"gm_present":true}'))
    assert not lock(spark, base % ("TIME_FROM_PTP_1588", "LISTENING", ',"time_status_np":{"gm_present":false}'))
    assert not lock(spark, base % ("TIME_FROM_PTP_1588", "SLAVE", ""))
    assert not lock(spark, "[]")


def test_alignment(spark):
    df = spark.createDataFrame([("phc clock time is 1781280168.602482101", "clock time is 1781280168.617407242"), ("x", "clock time is 1.5")], "a string, b string")
    assert [(r.ready, r.error is None) for r in status.phc_alignment(df, "a", "b").collect()] == [(True, True), (False, False)]
    assert one(spark, status.aligned(F.lit(1781280168.6174073), F.lit(1781280168.602482), status.SENSOR_LIMIT_S))
    assert not one(spark, status.aligned(F.lit(1781032462.8541107), F.lit(1781278969.1754236), status.SENSOR_LIMIT_S))
    win = spark.createDataFrame([(1781280168.60, 1781280175.10, 1781280169200000000, 1781280174800000000), (1781280168.60, 1781280175.10, 1781032462850000000, 1781280174800000000)], "a double, b double, f long, l long")
    assert [r.inside for r in status.window_contains(win, before="a", after="b", first_ns="f", last_ns="l").collect()] == [True, False]


def test_log(spark):
    lines = ["GPS fix logged: 1", "GPS fix logged: 2", "Starting chunk 0: 30 s", "GPS fix logged: 3", "GPS fix logged: 4"]
    df = spark.createDataFrame([(1, i, s) for i, s in enumerate(lines)], "run long, ord long, text string")
    assert [r.ord for r in logs.surfaced(df, keys=["run"]).orderBy("ord").collect()] == [0, 2, 3]
    last = logs.states(df, keys=["run"]).orderBy(F.desc("ord")).first()
    assert (last.phase, last.current_chunk_index, last.latest_gps_log, last.gps_fix_ready) == ("capturing", 0, "GPS fix logged: 4", False)


def test_repeats_may_come_back(spark):
    df = spark.createDataFrame([(0, i, s, g) for i, (s, g) in enumerate([(1, "a"), (1, "b"), (2, "b"), (1, "b"), (None, "c"), (None, "c"), (1, "d")])], "k int, ord long, seq long, sig string")
    assert [r.ord for r in logs.drop_repeats(df, keys=["k"], order="ord", sequence="seq", signature=["sig"]).orderBy("ord").collect()] == [0, 2, 3, 4]


def test_gate(spark):
    polls = spark.createDataFrame([("a", 0, False), ("a", 5, True), ("b", 0, False), ("b", 50, True), ("c", 0, False)], "k string, t long, ready boolean")
    got = {r.k: (r.opened, r.passed) for r in status.gate(polls, keys=["k"], time="t", ready="ready", timeout_ns=10).collect()}
    assert got == {"a": (5, True), "b": (None, False), "c": (None, False)}
    assert status.gate(polls, keys=["k"], time="t", ready="ready", timeout_ns=None).where("passed").count() == 2


def test_helper_documents(spark):
    rows = [(0, '{"gps_time_ready": true, "summary": "fine"}', ""), (1, "out", " bad "), (0, "[1]", ""), (0, "{", ""), (0, "", ""), (2, "", "")]
    df = status.timing_snapshot(status.helper_document(spark.createDataFrame(rows, "rc int, out string, err string"), returncode="rc", stdout="out", stderr="err"))
    got = [(r.ok, r.gps_time_ready, r.summary, r.error) for r in df.collect()]
    off = "status unavailable"
    assert got == [(True, True, "fine", None), (False, False, off, "bad"), (False, False, off, "not an object"), (False, False, off, "invalid JSON"), (True, False, off, None), (False, False, off, "exit code 2")]


def test_sensor_facts_and_preflight(spark):
    clock = spark.createDataFrame([(1, True), (2, True), (3, False)], "k int, ready boolean")
    lock = '{"timestamp_mode":"TIME_FROM_PTP_1588","ptp":{"port_data_set":{"port_state":"SLAVE"},"time_status_np":{"gm_present":true}}}'
    sensor = spark.createDataFrame([(1, lock, '{"prod_line":"M","serial_no":"7","image_rev":"fw-v3.2"}', None), (3, lock, "{}", "e")], "k int, status string, info string, error string")
    got = {r.k: r for r in status.preflight(clock, sensor, keys=["k"]).collect()}
    assert [got[k].go for k in (1, 2, 3)] == [True, False, False]
    assert got[1].facts.asDict() == {"model": "M", "serial": "7", "firmware": "fw-v3.2 fw-v3.2", "imu_rate_hint_hz": "640"}
    assert got[3].facts.firmware == "-" and got[3].sensor_error == "e"


def test_capture_arguments(spark):
    args = text.capture_arguments(F.lit(" "), F.lit("gpsd"), flags={"wait": F.lit(True), "lock": F.lit(False)}, options={"mode": F.lit("1024x20"), "host": F.lit(" ")})
    assert one(spark, args) == ["--wait", "--no-lock", "--mode", "1024x20"]
    assert one(spark, text.capture_arguments(F.lit("x"), F.lit(None).cast("string"), flags={"a": F.lit(True)}, options={})) is None
