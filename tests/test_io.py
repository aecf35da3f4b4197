"""Readers, writers and streams."""

import json
import os
import struct

import pytest
from pyspark.sql import functions as F

from trackloom import sinks, sources, streaming
from trackloom.schema import FIX

GGA = "$GPGGA,194410.00,2925.4472,N,09829.6178,W,4,18,0.6,200.5,M,-24.3,M,,*59"
RMC = "$GPRMC,194410.00,A,2925.4472,N,09829.6178,W,0.1,0.0,090626,,,A*44"


def test_point_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text("# meta line\n#TIMESTAMP (ns), X1 (m), Y1 (m), Z1 (m)\n100,1.0,2.0,3.0\n200,1.5,x,3.5\n\n")
    got = sources.point_text(sources.numbered_lines(spark, str(tmp_path / "a.csv"))).orderBy("ord").collect()
    assert [(r.ord, r.t_ns, r.x1, r.y1, r.z1) for r in got] == [(0, 100, 1.0, 2.0, 3.0), (1, 200, 1.5, None, 3.5)]
    (tmp_path / "b.csv").write_text("TIMESTAMP (ns),X1 (m)\n1,2\n")
    with pytest.raises(ValueError, match="y1"):
        sources.point_text(sources.numbered_lines(spark, str(tmp_path / "b.csv")))
    (tmp_path / "c.csv").write_text("nothing\n")
    with pytest.raises(ValueError, match="no header"):
        sources.point_text(sources.numbered_lines(spark, str(tmp_path / "c.csv")))


def test_fix_log(spark, tmp_path):
    (tmp_path / "g.csv").write_text(",".join(FIX.names) + "\n1773758460000505001,i,,t,4,12,0.9,1.5,2.5,,600000.5,4000000.5\n5,i,1773758460000505001,t,fix,,,1,2,3,4,5\n")
    a, b = sources.fix_log(spark, str(tmp_path / "g.csv")).orderBy("ord").collect()
    assert (a.pi_time_ns, a.gps_epoch_ns, a.altitude_m, b.gps_epoch_ns, b.gps_quality) == (1773758460000505001, None, None, 1773758460000505001, "fix")


def test_listing(spark, tmp_path):
    for n in ("b.pcap", "a.OSF", "a.json", "b_0.json", "b_x.json"):
        (tmp_path / n).write_text("x" if n != "b.pcap" else "")
    root = str(tmp_path)
    assert [os.path.basename(p) for p in sources.expand_raw(spark, [f"{root}/b.pcap", root])] == ["b.pcap", "a.OSF"]
    with pytest.raises(ValueError):
        sources.expand_raw(spark, [f"{root}/a.json"])
    with pytest.raises(FileNotFoundError):
        sources.expand_raw(spark, [f"{root}/none*"])
    files = spark.createDataFrame(sources.listing(spark, root), "path string, length long")
    raw = files.where(F.lower("path").rlike("pcap|osf"))
    got = {os.path.basename(r.path): os.path.basename(r.sidecar) for r in sources.sidecars(raw.select("path"), files).collect()}
    assert got == {"b.pcap": "b_0.json", "a.OSF": "a.json"}
    states = {os.path.basename(r.path): r.state for r in sources.file_state(spark.createDataFrame([(f"{root}/{n}",) for n in ("b.pcap", "a.OSF", "q.osf")], "path string"), files).collect()}
    assert states == {"b.pcap": "empty", "a.OSF": "ready", "q.osf": "missing"}
    assert sources.chunk_files(files, f"{root}/b.pcap").count() == 3


def test_frame_bytes():
    buf = bytearray(b"noise$A,1\r\n$B")
    assert sources.frame_bytes(buf) == "$A,1"
    assert sources.frame_bytes(buf) is None and buf == b"$B"
    noise = bytearray(b"x" * 5000)
    assert sources.frame_bytes(noise) is None and len(noise) == 256
    assert sources.byte_count(0x01, 0x00) == 256 and sources.byte_count(0xF0, 0x01) == 0x01F0


def test_decoder_source(spark):
    spark.dataSource.register(sources.raw_scan_source("demo_scans", lambda path: iter([(path, 0, 0, 0, 0, 5, 1.0, 2.0, 3.0, 1000, None)])))
    got = spark.read.format("demo_scans").option("paths", "/x/a,/x/b").load()
    assert sorted(r.file for r in got.collect()) == ["/x/a", "/x/b"]


def test_las(spark, tmp_path):
    df = spark.createDataFrame([(1 * 10**9, 600000.0015, 4000000.5, 10.25), (2 * 10**9, 600001.0, 4000002.0, 9.0)], "timestamp_ns long, x_global double, y_global double, z_global double")
    path = str(tmp_path / "out.las")
    assert sinks.write_las(df.repartition(2), path, offsets=(600000.0, 4000000.0, 0.0), wkt='PROJCS["x"]') == 2
    raw = open(path, "rb").read()
    assert raw[:4] == b"LASF" and raw[24:26] == bytes([1, 4])
    at, n = struct.unpack_from("<I", raw, 96)[0], struct.unpack_from("<Q", raw, 247)[0]
    assert (n, len(raw) - at, raw[104], struct.unpack_from("<H", raw, 105)[0]) == (2, 60, 6, 30)
    xs = sorted(struct.unpack_from("<i", raw, at + 30 * i)[0] for i in range(2))
    assert xs == [2, 1000]
    assert struct.unpack_from("<2d", raw, 179) == (600001.0, 600000.0015)
    assert not os.path.exists(path + ".parts") and not os.path.exists(path + ".partial")


def test_commit_and_names(tmp_path):
    p = str(tmp_path / "a.las")

    def fail(part):
        open(part, "w").close()
        raise RuntimeError

    with pytest.raises(RuntimeError):
        sinks.commit(p, fail)
    assert os.listdir(tmp_path) == []
    open(p, "w").close()
    open(str(tmp_path / "a_2.las.partial"), "w").close()
    assert sinks.next_free(p) == str(tmp_path / "a_3.las")
    sinks.write_json_atomic(str(tmp_path / "f.json"), {"b": 1})
    assert json.load(open(tmp_path / "f.json")) == {"b": 1}
    assert sinks.qa_path("/x/m.las") == "/x/m_qa.json"


def test_reports(spark, tmp_path):
    m = spark.createDataFrame([(4.0, 11.0)], "xy_median_m double, xy_p95_m double")
    row = sinks.qa_report(m, backend="rigid_fit", time_mode="unix_ns").first()
    doc = json.loads(row["value"])
    assert (doc["pass"], doc["backend"], doc["thresholds"]["xy_p95_max_m"], list(doc)) == (False, "rigid_fit", 10.0, sorted(doc))
    s = spark.range(1).select(sinks.clock_sample(F.lit(12.5), F.lit(10.25)).alias("s")).first().s
    assert (s.tv_sec, s.tv_usec, s.offset) == (10, 250000, 2.25)


def stream(spark, tmp_path, batches, schema):
    """Feeds lists of rows as files, one per trigger."""
    src = tmp_path / "in"
    src.mkdir()
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(str(tmp_path / f"w{i}"))
        name = next(p for p in os.listdir(tmp_path / f"w{i}") if p.endswith(".parquet"))
        os.rename(tmp_path / f"w{i}" / name, src / f"{i}.parquet")
        os.utime(src / f"{i}.parquet", (1_000_000 + i, 1_000_000 + i))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(src))


def drain(df, name):
    q = df.writeStream.format("memory").queryName(name).outputMode("append").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return df.sparkSession.table(name)


def test_stream_dedupe_and_freshness(spark, tmp_path):
    start = 1781034250801505001
    rows = [[("a", 1, start - 1, "x")], [("a", 2, start + 4999, "x"), ("a", 2, start + 6000, "y")], [("a", 2, start + 7000, "z"), ("a", 1, start + 8000, "z")]]
    s = streaming.fresh(stream(spark, tmp_path, rows, "dev string, sequence long, pi_time_ns long, sig string"), start)
    got = drain(streaming.drop_repeats(s, keys=["dev"], order="pi_time_ns", sequence="sequence", signature=["sig"]), "fresh").orderBy("pi_time_ns").collect()
    assert [(r.sequence, r.pi_time_ns - start) for r in got] == [(2, 4999), (1, 8000)]


def test_stream_of_sentences_keeps_the_date(spark, tmp_path):
    s = stream(spark, tmp_path, [[("a", 0, GGA), ("a", 1, RMC)], [("a", 2, GGA)]], "dev string, ord long, value string")
    got = drain(streaming.nmea_fixes(s, keys=["dev"]), "nmea").orderBy("ord").collect()
    assert [r.gps_epoch_ns for r in got] == [None, 1781034250 * 10**9]


def test_stream_of_reports_keeps_the_sky(spark, tmp_path):
    sky, tpv = '{"class":"SKY","hdop":0.9,"satellites":[{"used":true},{"used":false},{"used":true}]}', '{"class":"TPV","mode":3,"lat":1.5,"lon":2.5,"altHAE":7.0}'
    s = stream(spark, tmp_path, [[("a", 0, tpv), ("a", 1, sky)], [("a", 2, tpv), ("a", 3, '{"class":"TPV","mode":1}')]], "dev string, ord long, value string")
    got = drain(streaming.gpsd_fixes(s, keys=["dev"]), "gpsd").orderBy("ord").collect()
    assert [(r.ord, r.hdop, r.num_sats, r.altitude_m) for r in got] == [(0, None, None, 7.0), (2, 0.9, 2, 7.0)]


def test_stream_of_logs(spark, tmp_path):
    s = stream(spark, tmp_path, [[(1, 0, "GPS fix acquired")], [(1, 1, "Starting chunk 3: 30 s"), (1, 2, "GPS CSV: /a.csv ")]], "run long, ord long, text string")
    last = drain(streaming.log_states(s, keys=["run"]), "logs").orderBy(F.desc("ord")).first()
    assert (last.gps_fix_ready, last.ptp_lock_ready, last.current_chunk_index, last.phase, last.gps_csv_path) == (True, False, 3, "capturing", "/a.csv")


def test_recorded_chunks(spark):
    rows = spark.createDataFrame([(5,), (10,), (15,)], "t_ns long")
    chunks = spark.createDataFrame([(0, 0, 10), (1, 11, 14)], "chunk_index int, capture_start_ns long, capture_end_ns long")
    assert [r.chunk_index for r in streaming.chunk_of_time(rows, chunks).orderBy("t_ns").collect()] == [0, 0, None]


def test_point_stream_on_a_recorded_track(spark, tmp_path):
    track = spark.createDataFrame([(1, 0, 0.0), (1, 3_000_000_000, 30.0), (2, 0, 5.0)], "session_id int, t_ns long, easting double")
    rows = [(1, 0), (1, 1_500_000_000), (1, 3_000_000_000), (1, 3_000_000_001), (2, 0), (2, 1), (1, -1)]
    spark.createDataFrame(rows, "session_id int, t_ns long").coalesce(1).write.parquet(str(tmp_path / "points"))
    live = spark.readStream.schema("session_id int, t_ns long").parquet(str(tmp_path / "points"))
    got = drain(streaming.fuse_stream(live, track, values=["easting"]), "laid").orderBy("session_id", "t_ns").collect()
    assert [tuple(r) for r in got] == [(1, 0, 0.0), (1, 1_500_000_000, 15.0), (1, 3_000_000_000, 30.0), (2, 0, 5.0)]
