"""Queries over whole sessions: ordered gates, aborted captures, framed bytes, nested documents.

``events`` gives the polls (each type of event polls one gate), and ``documents`` gives the byte stream of each source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import folds, gates, manifest, nested, quantiles, status, track
from ..operators.running import running_sum
from ..streaming.sources import sentences_of_log
from .queries import EVENTS, events, query, table

#: Which type of event polls which stage, and from which value on it is ready.
POLLS = dict(zip(gates.STAGES, ("view", "click", "error", "signup", "purchase"), strict=True))
READY_FROM = 20
GATES = gates.capture_gates(timeout_s=4 * 86_400)


def _polls(spark: SparkSession, sf: str) -> DataFrame:
    stage = F.create_map(*[F.lit(x) for s, kind in POLLS.items() for x in (kind, s)])
    return events(spark, sf).select("session_id", "t_ns", stage[F.col("event_type")].alias("gate"), (F.col("easting") >= READY_FROM).alias("ready"))


def _gates_sql() -> str:
    parts = [f"{EVENTS}, g0 AS (SELECT session_id, min(t_ns) AS started, min(t_ns) AS o FROM track GROUP BY 1)"]
    for k, g in enumerate(GATES, 1):
        late = "" if g.timeout_ns is None else f" AND t.t_ns - g.o <= {g.timeout_ns}"
        parts.append(f"g{k} AS (SELECT g.session_id, g.o AS since, min(t.t_ns) AS o FROM g{k - 1} g LEFT JOIN track t ON t.session_id = g.session_id AND t.event_type = '{POLLS[g.stage]}' AND t.easting >= {READY_FROM} AND t.t_ns >= g.o{late} GROUP BY 1, 2)")
    names = [f"g{k}.o AS {g.stage}_opened" for k, g in enumerate(GATES, 1)]
    failed = " ".join(f"WHEN g{k}.since IS NOT NULL AND g{k}.o IS NULL THEN '{g.stage}'" for k, g in enumerate(GATES, 1) if g.timeout_ns is not None)
    ended = " ".join(f"WHEN g{k}.since IS NOT NULL AND g{k}.o IS NULL THEN g{k}.since + {g.timeout_ns}" for k, g in enumerate(GATES, 1) if g.timeout_ns is not None)
    joins = " ".join(f"JOIN g{k} USING (session_id)" for k in range(1, len(GATES) + 1))
    return f"""WITH {", ".join(parts)},
judged AS (SELECT session_id, g0.started, {", ".join(names)}, CASE {failed} END AS failed_stage, CASE {ended} ELSE g{len(GATES)}.o END AS ended FROM g0 {joins})"""


LAST = f"{GATES[-1].stage}_opened"


@query(f"{_gates_sql()} SELECT *, CASE WHEN failed_stage IS NOT NULL THEN 'aborted' WHEN {LAST} IS NOT NULL THEN 'ready' ELSE 'waiting' END AS state FROM judged")
def ordered_gates(spark: SparkSession, sf: str) -> DataFrame:
    return gates.ordered_gates(_polls(spark, sf), GATES)


@query(f"""{_gates_sql()}, f AS (SELECT j.session_id, count(*) AS n, arg_min(t_ns, ord) AS a, arg_max(t_ns, ord) AS b FROM judged j JOIN knots k ON k.session_id = j.session_id AND k.t_ns <= j.ended WHERE failed_stage IS NOT NULL GROUP BY 1)
SELECT session_id, 'aborted_no_' || failed_stage AS capture_mode, started AS run_start_ns, ended AS run_end_ns, coalesce(n, 0) AS gps_rows_written, a AS gps_first_fix_time_ns, b AS gps_latest_fix_time_ns, 0 AS chunks_captured,
  concat_ws(',', {", ".join(f"CASE WHEN {s}_opened IS NOT NULL THEN '{s}' END" for s in gates.STAGES)}) AS ready_stages FROM judged LEFT JOIN f USING (session_id) WHERE failed_stage <> '{gates.STAGES[0]}'""")
def aborted_manifests(spark: SparkSession, sf: str) -> DataFrame:
    judged = gates.ordered_gates(_polls(spark, sf), GATES)
    fixes = events(spark, sf).where(F.col("event_type").isin("view", "click"))
    ready = F.concat_ws(",", *[F.when(F.col("readiness")[s]["ready"], F.lit(s)) for s in gates.STAGES])
    return gates.abort_manifests(judged, GATES, fixes).withColumn("ready_stages", ready).drop("readiness", "chunks", "failed_stage")


@query(r"""WITH s AS (SELECT source, string_agg(coalesce(text, ''), '' ORDER BY doc_id) AS log FROM documents GROUP BY 1),
l AS (SELECT source, unnest(string_split(log, chr(10))) AS t, generate_subscripts(string_split(log, chr(10)), 1) - 1 AS n, len(string_split(log, chr(10))) - 1 AS last FROM s)
SELECT source, CAST(n AS BIGINT) AS n, regexp_replace(regexp_replace(substr(t, strpos(t, '$')), '[^\x00-\x7F]', '', 'g'), '^[\s\x0B\x1C-\x1F]+|[\s\x0B\x1C-\x1F]+$', '', 'g') AS value FROM l WHERE n < last AND contains(t, '$')""")
def framed_sentences(spark: SparkSession, sf: str) -> DataFrame:
    """Every text is a chunk of its source's log; lines run on over the borders of texts."""
    return sentences_of_log(table(spark, sf, "documents"), keys=["source"], order="doc_id", data="text")


@query("SELECT user_id AS session_id, event_id AS ord, CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS total FROM events")
def running_total(spark: SparkSession, sf: str) -> DataFrame:
    """In parts of 16 rows, so that the shifts between parts count here as they do on long keys."""
    e = events(spark, sf).select("session_id", "ord", F.round(F.col("easting") * 100).cast("long").alias("v"))
    return running_sum(e, "v", keys=["session_id"], order="ord", name="total", rows=16).select("session_id", "ord", "total")


#: Documents of four shapes about each event, as different software would write them.
SHAPES = """CASE event_id % 6 WHEN 0 THEN '{"metadatas": [null, ' || i || ', {"id": -1}], "infos": ' || i || ', "scan": [null, {"w": 1}, ' || s || ']}'
  WHEN 1 THEN '{"metadata": ' || i || ', "metadatas": [{"id": -2}], "scan": ' || s || '}'
  WHEN 2 THEN '{"metadata": null, "infos": [], "sensor_info": ' || i || ', "scan": [[' || s || ']]}'
  WHEN 3 THEN '{"metadatas": [null], "infos": [null, ' || i || '], "scan": [3, "x", ' || s || ', {"fields": [], "h": 1, "w": 1, "timestamp": 0}]}'
  WHEN 4 THEN '{"other": ' || i || ', "scan": null}' ELSE '[1]' END"""
SCAN = """'{"h": ' || event_id || ', "w": 2, "timestamp": null, "fields": ' || CASE event_id % 5 WHEN 0 THEN '["RANGE"]' WHEN 1 THEN '["ChanField.RANGE", "REFLECTIVITY"]' WHEN 2 THEN '[]' ELSE '["SIGNAL"]' END
  || ', "field": ' || CASE event_id % 4 WHEN 0 THEN '{"ChanField.RANGE": [' || event_id || ', 5]}' WHEN 1 THEN '{"RANGE": [7, ' || event_id || ']}' ELSE '{}' END || '}'"""


@query(f"""WITH p AS (SELECT event_id, '{{"id": ' || event_id || ', "p": ' || props || '}}' AS i, {SCAN} AS s FROM events), d AS (SELECT event_id, {SHAPES} AS doc FROM p),
x AS (SELECT event_id, event_id % 6 IN (0, 1, 2, 3) AS informed, event_id % 6 IN (0, 1, 3) AS shallow, event_id % 6 IN (0, 1, 2, 3) AS deep,
  CASE WHEN event_id % 4 IN (0, 1) OR event_id % 5 IN (0, 1) THEN true ELSE false END AS ranged, json_extract(props, '$.k') AS k FROM events)
SELECT event_id, CASE WHEN informed THEN event_id END AS info_id, CASE WHEN informed THEN CAST(k AS BIGINT) END AS info_k, CASE WHEN shallow THEN event_id END AS scan_h, CASE WHEN deep THEN event_id END AS deep_h,
  deep AND ranged AS has_range, deep AND event_id % 5 = 1 AS has_reflectivity, CASE WHEN deep AND event_id % 4 = 0 THEN event_id + 5 WHEN deep AND event_id % 4 = 1 THEN 7 + event_id END AS range_sum FROM x""")
def nested_scans(spark: SparkSession, sf: str) -> DataFrame:
    made = table(spark, sf, "events").select("event_id", F.expr("'{\"id\": ' || event_id || ', \"p\": ' || props || '}'").alias("i"), F.expr(SCAN).alias("s"))
    doc = made.select("event_id", F.try_parse_json(F.expr(SHAPES)).alias("doc"))
    read = doc.select("event_id", nested.first_sensor_info(F.col("doc")).alias("info"), *[nested.first_scan(nested.part(F.col("doc"), "scan"), d).alias(n) for n, d in (("near", 1), ("deep", 3))])
    deep = F.col("deep")
    return read.select(
        "event_id", F.try_variant_get("info", "$.id", "bigint").alias("info_id"), F.try_variant_get("info", "$.p.k", "bigint").alias("info_k"), F.try_variant_get("near", "$.h", "bigint").alias("scan_h"),
        F.try_variant_get("deep", "$.h", "bigint").alias("deep_h"), nested.has_field(deep, "RANGE").alias("has_range"), nested.has_field(deep, "REFLECTIVITY").alias("has_reflectivity"),
        F.aggregate(nested.get_field(deep, "RANGE", "array<bigint>"), F.lit(0).cast("bigint"), lambda a, b: a + b).alias("range_sum"),
    )


@query("""SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.5), 6) AS median, round(quantile_cont(l_extendedprice, 0.95), 6) AS p95, round(quantile_cont(l_extendedprice, 0.001), 6) AS low FROM lineitem GROUP BY 1""")
def exact_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    """With keys of over 1,000 rows narrowed down by histograms, as keys of over a million are otherwise."""
    rows = table(spark, sf, "lineitem")
    out = quantiles.exact(rows, "l_extendedprice", {"median": 0.5, "p95": 0.95, "low": 0.001}, keys=["l_returnflag"], small=1000)
    return out.select("l_returnflag", *[F.round(c, 6).alias(c) for c in ("median", "p95", "low")])


@query(f"""WITH RECURSIVE {EVENTS},
s AS (SELECT ord, t_ns, easting * 1000 AS x, row_number() OVER (ORDER BY t_ns, ord) AS i FROM track),
f(i, ord, lt, lx, verdict) AS (SELECT i, ord, t_ns, x, 'kept' FROM s WHERE i = 1
  UNION ALL SELECT i, ord, CASE WHEN verdict = 'kept' THEN t_ns ELSE lt END, CASE WHEN verdict = 'kept' THEN x ELSE lx END, verdict
  FROM (SELECT s.*, f.lt, f.lx, CASE WHEN s.t_ns <= f.lt THEN 'time' WHEN abs(s.x - f.lx) / ((s.t_ns - f.lt) * 1e-9) > 120.0 THEN 'speed' ELSE 'kept' END AS verdict FROM f JOIN s ON s.i = f.i + 1))
SELECT ord, verdict FROM f""")
def speed_filter_one_track(spark: SparkSession, sf: str) -> DataFrame:
    """All events as one track, folded in parts of about 500 rows."""
    e = events(spark, sf).select("ord", "t_ns", (F.col("easting") * 1000).alias("x"), F.lit(0.0).alias("y"), F.lit(0).alias("all"))
    run = lambda cols, last: track._speed_run(cols, last, 120.0)
    return folds.fold(e, run, inputs=["t_ns", "x", "y"], keys=["all"], order=["t_ns", "ord"], column="verdict", kind="string", rows=500).select("ord", "verdict")


@query("""WITH a AS (SELECT user_id AS session_id, event_id AS chunk_index, CAST(event_id % 3 AS INTEGER) AS rc, event_type IN ('view', 'click', 'signup') AS raw FROM events),
l AS (SELECT session_id, min(chunk_index) FILTER (rc <> 0 AND NOT raw) AS last FROM a GROUP BY 1)
SELECT session_id, chunk_index, rc AS returncode FROM a JOIN l USING (session_id) WHERE last IS NULL OR chunk_index <= last""")
def chunks_taken(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    name = F.when(F.col("event_type").isin("view", "click", "signup"), F.concat(F.lit("/d/"), "event_id", F.lit(".PCAP"))).otherwise("/d/x.csv")
    rows = e.select(F.col("user_id").alias("session_id"), F.col("event_id").alias("chunk_index"), (F.col("event_id") % 3).cast("int").alias("returncode"), F.array(name).alias("produced_files"))
    return manifest.taken(rows, keys=["session_id"]).drop("produced_files")


@query("""WITH f AS (SELECT event_id, event_id % 2 = 0 AS g, event_id % 3 <> 0 AS p, event_id % 5 <> 0 AS s, event_id % 7 <> 0 AS c, event_id % 11 <> 0 AS b, value <= 60 AS a, value FROM events)
SELECT event_id, g AS gps_time_ready, p AND s AND a AS pi_time_broadcast_ready, c AND b AND p AND s AS background_services_ready, 'eth' || (event_id % 4) AS iface, CASE WHEN p THEN 'active' ELSE 'failed' END AS ptp4l_state, p AS ptp4l_active, b AS bridge_active,
  CASE WHEN g THEN 'PPS' ELSE 'pool' END AS selected, g AS restart_allowed, round(value / 100, 6) AS delta_s, CASE WHEN g AND p AND s AND a THEN 'You can start a PTP capture session.' WHEN NOT g THEN 'Move outside for sky view and wait for GPS time to lock before starting capture.' WHEN NOT s THEN 'Use the Fix Time Broadcast button once GPS time is ready.'
    WHEN NOT a THEN 'Use the Fix Time Broadcast button to restart the broadcast after GPS time is ready.' WHEN NOT (c AND b AND p AND s) THEN 'Check the service details below and restart the missing service.' ELSE 'Refresh timing status after a few seconds.' END AS recommended_action FROM f""")
def status_documents(spark: SparkSession, sf: str) -> DataFrame:
    """The nested document of each event, read back from its text."""
    i, v = F.col("event_id"), F.col("value")
    state = lambda n: F.when(i % n != 0, " active\n").otherwise("failed")
    rows = table(spark, sf, "events").select("event_id", "value", state(3).alias("ptp4l"), state(5).alias("phc2sys"), state(7).alias("chrony"), state(11).alias("bridge"))
    source = F.when(i % 2 == 0, "PPS").otherwise("pool")
    clock = rows.select("event_id", (i % 2 == 0).alias("ready"), source.alias("selected_source"), F.lit("GPS:+").alias("local_states"), F.concat(F.lit("follows "), source).alias("summary"))
    phc = F.struct((v <= 60).alias("ready"), F.round(v / 100, 6).alias("delta_s"), F.when(v <= 30, "aligned").alias("summary"))
    out = status.status_document(rows, iface=F.concat(F.lit("eth"), (i % 4).cast("string")), at=F.lit("2026-03-17T09:40:22+00:00"), chrony=clock, phc=phc, keys=["event_id"])
    read = lambda path, kind="string": F.get_json_object("document", f"$.{path}").cast(kind)
    return out.select(
        "event_id", *[read(n, "boolean").alias(n) for n in ("gps_time_ready", "pi_time_broadcast_ready", "background_services_ready")], read("iface").alias("iface"), read("services.ptp4l.state").alias("ptp4l_state"),
        read("services.ptp4l.active", "boolean").alias("ptp4l_active"), read("services.bridge.active", "boolean").alias("bridge_active"), read("chrony.evaluation.selected_source").alias("selected"),
        read("actions.restart_phc2sys_allowed", "boolean").alias("restart_allowed"), read("phc_alignment.delta_s", "double").alias("delta_s"), read("recommended_action").alias("recommended_action"),
    )
