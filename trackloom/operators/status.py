"""Readiness of clocks and sensors from captured text and JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import phc_seconds

#: Names of the local reference clocks, and limits in seconds.
LOCAL_CLOCKS = ("GPS", "PPS")
PHC_LIMIT_S, SENSOR_LIMIT_S, WINDOW_SLOP_S = 0.05, 1.0, 5.0
STATUS_SCHEMA = (
    "timestamp_mode string, ptp struct<port_data_set:struct<port_state:string>,time_status_np:struct<gm_present:boolean>,parent_data_set:struct<grandmaster_identity:string>>,"
    "time struct<sensor:struct<timestamp:struct<time:double>>>"
)


def clock_sources(df: DataFrame, text: str, *, keys: Sequence[str]) -> DataFrame:
    """One row per source line of a clock daemon's listing: mode, state, name, and its place."""
    lines = df.select(*keys, F.posexplode(F.split(text, "\n")).alias("ord", "line"))
    pattern = r"^([#^=])([*+\-?x~])\s*(\S+)"
    part = lambda i: F.regexp_extract("line", pattern, i)
    return lines.where(F.col("line").rlike(pattern)).select(*keys, "ord", part(1).alias("mode"), part(2).alias("state"), part(3).alias("name"))


#: What the capture program and the timing helper say of a clock, in this order: nothing printed by the wait,
#: no local source, none selected, another one selected (before and after its name), a local one selected (before and after).
CAPTURE_TEXTS = (
    "chronyc waitsync not yet satisfied",
    "chrony waitsync passed, but GPS/PPS refclocks were not present in `chronyc sources -v`.",
    "chrony waitsync passed, but no selected source was reported.",
    "chrony is synchronized to ", " instead of GPS/PPS.",
    "chrony synchronized to local source ", ".",
)
HELPER_TEXTS = (
    "Pi time has not settled yet.",
    "GPS/PPS timing sources are not showing up yet.",
    "A timing source is visible, but none is selected yet.",
    "Pi time is still following ", " instead of local GPS/PPS.",
    "Pi time is locked to local ", ".",
)


def clock_sync(sources: DataFrame, returncodes: DataFrame, *, keys: Sequence[str], texts: Sequence[str] = CAPTURE_TEXTS) -> DataFrame:
    """Ready if waiting for sync succeeded and the first selected source is a local one; states of the local sources; a summary.

    ``returncodes`` holds the wait's ``returncode`` and, where captured, its ``stdout`` and ``stderr``, which a failed wait's summary repeats.
    """
    local = F.col("name").isin(*LOCAL_CLOCKS)
    per = sources.groupBy(*keys).agg(
        F.min_by("name", F.when(F.col("state") == "*", F.col("ord"))).alias("_name"),
        F.count_if(F.col("state") == "*").alias("_selected"),
        F.array_sort(F.collect_set(F.when(local, F.concat_ws(":", "name", "state")))).alias("_local"),
    )
    both = returncodes.join(per, list(keys), "left")
    name = F.when(F.col("_selected") > 0, F.col("_name"))
    is_local = F.coalesce(name.isin(*LOCAL_CLOCKS), F.lit(False))
    waited = F.coalesce(F.col("returncode") == 0, F.lit(False))
    said = [F.nullif(F.col(c), F.lit("")) for c in ("stdout", "stderr") if c in returncodes.columns]
    summary = (
        F.when(~waited, F.coalesce(*said, F.lit(texts[0]))).when(F.coalesce(F.size("_local"), F.lit(0)) <= 0, texts[1]).when(name.isNull(), texts[2])
        .when(~is_local, F.concat(F.lit(texts[3]), name, F.lit(texts[4]))).otherwise(F.concat(F.lit(texts[5]), name, F.lit(texts[6])))
    )
    return both.select(*keys, (waited & is_local).alias("ready"), name.alias("selected_source"), F.coalesce(F.concat_ws(",", "_local"), F.lit("")).alias("local_states"), summary.alias("summary"))


def ptp_locked(status: Column) -> Column:
    """Locked to a grandmaster: PTP time if the mode is known, port is slave in any case, and a grandmaster is present or named."""
    mode, port = status["timestamp_mode"], status["ptp"]["port_data_set"]["port_state"]
    present, named = status["ptp"]["time_status_np"]["gm_present"], status["ptp"]["parent_data_set"]["grandmaster_identity"]
    ok = (mode.isNull() | (mode == "TIME_FROM_PTP_1588")) & (F.upper(port) == "SLAVE") & F.coalesce(present, F.lit(True)) & (present.isNotNull() | (F.coalesce(named, F.lit("")) != ""))
    return F.coalesce(ok, F.lit(False))


def sensor_seconds(status: Column) -> Column:
    return status["time"]["sensor"]["timestamp"]["time"]


def aligned(a: Column, b: Column, limit: float) -> Column:
    return F.coalesce(F.abs(a - b) <= limit, F.lit(False))


def phc_alignment(df: DataFrame, a: str, b: str, limit: float = PHC_LIMIT_S) -> DataFrame:
    """Difference of two clock probes and whether it is within the limit; text that holds no time is an error row."""
    x, y = phc_seconds(F.col(a)), phc_seconds(F.col(b))
    return df.withColumns({"delta_s": x - y, "ready": aligned(x, y, limit), "error": F.when(x.isNull() | y.isNull(), "no clock time in probe")})


def window_contains(df: DataFrame, *, before: str, after: str, first_ns: str, last_ns: str, slop_s: float = WINDOW_SLOP_S) -> DataFrame:
    """Adds ``inside``: both ends of the capture lie between the sensor's times before and after, give or take the slop."""
    lo, hi = F.col(before) - slop_s, F.col(after) + slop_s
    s = lambda c: F.col(c).cast("double") / 1e9
    return df.withColumn("inside", F.coalesce(s(first_ns).between(lo, hi) & s(last_ns).between(lo, hi), F.lit(False)))


def gate(polls: DataFrame, *, keys: Sequence[str], time: str, ready: str, timeout_ns: int | None) -> DataFrame:
    """When a polled gate opened, if it did before its deadline; without a deadline it may open at any time."""
    per = polls.groupBy(*keys).agg(F.min(time).alias("started"), F.min(F.when(F.col(ready), F.col(time))).alias("opened"))
    ok = F.col("opened").isNotNull() & (F.lit(timeout_ns is None) | (F.col("opened") - F.col("started") <= F.lit(timeout_ns or 0)))
    return per.select(*keys, "started", F.when(ok, F.col("opened")).alias("opened"), ok.alias("passed"))


SERVICES = ("chrony", "bridge", "ptp4l", "phc2sys")
#: Fixed values: (summary, recommended action) by state; an empty summary repeats the clock's or the broadcast's own.
ROLL_UP = {
    "ready": ("Timing stack looks ready for PTP capture.", "You can start a PTP capture session."),
    "no gps time": ("", "Move outside for sky view and wait for GPS time to lock before starting capture."),
    "no broadcast": ("Pi time broadcast is not running yet.", "Use the Fix Time Broadcast button once GPS time is ready."),
    "broadcast not aligned": ("", "Use the Fix Time Broadcast button to restart the broadcast after GPS time is ready."),
    "service missing": ("One or more background timing services are not running.", "Check the service details below and restart the missing service."),
    "partly ready": ("Timing stack is partially ready.", "Refresh timing status after a few seconds."),
}
BROADCAST_UNKNOWN, BROADCAST_OFF = "Pi time broadcast status unavailable.", "Pi time broadcast is not aligned yet."
RESTART_OK = "GPS time is ready, so the Pi time broadcast can be restarted safely."
RESTART_WAIT = "Wait for GPS/PPS lock before restarting the Pi time broadcast."


def roll_up(df: DataFrame) -> DataFrame:
    """The status document's own fields, most urgent state first.

    From the flags ``gps_ready``, ``phc_ready`` and one for each of SERVICES (active), and the clock's and the
    broadcast's summaries ``gps_time_summary`` and ``phc_summary``.
    """
    stack = F.forall(F.array(*SERVICES), lambda x: x)
    broadcast = F.col("ptp4l") & F.col("phc2sys") & F.col("phc_ready")
    state = (
        F.when(F.col("gps_ready") & broadcast, "ready").when(~F.col("gps_ready"), "no gps time").when(~F.col("phc2sys"), "no broadcast")
        .when(~F.col("phc_ready"), "broadcast not aligned").when(~stack, "service missing").otherwise("partly ready")
    )
    phc = F.nullif(F.col("phc_summary"), F.lit(""))
    own = F.when(F.col("state") == "no gps time", F.col("gps_time_summary")).when(F.col("state") == "broadcast not aligned", F.coalesce(phc, F.lit(BROADCAST_OFF)))
    said = lambda i: F.create_map(*[F.lit(x) for k, v in ROLL_UP.items() for x in (k, v[i])])[F.col("state")]
    active = sum((F.col(c).cast("int") for c in SERVICES), F.lit(0))
    return df.withColumn("state", state).withColumns({
        "gps_time_ready": F.col("gps_ready"), "pi_time_broadcast_ready": broadcast, "pi_time_broadcast_summary": F.coalesce(phc, F.lit(BROADCAST_UNKNOWN)),
        "background_services_ready": stack, "background_services_summary": F.concat(active.cast("string"), F.lit(f"/{len(SERVICES)} timing services running.")),
        "summary": F.coalesce(own, said(0)), "recommended_action": said(1), "restart_phc2sys_allowed": F.col("gps_ready"),
        "restart_phc2sys_reason": F.when(F.col("gps_ready"), RESTART_OK).otherwise(RESTART_WAIT),
    })


def service(state: Column) -> Column:
    """A service's entry of the status document: its state as printed, and whether it is active."""
    printed = F.btrim(state, F.lit(" \t\r\n"))
    return F.struct((printed == "active").alias("active"), printed.alias("state"))


def status_document(df: DataFrame, *, iface: Column, at: Column, chrony: DataFrame, phc: Column, keys: Sequence[str]) -> DataFrame:
    """Adds ``document``, the whole nested status, and the flat fields of :func:`roll_up`.

    ``df`` has the printed state of each of SERVICES; ``chrony`` is the result of :func:`clock_sync` per key; ``phc`` a
    struct with ``ready`` and ``summary`` of the broadcast's alignment, among others.
    """
    states = {n: f"_state_{n}" for n in SERVICES}
    held = df.withColumns({c: F.col(n) for n, c in states.items()} | {"_phc": phc, "iface": iface, "timestamp": at})
    clock = chrony.select(*keys, F.struct("ready", "selected_source", "local_states", "summary").alias("_chrony"))
    both = held.join(clock, list(keys), "left")
    active = {n: F.coalesce(service(F.col(c))["active"], F.lit(False)) for n, c in states.items()}
    flags = {"gps_ready": F.coalesce("_chrony.ready", F.lit(False)), "gps_time_summary": F.col("_chrony.summary"), "phc_ready": F.coalesce("_phc.ready", F.lit(False)), "phc_summary": F.col("_phc.summary")}
    rolled = roll_up(both.withColumns(active | flags))
    said = ("gps_time_ready", "gps_time_summary", "pi_time_broadcast_ready", "pi_time_broadcast_summary", "background_services_ready", "background_services_summary", "summary", "recommended_action")
    parts = [
        "timestamp", "iface", *said, F.struct("restart_phc2sys_allowed", "restart_phc2sys_reason").alias("actions"), F.struct(*[service(F.col(c)).alias(n) for n, c in states.items()]).alias("services"),
        F.struct(F.col("gps_time_ready").alias("ready"), F.col("_chrony").alias("evaluation")).alias("chrony"), F.col("_phc").alias("phc_alignment"),
    ]
    return rolled.withColumn("document", F.to_json(F.struct(*parts), {"ignoreNullFields": "false"})).select(*keys, *said, "document")


#: What must hold for a fresh capture to count as aligned.
CAPTURE_CHECKS = ("phc_ready", "locked_before", "locked_after", "aligned_before", "aligned_after", "file_ready", "window_ready")


def capture_verdict(df: DataFrame) -> DataFrame:
    """Adds ``passed``, the AND of CAPTURE_CHECKS (null counts as not passed), and ``failed``, the names of those that are not."""
    flags = {c: F.coalesce(F.col(c), F.lit(False)) for c in CAPTURE_CHECKS}
    failed = F.filter(F.array(*[F.when(~f, F.lit(c)) for c, f in flags.items()]), lambda x: x.isNotNull())
    return df.withColumn("failed", failed).withColumn("passed", F.size("failed") == 0)


def pulse_count(df: DataFrame, text: str, *, least: int = 2) -> DataFrame:
    """Adds ``asserts``, the lines of a pulse test's output that hold 'assert', and ``pulsing``, whether there are enough."""
    n = F.size(F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda line: line.contains("assert")))
    return df.withColumn("asserts", n).withColumn("pulsing", F.col("asserts") >= least)


def verdict(locked: Column, synced: Column) -> Column:
    """Smoke verdict of two flags."""
    return F.when(locked & synced, "PASS").when(locked, "PARTIAL: clock").when(synced, "PARTIAL: lock").otherwise("FAIL")


def wifi_rows(df: DataFrame, text: str, *, keys: Sequence[str]) -> DataFrame:
    """NAME:TYPE:DEVICE lines of wireless connections, in order."""
    rows = df.select(*keys, F.posexplode(F.split(text, "\n")).alias("ord", "line"))
    part = lambda i: F.get(F.split("line", ":"), F.lit(i))
    return rows.where(part(1).isin("wifi", "802-11-wireless")).select(*keys, "ord", part(0).alias("name"), part(2).alias("device"))


#: What text probes are searched for.
PROBES = {
    "nmea": r"\$G[A-Z]GGA|\$G[A-Z]RMC",
    "leap_normal": r"Leap status\s*:\s*Normal",
    "selected_source": r"(?m)^[#^=]\*",
    "local_selected": r"(?m)^#\*\s*(PPS|GPS)",
    "ptp_clock": r"PTP Hardware Clock: \d+",
    "slave": r'"port_state"\s*:\s*"SLAVE"',
}


def probe(df: DataFrame, text: str, *, keys: Sequence[str]) -> DataFrame:
    """One row per probe text and rule: PASS or FAIL."""
    rules = F.array(*[F.struct(F.lit(k).alias("check"), F.when(F.col(text).rlike(p), "PASS").otherwise("FAIL").alias("level")) for k, p in PROBES.items()])
    return df.select(*keys, F.explode(rules).alias("r")).select(*keys, "r.check", "r.level")


def helper_document(df: DataFrame, *, returncode: str, stdout: str, stderr: str) -> DataFrame:
    """Adds ``document`` (a JSON object's text) and ``error``: a failed call's message, or that its output is no JSON object."""
    said = F.coalesce(F.nullif(F.trim(stdout), F.lit("")), F.lit("{}"))
    parsed = F.try_parse_json(said)
    failed = F.coalesce(F.nullif(F.trim(stderr), F.lit("")), F.nullif(F.trim(stdout), F.lit("")), F.concat(F.lit("exit code "), F.col(returncode).cast("string")))
    error = F.when(F.col(returncode) != 0, failed).when(parsed.isNull(), "invalid JSON").when(~F.schema_of_variant(parsed).startswith("OBJECT"), "not an object")
    return df.withColumn("error", error).withColumn("document", F.when(F.col("error").isNull(), said))


def timing_snapshot(documents: DataFrame) -> DataFrame:
    """Flags and summary out of ``document``; a row with an error gets the same shape, all flags off and the error as text."""
    flags = ("gps_time_ready", "pi_time_broadcast_ready", "background_services_ready")
    value = lambda k: F.get_json_object("document", f"$.{k}")
    return documents.withColumns(
        {k: F.coalesce(value(k) == "true", F.lit(False)) for k in flags}
        | {"ok": F.col("error").isNull(), "summary": F.coalesce(value("summary"), F.lit("status unavailable")), "recommended_action": F.coalesce(value("recommended_action"), F.col("error"), F.lit(""))}
    )


def sensor_facts(info: Column) -> Column:
    """Model, serial, firmware and a hint at the inertial rate, each under the keys that different firmwares use; '-' where unknown."""
    value = lambda *ks: F.coalesce(*[F.nullif(F.get_json_object(info, f"$.{k}"), F.lit("")) for k in ks], F.lit("-"))
    build, image = value("build_rev", "image_rev"), value("image_rev")
    firmware = F.when(build == "-", image).when(image == "-", build).otherwise(F.concat_ws(" ", build, image))
    return F.struct(
        value("prod_line", "product_line").alias("model"), value("prod_sn", "serial_no").alias("serial"), firmware.alias("firmware"),
        F.when(F.lower(firmware).contains("v3.2"), "640").otherwise("-").alias("imu_rate_hint_hz"),
    )


def preflight(clock: DataFrame, sensor: DataFrame, *, keys: Sequence[str]) -> DataFrame:
    """One readiness row per key out of :func:`clock_sync` and sensor status text (status, info, error as captured)."""
    s = F.from_json("status", STATUS_SCHEMA)
    facts = sensor.select(*keys, ptp_locked(s).alias("locked"), sensor_seconds(s).alias("sensor_s"), sensor_facts(F.col("info")).alias("facts"), F.col("error").alias("sensor_error"))
    both = clock.join(facts, list(keys), "left")
    return both.withColumn("locked", F.coalesce("locked", F.lit(False))).withColumn("go", F.col("ready") & F.col("locked"))
