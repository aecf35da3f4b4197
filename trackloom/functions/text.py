"""Coercions, names, modes and probe texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TRUTHY = ("1", "true", "yes", "on")
#: Column count and scan rate that belong together.
SUPPORTED_RATES = {(1024, 20): "1024x20", (2048, 10): "2048x10", (4096, 5): "4096x5"}


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def truthy(c: Column, default: bool = False) -> Column:
    return F.coalesce(F.lower(F.trim(c.cast("string"))).isin(*TRUTHY), F.lit(default))


def number(c: Column) -> Column:
    """Number or null."""
    return F.trim(c).try_cast("double")


def number_or_nan(c: Column) -> Column:
    return F.coalesce(number(c), F.lit(float("nan")))


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    return F.regexp_replace(basename(path), r"\.[^.]*$", "")


def manifest_label(path: Column) -> Column:
    return F.regexp_replace(stem(path), "^capture_manifest_", "")


def session_id(path: Column) -> Column:
    """The session in a log's name: right after the usual prefix, else the first date_time anywhere; null without one."""
    name = basename(path)
    exact = F.regexp_extract(name, r"^raw_gps_(\d{8}_\d{6})\.", 1)
    return F.coalesce(F.nullif(exact, F.lit("")), F.nullif(F.regexp_extract(name, r"(\d{8}_\d{6})", 1), F.lit("")))


def lidar_mode(c: Column) -> Column:
    """'<columns>x<rate>' without blanks or leading zeros; blank is null, anything else is null too (see :func:`lidar_mode_error`)."""
    t = F.lower(F.trim(c))
    ok = t.rlike(r"^\d+x\d+$")
    part = lambda i: F.split(t, "x")[i].try_cast("int").cast("string")
    return F.when(ok, F.concat_ws("x", part(0), part(1)))


def lidar_mode_error(c: Column) -> Column:
    t = F.trim(c)
    return F.coalesce((t != "") & ~F.lower(t).rlike(r"^\d+x\d+$"), F.lit(False))


def mode_of(columns: Column, rate: Column) -> Column:
    """Mode of a supported pair; null for others."""
    out = F.lit(None).cast("string")
    for (n, hz), name in SUPPORTED_RATES.items():
        out = F.when((columns == n) & (rate == hz), name).otherwise(out)
    return out


def attempts(seconds: Column) -> Column:
    """Capture lengths to try: at least a second, and ten if that was shorter."""
    first = F.greatest(F.lit(1), seconds.cast("int"))
    return F.when(first < 10, F.array(first, F.lit(10))).otherwise(F.array(first))


def other_profile(c: Column) -> Column:
    """The profile to flip to and back; null for unknown ones."""
    t = F.lower(F.trim(c))
    return F.when(t == "default", "gptp").when(t == "gptp", "default")


def phc_seconds(c: Column) -> Column:
    """Seconds out of a clock probe; null if it holds none."""
    return F.regexp_extract(c, r"clock time is (\d+\.\d+)", 1).try_cast("double")


def iso_epoch_ns(c: Column) -> Column:
    """ISO 8601 text to nanoseconds; no zone means UTC (the session's zone), blank or broken is null."""
    return F.unix_micros(blank_to_null(c).try_cast("timestamp")) * 1000


def iso_time_text(c: Column) -> Column:
    """Its time of day as text, blank if there is none."""
    return F.coalesce(F.date_format(blank_to_null(c).try_cast("timestamp"), "HH:mm:ss.SSSSSS"), F.lit(""))


def service_state(stdout: Column, stderr: Column) -> Column:
    return F.coalesce(blank_to_null(stdout), blank_to_null(stderr), F.lit("unknown"))


def first_json_value(c: Column, key: str) -> Column:
    """First value of ``key`` at any depth, as text, in document order."""
    return F.nullif(F.regexp_extract(c, rf'"{key}"\s*:\s*"?([^",}}\]]*)', 1), F.lit(""))


def flag(name: str, on: Column) -> Column:
    """'--name' or '--no-name'."""
    return F.when(on, f"--{name}").otherwise(f"--no-{name}")


def option(name: str, value: Column) -> Column:
    """['--name', value], or nothing if the value is blank."""
    return F.when(blank_to_null(value).isNotNull(), F.array(F.lit(f"--{name}"), F.trim(value))).otherwise(F.array().cast("array<string>"))


def capture_arguments(mode: Column, gps_mode: Column, *, flags: dict[str, Column], options: dict[str, Column]) -> Column:
    """Arguments of a capture run; null for an unknown capture or fix input mode."""
    good = F.coalesce(blank_to_null(mode), F.lit("ptp")).isin("ptp", "original") & F.coalesce(blank_to_null(gps_mode), F.lit("bridge")).isin("serial", "gpsd", "bridge")
    parts = F.concat(F.array(*[flag(k, v) for k, v in flags.items()]), *[option(k, v) for k, v in options.items()])
    return F.when(good, parts)
