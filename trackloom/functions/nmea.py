"""NMEA 0183 sentences: checksum, fields, times, coordinates and fixes, all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.asof import carry_last

#: Two-digit years from this one on belong to the last century.
YEAR_PIVOT = 80


def body(sentence: Column) -> Column:
    """What the checksum covers: between '$' and '*'."""
    return F.regexp_extract(sentence, r"^\$([^*]*)", 1)


def _once(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it is named."""
    return F.transform(F.array(value), use)[0]


def checksum(text: Column) -> Column:
    """XOR of the characters, as a number."""
    codes = F.transform(F.split(text, ""), lambda c: F.ascii(c))
    return F.aggregate(codes, F.lit(0), lambda a, b: a.bitwiseXOR(b))


def checksum_ok(sentence: Column) -> Column:
    given = F.regexp_extract(sentence, r"^\$[^*]*\*([0-9A-Fa-f]{2})", 1)
    return F.coalesce((given != "") & (checksum(body(sentence)) == F.conv(given, 16, 10).cast("int")), F.lit(False))


def fields(sentence: Column) -> Column:
    return F.split(body(sentence), ",")


def kind(sentence: Column) -> Column:
    """RMC, GGA, ...: the last three letters of the first field."""
    return _kind(fields(sentence))


def _kind(f: Column) -> Column:
    return F.right(F.get(f, F.lit(0)), F.lit(3))


def time_of_day_us(value: Column) -> Column:
    """hhmmss[.f...] as microseconds of the day; null if too short, not a number or out of range."""
    ok = value.rlike(r"^\d{6}(\.\d*)?$")
    h, m, s = (F.substring(value, p, 2).try_cast("int") for p in (1, 3, 5))
    frac = F.rpad(F.substring(F.concat(F.regexp_extract(value, r"\.(\d*)$", 1), F.lit("000000")), 1, 6), 6, "0").try_cast("long")
    good = ok & (h < 24) & (m < 60) & (s < 60)
    return F.when(good, (h * 3600 + m * 60 + s).cast("long") * 1000000 + frac)


def date(value: Column) -> Column:
    """ddmmyy as a date; null if it is none."""
    ok = value.rlike(r"^\d{6}$")
    yy = F.substring(value, 5, 2).try_cast("int")
    year = F.when(yy >= YEAR_PIVOT, yy + 1900).otherwise(yy + 2000)
    text = F.concat_ws("-", year.cast("string"), F.substring(value, 3, 2), F.substring(value, 1, 2))
    return F.when(ok, text.try_cast("date"))


def epoch_ns(day: Column, us_of_day: Column) -> Column:
    """Exact nanoseconds since 1970; null if either part is missing."""
    return F.unix_date(day).cast("long") * 86400000000000 + us_of_day * 1000


def epoch_ns_via_float(day: Column, us_of_day: Column) -> Column:
    """The same through a double of seconds: off by up to 240 ns, for comparison with such logs."""
    us = F.unix_date(day).cast("long") * 86400000000 + us_of_day
    return (us.cast("double") / 1e6 * 1e9).cast("long")


def coordinate(value: Column, hemisphere: Column, latitude: bool) -> Column:
    """ddmm.mmmm or dddmm.mmmm with a hemisphere letter, as signed degrees."""
    n = 2 if latitude else 3
    degrees, minutes = F.substring(value, 1, n).try_cast("double"), F.substring(value, n + 1, 40).try_cast("double")
    sign = F.when(hemisphere.isin("N", "E"), 1.0).when(hemisphere.isin("S", "W"), -1.0)
    return F.when(value.rlike(rf"^\d{{{n}}}"), sign * (degrees + minutes / 60))


def rmc_date(sentence: Column) -> Column:
    """Date of a valid RMC sentence with status A."""
    return _rmc_date(fields(sentence), checksum_ok(sentence))


def _rmc_date(f: Column, valid: Column) -> Column:
    return F.when((_kind(f) == "RMC") & valid & (F.size(f) >= 10) & (F.get(f, F.lit(2)) == "A"), date(F.get(f, F.lit(9))))


def rmc_epoch_us(sentence: Column) -> Column:
    """Microseconds since 1970 of a valid RMC sentence."""
    return epoch_ns(rmc_date(sentence), time_of_day_us(F.get(fields(sentence), F.lit(1)))) / 1000


def gga(sentence: Column) -> Column:
    """A fix as a struct; null without a valid checksum, quality or position. The time may be missing; so may the altitude (NaN)."""
    return _gga(fields(sentence), checksum_ok(sentence))


def _gga(f: Column, valid: Column) -> Column:
    at = lambda i: F.get(f, F.lit(i))
    lat, lon = coordinate(at(2), at(3), True), coordinate(at(4), at(5), False)
    quality = at(6).try_cast("int")
    ok = (_kind(f) == "GGA") & valid & (F.size(f) >= 10) & (quality > 0) & lat.isNotNull() & lon.isNotNull()
    return F.when(ok, F.struct(
        time_of_day_us(at(1)).alias("us_of_day"), quality.alias("gps_quality"), F.nullif(at(7), F.lit("")).alias("num_sats"), F.nullif(at(8), F.lit("")).alias("hdop"),
        lat.alias("latitude"), lon.alias("longitude"), F.coalesce(at(9).try_cast("double"), F.lit(float("nan"))).alias("altitude_m"),
    ))


def frame(raw: DataFrame, text: str = "value") -> DataFrame:
    """Lines that hold a sentence, cut to start at its '$'."""
    return raw.withColumn(text, F.trim(F.regexp_extract(text, r"(\$[^\r\n]*)", 1))).where(F.col(text).startswith("$"))


def fixes(sentences: DataFrame, *, keys: list[str], order: str = "ord", text: str = "value") -> DataFrame:
    """One row per valid GGA sentence; its date is that of the latest RMC sentence before it in the stream."""
    # Fields first, then the checksum of the two kinds that count, once a line.
    cut = sentences.withColumn("_f", fields(F.col(text))).where(_kind(F.col("_f")).isin("RMC", "GGA")).where(checksum_ok(F.col(text)))
    parsed = cut.withColumns({"_date": _rmc_date(F.col("_f"), F.lit(True)), "_fix": _gga(F.col("_f"), F.lit(True))})
    dated = carry_last(parsed, ["_date"], keys=keys, order=order).where("_fix is not null")
    return dated.select(*keys, order, epoch_ns(F.col("_date"), F.col("_fix.us_of_day")).alias("gps_epoch_ns"), *[F.col(f"_fix.{c}").alias(c) for c in ("gps_quality", "num_sats", "hdop", "latitude", "longitude", "altitude_m")])


def gga_sentence(us_of_day: Column, lat: Column, lon: Column, quality: Column, sats: Column, hdop: Column, altitude: Column) -> Column:
    """A GGA sentence with its checksum (for tests and replays)."""
    def dm(v: Column, width: int, pos: str, neg: str) -> list[Column]:
        a = F.abs(v)
        d = F.floor(a)
        return [F.concat(F.lpad(d.cast("string"), width, "0"), F.lpad(F.format_string("%.6f", (a - d) * 60), 9, "0")), F.when(v >= 0, pos).otherwise(neg)]

    text = F.concat_ws(",", F.lit("GPGGA"), _clock(us_of_day), *dm(lat, 2, "N", "S"), *dm(lon, 3, "E", "W"), quality.cast("string"), sats.cast("string"), hdop.cast("string"), F.format_string("%.2f", altitude), F.lit("M"), F.lit("0.0"), F.lit("M"), F.lit(""), F.lit(""))
    return _signed(text)


def rmc_sentence(day: Column, us_of_day: Column) -> Column:
    """An RMC sentence that only tells date and time."""
    return _signed(F.concat_ws(",", F.lit("GPRMC"), _clock(us_of_day), F.lit("A"), *[F.lit("")] * 6, F.date_format(day, "ddMMyy"), F.lit(""), F.lit(""), F.lit("A")))


def _clock(us: Column) -> Column:
    s = F.floor(us / 1000000)
    return F.format_string("%02d%02d%02d.%06d", F.floor(s / 3600).cast("long"), F.floor(s / 60).cast("long") % 60, s % 60, us % 1000000)


def _signed(text: Column) -> Column:
    return _once(text, lambda t: F.concat(F.lit("$"), t, F.lit("*"), F.lpad(F.hex(checksum(t)), 2, "0")))
