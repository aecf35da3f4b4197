"""Live fixes and logs with Structured Streaming."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import nmea
from ..operators.logs import FIX_LINE, FLAGS, PHASES, after, chunk_of


def _ddl(df: DataFrame, names: Sequence[str]) -> str:
    kinds = dict(df.dtypes)
    return ", ".join(f"`{n}` {kinds[n]}" for n in names)


def fresh(df: DataFrame, start_ns: int, time: str = "pi_time_ns") -> DataFrame:
    """Fixes stamped at or after the session's start; the bound is fixed and never advances."""
    return df.where(F.col(time) >= start_ns)


def carry(df: DataFrame, values: Sequence[str], *, keys: Sequence[str], order: str) -> DataFrame:
    """Streaming form of carrying the latest value: the state of a key is one value per column.

    Whole numbers travel as text, since beside nulls they would turn into floats and lose digits.
    """
    kinds = dict(df.dtypes)
    whole = [v for v in values if kinds[v] in ("tinyint", "smallint", "int", "bigint")]
    rows = df.withColumns({v: F.col(v).cast("string") for v in whole})
    moved = dict(rows.dtypes)
    state_schema = ", ".join(f"`s_{v}` {moved[v]}" for v in values)

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = list(state.get) if state.exists else [None] * len(values)
        rows = pd.concat(list(batches)).sort_values(order, kind="stable")
        for i, v in enumerate(values):
            filled, out = last[i], []
            for x in rows[v].tolist():
                filled = filled if x is None or x != x else x
                out.append(filled)
            rows[v], last[i] = pd.Series(out, index=rows.index, dtype=object), filled
        state.update(tuple(last))
        yield rows

    out = rows.groupBy(*keys).applyInPandasWithState(run, _ddl(rows, rows.columns), state_schema, "append", GroupStateTimeout.NoTimeout)
    return out.select(*[F.col(c).cast(kinds[c]).alias(c) if c in whole else F.col(c) for c in df.columns])


def drop_repeats(df: DataFrame, *, keys: Sequence[str], order: str, sequence: str, signature: Sequence[str]) -> DataFrame:
    """Rows that differ from the last one of their key, by number, or by signature where there is none; the number must be whole to be remembered.

    Both are compared as text: the number's digits, and the signature as one JSON object, so no digit or separator is lost.
    """
    rows = df.withColumns({"_number": F.col(sequence).cast("bigint").cast("string"), "_sig": F.to_json(F.struct(*signature), {"ignoreNullFields": "false"})})

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        number, sig = state.get if state.exists else (None, None)
        keep = []
        rows = pd.concat(list(batches)).sort_values(order, kind="stable")
        for n, s in zip(rows["_number"].tolist(), rows["_sig"].tolist(), strict=True):
            keep.append(n != number if n is not None else s != sig)
            number, sig = number if n is None else n, s
        state.update((number, sig))
        yield rows[keep][["_row"]]

    packed = rows.select(*keys, order, "_number", "_sig", F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("_row"))
    kept = packed.groupBy(*keys).applyInPandasWithState(run, "_row string", "number string, sig string", "append", GroupStateTimeout.NoTimeout)
    return kept.select(F.from_json("_row", df.schema).alias("r")).select("r.*")


def nmea_fixes(df: DataFrame, *, keys: Sequence[str], order: str = "ord", text: str = "value") -> DataFrame:
    """Fix rows of a sentence stream; parsing is column work, only the latest date is state."""
    parsed = nmea.frame(df, text).select(*keys, order, F.unix_date(nmea.rmc_date(F.col(text))).cast("long").alias("day"), F.to_json(nmea.gga(F.col(text))).alias("fix"))
    dated = carry(parsed, ["day"], keys=keys, order=order).where("fix is not null")
    f = F.from_json("fix", "us_of_day long, gps_quality int, num_sats string, hdop string, latitude double, longitude double, altitude_m double")
    rows = dated.withColumn("f", f)
    return rows.select(*keys, order, (F.col("day") * 86400000000000 + F.col("f.us_of_day") * 1000).alias("gps_epoch_ns"), *[F.col(f"f.{c}").alias(c) for c in ("gps_quality", "num_sats", "hdop", "latitude", "longitude", "altitude_m")])


def gpsd_fixes(df: DataFrame, *, keys: Sequence[str], order: str = "ord", text: str = "value") -> DataFrame:
    """Position reports of a tagged JSON stream, with the latest sky report's hdop and satellites used."""
    doc = F.from_json(text, "class string, mode int, lat double, lon double, altMSL double, altHAE double, alt double, time string, hdop double, uSat int, satellites array<struct<used:boolean>>")
    rows = df.withColumn("d", doc)
    sky = F.col("d.class") == "SKY"
    used = F.coalesce("d.uSat", F.size(F.filter("d.satellites", lambda s: F.coalesce(s["used"], F.lit(False)))))
    ok = (F.col("d.class") == "TPV") & (F.col("d.mode") >= 2) & F.col("d.lat").isNotNull() & ~F.isnan("d.lat") & F.col("d.lon").isNotNull() & ~F.isnan("d.lon")
    flat = rows.select(
        *keys, order, F.when(sky, F.col("d.hdop")).alias("hdop"), F.when(sky & (used >= 0), used).alias("num_sats"), F.coalesce(ok, F.lit(False)).alias("is_fix"),
        F.col("d.lat").alias("latitude"), F.col("d.lon").alias("longitude"), F.coalesce("d.altMSL", "d.altHAE", "d.alt", F.lit(float("nan"))).alias("altitude_m"), F.col("d.time").alias("gps_utc_time"),
    )
    return carry(flat, ["hdop", "num_sats"], keys=keys, order=order).where("is_fix").drop("is_fix")


def log_states(df: DataFrame, *, keys: Sequence[str], order: str = "ord", text: str = "text") -> DataFrame:
    """The log state machine over a stream: flags that stay, latest phase, chunk and paths."""
    t = F.col(text)
    phase = F.lit(None).cast("string")
    for pattern, name in PHASES:
        phase = F.when(t.rlike(pattern), name).otherwise(phase)
    marked = df.withColumns({k: F.when(t.rlike(p), True) for k, p in FLAGS.items()} | {"phase": phase, "current_chunk_index": chunk_of(t), "gps_csv_path": after(t, "GPS CSV:"), "manifest_path": after(t, "Manifest:")})
    names = [*FLAGS, "phase", "current_chunk_index", "gps_csv_path", "manifest_path"]
    return carry(marked, names, keys=keys, order=order).fillna(False, subset=list(FLAGS))


def surfaced(df: DataFrame, *, keys: Sequence[str], order: str = "ord", text: str = "text") -> DataFrame:
    """The streaming form of :func:`logs.surfaced`: all lines but fix lines, and of those the first in each context; the state is two chunk numbers."""
    rows = df.withColumns({"_chunk": chunk_of(F.col(text)).cast("string"), "_fix": F.coalesce(F.col(text).contains(FIX_LINE), F.lit(False))})

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        chunk, seen = state.get if state.exists else ("-1", None)
        lines = sorted((line for b in batches for line in zip(b[order].tolist(), b["_chunk"].tolist(), b["_fix"].tolist(), b["_row"].tolist(), strict=True)), key=lambda x: x[0])
        kept = []
        for _, c, fix, row in lines:
            chunk = c if isinstance(c, str) else chunk
            if not fix or seen != chunk:
                kept.append(row)
            seen = chunk if fix else seen
        state.update((chunk, seen))
        yield pd.DataFrame({"_row": kept}, dtype=object)

    packed = rows.select(*keys, order, "_chunk", "_fix", F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("_row"))
    shown = packed.groupBy(*keys).applyInPandasWithState(run, "_row string", "chunk string, seen string", "append", GroupStateTimeout.NoTimeout)
    return shown.select(F.from_json("_row", df.schema).alias("r")).select("r.*")


def tumble(df: DataFrame, time: str, width: str, *, keys: Sequence[str] = (), late: str | None = None) -> DataFrame:
    """Rows, first and last time of each fixed window; with ``late`` a stream's windows close after that delay."""
    rows = df.withWatermark(time, late) if late else df
    return rows.groupBy(*keys, F.window(time, width).alias("w")).agg(F.count("*").alias("n"), F.min(time).alias("first"), F.max(time).alias("last")).select(*keys, F.col("w.start").alias("start"), "n", "first", "last")


def chunk_of_time(rows: DataFrame, chunks: DataFrame, *, time: str = "t_ns", keys: Sequence[str] = ("session_id",)) -> DataFrame:
    """Rows with the index of the interval (ends included) that their session recorded at their time, if any."""
    both = [k for k in keys if k in rows.columns and k in chunks.columns]
    c = chunks.select(*[F.col(k).alias(f"_{k}") for k in both], *[x for x in chunks.columns if x not in both])
    inside = (F.col(time) >= F.col("capture_start_ns")) & (F.col(time) <= F.col("capture_end_ns"))
    for k in both:
        inside = inside & (F.col(k) == F.col(f"_{k}"))
    return rows.join(c, inside, "left").drop(*[f"_{k}" for k in both])


def fuse_stream(points: DataFrame, track: DataFrame, *, keys: Sequence[str] = ("session_id",), time: str = "t_ns", values: Sequence[str] = ("easting", "northing", "altitude_m"), bin_ns: int = 1_000_000_000) -> DataFrame:
    """A point stream laid on a recorded track: a stream-static join on session and bin of time, then linear interpolation.

    The track's segments are cut into bins, so the join has equal keys and no state; points outside the track are dropped.
    """
    knot = F.struct(F.col(time).alias("t"), *values)
    w = Window.partitionBy(*keys).orderBy(time)
    end = F.struct((F.col(time) + 1).alias("t"), *values)  # the last knot holds for its own time only
    segments = track.select(*keys, knot.alias("_a"), F.coalesce(F.lead(knot).over(w), end).alias("_b"))
    bins = F.sequence(F.expr(f"_a.t div {bin_ns}"), F.expr(f"(_b.t - 1) div {bin_ns}"))
    segments = segments.where("_a.t < _b.t").select(*keys, "_a", "_b", F.explode(bins).alias("_bin"))
    met = points.withColumn("_bin", F.expr(f"{time} div {bin_ns}")).join(segments, [*keys, "_bin"])
    met = met.where((F.col(time) >= F.col("_a.t")) & (F.col(time) < F.col("_b.t")))
    share = (F.col(time) - F.col("_a.t")).cast("double") / (F.col("_b.t") - F.col("_a.t")).cast("double")
    return met.select(*points.columns, *[(F.col("_a")[v] + (F.col("_b")[v] - F.col("_a")[v]) * share).alias(v) for v in values])
