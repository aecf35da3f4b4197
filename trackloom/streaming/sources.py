"""Live readers: a file that always holds the latest fix, and bytes that are framed into sentences."""

from __future__ import annotations

import json
import math
import os
import time
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.running import running_sum
from ..sinks import write_json_atomic
from ..sources import frame_bytes

#: The fix log's columns as the file gives them; quality, satellites and hdop arrive as anything and stay text.
FIX_DDL = "pi_time_ns long, pi_time_iso string, gps_epoch_ns long, gps_utc_time string, gps_quality string, num_sats string, hdop string, latitude double, longitude double, altitude_m double"
#: What tells two fixes without a sequence number apart.
SIGNATURE = ("gps_epoch_ns", "gps_utc_time", "latitude", "longitude", "gps_quality", "num_sats", "hdop", "altitude_m")


def _number(x: object, default: float | None = None) -> float | None:
    try:
        return float(x)
    except (TypeError, ValueError):
        return default


def fix_of(doc: dict, now_ns: int) -> tuple | None:
    """A row of FIX_DDL, or None if the document holds no position."""
    lat, lon = doc.get("latitude"), doc.get("longitude")
    if any(isinstance(x, bool) or not isinstance(x, (int, float)) or math.isnan(x) for x in (lat, lon)):
        return None
    text = lambda k: None if doc.get(k) is None else str(doc[k])
    epoch = doc.get("gps_epoch_ns")
    try:
        epoch = None if epoch in (None, "") else int(epoch)
    except (TypeError, ValueError):
        epoch = None
    pi = int(doc.get("pi_time_ns") or now_ns)
    iso = doc.get("pi_time_iso") or time.strftime("%Y-%m-%dT%H:%M:%S", time.gmtime(pi // 10**9)) + f".{pi % 10**9 // 1000:06d}+00:00"
    return pi, str(iso), epoch, str(doc.get("gps_utc_time") or ""), text("gps_quality"), text("num_sats"), text("hdop"), float(lat), float(lon), _number(doc.get("altitude_m"), float("nan"))


class _LatestFixReader(SimpleDataSourceStreamReader):
    """Offsets count the fixes seen.  A fix is kept in a journal in the shared folder before its offset is given out, until its batch is committed."""

    def __init__(self, path: str, journal: str, since_ns: int, polls: int, wait_s: float) -> None:
        self.path, self.journal, self.since_ns, self.polls, self.wait_s = path, journal, since_ns, polls, wait_s

    def initialOffset(self) -> dict:
        return {"n": 0, "sequence": None, "signature": None}

    def _entry(self, n: int) -> str:
        return os.path.join(self.journal, f"{n:020d}.json")

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        """Up to ``polls`` looks at the file; each fix that is new goes to the journal and into the batch."""
        os.makedirs(self.journal, exist_ok=True)
        at, rows = dict(start), []
        while os.path.exists(self._entry(at["n"])):  # seen before a restart, but not yet in any batch
            with open(self._entry(at["n"]), encoding="utf-8") as f:
                kept = json.load(f)
            rows.append(tuple(kept["row"]))
            at = kept["next"]
        for k in range(self.polls):
            if k:
                time.sleep(self.wait_s)
            try:
                with open(self.path, encoding="utf-8") as f:
                    doc = json.load(f)
            except (OSError, ValueError):
                continue  # not there yet, or not a document
            if not isinstance(doc, dict):
                continue
            sequence, signature = doc.get("sequence"), json.dumps([doc.get(c) for c in SIGNATURE])
            if sequence == at["sequence"] if sequence is not None else signature == at["signature"]:
                continue
            row = fix_of(doc, time.time_ns())
            if row is None or row[0] < self.since_ns:
                continue
            # A number that is not whole is compared, but not remembered.
            whole = isinstance(sequence, int) and not isinstance(sequence, bool)
            after = {"n": at["n"] + 1, "sequence": sequence if whole else at["sequence"], "signature": signature}
            write_json_atomic(self._entry(at["n"]), {"row": row, "next": after})
            rows.append(row)
            at = after
        return iter(rows), at

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        for n in range(start["n"], end["n"]):
            with open(self._entry(n), encoding="utf-8") as f:
                yield tuple(json.load(f)["row"])

    def commit(self, end: dict) -> None:
        for name in os.listdir(self.journal):
            if name.endswith(".json") and int(name[:-5]) < end["n"]:
                os.remove(os.path.join(self.journal, name))


class LatestFix(DataSource):
    """``spark.readStream.format("latest_fix")``: rows of a JSON file that is replaced whenever there is a new fix.

    Options: ``path`` of the file, ``journal`` (a folder of the query's own, shared by all machines that the driver may
    restart on), ``since_ns`` (older fixes are stale and skipped), ``polls`` a trigger and ``wait_s`` between them.
    A fix counts once: by its sequence number, or without one by its contents.  A restart neither loses nor repeats one
    that was seen; what the file held between two looks is not seen.
    """

    @classmethod
    def name(cls) -> str:
        return "latest_fix"

    def schema(self) -> str:
        return FIX_DDL

    def simpleStreamReader(self, schema) -> _LatestFixReader:
        o = self.options
        if not o.get("path") or not o.get("journal"):
            raise ValueError("latest_fix needs the options path and journal")
        return _LatestFixReader(o["path"], o["journal"], int(o.get("since_ns", 0)), int(o.get("polls", 1)), float(o.get("wait_s", 0.2)))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(LatestFix)


def _frames(buffer: bytearray, chunk: bytes, limit: int, tails: tuple[int, int]) -> Iterator[str]:
    """Sentences that ``chunk`` completes.  Bytes go in by portions that the buffer's limit allows, so where a log is cut makes no difference."""
    at = 0
    while at < len(chunk):
        room = max(1, limit + 1 - len(buffer))
        buffer += chunk[at : at + room]
        at += room
        while (line := frame_bytes(buffer, limit, tails)) is not None:
            yield line


def sentences(chunks: DataFrame, *, keys: Sequence[str], order: str = "ord", data: str = "data", limit: int = 4096, tails: tuple[int, int] = (256, 512)) -> DataFrame:
    """(keys, n, value): the sentences, numbered, of each key's stream of binary chunks, which come in order.

    The state of a key is what follows its last sentence.  Noise before a '$' is dropped; what outgrows ``limit`` without
    an end keeps its tail only and is searched again for a beginning.
    """
    kinds = dict(chunks.dtypes)
    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", n long, value string"

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        left, n = state.get if state.exists else (b"", 0)
        buffer = bytearray(left)
        parts = sorted((p for b in batches for p in zip(b[order].tolist(), b[data].tolist(), strict=True)), key=lambda p: p[0])  # one trigger's chunks of one key
        out = [line for _, chunk in parts if chunk for line in _frames(buffer, bytes(chunk), limit, tails)]
        state.update((bytes(buffer), n + len(out)))
        yield pd.DataFrame({**{k: [v] * len(out) for k, v in zip(keys, key, strict=True)}, "n": range(n, n + len(out)), "value": out}).astype({"n": "int64"})

    rows = chunks.select(*keys, order, F.col(data).cast("binary").alias(data))
    return rows.groupBy(*keys).applyInPandasWithState(run, schema, "left binary, n long", "append", GroupStateTimeout.NoTimeout)


def sentences_of_log(chunks: DataFrame, *, keys: Sequence[str], order: str = "ord", data: str = "data") -> DataFrame:
    """(keys, n, value): the same for whole recorded logs of text chunks, wherever they are cut, in column work.

    A line's number is the running count of line ends before it, so the parts of a line that was cut meet by that
    number; no key is one task's group.  Sentences of any length are kept.
    """
    # Splitting leaves one part more than there are line ends; the last part goes on in the next chunk.
    parts = F.split(F.coalesce(F.col(data), F.lit("")), "\n", -1)
    counted = running_sum(chunks.select(*keys, order, parts.alias("_parts"), (F.size(parts) - 1).cast("long").alias("_ends")), "_ends", keys=keys, order=order, name="_upto")
    pieces = counted.select(*keys, order, (F.col("_upto") - F.col("_ends")).alias("_line"), F.col("_ends").alias("_last"), F.posexplode("_parts").alias("_i", "_part"))
    pieces = pieces.select(*keys, (F.col("_line") + F.col("_i")).alias("n"), order, "_part", (F.col("_i") < F.col("_last")).alias("_ended"))
    lines = pieces.groupBy(*keys, "n").agg(F.array_sort(F.collect_list(F.struct(order, "_part"))).alias("p"), F.max("_ended").alias("ended"))
    text = F.array_join(F.transform("p", lambda x: x["_part"]), "")
    # From the first '$' on; an unfinished last line is no sentence.
    whole = lines.where("ended").select(*keys, "n", text.alias("t")).where(F.col("t").contains("$"))
    plain = F.regexp_replace(F.expr("substr(t, locate('$', t))"), r"[^\x00-\x7F]", "")
    return whole.select(*keys, "n", F.regexp_replace(plain, r"^[\s\x0B\x1C-\x1F]+|[\s\x0B\x1C-\x1F]+$", "").alias("value"))
