"""Substring dedup by content-defined chunking (operator 4).

A gear hash rolls over the text's bytes; a chunk ends where the hash is the
largest within ``REACH`` bytes on either side, so borders depend on nearby bytes
only and an insertion moves the borders next to it, not those after it.  Where no
border comes for MAX_CHUNK bytes, one is set.  Chunks are compared by 128-bit
digests: of all chunks with one digest the occurrence with the smallest
(doc_id, position) stays, and every later one is a repeat and is cut out, however
short it is.  A second digest of every chunk covers the bytes around it that decide
its borders too (BEFORE before it, REACH after it, as far as the text goes); where
that is repeated, the repeat reaches so far, and those bytes go as well.  Repeats
that touch or overlap make one run.  Each cut byte thus stands at an earlier place.

Per digest only the first place and the number of places is aggregated, with
partial aggregation before the shuffle, so a line in a third of all rows is one
row per task; the places of such a digest are dealt over several tasks.

Edge cases: null and empty texts have no chunks; equal rows repeated under one id
are one document, and different texts under one id are compared and cut each for
itself; rows with a null id are neither compared nor cut; very long texts are
chunked whole; an empty table gives an empty one; extra columns stay.  Positions are
byte positions.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kit
from .store import discard, free_name, join_dealt, settle, small_batches, versions

#: Half-width of the neighbourhood in which a border's hash is the largest; a chunk has about twice as many bytes.
REACH = 24
MAX_CHUNK = 256
_WINDOW = 32
#: Bytes before a border that decide it.
BEFORE = _WINDOW + REACH

#: One random word for each byte value, made by a rule.
GEAR = (kit.mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)


def gear(data: np.ndarray) -> np.ndarray:
    """The gear hash h = (h << 1) + GEAR[byte] at every byte, over the last 32 bytes, by doubling."""
    h = GEAR[data]
    k = 1
    while k < _WINDOW:
        if len(h) > k:
            shifted = h[:-k] << np.uint32(k)
            h = h.copy()
            h[k:] += shifted
        k *= 2
    return h


def _window_max(h: np.ndarray, n: int) -> np.ndarray:
    """Largest of h[i : i + n] for every i that has n values."""
    out, have = h, 1
    while have < n:
        step = min(have, n - have)
        out = np.maximum(out[:-step], out[step:])
        have += step
    return out


def borders(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Ends of all chunks, texts' ends included, ascending."""
    n = len(data)
    edge = offs[1:][np.diff(offs) > 0]
    if n <= 2 * REACH:
        return edge
    h = gear(data)
    side = _window_max(h, REACH)
    at = np.arange(REACH, n - REACH)
    peak = at[(h[at] >= side[at - REACH]) & (h[at] > side[at + 1])]
    # Near a text's border the hash has seen its neighbour's bytes: no chunk ends there.
    text = np.searchsorted(offs, peak, "right") - 1
    room = (peak - offs[text] >= BEFORE) & (offs[text + 1] - peak > REACH)
    cuts = np.unique(np.concatenate([peak[room] + 1, edge]))
    begin = np.concatenate([[0], cuts[:-1]])
    extra = (cuts - begin - 1) // MAX_CHUNK
    if extra.any():
        long = np.flatnonzero(extra)
        times = extra[long]
        step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + 1
        cuts = np.sort(np.concatenate([cuts, np.repeat(begin[long], times) + step * MAX_CHUNK]))
    return cuts


def chunks(docs: DataFrame) -> DataFrame:
    """(doc_id, v, start, size, a, b, before, after, c, d): every chunk of every text (doc_id, v, text).

    a and b are the halves of its digest, c and d of its digest with the ``before`` and ``after`` bytes around it.
    """
    names = ["doc_id", "v", "start", "size", "a", "b", "before", "after", "c", "d"]

    def run(batches):
        for batch in batches:
            ids, vs = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for lo, _, block, offs in kit.blocks(*kit.as_bytes(batch.column(2))):
                ends = borders(block, offs)
                if not len(ends):
                    continue
                starts = np.concatenate([[0], ends[:-1]])
                text = np.searchsorted(offs, starts, "right") - 1
                wide, far = np.maximum(starts - BEFORE, offs[text]), np.minimum(ends + REACH, offs[text + 1])
                raw = memoryview(block.tobytes())
                digest = xxhash.xxh3_128_digest
                own, more = (np.frombuffer(b"".join([digest(raw[s:e]) for s, e in zip(u.tolist(), v.tolist(), strict=True)]), np.int64).reshape(-1, 2) for u, v in ((starts, ends), (wide, far)))
                whole = [starts - offs[text], ends - starts, starts - wide, far - ends]
                start, size, before, after = (pa.array(x.astype(np.int32)) for x in whole)
                cols = [pa.array(ids[lo + text]), pa.array(vs[lo + text]), start, size, *[pa.array(own[:, i].copy()) for i in (0, 1)], before, after, *[pa.array(more[:, i].copy()) for i in (0, 1)]]
                yield pa.RecordBatch.from_arrays(cols, names)

    small_batches(docs.sparkSession)
    rows = docs.where("doc_id is not null and text <> ''").select(F.col("doc_id").cast("long").alias("doc_id"), "v", "text")
    return rows.mapInArrow(run, "doc_id long, v long, start int, size int, a long, b long, before int, after int, c long, d long")


@F.arrow_udf(T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])))
def _runs(repeats: pa.Array) -> pa.Array:
    """Runs of touching or overlapping repeats."""
    out = []
    for row in repeats.to_pylist():
        runs: list[dict] = []
        for start, size in sorted((x["start"], x["size"]) for x in row):
            if runs and start <= runs[-1]["end"]:
                runs[-1]["end"] = max(runs[-1]["end"], start + size)
            else:
                runs.append({"start": start, "end": start + size})
        out.append(runs)
    return pa.array(out, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))


def _later(made: DataFrame, x: str, y: str, start: Column, end: Column) -> DataFrame:
    """(doc_id, v, at, start, size): the bytes [start, end) of chunks whose digest (x, y) has an earlier place; ``at`` is the chunk's own start."""
    place = F.struct("doc_id", "v", "start")
    seen = made.groupBy(x, y).agg(F.min(place).alias("first"), F.max(place).alias("final"), F.count("*").alias("n"))
    seen = settle(seen.where("first <> final").drop("final"))
    later = join_dealt(made, seen, [x, y], "start").where(place > F.col("first"))
    return settle(later.select("doc_id", "v", F.col("start").alias("at"), start.alias("start"), (end - start).alias("size")), seen)


def repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, v, n_repeats, runs): texts of ``docs`` (doc_id, v, text) with repeated chunks, and the runs to cut out of them."""
    made = settle(chunks(docs))
    start, end = F.col("start"), F.col("start") + F.col("size")
    own = _later(made.select("doc_id", "v", "start", "size", "a", "b"), "a", "b", start, end)
    around = _later(made.drop("a", "b"), "c", "d", start - F.col("before"), end + F.col("after"))
    discard(made)
    parts = own.unionByName(around).groupBy("doc_id", "v").agg(F.collect_set(F.struct("start", "size")).alias("parts"), F.collect_set("at").alias("at"))
    return parts.select("doc_id", "v", F.size("at").cast("long").alias("n_repeats"), _runs("parts").alias("runs"))


def _with_runs(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """``docs`` with the repeats of each row's text (null where there are none), and the names of those two columns."""
    key, v, kv, n, runs = (free_name(docs, c) for c in ("id", "v", "kv", "n_repeats", "runs"))
    rows = versions(docs, v)
    found = repeats(rows.select("doc_id", F.col(v).alias("v"), "text")).select(F.col("doc_id").alias(key), F.col("v").alias(kv), F.col("n_repeats").alias(n), F.col("runs").alias(runs))
    return rows.join(found, (F.col("doc_id").cast("long") == F.col(key)) & (F.col(v) == F.col(kv)), "left"), n, runs


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_repeats, n_removed, spans for every row of ``docs``; spans are start:end, comma-joined."""
    rows, n, runs = _with_runs(docs.select("doc_id", "text"))
    removed = F.aggregate(runs, F.lit(0).cast("long"), lambda t, x: t + x["end"] - x["start"])
    return rows.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.coalesce(n, F.lit(0).cast("long")).alias("n_repeats"),
        F.coalesce(removed, F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce(F.concat_ws(",", F.transform(runs, lambda x: F.concat_ws(":", x["start"].cast("string"), x["end"].cast("string")))), F.lit("")).alias("spans"),
    )


@F.arrow_udf(T.StringType())
def _without(text: pa.Array, runs: pa.Array) -> pa.Array:
    out = []
    for t, row in zip(text.to_pylist(), runs.to_pylist(), strict=True):
        if t and row:
            raw, at, kept = t.encode(), 0, []
            for x in row:
                kept.append(raw[at : x["start"]])
                at = x["end"]
            # A border may lie within a character that differs on its other side: such halves go too.
            t = (b"".join(kept) + raw[at:]).decode(errors="ignore")
        out.append(t)
    return pa.array(out, pa.string())


def remove(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated runs cut out of the texts, and n_chars to match where there is one; all rows and columns stay."""
    rows, _, runs = _with_runs(docs)
    cut = F.col(runs).isNotNull()
    out = rows.withColumn("text", F.when(cut, _without("text", runs)).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(cut, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
