"""Benchmark decontamination (operator 10).

Test items are cut into windows of 13 consecutive words (an item of fewer, but
at least one, is one window).  The windows' hashes form a table that is
broadcast in blocks of proven size; every document's word windows are looked up
in it, each hit is verified word for word, and the words inside any verified
window count as hit.

Edge cases: null or empty texts have no words and no hits; an item without
words or with a null id takes no part; repeated items with one id count once;
very long texts are scanned whole.  Extra columns are ignored by
:func:`find_hits` and kept by :func:`decontaminate`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kit
from .store import free_name, settle, small_batches

WINDOW = 13
#: Bytes of benchmark text in one broadcast block, about (its table takes four times as much); more items make more passes, not a larger broadcast.
BLOCK_BYTES = 16 << 20
#: A document is contaminated if hit words are at least one in SHARE of its words.
SHARE = 20

_FILTER_BITS = 22
_HITS = "struct<n_words:bigint,starts:array<bigint>,ends:array<bigint>,items:array<bigint>>"


def _phrases(low: np.ndarray, s: np.ndarray, e: np.ndarray, at: int, k: int) -> bytes:
    return b" ".join(low[s[at] : e[at + k - 1]].tobytes().replace(b"\0", b" ").split())


def build_table(item_ids: list[int], texts: list[str], window: int = WINDOW) -> dict:
    """Flat arrays of about four times the texts' bytes: the words one after the other, and per window length the sorted hashes and their places."""
    data, offs = kit.as_bytes(pa.array(texts, pa.large_string()))
    s, e, d, h = kit.words(data, offs)
    low = kit.FOLD[data]
    size = e - s
    starts = np.concatenate([[0], np.cumsum(size + 1)])
    raw = np.full(starts[-1], 0x20, np.uint8)
    raw[np.arange(size.sum()) + np.repeat(np.arange(len(s)), size)] = low[low != 0]
    counts = np.bincount(d, minlength=len(texts)) if len(d) else np.zeros(len(texts), np.int64)
    first = np.concatenate([[0], np.cumsum(counts)])
    cut = np.minimum(counts, window)
    lengths = {}
    for k in np.unique(cut[cut > 0]).tolist():
        hashes, own = kit.windows(h, k), np.flatnonzero(cut == k)
        n = counts[own] - k + 1
        at = np.repeat(first[own] - np.cumsum(n) + n, n) + np.arange(n.sum())
        at = at[np.argsort(hashes[at], kind="stable")]
        seen = np.zeros(1 << _FILTER_BITS, bool)
        seen[hashes[at] >> np.uint64(64 - _FILTER_BITS)] = True
        lengths[k] = (hashes[at], at.astype(np.int32), seen)
    return {"ids": np.array(item_ids, np.int64), "first": first, "raw": raw.tobytes(), "starts": starts.astype(np.int32), "lengths": lengths}


def _items(table: dict, k: int, h: int, words: bytes) -> set:
    """Items that hold a window of these words."""
    keys, at, _ = table["lengths"][k]
    found = at[np.searchsorted(keys, h) : np.searchsorted(keys, h, "right")]
    raw, starts = table["raw"], table["starts"]
    same = [w for w in found.tolist() if raw[starts[w] : starts[w + k] - 1] == words]
    return set(table["ids"][np.searchsorted(table["first"], same, "right") - 1].tolist()) if same else set()


def scan(col: pa.Array, table: dict) -> pa.Array:
    """Per text: number of words, merged word intervals inside verified windows, ids of the items found."""
    kit.give_back()
    data, offs = kit.as_bytes(col)
    n = len(offs) - 1
    n_words = np.zeros(n, np.int64)
    spans: dict[int, tuple[list, list]] = {}
    found: dict[int, set] = {}
    for lo, hi, block, at in kit.blocks(data, offs):
        s, e, d, h = kit.words(block, at)
        if not len(s):
            continue
        low = None
        counts = np.bincount(d, minlength=hi - lo)
        n_words[lo:hi] = counts
        first = np.concatenate([[0], np.cumsum(counts)])
        marks = None
        for k, (keys, _, seen) in table["lengths"].items():
            wh = kit.windows(h, k)
            if not len(wh):
                continue
            cand = np.flatnonzero(seen[wh >> np.uint64(64 - _FILTER_BITS)])
            cand = cand[d[cand] == d[cand + k - 1]]
            if not len(cand):
                continue
            pos = np.searchsorted(keys, wh[cand])
            cand = cand[keys[np.minimum(pos, len(keys) - 1)] == wh[cand]]
            low = kit.FOLD[block] if low is None and len(cand) else low
            for i in cand.tolist():
                ids = _items(table, k, wh[i], _phrases(low, s, e, i, k))
                if ids:
                    marks = np.zeros(len(s) + 1, np.int32) if marks is None else marks
                    marks[i] += 1
                    marks[i + k] -= 1
                    found.setdefault(lo + int(d[i]), set()).update(ids)
        if marks is not None:
            hit = np.cumsum(marks[:-1]) > 0
            for doc in {x for x in found if lo <= x < hi}:
                own = hit[first[doc - lo] : first[doc - lo + 1]]
                edge = np.diff(np.concatenate([[0], own.view(np.int8), [0]]))
                spans[doc] = (np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())
    none: tuple[list, list] = ([], [])
    return pa.StructArray.from_arrays(
        [
            pa.array(n_words),
            pa.array([spans.get(i, none)[0] for i in range(n)], pa.list_(pa.int64())),
            pa.array([spans.get(i, none)[1] for i in range(n)], pa.list_(pa.int64())),
            pa.array([sorted(found.get(i, ())) for i in range(n)], pa.list_(pa.int64())),
        ],
        ["n_words", "starts", "ends", "items"],
    )


def _merge(starts: pa.Array, ends: pa.Array) -> pa.Array:
    """Length of the union of intervals, for hits gathered in more than one pass."""
    out = []
    for a, b in zip(starts.to_pylist(), ends.to_pylist(), strict=True):
        total, reach = 0, 0
        for x, y in sorted(zip(a, b, strict=True)):
            total += max(0, y - max(x, reach))
            reach = max(reach, y)
        out.append(total)
    return pa.array(out, pa.int64())


def _hits(docs: DataFrame, benchmark: DataFrame, window: int, name: str) -> tuple[DataFrame, Column]:
    """``docs`` with the hits in column ``name``, and their number of words.

    The benchmark is taken in blocks that are bounded in bytes before they are collected.  One block is a column; of more,
    each is broadcast, looked up in a pass of its own that is settled, and released before the next one is collected.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("i"), F.col("text").alias("t")).where("i is not null and t is not null").distinct()
    size = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, -(-size // BLOCK_BYTES))
    block = F.pmod(F.xxhash64("i"), F.lit(n))
    more, done = free_name(docs, "more"), []
    for b in range(n):
        rows = items.where(block == b).collect()
        shared = spark.sparkContext.broadcast(build_table([r[0] for r in rows], [r[1] for r in rows], window))
        hits = F.arrow_udf(lambda text, shared=shared: scan(text, shared.value), _HITS).asNondeterministic()
        docs = docs.withColumn(name if b == 0 else more, hits(F.col("text")))
        if n == 1:
            break
        if b:
            both = lambda f: F.concat(F.col(f"{name}.{f}"), F.col(f"{more}.{f}")).alias(f)
            docs = docs.withColumn(name, F.struct(F.col(f"{name}.n_words"), both("starts"), both("ends"), F.array_distinct(both("items")).alias("items"))).drop(more)
        docs = settle(docs, *done)
        done = [docs]
        shared.unpersist()
    if n == 1:
        total = F.aggregate(F.zip_with(f"{name}.ends", f"{name}.starts", lambda b, a: b - a), F.lit(0).cast("long"), lambda x, y: x + y)
    else:
        total = F.arrow_udf(_merge, "bigint")(F.col(f"{name}.starts"), F.col(f"{name}.ends"))
    return docs, total


def _verdict(n_words: Column, n_hit: Column, items: Column) -> list[Column]:
    return [
        n_words.alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort(F.transform(items, lambda x: x.cast("string")))), 256).alias("items_sha256"),
        ((n_hit > 0) & (SHARE * n_hit >= n_words)).alias("contaminated"),
    ]


def find_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated: one row per row of ``docs``, no shuffle."""
    small_batches(docs.sparkSession)
    rows, n_hit = _hits(docs.select("doc_id", "text"), benchmark, window, "h")
    return rows.select("doc_id", *_verdict(F.col("h.n_words"), n_hit, F.col("h.items")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, remove: str = "documents") -> DataFrame:
    """``docs`` without contaminated documents, or (``remove='spans'``) with the hit words blanked out and ``n_chars`` following."""
    small_batches(docs.sparkSession)
    name, verdict = free_name(docs, "hits"), free_name(docs, "verdict")
    rows, n_hit = _hits(docs, benchmark, window, name)
    if remove == "spans":
        out = rows.withColumn("text", _blank()(F.col("text"), F.col(name)))
        if "n_chars" in docs.columns:
            hit = F.size(f"{name}.starts") > 0
            out = out.withColumn("n_chars", F.when(hit, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
        return out.select(*docs.columns)
    judged = rows.withColumn(verdict, (n_hit > 0) & (SHARE * n_hit >= F.col(f"{name}.n_words")))
    return judged.where(~F.col(verdict)).select(*docs.columns)


def _blank():
    @F.arrow_udf("string")
    def blank(text: pa.Array, hits: pa.Array) -> pa.Array:
        data, offs = kit.as_bytes(text)
        s, e, d, _ = kit.words(data, offs)
        first = np.searchsorted(d, np.arange(len(offs)))
        out = []
        for i, (t, h) in enumerate(zip(text.to_pylist(), hits.to_pylist(), strict=True)):
            if t is None or not h["starts"]:
                out.append(t)
                continue
            raw, at, kept = data[offs[i] : offs[i + 1]].tobytes(), 0, []
            for a, b in sorted(zip(h["starts"], h["ends"], strict=True)):
                if s[first[i] + a] - offs[i] < at:  # blocks of the benchmark may mark the same words
                    a = min(b, int(np.searchsorted(s[first[i] : first[i + 1]] - offs[i], at)))
                    if a >= b:
                        continue
                kept.append(raw[at : s[first[i] + a] - offs[i]])
                at = e[first[i] + b - 1] - offs[i]
            out.append((b"".join(kept) + raw[at:]).decode())
        return pa.array(out, pa.string())

    return blank


#: DuckDB, for query op10: words by the contract's pattern, windows as word lists, hits by position.
ORACLE_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(ws), 13) AS k,
         array_to_string(ws[i : i + least(len(ws), 13) - 1], ' ') AS win
  FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(len(ws), 13) + 2)) AS i FROM b WHERE len(ws) > 0)),
dw AS (
  SELECT doc_id, k, i, array_to_string(ws[i : i + k - 1], ' ') AS win
  FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, (SELECT DISTINCT k FROM bw) WHERE len(ws) >= k)),
m AS (SELECT dw.doc_id, dw.i, dw.k, bw.item_id FROM dw JOIN bw ON dw.k = bw.k AND dw.win = bw.win),
p AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS pos FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM m) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w.ws) AS BIGINT) AS n_words, CAST(coalesce(p.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(t.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(t.ids, '')) AS items_sha256,
       coalesce(p.n_hit, 0) > 0 AND 20 * coalesce(p.n_hit, 0) >= len(w.ws) AS contaminated
FROM w LEFT JOIN p USING (doc_id) LEFT JOIN t USING (doc_id)
"""
