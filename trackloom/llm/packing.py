"""Packing (operator 3): hierarchical multi-length packing.

Each document becomes token ids (public tokenizer, then the end id) and is
routed by length to a context-size tier.  Runs of the longest tier are cut off
as full windows; every remainder leads a window of the smallest tier that holds
it.  Tiers are packed from the longest down: the gap behind a lead is filled
with whole documents of shorter tiers and closed exactly with a piece cut from
one.  What is left over at the end of a partition is streamed into the longest
windows, and the last few ids into windows of decreasing powers of two, so that
no window is padded.

Each input partition is packed on its own: no shuffle, bounded buffers, and a
lost task repeats only itself.  Window ids are the partition's number and a
counter.  Then all windows, the longest first, are dealt in turn to the step groups, of
which there are as many as STEP_TOKENS goes into all ids: each group gets its share of
every tier, and no two groups differ by more than the longest window.  A window's
place in that order follows from counts for each partition and tier.

Edge cases: a null or empty text is the end id alone; a text longer than a
window is cut; repeated rows are packed as often as they occur; extra columns
are ignored.
"""

from __future__ import annotations

import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import settle, small_batches
from .tokens import Encoder

WINDOW = 4096
TIERS = (4096, 2048, 1024, 512, 256)
STEP_TOKENS = 32768
#: Ids that a partition buffers before it packs.
BUFFER = 2_000_000
END_ID = 2

#: Pieces as packed: ``part`` is the partition, ``nth`` counts its windows of one length.
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_length long, part long, nth long"


class Packer:
    """Packs one partition; ``out`` gathers rows in the order of SCHEMA."""

    def __init__(self, partition: int) -> None:
        self.part, self.base = partition, partition << 33
        self.n = 0
        self.pools: dict[int, deque] = {t: deque() for t in TIERS}
        self.held = 0
        self.closed: dict[int, int] = {}
        self.out: list[list] = [[] for _ in range(10)]

    def _close(self, pieces: list, length: int) -> None:
        """Emits one full window made of (doc_id, ids, start, length) pieces."""
        seq = self.base + self.n
        self.n += 1
        nth = self.closed.get(length, 0)
        self.closed[length] = nth + 1
        at = 0
        for doc, ids, start, size in pieces:
            row = (doc, start, size, zlib.crc32(ids[start : start + size]), len(ids), seq, at, length, self.part, nth)
            for col, v in zip(self.out, row, strict=True):
                col.append(v)
            at += size

    def _route(self, doc, ids, start: int) -> None:
        size = len(ids) - start
        tier = next(t for t in reversed(TIERS) if t >= size)
        self.pools[tier].append((doc, ids, start))

    def add(self, doc, ids: np.ndarray) -> None:
        start = 0
        while len(ids) - start >= WINDOW:
            self._close([(doc, ids, start, WINDOW)], WINDOW)
            start += WINDOW
        if start < len(ids):
            self._route(doc, ids, start)
            self.held += len(ids) - start
            if self.held >= BUFFER:
                self.pack(last=False)

    def _fill(self, pieces: list, gap: int, below: tuple) -> int:
        """Fills ``gap`` from the tiers in ``below``; returns what stays open."""
        for t in below:
            pool = self.pools[t]
            while pool and len(pool[-1][1]) - pool[-1][2] <= gap:
                doc, ids, start = pool.pop()
                pieces.append((doc, ids, start, len(ids) - start))
                gap -= len(ids) - start
        for t in reversed(below):
            if gap and self.pools[t]:
                doc, ids, start = self.pools[t].pop()  # longer than the gap, or it had been taken whole
                pieces.append((doc, ids, start, gap))
                self._route(doc, ids, start + gap)
                gap = 0
        return gap

    def pack(self, last: bool) -> None:
        rest = []
        for k, tier in enumerate(TIERS[:-1]):
            pool = self.pools[tier]
            while pool:
                doc, ids, start = pool.popleft()
                pieces = [(doc, ids, start, len(ids) - start)]
                gap = self._fill(pieces, tier - (len(ids) - start), TIERS[k + 1 :])
                if gap:
                    rest += pieces
                else:
                    self._close(pieces, tier)
        while self.pools[TIERS[-1]]:
            doc, ids, start = self.pools[TIERS[-1]].popleft()
            rest.append((doc, ids, start, len(ids) - start))
        total = sum(p[3] for p in rest)
        sizes = [WINDOW] * (total // WINDOW)
        if last:
            sizes += [1 << b for b in range(WINDOW.bit_length() - 2, -1, -1) if (total % WINDOW) >> b & 1]
        todo = deque(rest)
        for size in sizes:
            pieces, gap = [], size
            while gap:
                doc, ids, start, n = todo.popleft()
                take = min(n, gap)
                pieces.append((doc, ids, start, take))
                gap -= take
                if n > take:
                    todo.appendleft((doc, ids, start + take, n - take))
            self._close(pieces, size)
        self.held = 0
        for doc, ids, start, n in todo:  # each reaches to its text's end
            self._route(doc, ids, start)
            self.held += n

    def batch(self) -> pa.RecordBatch:
        rows, self.out = self.out, [[] for _ in range(10)]
        names = [f.strip().split()[0] for f in SCHEMA.split(",")]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in rows], names)


def step_groups(packed: DataFrame, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """``packed`` pieces with ``step_group`` instead of ``part`` and ``nth``."""
    windows = packed.where("offset = 0").groupBy("sequence_length", "part").agg(F.count("*").alias("n"))
    totals = windows.groupBy("sequence_length").agg(F.sum("n").alias("n")).orderBy(F.desc("sequence_length")).collect()  # one row a length: powers of two and tiers
    groups = max(1, -(-sum(r["sequence_length"] * r["n"] for r in totals) // step_tokens))
    longer, first = 0, F.lit(0).cast("long")
    for r in totals:
        first = F.when(F.col("sequence_length") == r["sequence_length"], F.lit(longer).cast("long")).otherwise(first)
        longer += r["n"]
    before = F.coalesce(F.sum("n").over(Window.partitionBy("sequence_length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    places = windows.select("sequence_length", "part", (first + before).alias("before"))  # a row for each partition and length
    dealt = packed.join(places, ["sequence_length", "part"]).withColumn("step_group", F.pmod(F.col("before") + F.col("nth"), F.lit(groups)).cast("long"))
    return dealt.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_length", "step_group")


def pack(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """One row per piece of a document: where it starts, how long it is, its window and its place there.

    ``tokenizer``: path of the tokenizer file, on every worker; the public one by default.
    """
    small_batches(docs.sparkSession)

    def run(batches):
        packer, encoder = Packer(TaskContext.get().partitionId()), Encoder.shared(tokenizer)
        for b in batches:
            ids = b.column(0).to_pylist()
            at = 0
            for flat, offs in encoder.encode(b.column(1), END_ID):
                for i in range(len(offs) - 1):
                    packer.add(ids[at + i], flat[offs[i] : offs[i + 1]])
                at += len(offs) - 1
            if len(packer.out[0]) > 20_000:
                yield packer.batch()
        packer.pack(last=True)
        yield packer.batch()

    return step_groups(settle(docs.select("doc_id", "text").mapInArrow(run, SCHEMA)))
