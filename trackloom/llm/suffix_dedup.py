"""Suffix-array dedup (operator 9): bytes covered by a long string that starts in an earlier document too.

Every 50-byte string of a text is named by its minimizer, the k-gram of smallest
hash within it, so equal strings always meet under one name, whatever surrounds
them.  Names that only one document has are dropped.  Every other name is filed
under one of its documents and a stretch of that one's positions; the strings of a text
that are filed together and follow each other move as one stretch of bytes.  All
stretches filed in one place form a *lane*, a small text of its own, and suffix
arrays by linear grouping decide which strings of a lane are equal: exact copies,
near copies and passages alike.  Runs of equal bytes stand in a lane's array once,
for the documents of all.  Thousands of lanes are sorted in step, one
group of suffixes of each lane at a time, so that a step is a few numpy calls.

Names with many occurrences are split.  The counting aggregates on the map side;
the join that brings the counts back deals the names that hold more than one in
HOT occurrences (at most HOT names) over several keys; and lanes of names with more
than LANE occurrences are salted: what stays first in a salted lane is held
against the other lanes' firsts, string by string, in a second pass.

Edge cases: null and empty texts have no bytes; texts shorter than 50 bytes lose
nothing; exact copies of a text of an earlier document lose all; rows repeated
under one id are one document, are not compared with each other, and each is cut
by its own text; rows with a null id are not compared and stay whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kit
from .store import settle, small_batches, versions

SPAN = 50
_K = 20
_W = SPAN - _K + 1
_TABLE = kit.mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_STEP = [*kit._STEP, np.uint64(0xD6E8FEB86659FD93)]
#: Bytes of texts, about, that are named together: their hashes stay in a core's cache.
NAMED_BYTES = 256 << 10
#: Bytes of lanes, about, that are sorted in step.
SORTED_BYTES = 4 << 20
#: Positions of a name's first places (a power of two) that share a lane, and occurrences of a name in an unsalted one.
REGION, LANE = 9, 4096
#: A name with more than one in HOT of all occurrences is dealt over several keys of the join.
HOT = 10_000
#: A stretch is cut where it enters another block of so many bytes (a power of two).
_CUT = 12
#: A place within a document: which of the texts under one id, first byte, number of strings.
_V, _S = 38, 6
#: Low bits of a place: log2 of how many lanes its name is dealt over.
_DEAL = 31
#: Strings of a run at most.
MOST = (1 << _S) - 1


def _fresh(x: np.ndarray) -> np.ndarray:
    """Whether each value differs from the one before it; the first does."""
    out = np.empty(len(x), bool)
    out[:1] = True
    np.not_equal(x[1:], x[:-1], out=out[1:])
    return out


def _gaps(first: np.ndarray, n: int) -> np.ndarray:
    """Lengths of the runs that start at ``first``, up to ``n``."""
    out = np.empty_like(first)
    np.subtract(first[1:], first[:-1], out=out[:-1])
    out[-1:] = n - first[-1:]
    return out


def suffix_arrays(text: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Suffix arrays of many texts by linear grouping, in step: positions in ``text``, one text after the other.

    ``ends`` holds the end of each text; its last symbol is its only smallest one.

    Phase 1 takes groups of suffixes from the highest down.  Each suffix of the
    group looks for the nearest position before it that lies in a lower group (its
    previous smaller suffix); the suffixes so found are extended by the group's
    common prefix and move, by how often they were found, into new groups right
    above their old ones.  In the end every group is the set of suffixes with one
    Lyndon prefix, and groups are in order.  Phase 2 goes through the suffixes in
    ascending order and, for each, emits the suffixes that lead to it into the front
    of their groups.  A step does this for one group of every text.
    """
    k = len(ends)
    sizes = np.diff(np.concatenate([[0], ends]))
    base = np.concatenate([[0], ends[:-1]]) + np.arange(k)  # a place below all others stands before each text
    n = len(text) + k
    lane = np.repeat(np.arange(k), sizes + 1)
    symbol = np.zeros(n, np.int64)
    real = np.ones(n, bool)
    real[base] = False
    symbol[real] = text + 1
    key = lane * (int(symbol.max(initial=0)) + 1) + symbol
    del symbol
    # Key and position in one word: sorting words is much cheaper than sorting indirectly.
    bits = n.bit_length()
    word = (key << bits) + np.arange(n)
    del key
    word.sort()
    order = word & ((1 << bits) - 1)
    word >>= bits
    starts = np.flatnonzero(new := _fresh(word))
    del word
    group = np.empty(n, np.int64)  # where a suffix's group starts in ``order``
    group[order] = starts[np.cumsum(new) - 1]
    where = np.empty(n, np.int64)
    where[order] = np.arange(n)
    size = np.zeros(n, np.int64)
    size[starts] = np.diff(np.append(starts, n))
    prev = np.arange(n) - 1
    found = np.zeros(n, bool)

    first, end = base + 1, base + sizes + 1
    while len(end):
        start = group.take(order.take(end - 1))
        count = end - start
        upto = count.cumsum()
        i = order.take((start - upto + count).repeat(count) + np.arange(upto[-1]))
        bar = start.repeat(count)
        p = i - 1
        todo = (group.take(p) >= bar).nonzero()[0]
        while len(todo):
            to = prev.take(p.take(todo))
            p[todo] = to
            prev[i.take(todo)] = to
            todo = todo[group.take(to) >= bar.take(todo)]
        p = p[real.take(p)]
        p.sort()
        if len(p):
            edge = _fresh(p).nonzero()[0]
            u, times = p.take(edge), _gaps(edge, len(p))
            g = group.take(u)
            by = ((g << 32) + times).argsort()
            u, times, g = u.take(by), times.take(by), g.take(by)
            fresh = _fresh(g)
            seg = fresh.nonzero()[0]
            of = fresh.cumsum() - 1
            here = _gaps(seg, len(u))
            low = g.take(seg)
            keep = size.take(low) - here
            tail = low + keep  # the found suffixes of a group move to its end, the most often found last
            to = (tail - seg).take(of) + np.arange(len(u))
            step = (fresh | _fresh(times)).nonzero()[0]
            had = where.take(u)
            found[u] = True
            out = order.take(to)
            out, gap = out[~found.take(out)], had[had < tail.take(of)]
            found[u] = False
            order[gap], where[out] = out, gap
            order[to], where[u] = u, to
            long = _gaps(step, len(u))
            group[u] = to.take(step).repeat(long)
            size[low[keep > 0]] = keep[keep > 0]
            size[to.take(step)] = long
        more = start > first
        first, end = first[more], start[more]

    del size, where, found
    out = np.empty(n, np.int64)
    free, best = np.arange(n), np.where(real, n, -1)  # -1: needs no place, or has one
    home = group[order]  # the group that holds a place
    read, last = base + 1, base + sizes
    out[read] = base + sizes
    free[home[read]] += 1
    best[out[read]] = -1
    while len(read):
        # All suffixes that stand ready at the front of the lowest open group, in order.
        to = free.take(home.take(read))
        count = to - read
        upto = count.cumsum()
        r = (read - upto + count).repeat(count) + np.arange(upto[-1])
        j = out.take(r) - 1
        reached, by = [], []
        while True:
            go = (r < best.take(j)).nonzero()[0]
            if not len(go):
                break
            j, r = j.take(go), r.take(go)
            best[j[::-1]] = r[::-1]
            go = (best.take(j) == r).nonzero()[0]
            j, r = j.take(go), r.take(go)
            reached.append(j)
            by.append(r)
            j = prev.take(j)
        if reached:
            j, r = np.concatenate(reached), np.concatenate(by)
            own = (best.take(j) == r).nonzero()[0]
            j, r = j.take(own), r.take(own)
            g = group.take(j)
            at = ((g << 32) + r).argsort()
            j, g = j.take(at), g.take(at)
            seg = _fresh(g).nonzero()[0]
            long, low = _gaps(seg, len(j)), g.take(seg)
            front = free.take(low)
            out[(front - seg).repeat(long) + np.arange(len(j))] = j
            free[low] = front + long
            best[j] = -1
        more = to <= last
        read, last = to[more], last[more]
    out = out[real]
    return out - lane[out] - 1


def _fold(h: np.ndarray, n: int, f) -> np.ndarray:
    """f over h[i : i + n] for every i."""
    out, have = h, 1
    while have < n:
        step = min(have, n - have)
        out = f(out[:-step], out[step:])
        have += step
    return out


def _grams(data: np.ndarray, k: int) -> np.ndarray:
    """Hashes, not yet mixed, of all ``k``-byte strings (k from 17 to 64), across the ends of texts too."""
    h, step = _TABLE[data], 1
    for c in _STEP[: (k - 1).bit_length() - 1]:
        h = h[:-step] * c + h[step:]
        step *= 2
    return h[: step - k] * _STEP[0] + h[k - step :]  # two overlapping strings of 16 or 32 bytes


def snippets(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text index, name, first string's start, number of strings) of every run of strings with one name.

    A string's name is the smallest hash of its k-grams; runs are cut at MOST strings.
    """
    none = np.zeros(0, np.int64)
    if len(data) < SPAN:
        return none, none, none, none
    least = _fold(kit.mix(_grams(data, _K)), _W, np.minimum)
    text = np.repeat(np.arange(len(offs) - 1), np.diff(offs))[: len(least)]
    at = np.flatnonzero(np.arange(len(least)) + SPAN <= offs[text + 1])
    least, text = least[at], text[at]
    new = np.ones(len(at), bool)
    new[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1])
    run = np.flatnonzero(new)
    size = np.diff(np.append(run, len(at)))
    more = (size + MOST - 1) // MOST
    nth = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more)
    first = np.repeat(run, more) + nth * MOST
    count = np.minimum(MOST, np.repeat(run + size, more) - first)
    return text[first], least[first].view(np.int64), at[first] - offs[text[first]], count


def _promising(raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray, lane: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the runs of strings whose fingerprint occurs more than once in their lane; others need no sorting."""
    count = sizes - SPAN + 1
    owner = np.repeat(np.arange(len(sizes)), count)
    at = np.repeat(starts - np.cumsum(count) + count, count) + np.arange(len(owner))
    seed = lane.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    # A fingerprint's high bits and its string's number in one word: sorting words is much cheaper than sorting indirectly.
    low = np.uint64((1 << len(at).bit_length()) - 1)
    word = kit.mix(_grams(raw, SPAN)[at] + seed[owner]) & ~low | np.arange(len(at), dtype=np.uint64)
    word.sort()
    same = word[1:] ^ word[:-1] <= low
    twice = np.zeros(len(at), bool)
    twice[word[1:][same] & low] = twice[word[:-1][same] & low] = True
    at, owner = at[twice], owner[twice]
    if not len(at):
        return at, at
    new = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (owner[1:] != owner[:-1])])
    first = np.flatnonzero(new)
    return at[first], at[np.append(first[1:], len(at)) - 1] + SPAN


def _runs(mark: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(stretch, first, end) of the runs of marked strings of each stretch; the last 49 bytes of one start no string."""
    edge = np.diff(np.concatenate([[0], mark.view(np.int8), [0]]))
    lo, hi = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    own = np.searchsorted(starts, lo, "right") - 1
    return own, lo - starts[own], hi - starts[own]


def _once(lanes: np.ndarray, data: bytes, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(kind of each run of bytes, from 0, first run of each kind): runs of a kind are equal and in one lane."""
    seen: dict[tuple, int] = {}
    kind = np.array([seen.setdefault((a, data[s:e]), len(seen)) for a, s, e in zip(lanes.tolist(), lo.tolist(), hi.tolist(), strict=True)])
    return kind, np.unique(kind, return_index=True)[1]


def covered(docs: np.ndarray, lanes: np.ndarray, parts: list[bytes], salted: np.ndarray) -> tuple[tuple, tuple]:
    """Runs (stretch, first string, end) of strings that a smaller document of the lane has too, and of all others of salted lanes.

    ``lanes`` ascends from 0.  Strings without an equal in their lane are among the others.  Of equal runs
    the suffix array holds one, which stands for the documents of all.
    """
    sizes = np.array([len(p) for p in parts])
    starts = np.cumsum(sizes) - sizes
    data = b"".join(parts)
    raw = np.frombuffer(data, np.uint8)
    hit = np.zeros(len(raw), bool)
    lo, hi = _promising(raw, starts, sizes, lanes)
    if len(lo):
        of = np.searchsorted(starts, lo, "right") - 1
        kind, one = _once(lanes[of], data, lo, hi)
        smallest = np.full(len(one), np.iinfo(np.int64).max)
        np.minimum.at(smallest, kind, docs[of])
        # The runs one after the other, each closed by a symbol below all bytes, and the lowest at a lane's very end.
        lane, length = lanes[of[one]], (hi - lo)[one]
        closing = np.append(lane[1:] != lane[:-1], True)
        begin = np.cumsum(length + 1 + closing) - (length + 1 + closing)
        owner = np.repeat(np.arange(len(one)), length + 1 + closing)
        inside = np.arange(len(owner)) - begin[owner]
        src = lo[one][owner] + np.minimum(inside, length[owner] - 1)
        symbols = raw[src].astype(np.int64) + 2
        symbols[begin + length] = 1
        ends = (begin + length + 1 + closing)[closing]
        symbols[ends - 1] = 0
        order = suffix_arrays(symbols, ends)
        order = order[length[owner[order]] - inside[order] >= SPAN]
        view = np.lib.stride_tricks.sliding_window_view(raw, SPAN)[src[order]].view(np.uint16)
        run = owner[order]
        new = np.concatenate([[True], (view[1:] != view[:-1]).any(1) | (lane[run[1:]] != lane[run[:-1]])])
        least = np.empty(len(symbols), np.int64)
        least[order] = np.minimum.reduceat(smallest[run], np.flatnonzero(new))[np.cumsum(new) - 1]
        count = hi - lo - SPAN + 1
        nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        hit[(np.repeat(lo, count) + nth)[least[np.repeat(begin[kind], count) + nth] < np.repeat(docs[of], count)]] = True
    rest = ~hit & np.repeat(salted[lanes], sizes)
    for back in range(1, SPAN):
        rest[starts + sizes - back] = False
    return _runs(hit, starts, sizes), _runs(rest, starts, sizes)


def _named(texts: DataFrame) -> DataFrame:
    """(h, id, w): every minimizer occurrence; w is its place, see _V and _S."""

    def run(batches):
        for b in batches:
            ids, version = b.column(0).to_numpy(), b.column(1).to_numpy()
            for lo, _, block, offs in kit.blocks(*kit.as_bytes(b.column(2)), NAMED_BYTES):
                text, name, first, count = snippets(block, offs)
                w = (version[lo + text] << _V) + (first << _S) + count
                yield pa.RecordBatch.from_arrays([pa.array(name.astype(np.int64)), pa.array(ids[lo + text]), pa.array(w)], ["h", "id", "w"])

    return texts.select("id", "v", "text").mapInArrow(run, "h long, id long, w long")


_PART = "a long, b long, id long, w long, part binary"


def _stretches(rows: DataFrame) -> DataFrame:
    """The bytes of neighbouring strings that are filed together, by lane (a, b), from (id, v, text, ws, as)."""

    def run(batches):
        for batch in batches:
            ids, version = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            data, offs = kit.as_bytes(batch.column(2))
            row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(batch.column(3)).to_numpy())
            w, a = (batch.column(k).flatten().to_numpy() & low for k, low in ((3, (1 << _V) - 1), (4, -1)))
            order = np.lexsort((w, row))
            w, a, row = w[order], a[order], row[order]
            start, to = w >> _S, (w >> _S) + (w & ((1 << _S) - 1))
            new = _fresh(row) | _fresh(a)
            new[1:] |= start[1:] != to[:-1]
            first = np.flatnonzero(new)
            last, start, a, row = to[first + _gaps(first, len(w)) - 1], start[first], a[first], row[first]
            # Long runs are cut, so that a lane's stretches stay short.
            times = ((last - start) >> _CUT) + 1
            lo = np.repeat(start - ((np.cumsum(times) - times) << _CUT), times) + (np.arange(times.sum()) << _CUT)
            hi = np.minimum(np.repeat(last, times), lo + (1 << _CUT))
            a, row = np.repeat(a, times), np.repeat(row, times)
            lo, hi, a, row = (x[hi > lo] for x in (lo, hi, a, row))
            # Over how many lanes a name of many is dealt stands in the low bits of its place, as a logarithm.
            spot = kit.mix(kit.mix(ids[row].astype(np.uint64)) + (lo >> _CUT).astype(np.uint64))
            salt = (spot >> np.uint64(2)).astype(np.int64) & ((np.int64(1) << (a & _DEAL)) - 1)
            b = np.where(a & _DEAL, salt + 1, 0)
            raw, begin, end = data.tobytes(), offs[row] + lo, offs[row] + hi + SPAN - 1
            parts = pa.array([raw[s:e] for s, e in zip(begin.tolist(), end.tolist(), strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([*[pa.array(c) for c in (a, b, ids[row], (version[row] << _V) + (lo << _S))], parts], ["a", "b", "id", "w", "part"])

    return rows.select("id", "v", "text", "ws", "as").mapInArrow(run, _PART)


def _lanes(batches):
    """Tables of whole lanes, of about SORTED_BYTES each, from batches sorted by lane."""
    held: list[pa.RecordBatch] = []
    size = 0

    def cut(last: bool):
        t = pa.Table.from_batches(held).combine_chunks()
        a, b = t["a"].to_numpy(), t["b"].to_numpy()
        ends = np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1  # the last lane may go on in the next batch
        ends = np.append(ends, len(t)) if last else ends
        reach = np.concatenate([[0], np.cumsum(pc.binary_length(t["part"]).to_numpy().astype(np.int64))])
        lo, out = 0, []
        while len(ends) and lo < ends[-1]:
            k = max(np.searchsorted(ends, lo, "right"), np.searchsorted(reach[ends], reach[lo] + SORTED_BYTES, "right") - 1)
            hi = int(ends[min(k, len(ends) - 1)])
            out.append(t.slice(lo, hi - lo).combine_chunks())
            lo = hi
        return out, t.slice(lo)

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.nbytes
            if size > SORTED_BYTES:
                out, rest = cut(last=False)
                yield from out
                held, size = rest.to_batches(), 0
    if held and sum(len(h) for h in held):
        yield from cut(last=True)[0]


def _laned(batches):
    """(table, lane of each row from 0, rows that open a lane, parts) of whole lanes."""
    for t in _lanes(batches):
        a, b = t["a"].to_numpy(), t["b"].to_numpy()
        lane = np.cumsum(np.concatenate([[0], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
        yield t, lane, np.flatnonzero(np.concatenate([[True], lane[1:] != lane[:-1]])), t["part"].to_pylist()


_FOUND = "id long, ws array<long>, n long, part binary"


def _found(ids, ws, n, parts) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(ws, pa.list_(pa.int64())), pa.array(n, pa.int64()), pa.array(parts, pa.binary())], ["id", "ws", "n", "part"])


def _sorted_out(parts: DataFrame) -> DataFrame:
    """(id, ws, n, part): runs of n strings from place ws[0] that a smaller document of their lane has too.

    Rows with a part are strings, with all their places, that are first in a salted lane.  ``parts`` is sorted by lane.
    """

    def run(batches):
        for t, lane, opens, raw in _laned(batches):
            b, ids, w = (t[c].to_numpy() for c in ("b", "id", "w"))
            (own, lo, hi), more = covered(ids, lane, raw, b[opens] > 0)
            first: dict[tuple, list] = {}
            for i, s, e in zip(*[x.tolist() for x in more], strict=True):
                for x in range(s, e):
                    first.setdefault((int(ids[i]), raw[i][x : x + SPAN]), []).append(int(w[i]) + (x << _S))
            runs = (w[own] + (lo << _S))[:, None].tolist()
            yield _found([*ids[own].tolist(), *[k[0] for k in first]], runs + list(first.values()), [*(hi - lo).tolist(), *[1] * len(first)], [None] * len(own) + [k[1] for k in first])

    return parts.mapInArrow(run, _FOUND)


def _sorted_firsts(strings: DataFrame) -> DataFrame:
    """The same rows, without parts, for single strings (a, b, id, ws, part) sorted by lane."""

    def run(batches):
        for t, lane, opens, raw in _laned(batches):
            (own, _, _), _ = covered(t["id"].to_numpy(), lane, raw, np.zeros(len(opens), bool))
            at = pa.array(own)
            yield _found(t["id"].take(at).combine_chunks(), t["ws"].take(at).combine_chunks(), np.ones(len(own), np.int64), [None] * len(own))

    return strings.mapInArrow(run, _FOUND)


def _dealt(parts: DataFrame, size: Column, *keys: str) -> DataFrame:
    """``parts`` in partitions of about 16 MB, sorted by the lane's key."""
    n = max(parts.sparkSession.sparkContext.defaultParallelism, (parts.agg(F.sum(size)).first()[0] or 0) >> 24)
    return parts.repartition(int(n), *keys).sortWithinPartitions(*keys)


def repeats(rows: DataFrame) -> DataFrame:
    """(id, v, s, e): byte ranges to remove from ``rows`` (id, v, text); they may overlap."""
    small_batches(rows.sparkSession)
    texts = rows.where(F.col("id").isNotNull() & (F.octet_length("text") >= SPAN)).select("id", "v", "text")
    single, twin = texts.where("v = 0"), texts.where("v > 0").dropDuplicates(["id", "v"])
    texts = single if rows.where("v > 0").isEmpty() else single.unionByName(twin)

    named = _named(texts)
    start = F.shiftright(F.col("w").bitwiseAND(F.lit((1 << _V) - 1)), _S)
    # A name is filed under one of its documents (36 bits of a hash), by that one's first places (22 bits); equal hashes only make a lane longer.
    place = F.shiftleft(F.shiftrightunsigned(F.xxhash64("id"), 28), 27) + F.shiftleft(F.shiftright(start, REGION), 5)
    shared = named.groupBy("h").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.min(place).alias("a"), F.count("*").alias("n")).where("lo < hi")
    shared = settle(shared.select("h", "a", "n"))
    # Names with more than one in HOT of these occurrences, at most HOT of them, are dealt over several keys.
    bar = max(LANE, (shared.agg(F.sum("n")).first()[0] or 0) // HOT)
    times = F.ceil(F.col("n") / bar).cast("int")
    hot = settle(shared.where(F.col("n") > bar).select("h", times.alias("times")))
    deal = F.greatest(F.ceil(F.log2(F.col("n") / LANE)), F.lit(0)).cast("long")
    filed = shared.select("h", (F.col("a") + deal).alias("a"), F.explode(F.sequence(F.lit(0), F.greatest(times, F.lit(1)) - 1)).alias("k"))
    if hot.isEmpty():
        named = named.withColumn("k", F.lit(0))
    else:
        named = named.join(F.broadcast(hot), "h", "left").withColumn("k", F.pmod(F.xxhash64("id", "w"), F.coalesce("times", F.lit(1))).cast("int"))
    marks = named.join(filed.hint("shuffle_hash"), ["h", "k"]).groupBy("id", F.shiftright("w", _V).alias("v")).agg(F.collect_list(F.struct("w", "a")).alias("x"))
    marks = settle(marks.select("id", "v", F.col("x.w").alias("ws"), F.col("x.a").alias("as")), shared, hot)

    parts = settle(_stretches(texts.join(marks, ["id", "v"])), marks)
    found = settle(_sorted_out(_dealt(parts, F.octet_length("part"), "a", "b")), parts)
    ranges = found.where("part is null")
    firsts = found.where("part is not null")
    if not firsts.isEmpty():  # held against those of the other lanes
        strings = firsts.select(F.xxhash64("part").alias("a"), F.lit(0).cast("long").alias("b"), "id", "ws", "part")
        ranges = ranges.unionByName(_sorted_firsts(_dealt(strings, F.lit(SPAN), "a")))
    spots = ranges.select("id", F.explode("ws").alias("w"), "n")
    return spots.select("id", F.shiftright("w", _V).alias("v"), start.alias("s"), (start + F.col("n") + SPAN - 1).alias("e"))


_DONE = T.StructType([*[T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")], T.StructField("kept_sha256", T.StringType()), T.StructField("kept", T.StringType())])


def _cut(with_text: bool):
    @F.arrow_udf(_DONE)
    def cut(text: pa.Array, ranges: pa.Array) -> pa.Array:
        out = []
        for t, xs in zip(text, ranges.to_pylist(), strict=True):
            raw = t.as_buffer().to_pybytes() if t.is_valid else b""
            kept, removed, spans, reach = [], 0, 0, 0
            for x in sorted(xs or [], key=lambda x: x["s"]):
                if spans and x["s"] <= reach:
                    removed += max(0, x["e"] - reach)
                else:
                    kept.append(raw[reach : x["s"]])
                    removed += x["e"] - x["s"]
                    spans += 1
                    reach = x["e"]
                reach = max(reach, x["e"])
            kept.append(raw[reach:])
            rest = b"".join(kept)
            out.append({"n_bytes": len(raw), "n_removed": removed, "n_spans": spans, "kept_sha256": hashlib.sha256(rest).hexdigest(), "kept": rest.decode(errors="ignore") if with_text else None})
        return pa.array(out, pa.struct([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string())]))

    return cut


def dedup(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and ``kept``, the rest of the text) for every row of ``docs``."""
    rows = versions(docs.select("doc_id", "text", F.col("doc_id").cast("long").alias("id")), "v")
    ranges = repeats(rows).groupBy(F.col("id").alias("k"), F.col("v").alias("kv")).agg(F.collect_list(F.struct("s", "e")).alias("x"))
    joined = rows.join(ranges, (F.col("id") == F.col("k")) & (F.col("v") == F.col("kv")), "left")
    done = joined.select("doc_id", _cut(with_text).asNondeterministic()("text", "x").alias("r"))
    return done.select("doc_id", "r.n_bytes", "r.n_removed", "r.n_spans", "r.kept_sha256", *(["r.kept"] if with_text else []))


#: DuckDB, for query op9: all 50-byte strings, the smallest document of each, and the bytes that they cover.
ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS raw FROM documents),
w AS (SELECT doc_id, p, CAST(array_slice(raw, p + 1, p + {SPAN}) AS BLOB) AS s
      FROM (SELECT doc_id, raw, unnest(range(0, octet_length(raw) - {SPAN - 1})) AS p FROM d WHERE doc_id IS NOT NULL)),
f AS (SELECT s, min(doc_id) AS first FROM w GROUP BY s HAVING min(doc_id) <> max(doc_id)),
h AS (SELECT DISTINCT doc_id, p FROM w JOIN f USING (s) WHERE doc_id > first),
m AS (SELECT doc_id, p, coalesce(p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + {SPAN}, true) AS fresh FROM h),
r AS (SELECT doc_id, min(p) AS a, max(p) + {SPAN} AS b FROM (SELECT doc_id, p, sum(CAST(fresh AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM m) GROUP BY doc_id, run),
k AS (SELECT doc_id, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS lo, a AS hi FROM r
      UNION ALL SELECT doc_id, max(b), NULL FROM r GROUP BY doc_id),
t AS (SELECT doc_id, string_agg(hex(array_slice(raw, lo + 1, coalesce(hi, octet_length(raw)))), '' ORDER BY lo) AS kept FROM k JOIN d USING (doc_id) GROUP BY doc_id),
n AS (SELECT doc_id, sum(b - a) AS removed, count(*) AS spans FROM r GROUP BY doc_id)
SELECT d.doc_id, CAST(octet_length(raw) AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
  CASE WHEN removed IS NULL THEN sha256(raw) ELSE sha256(unhex(t.kept)) END AS kept_sha256
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN t USING (doc_id)
"""
