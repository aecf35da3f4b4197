"""Byte-level text primitives shared by the operators of this subpackage.

Texts arrive as Arrow string arrays; everything here works on their raw UTF-8
buffers with numpy, so no Python string is made per document or per word.

A *word* is a maximal run of bytes that are an ASCII digit, an ASCII letter
(folded to lower case) or part of a multi-byte character.  Null and empty
texts have no words.  Work proceeds in blocks of about ``BLOCK`` bytes, which
bounds the temporaries; one text longer than that forms a block of its own and
is hashed in segments.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

import numpy as np
import pyarrow as pa

BLOCK = 2 << 20
SEGMENT = 1 << 20

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = U64(pow(int(_BASE), -1, 1 << 64))

_fold = np.zeros(256, np.uint8)
for _c in range(256):
    if 0x30 <= _c <= 0x39 or 0x61 <= _c <= 0x7A or _c >= 0x80:
        _fold[_c] = _c
    elif 0x41 <= _c <= 0x5A:
        _fold[_c] = _c + 32
#: Word bytes, A-Z folded; 0 for bytes that end a word.
FOLD = _fold

_pow: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "p" not in _pow or len(_pow["p"]) < n:
        size = max(n, SEGMENT + 4096)
        for key, base in (("p", _BASE), ("i", _BASE_INV)):
            a = np.full(size, base, U64)
            a[0] = 1
            _pow[key] = np.cumprod(a, dtype=U64)
    return _pow["p"], _pow["i"]


#: What this worker process keeps from task to task: the tables of one operator.
_kept: dict = {}


def keep(key: tuple, make: Callable):
    """The worker's tables for ``key``, made when first asked for; those of another key are given back before."""
    if key not in _kept:
        give_back()
        _kept[key] = make()
    return _kept[key]


def give_back() -> None:
    """Drops kept tables, and hands freed memory to the system: workers are reused by stages that have no use for them."""
    if _kept:
        _kept.clear()
        gc.collect()
        trim()


def trim() -> None:
    """Hands memory that this process has freed, but still holds, to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # another C library
        pass


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64), on a copy."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def as_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array and its n + 1 offsets into them; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    bufs = col.buffers()
    offs = np.frombuffer(bufs[1], np.int64 if wide else np.int32)[col.offset : col.offset + n + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None and bufs[2].size else np.zeros(0, np.uint8)
    return data[offs[0] : offs[-1]], offs - offs[0]


def blocks(data: np.ndarray, offs: np.ndarray, size: int = BLOCK):
    """(first row, row after, bytes, offsets) of runs of texts of about ``size`` bytes."""
    n, lo = len(offs) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + size, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


def _runs(inside: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True, never across a text's border."""
    n = len(inside)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    edge = offs[1:-1]
    edge = edge[(edge > 0) & (edge < n)]
    begin[edge] = inside[edge]
    end[edge - 1] = inside[edge - 1]
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


def span_hash(low: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [s, e), which ascend and are not empty."""
    out = np.empty(len(s), U64)
    if not len(s):
        return out
    at = 0
    while at < len(s):
        base = s[at]
        to = max(at + 1, int(np.searchsorted(e, base + SEGMENT, "right")))
        top = int(e[to - 1] - base)
        p, inv = _powers(top + 1)
        c = np.zeros(top + 1, U64)
        np.cumsum((low[base : base + top].astype(U64) + U64(1)) * p[:top], out=c[1:])
        a, b = s[at:to] - base, e[at:to] - base
        out[at:to] = (c[b] - c[a]) * inv[a] + (b - a).astype(U64) * U64(0xD6E8FEB86659FD93)
        at = to
    return mix(out)


def words(data: np.ndarray, offs: np.ndarray):
    """(starts, ends, text index, hash) of every word, in order."""
    low = FOLD[data]
    s, e = _runs(low != 0, offs)
    return s, e, np.searchsorted(offs, s, "right") - 1, span_hash(low, s, e)


_STEP = [U64(x | 1) for x in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]


def windows(wh: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` consecutive words, whatever text they lie in: len(wh) - k + 1 of them."""
    n = len(wh) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    acc = wh[:n].copy()
    for j in range(1, k):
        acc *= _STEP[j & 3]
        acc += wh[j : j + n]
    return mix(acc + U64(k * int(_STEP[0]) & 0xFFFFFFFFFFFFFFFF))


def shingles(wh: np.ndarray, wdoc: np.ndarray, n_docs: int, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(text index, hash) of all k-word shingles; a text of 1 to k-1 words has one, of all its words."""
    full = windows(wh, k)
    inside = wdoc[: len(full)] == wdoc[k - 1 :] if len(full) else np.zeros(0, bool)
    docs, hashes = [wdoc[: len(full)][inside]], [full[inside]]
    counts = np.bincount(wdoc, minlength=n_docs) if len(wdoc) else np.zeros(n_docs, np.int64)
    first = np.concatenate([[0], np.cumsum(counts)[:-1]]) if n_docs else np.zeros(0, np.int64)
    for c in range(1, k):
        rows = np.flatnonzero(counts == c)
        if len(rows):
            all_c = windows(wh, c)
            docs.append(rows)
            hashes.append(all_c[first[rows]])
    return np.concatenate(docs), np.concatenate(hashes)
