"""Exact token ids of a public word-level BPE vocabulary, at memory speed.

The vocabulary's pre-tokenizer never joins text across white space, nor an
ASCII letter or digit with a following mark such as a comma, so a text's ids
are the concatenation of its chunks' ids.  Chunks are found and hashed on raw
bytes; each distinct chunk is encoded once per worker and remembered.

New chunks whose characters are plain (ASCII, Latin letters) go through one
bulk call of a byte-pair encoder built from the same merges, where the word-end
mark is a NUL byte: as every merge product of the vocabulary is reached by one
merge only, joining the lowest-ranked *bytes* equals joining the lowest-ranked
*pair*.  Any other chunk, and any text that holds a special token, goes to the
tokenizer itself.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa

from . import kit

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x0A, 0x09, 0x0D]] = True
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_MARK = np.zeros(256, bool)
_MARK[list(b",.;:!?")] = True
_LETTER = "a-z\u00df-\u00f6\u00f8-\u017f"
_PLAIN = re.compile("[\x21-\x7e\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f\n]*")
_WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[0-9]|\n|[^\\s0-9{_LETTER}]+")
#: Distinct chunks remembered by a worker before it starts afresh.
REMEMBER = 300_000


def byte_symbols() -> dict[str, int]:
    """The printable stand-in of every byte in byte-level vocabularies -> the byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    @classmethod
    def shared(cls, path: str | None) -> Encoder:
        """One per worker process and file."""
        return kit.keep((cls, path), lambda: cls(path))

    def __init__(self, path: str | None = None) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("word_bpe_49k.json")
        self.slow = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        vocab, sym = model["model"]["vocab"], byte_symbols()
        self.special = [t["content"].encode() for t in model["added_tokens"]]

        def raw(token: str) -> bytes:
            body = token.removesuffix("</w>")
            return bytes(sym[c] for c in body) + (b"\0" if len(body) < len(token) else b"")

        ranks, ids = {}, []
        for b in range(256):
            ranks[bytes([b])] = len(ids)
            ids.append(vocab.get(next(c for c, v in sym.items() if v == b), 0))
        for b in range(1, 256):
            ranks[bytes([b, 0])] = len(ids)
            ids.append(vocab[next(c for c, v in sym.items() if v == b) + "</w>"])
        for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["model"]["merges"]):
            key = raw(a) + raw(b)
            if key in ranks:
                raise ValueError(f"the vocabulary reaches {a + b!r} by two merges")
            ranks[key] = len(ids)
            ids.append(vocab[a + b])
        self.ids = np.array(ids, np.uint32)
        self.stop = ranks[b"\n\0"]
        self.fast = tiktoken.Encoding("words", pat_str="[^\0]+\0", mergeable_ranks=ranks, special_tokens={})
        self._forget()

    def _forget(self) -> None:
        self.known: dict[int, int] = {}
        self.pool = np.zeros(1 << 20, np.uint32)
        self.used = 0
        self.start = np.zeros(1 << 16, np.int64)
        self.size = np.zeros(1 << 16, np.int64)

    def _remember(self, hashes: list[int], flat: np.ndarray, sizes: np.ndarray) -> None:
        n, k = len(self.known), len(hashes)
        while self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while n + k > len(self.start):
            self.start, self.size = (np.concatenate([a, np.zeros_like(a)]) for a in (self.start, self.size))
        self.pool[self.used : self.used + len(flat)] = flat
        self.start[n : n + k] = self.used + np.cumsum(sizes) - sizes
        self.size[n : n + k] = sizes
        self.used += len(flat)
        self.known.update(zip(hashes, range(n, n + k), strict=True))

    def chunk_ids(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids and the number for each chunk."""
        text = "\n".join(chunks) + "\n"
        if _PLAIN.fullmatch(text):
            pieces = _WORD.findall(text.lower())
            got = np.array(self.fast.encode_ordinary("\0".join(pieces) + "\0"), np.int64)
            ends = np.flatnonzero(got == self.stop)
            sizes = np.diff(np.concatenate([[-1], ends])) - 1
            return self.ids[got[got != self.stop]], sizes
        out = [None] * len(chunks)
        plain = [i for i, c in enumerate(chunks) if _PLAIN.fullmatch(c)]
        if plain:
            flat, sizes = self.chunk_ids([chunks[i] for i in plain])
            for i, a in zip(plain, np.split(flat, np.cumsum(sizes)[:-1]), strict=True):
                out[i] = a
        for i, c in enumerate(chunks):
            if out[i] is None:
                out[i] = np.array(self.slow.encode(c, add_special_tokens=False).ids, np.uint32)
        return np.concatenate(out), np.array([len(a) for a in out], np.int64)

    def encode(self, col: pa.Array, end_id: int | None = None):
        """Yields (ids, offsets) of runs of texts, in order; ``end_id`` follows each text."""
        data, offs = kit.as_bytes(col)
        for lo, hi, block, at in kit.blocks(data, offs):
            yield self._block(block, at, end_id)

    def _block(self, data: np.ndarray, offs: np.ndarray, end_id: int | None):
        n_docs, n = len(offs) - 1, len(data)
        inside = ~_SPACE[data]
        s, e = kit._runs(inside, offs)
        if len(s):
            cut = np.flatnonzero(_MARK[data[1:]] & _ALNUM[data[:-1]]) + 1
            if len(cut):
                edge = np.zeros(n + 1, bool)
                edge[offs] = True
                cut = cut[~edge[cut]]
                s, e = np.sort(np.concatenate([s, cut])), np.sort(np.concatenate([e, cut]))
        doc = np.searchsorted(offs, s, "right") - 1
        h = kit.span_hash(data, s, e)
        uniq, first, inv = np.unique(h, return_index=True, return_inverse=True)
        if len(self.known) + len(uniq) > REMEMBER:
            self._forget()
        get = self.known.get
        index = np.array([get(x, -1) for x in uniq.tolist()], np.int64)
        new = np.flatnonzero(index < 0)
        if len(new):
            raw = data.tobytes()
            chunks = [raw[a:b].decode() for a, b in zip(s[first[new]].tolist(), e[first[new]].tolist(), strict=True)]
            before = len(self.known)
            self._remember(uniq[new].tolist(), *self.chunk_ids(chunks))
            index[new] = np.arange(before, before + len(new))
        word = index[inv] if len(inv) else np.zeros(0, np.int64)
        size = self.size[word]
        total = np.zeros(len(s) + 1, np.int64)
        np.cumsum(size, out=total[1:])
        src = np.repeat(self.start[word] - total[:-1], size) + np.arange(total[-1])
        flat = self.pool[src]
        out_offs = total[np.searchsorted(doc, np.arange(n_docs + 1))]
        special = self._special(data, offs)
        if special:
            parts = [flat[out_offs[i] : out_offs[i + 1]] for i in range(n_docs)]
            for i in special:
                text = data[offs[i] : offs[i + 1]].tobytes().decode()
                parts[i] = np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)
            flat = np.concatenate(parts)
            out_offs = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        if end_id is not None:
            flat = np.insert(flat, out_offs[1:], np.uint32(end_id))
            out_offs = out_offs + np.arange(n_docs + 1)
        return flat, out_offs

    def _special(self, data: np.ndarray, offs: np.ndarray) -> list[int]:
        """Texts in which a special token's string occurs."""
        raw, out = data.tobytes(), set()
        for token in self.special:
            at = raw.find(token)
            while at >= 0:
                out.add(int(np.searchsorted(offs, at, "right")) - 1)
                at = raw.find(token, at + 1)
        return sorted(out)
