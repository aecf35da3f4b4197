"""Cross-tokenizer alignment (operator 12).

Every text is encoded by a byte-level BPE (A) and a piece BPE (B).  Where tokens of
both end at one byte, a group ends; every A and B token whose bytes overlap are
linked.  How many documents hold a linked pair of ids is counted over the corpus.

Postings: a document sends each of its linked id pairs once, with its multiplicity.
The postings of an A id are shuffled to one task, where Spark's sorter, which spills,
lays the documents of a pair side by side; windows over that order count each pair's
documents and find the A id's largest count, and every posting gives its document a
contribution.  The contributions are summed by document, before the shuffle as well.
A ids that hold many postings are dealt over several tasks by document; their
pairs are counted beforehand by partial aggregation.

Both tokenizers split before a space that follows a character other than white space
(no merge of either crosses it), so groups never cross it either.  A text is cut
there, and every distinct chunk of a worker is aligned once and remembered.

Edge cases: a text that is null, empty, or whose tokens' bytes differ from its own
(a space before it) has no tokens: zeros and an empty digest; it still is a row.
Each row is a document of its own, also under a repeated or null doc_id.  Extra columns
are ignored; very long texts are encoded whole; an empty table gives an empty one.
Of pairs with the highest count, all count as best.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import defaultdict
from itertools import chain, count, islice
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kit
from .store import join_dealt, settle, small_batches
from .tokens import byte_symbols

#: Distinct chunks that a worker remembers, and bytes of their results, before it starts afresh.
REMEMBER, REMEMBER_BYTES = 400_000, 160 << 20
#: Characters of texts that are aligned at a time; one longer text is aligned alone.
BATCH = 1 << 20
#: Bits of a B id within a pair.
SIDE = 15
#: An A id is hot beyond this many postings and this share of all.
LEAST, SHARE = 4096, 2000

_LAST = itemgetter(-1)
_CHUNK = re.compile(r" \s*\S*(?:[^\S ]\s*\S*)*")
#: Fixed value: how byte_bpe_50k splits texts before it merges bytes.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Ids in decimal, with room for a mark, and their numbers of digits.
_DECIMAL = np.frombuffer("".join(f"{i:<6}" for i in range(1 << 31 - SIDE)).encode(), np.uint8).reshape(-1, 6)
_DIGITS = np.array([len(str(i)) for i in range(1 << 31 - SIDE)], np.int64)
#: Characters whose classes no version of Unicode disputes.
_PLAIN = re.compile("[\x21-\x7e\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f \n]*")


def cut_chunks(text: str) -> list[str]:
    """The chunks of a text behind a space: as _CHUNK finds them."""
    words = text.split(" ")
    # Where no white space lies before a space, every space begins a chunk.
    if "" not in words and not any(map(str.isspace, map(_LAST, words))):
        return [" " + w for w in words]
    return _CHUNK.findall(" " + text)


def _sizes(chunks: list[str], plain: bool) -> np.ndarray:
    """Bytes of each chunk; in plain ones, a character has one."""
    return np.array([len(c) if plain else len(c.encode()) for c in chunks], np.int64)


def align(a: np.ndarray, b: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray, stops: np.ndarray):
    """Groups and links of two tokenizations of the same bytes, cut into chunks that end at the bytes ``stops``.

    Returns each chunk's number of groups and of links, the linked pairs (a << SIDE | b) in order, and each
    chunk's groups as ``a1,a2|b1;a3|b2;``.
    """
    ended = np.zeros(stops[-1] + 1, np.uint8)
    ended[a_ends] = 1
    ended[b_ends] |= 2
    ends = np.flatnonzero(ended)  # between two of them lies one link
    in_a, in_b, both = (ended[ends] & 1).astype(bool), ended[ends] > 1, ended[ends] == 3
    up_a, up_b, up_g = np.cumsum(in_a), np.cumsum(in_b), np.cumsum(both)
    pairs = a[up_a - in_a] << SIDE | b[up_b - in_b]
    last = np.searchsorted(ends, stops)
    # Tokens lie in the order in which groups name them, each followed by its mark.
    before = np.concatenate([[0], up_b[both]])
    at_a = np.arange(len(a)) + before[(up_g - both)[in_a]]
    at_b = np.arange(len(b)) + up_a[both][(up_g - both)[in_b]]
    ids, marks = np.empty(len(a) + len(b), np.int32), np.empty(len(a) + len(b), np.uint8)
    ids[at_a], ids[at_b] = a, b
    marks[at_a] = np.where(both[in_a], ord("|"), ord(","))
    marks[at_b] = np.where(both[in_b], ord(";"), ord(","))
    size = _DIGITS[ids]
    text = _DECIMAL[ids]
    text[np.arange(len(ids)), size] = marks
    raw = text[np.arange(text.shape[1]) <= size[:, None]].tobytes()
    upto = np.cumsum(size + 1)[up_a[last] + up_b[last] - 1].tolist()
    names = [raw[x:y] for x, y in zip([0, *upto], upto)]
    return np.diff(up_g[last], prepend=0), np.diff(last + 1, prepend=0), pairs, names


class Aligner:
    @classmethod
    def shared(cls, byte_bpe: str | None, piece_bpe: str | None) -> Aligner:
        """One per worker process and pair of files."""
        return kit.keep((cls, byte_bpe, piece_bpe), lambda: cls(byte_bpe, piece_bpe))

    def __init__(self, byte_bpe: str | None = None, piece_bpe: str | None = None) -> None:
        import tiktoken
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        if byte_bpe is None or piece_bpe is None:
            import public_tokenizers

            byte_bpe, piece_bpe = byte_bpe or public_tokenizers.path("byte_bpe_50k.json"), piece_bpe or public_tokenizers.path("piece_bpe_32k.model")
        self.a, self.b = Tokenizer.from_file(byte_bpe), SentencePieceProcessor(model_file=piece_bpe)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        sym = byte_symbols()
        with open(byte_bpe, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for t, i in vocab.items():
            self.a_bytes[i] = bytes(sym[c] for c in t) if all(c in sym for c in t) else b""
        # Ids ascend in the order of merges, so they serve as ranks.
        special = {t["content"] for t in json.loads(self.a.to_str())["added_tokens"]}
        self.fast = tiktoken.Encoding("bytes", pat_str=_SPLIT, mergeable_ranks={self.a_bytes[i]: i for t, i in vocab.items() if t not in special}, special_tokens={})
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            byte = re.fullmatch("<0x([0-9A-Fa-f]{2})>", piece)
            self.b_bytes.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())
        self.a_size, self.b_size = (np.array([len(x) for x in side], np.int64) for side in (self.a_bytes, self.b_bytes))
        if len(self.b_bytes) > 1 << SIDE or max(vocab.values()) >= 1 << 31 - SIDE:
            raise ValueError("the vocabularies are too large for pairs in an int")
        self._space = self.b.piece_to_id("▁")
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = defaultdict(count().__next__)  # a chunk gets the next number where it is first met
        self.names: list[bytes] = []
        self.held = self.used = 0
        self.pool = np.zeros(1 << 20, np.int32)
        #: Of each chunk: tokens of A, of B, groups, links, place of its pairs, and 1 if its bytes are not those of its tokens.
        self.facts = np.zeros((1 << 16, 6), np.int64)

    def encode(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A's ids of chunks, which start with a space, and their number in each; then B's, which adds that space itself."""
        b = self.b.encode([c[1:] for c in chunks], num_threads=1)
        b = [ids if c != " " else [self._space] for c, ids in zip(chunks, b, strict=True)]
        return *self._encode_a(chunks), np.array(list(chain.from_iterable(b)), np.int32), np.array(list(map(len, b)), np.int64)

    def _encode_a(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        text = "".join(chunks)
        # A chunk that ends in white space would be split otherwise with another one's space behind it.
        if _PLAIN.fullmatch(text) and not any(c[-1] in " \n" for c in chunks):
            ids = self.fast.encode_to_numpy(text, disallowed_special=()).astype(np.int32)
            ends = np.cumsum(self.a_size[ids])
            upto = np.searchsorted(ends, np.cumsum(_sizes(chunks, text.isascii())), "right")
            return ids, np.diff(upto, prepend=0)
        out: list = [None] * len(chunks)
        plain = [i for i, c in enumerate(chunks) if c[-1] not in " \n" and _PLAIN.fullmatch(c)]
        if plain:
            ids, sizes = self._encode_a([chunks[i] for i in plain])
            for i, own in zip(plain, np.split(ids, np.cumsum(sizes)[:-1]), strict=True):
                out[i] = own
        for i, c in enumerate(chunks):
            if out[i] is None:
                out[i] = np.array(self.fast.encode_ordinary(c) if _PLAIN.fullmatch(c) else self.a.encode(c, add_special_tokens=False).ids, np.int32)
        return np.concatenate(out), np.array(list(map(len, out)), np.int64)

    def _whole(self, chunks: list[str], ids: np.ndarray, sizes: np.ndarray, token: list[bytes], width: np.ndarray) -> np.ndarray:
        """Whether the bytes of each chunk are those of its tokens."""
        got, text = b"".join(map(token.__getitem__, ids.tolist())), "".join(chunks)
        at = np.concatenate([[0], np.cumsum(width[ids])])[np.concatenate([[0], np.cumsum(sizes)])]
        same = np.diff(at) == _sizes(chunks, text.isascii())
        if same.all() and got == text.encode():
            return same
        at = at.tolist()
        return np.array([got[x:y] == c.encode() for x, y, c in zip(at, at[1:], chunks)])

    def _learn(self, chunks: list[str]) -> None:
        """Facts, pairs and names of the chunks that are numbered next."""
        a, n_a, b, n_b = self.encode(chunks)
        good = self._whole(chunks, a, n_a, self.a_bytes, self.a_size) & self._whole(chunks, b, n_b, self.b_bytes, self.b_size)
        facts, names = np.zeros((len(chunks), 6), np.int64), [b""] * len(chunks)
        facts[:, 4], facts[:, 5] = self.used, ~good
        pairs = np.zeros(0, np.int32)
        if good.any():
            if not good.all():
                a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
            a_ends, b_ends = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
            groups, links, pairs, found = align(a, b, a_ends, b_ends, a_ends[np.cumsum(n_a[good]) - 1])
            facts[good, :4] = np.stack([n_a[good], n_b[good], groups, links], axis=1)
            facts[good, 4] += np.cumsum(links) - links
            for i, name in zip(np.flatnonzero(good).tolist(), found, strict=True):
                names[i] = name
        before, at = len(self.names), self.used + len(pairs)
        self.names += names
        while len(self.facts) < len(self.names):
            self.facts = np.concatenate([self.facts, np.zeros_like(self.facts)])
        self.facts[before : len(self.names)] = facts
        while len(self.pool) < at:
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used : at] = pairs
        self.held += sum(map(len, chunks)) + sum(map(len, names)) + 150 * len(chunks) + 4 * len(pairs)
        self.used = at

    def documents(self, texts: list[str | None]):
        """(facts, digests, pairs, times, offsets): n_a, n_b, n_groups and n_links of each text, and its pairs with their multiplicities."""
        cut = [cut_chunks(t) if t else [] for t in texts]
        flat = list(chain.from_iterable(cut))
        if len(self.known) > REMEMBER or self.held > REMEMBER_BYTES:
            self._forget()
        ids = list(map(self.known.__getitem__, flat))
        new = list(islice(reversed(self.known), len(self.known) - len(self.names)))[::-1]
        for lo, hi in _batches(new):
            self._learn(new[lo:hi])
        offs = np.concatenate([[0], np.cumsum([len(c) for c in cut])]).astype(np.int64)
        facts = self.facts[np.array(ids, np.int64)]
        whole = np.zeros((len(facts) + 1, 6), np.int64)
        np.cumsum(facts, axis=0, out=whole[1:])
        of = whole[offs[1:]] - whole[offs[:-1]]
        good = of[:, 5] == 0
        name = self.names.__getitem__
        digests = [hashlib.sha256(memoryview(b"".join(map(name, ids[lo:hi])))[:-1]).hexdigest() if ok and hi > lo else "" for lo, hi, ok in zip(offs[:-1].tolist(), offs[1:].tolist(), good, strict=True)]
        doc = np.repeat(np.arange(len(texts)), np.diff(offs))
        use = good[doc]
        size, first = facts[use, 3], facts[use, 4]
        ends = np.cumsum(size)
        pairs = self.pool[np.repeat(first - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]
        once, times = np.unique(np.repeat(doc[use], size) << 32 | pairs, return_counts=True)
        return of[:, :4] * good[:, None], digests, (once & 0xFFFFFFFF).astype(np.int32), times.astype(np.int32), np.searchsorted(once >> 32, np.arange(len(texts) + 1)).astype(np.int32)


def _batches(texts: list[str | None]):
    """(first, last) of runs of texts of about BATCH characters."""
    lo = held = 0
    for i, t in enumerate(texts):
        if held and held + len(t or "") > BATCH:
            yield lo, i
            lo, held = i, 0
        held += len(t or "") + 1
    if lo < len(texts):
        yield lo, len(texts)


def aligned(docs: DataFrame, byte_bpe: str | None = None, piece_bpe: str | None = None) -> DataFrame:
    """One row a document: key, doc_id, its counts and digest, and its linked pairs with their multiplicities."""

    def run(batches):
        base, n = TaskContext.get().partitionId() << 40, 0
        aligner = Aligner.shared(byte_bpe, piece_bpe)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for lo, hi in _batches(texts):
                facts, digests, pairs, times, offs = aligner.documents(texts[lo:hi])
                keys = pa.array(np.arange(base + n, base + n + hi - lo))
                n += hi - lo
                cols = [keys, batch.column(0).slice(lo, hi - lo), *[pa.array(c.copy()) for c in facts.T], pa.array(digests, pa.string()), *[pa.ListArray.from_arrays(pa.array(offs), pa.array(c)) for c in (pairs, times)]]
                yield pa.RecordBatch.from_arrays(cols, ["key", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])

    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "key long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<int>, times array<int>")


def contributions(postings: DataFrame, least: int = LEAST, share: int = SHARE) -> DataFrame:
    """(key, n_best, count_sum) of every document of ``postings`` (key, a, b, m), which has a row for each document and pair."""
    sizes = postings.groupBy("a").agg(F.count("*").alias("n"))
    bar = max(least, (sizes.agg(F.sum("n")).first()[0] or 0) // share)
    hot = F.broadcast(sizes.where(F.col("n") > bar).select("a"))  # at most ``share`` ids
    gives = [F.sum(F.when(F.col("c") == F.col("best"), F.col("m")).otherwise(0)).alias("n_best"), F.sum(F.col("m") * F.col("c")).alias("count_sum")]
    whole = postings.join(hot, "a", "left_anti").repartition("a")
    counted = whole.withColumn("c", F.count("*").over(Window.partitionBy("a", "b"))).withColumn("best", F.max("c").over(Window.partitionBy("a")))
    split = postings.join(hot, "a", "left_semi")
    pairs = split.groupBy("a", "b").agg(F.count("*").alias("n")).withColumn("c", F.col("n"))
    pairs = pairs.join(pairs.groupBy("a").agg(F.max("c").alias("best")), "a")
    dealt = join_dealt(split, pairs, ["a", "b"], "key", least)
    cols = ["key", "m", "c", "best"]
    return counted.select(cols).unionByName(dealt.select(cols)).groupBy("key").agg(*gives)


def links(docs: DataFrame, byte_bpe: str | None = None, piece_bpe: str | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row of ``docs``."""
    made = settle(aligned(docs, byte_bpe, piece_bpe))
    each = made.select("key", F.explode(F.arrays_zip("pairs", "times")).alias("x"))
    postings = each.select("key", F.shiftright("x.pairs", SIDE).alias("a"), F.col("x.pairs").bitwiseAND((1 << SIDE) - 1).alias("b"), F.col("x.times").alias("m"))
    out = made.drop("pairs", "times").join(contributions(postings), "key", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
