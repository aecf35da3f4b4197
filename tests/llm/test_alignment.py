"""Cross-tokenizer alignment against whole texts encoded by the two libraries."""

import collections
import hashlib
import json

import public_tokenizers
from sentencepiece import SentencePieceProcessor
from test_operators import table
from tokenizers import Tokenizer

from trackloom.llm import alignment
from trackloom.llm.alignment import Aligner
from trackloom.llm.tokens import byte_symbols

COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


class Plain:
    """Both tokenizations of whole texts, with each token's byte range."""

    def __init__(self):
        path = public_tokenizers.path("byte_bpe_50k.json")
        self.a = Tokenizer.from_file(path)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
        sym = byte_symbols()
        with open(path, encoding="utf-8") as f:
            self.a_bytes = {i: bytes(sym.get(c, 0) for c in t) for t, i in json.load(f)["model"]["vocab"].items()}

    def ranges(self, ids, raw):
        at, out = 0, []
        for i in ids:
            out.append((i, at, at := at + len(raw(i))))
        return out, b"".join(raw(i) for i in ids)

    def b_raw(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if piece.startswith("<0x") and len(piece) == 6 else piece.replace("▁", " ").encode()

    def tokens(self, text):
        if not text:
            return [], []
        want = (" " + text).encode()
        a, a_all = self.ranges(self.a.encode(" " + text, add_special_tokens=False).ids, self.a_bytes.__getitem__)
        b, b_all = self.ranges(self.b.encode(text), self.b_raw)
        return (a, b) if a_all == want == b_all else ([], [])


def by_force(rows):
    plain, docs, counts = Plain(), [], collections.Counter()
    for doc_id, text in rows:
        a, b = plain.tokens(text)
        overlaps = [(x, y) for x, s, e in a for y, u, v in b if s < v and u < e]
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, low = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for i, s, e in side if low <= s and e <= cut) for side in (a, b)))
            low = cut
        docs.append((doc_id, a, b, groups, overlaps))
        counts.update(set(overlaps))
    top = collections.defaultdict(int)
    for (x, _), n in counts.items():
        top[x] = max(top[x], n)
    return sorted(
        ((i, len(a), len(b), len(g), len(o), sum(counts[p] == top[p[0]] for p in o), sum(counts[p] for p in o), hashlib.sha256(";".join(g).encode()).hexdigest() if a else "") for i, a, b, g, o in docs),
        key=repr,
    )


ODD = [
    None, "", " ", "  ", "a", " a", "a ", "a  ", "\n", "a\n b", " \n a", "x\ty \u00a0 z", "tab\x1c sep", "nul\0 byte", "<|endoftext|> and </s> <s> <unk>", "under ▁ score", "ﬁ ligature 漢字　かな", "e\u0301 combining",
    "don't we'll I'm", "12345 67 8", "🙂🙂 emoji🙂 x", "ends with spaces   ", "a" * 300, "-" * 200 + " " + "=" * 77, "\r\n windows\r\n lines", "é à ü ñ", "\u2003wide \u2003 space", "mixed\u200b zero", "( [ { ) ] }",
]


def got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def test_odd_texts_equal_whole_texts(spark):
    rows = list(enumerate(ODD)) + [(3, "another under a known id"), (None, "no id at all"), (5, "a")]
    assert got(alignment.links(table(spark, rows))) == by_force(rows)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    short = [(r.doc_id, r.text) for r in docs.collect() if r.text is None or len(r.text) < 1500][:60]
    assert got(alignment.links(table(spark, short))) == by_force(short)
    whole, plain = Aligner.shared(None, None), Plain()
    for r in docs.collect()[:60]:  # long texts, kernel only
        a, b = plain.tokens(r.text)
        assert whole.documents([r.text])[0][0, :2].tolist() == [len(a), len(b)]


def test_hot_ids_are_dealt_alike(spark):
    rng = __import__("random").Random(3)
    rows = [(k, m, a, b) for k in range(120) for a in (1, 2, 3) for b, m in {rng.randrange(6): rng.randint(1, 4), 7: 1}.items()]
    posted = spark.createDataFrame([(k, a, b, m) for k, m, a, b in rows], "key long, a int, b int, m int")
    plain = sorted(map(tuple, alignment.contributions(posted).collect()))
    counts = collections.Counter((a, b) for _, _, a, b in rows)
    best = {a: max(n for (x, _), n in counts.items() if x == a) for a in (1, 2, 3)}
    want = collections.defaultdict(lambda: [0, 0])
    for k, m, a, b in rows:
        want[k][0] += m * (counts[a, b] == best[a])
        want[k][1] += m * counts[a, b]
    assert plain == sorted((k, *v) for k, v in want.items())
    assert sorted(map(tuple, alignment.contributions(posted, least=16, share=10).collect())) == plain


def test_empty_and_very_long(spark):
    assert got(alignment.links(table(spark, []))) == []
    long = "word another third " * 60_000 + "é" * 5000
    row = alignment.links(table(spark, [(1, long)])).first()
    a, b = Plain().tokens(long)
    assert (row.n_a, row.n_b) == (len(a), len(b))
    assert row.n_links == row.n_best == row.count_sum


def test_a_worker_that_forgets(monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBER", 3)
    small, whole = Aligner(), Aligner.shared(None, None)
    for t in (*ODD, "one two three four five six seven"):
        assert [str(x) for x in small.documents([t, t])] == [str(x) for x in whole.documents([t, t])]
