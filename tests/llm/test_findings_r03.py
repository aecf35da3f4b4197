"""Round 3's findings: texts and tables of the pipeline's secret scan, the alignment's work a chunk, the suffix sort's a repeat."""

import itertools
import weakref

import numpy as np
import pyarrow as pa

from trackloom.llm import alignment, decontam, secret_scan, suffix_dedup
from trackloom.llm.tokens import Encoder


def test_redaction_leaves_texts_where_they_are(spark, monkeypatch):
    had = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = spark.createDataFrame([(1, "password=abcdef12", 17), (2, "plain", 5), (3, None, 0), (2, "token: abcdefgh", 15)], "doc_id long, text string, n_chars int")
        out = {}
        for few in (secret_scan.FEW, 0):
            monkeypatch.setattr(secret_scan, "FEW", few)
            got = secret_scan.redact(docs)
            out[few] = sorted(map(tuple, got.collect()), key=repr)
            plan = got._jdf.queryExecution().executedPlan().toString()
            assert plan.count("SortMergeJoin") <= (few == 0) * 2  # the adaptive plan names a join twice
        assert out[0] == out[max(out)] == [(1, "password=[REDACTED]", 19), (2, "plain", 5), (2, "token: [REDACTED]", 17), (3, None, 0)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", had)


def test_stages_give_back_the_tables_of_others():
    table = decontam.build_table([1], ["one two three"], 3)
    for stage in (secret_scan._scan.func, lambda text: decontam.scan(text, table)):
        encoder = Encoder.shared(None)
        assert Encoder.shared(None) is encoder  # from task to task of one stage they stay
        held = weakref.ref(encoder)
        del encoder
        assert len(stage(pa.array(["password=abcdef12", None, "one two three"]))) == 3
        assert held() is None


def test_new_chunks_are_encoded_and_aligned_together():
    class Counted:
        def __init__(self, fast):
            self.fast, self.calls = fast, 0

        def __getattr__(self, name):
            self.calls += 1
            return getattr(self.fast, name)

    text = " ".join(map("".join, itertools.product("athe", repeat=4)))
    aligner, alone = alignment.Aligner(), alignment.Aligner()
    aligner.fast = Counted(aligner.fast)
    facts, digests, pairs, times, offs = aligner.documents([text, "one  two\n", None, "中文 é"])
    assert aligner.fast.calls <= 3  # not one for each of 256 words
    for k, t in enumerate([text, "one  two\n", None, "中文 é"]):
        one = alone.documents([t])
        own = slice(offs[k], offs[k + 1])
        assert np.array_equal(one[0][0], facts[k]) and one[1] == [digests[k]]
        assert np.array_equal(one[2], pairs[own]) and np.array_equal(one[3], times[own])


def test_chunks_begin_at_spaces_behind_other_characters():
    for n in range(1, 7):
        for t in map("".join, itertools.product("a \n\u3000", repeat=n)):
            assert alignment.cut_chunks(t) == alignment._CHUNK.findall(" " + t)


def test_equal_runs_are_sorted_once(monkeypatch):
    sort, sizes = suffix_dedup.suffix_arrays, []
    monkeypatch.setattr(suffix_dedup, "suffix_arrays", lambda text, ends: sizes.append(len(text)) or sort(text, ends))
    passage = np.random.default_rng(9).integers(97, 123, 300).astype(np.uint8).tobytes()
    parts = [b"%d" % k * 40 + passage + b"%d" % k * 40 for k in range(6)]
    (own, lo, hi), _ = suffix_dedup.covered(np.array([3, 1, 1, 4, 5, 2]), np.zeros(6, np.int64), parts, np.array([False]))
    assert sizes == [302]  # not one run for each of six stretches
    assert (own.tolist(), set(lo.tolist()), set(hi.tolist())) == ([0, 3, 4, 5], {40}, {291})


def test_covered_strings_are_those_of_smaller_documents():
    rng = np.random.default_rng(4)
    for _ in range(30):
        pool = [rng.integers(97, 99, n).astype(np.uint8).tobytes() for n in rng.integers(1, 90, 6)]
        parts = [b"".join(pool[k] for k in rng.integers(0, 6, 5)).ljust(suffix_dedup.SPAN, b"a") for _ in range(25)]
        lanes, docs, salted = np.sort(rng.integers(0, 4, 25)), rng.integers(-3, 4, 25), rng.random(4) < 0.5
        lanes = np.unique(lanes, return_inverse=True)[1]
        strings = [[p[x : x + suffix_dedup.SPAN] for x in range(len(p) - suffix_dedup.SPAN + 1)] for p in parts]
        least: dict = {}
        for own, doc, lane in zip(strings, docs.tolist(), lanes.tolist(), strict=True):
            for x in own:
                least[lane, x] = min(doc, least.get((lane, x), doc))
        hits = [{(i, k) for i, lo, hi in zip(*found, strict=True) for k in range(lo, hi)} for found in suffix_dedup.covered(docs, lanes, parts, salted)]
        all_of = {(i, k) for i, own in enumerate(strings) for k in range(len(own))}
        want = {(i, k) for i, k in all_of if least[lanes[i], strings[i][k]] < docs[i]}
        assert hits == [want, {(i, k) for i, k in all_of - want if salted[lanes[i]]}]
