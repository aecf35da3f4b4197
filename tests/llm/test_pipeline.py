"""The pipeline on the smallest tables, and the SQL of the queries that have one."""

import re
from pathlib import Path

import pytest

import corpus_pipeline
from trackloom.llm import decontam, near_dup, packing, queries, toxicity

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="needs the driver's tables")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    marks, bench = spark.read.parquet(f"{SF}/labels.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "secret_scan", "packing"]
    calm = {r.doc_id for r in toxicity.score(docs, marks).where("predicted = 0").collect()}
    one = docs.where(docs.doc_id.isin(list(calm)))
    kept = {r.doc_id for r in near_dup.classes(one).where("doc_id = class_id").collect()}
    clean = {r.doc_id for r in decontam.find_hits(one, bench).where("not contaminated").collect()}
    out = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in out.select("doc_id").distinct().collect()} == kept & clean
    got = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, got = got, stage(spark, got, SF)
        assert got.columns == docs.columns
    # Redaction takes effect: nothing that plain patterns find is left, other texts stay as they were, and n_chars follows.
    texts, was = {r.doc_id: r for r in got.collect()}, {r.doc_id: r for r in before.collect()}
    assert set(texts) == set(was) == kept & clean
    secret = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6,}|AKIA[A-Z0-9]{16,}|[0-9a-f]{24,}""")
    held = {i for i, r in was.items() if secret.search(r.text or "")}
    for i, r in texts.items():
        assert r.n_chars == (len(r.text) if r.text != was[i].text else was[i].n_chars)
        if i in held:
            assert r.text != was[i].text and not secret.search(r.text)
    ids = {r.doc_id: 0 for r in out.collect()}
    enc = packing.Encoder.shared(None)
    for r in out.collect():
        ids[r.doc_id] += r.length
    assert all(n == len(enc.slow.encode(texts[i].text or "", add_special_tokens=False).ids) + 1 for i, n in list(ids.items())[:40])


def test_odd_and_empty_tables(spark, tmp_path):
    words = "some words that are long enough for a shingle or two of them"
    rows = [(1, words), (1, "another text under a known id"), (2, words), (3, None), (4, ""), (None, "no id"), (5, "token=abcdef123456 in here")]
    docs = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), 7, "x") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, hits int, score string")
    for name, df in (("documents", docs), ("none", docs.limit(0))):
        sf = str(tmp_path / name)
        df.write.parquet(f"{sf}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
        spark.createDataFrame([(1, None), (2, "")], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    clean = {(r.doc_id, r.text): r.n_chars for r in corpus_pipeline.redact_secrets(spark, docs, str(tmp_path)).collect()}
    kept = {(i, t): None if t is None else len(t) for i, t in rows if i != 5}
    assert kept.items() <= clean.items() and len(clean) == len(rows)
    (marked,) = [t for i, t in clean if i == 5]
    assert "abcdef123456" not in marked and marked.endswith(" in here") and clean[5, marked] == len(marked)
    out = corpus_pipeline.run(spark, str(tmp_path / "documents")).collect()
    assert sorted({(r.doc_id, r.doc_tokens) for r in out}, key=str)[-1][0] is None
    assert {r.doc_id for r in out} == {1, 3, 4, 5, None} and len({(r.doc_id, r.doc_tokens) for r in out if r.doc_id == 1}) == 2
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0


def test_near_dedup_keeps_one_row(spark):
    words = " ".join(f"word{k}" for k in range(30))
    rows = [(5, words), (5, words), (7, words), (8, "another text that nobody repeats"), (9, "seen twice under one id"), (9, "seen twice under one id"), (None, "no id here"), (None, "no id here"), (None, "no id there"), (None, "?!"), (None, "?!"), (None, None)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, k int").repartition(3)
    kept = near_dup.keep_one(docs)
    assert kept.columns == docs.columns
    want = [(5, words), (8, rows[3][1]), (9, rows[4][1]), (None, "no id here"), (None, "no id there"), (None, "?!"), (None, "?!"), (None, None)]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    want = con.execute(queries.oracle_sql()[name])
    names = [d[0] for d in want.description]
    got = queries.queries()[name](spark, SF)
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*names).collect()), key=str) == sorted(want.fetchall(), key=str)
