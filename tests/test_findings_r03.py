"""Round 3's findings: rounds of a fold that forgets slowly, and plans whose tasks hold no key's rows."""

import math

import pytest

from trackloom.operators import folds, gates, manifest, metrics, track


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    had = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", had)


@pytest.mark.parametrize("forget", [10**9, 70])
def test_fold_rounds_grow_with_the_logarithm_of_parts(spark, monkeypatch, forget):
    """A sum that forgets at every ``forget``-th row, over some 150 parts in two keys, one of them null."""
    rounds = []
    monkeypatch.setattr(folds, "checkpointed", lambda df, real=folds.checkpointed: rounds.append(1) or real(df))

    def run(cols, last):
        out, s = [], last or 0
        for (x,) in zip(*cols, strict=True):
            s = x if x % forget == 0 else s + x
            out.append(s)
        return out, s

    rows = [(k, t, t) for k in ("a", None) for t in range(1, 301)]
    df = spark.createDataFrame(rows, "k string, t long, x long").repartition(5)
    got = folds.fold(df, run, inputs=["x"], keys=["k"], order=["t"], column="s", kind="long", rows=4).collect()
    said = dict(zip(range(1, 301), run([list(range(1, 301))], None)[0], strict=True))
    assert len(got) == 600 and all(r.s == said[r.t] for r in got)
    assert len(rounds) <= 5


def test_path_lengths_in_parts(spark):
    """Parts of 5 samples, also where places in the order repeat, are null or hold no sample, add up to the whole path."""
    rows = [("a", None, 3.0, 1.0)] + [("a", t, float(t * t % 7), float(t % 3)) for t in (1, 2, 2, 3, 40, 41, 42, 43, 44, 45, 46, 47)] + [(None, 5, 1.0, 1.0)] + [("b", t, 0.0, None) for t in range(9)]
    df = spark.createDataFrame(rows, "k string, t long, x double, y double")
    got = {r.k: r.d for r in track.path_lengths(df, {"d": ("x", "y")}, keys=["k"], order=["t"], rows=5).collect()}
    a = [r[2:] for r in sorted((r for r in rows if r[0] == "a"), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))]
    assert got["b"] == got[None] == 0.0
    assert math.isclose(got["a"], sum(math.dist(p, q) for p, q in zip(a, a[1:], strict=False)))
    m = metrics.alignment(df.na.fill(0.0), ref=("x", "y"), est=("x", "y"), keys=["k"], order=["t"])
    assert "_part" in _plan(m)  # no window over a key's rows


def test_gates_sort_no_polls(spark, no_broadcast):
    polls = spark.createDataFrame([(1, 5, gates.STAGES[0], True)], "session_id long, t_ns long, gate string, ready boolean")
    judged = gates.ordered_gates(polls, gates.capture_gates())
    fixes = spark.createDataFrame([(1, 5, 1)], "session_id long, t_ns long, ord long")
    made = gates.abort_manifests(judged, gates.capture_gates(), fixes)
    for df in (judged, made):
        assert "SortMergeJoin" not in _plan(df) and "ShuffledHashJoin" in _plan(df)
    assert made.first().gps_rows_written == 1


def test_manifest_paths_stay_in_their_row(spark):
    chunk = "struct<chunk_index:int,produced_files:array<string>,lidar_pcap_path:string,lidar_csv_path:string,requested_output_path:string>"
    rows = [
        (1, [(2, ["b.pcap", "a.OSF"], "c.pcap", None, None), None, (1, None, "b.pcap", None, "z.csv"), (None, ["0.pcap"], None, None, "b.pcap")], None),
        (2, None, "top.csv"), (3, [(1, [None, "x.csv"], None, "y.csv", "x.csv")], "top.csv"), (4, [], None),
    ]
    df = spark.createDataFrame(rows, f"s int, chunks array<{chunk}>, lidar_csv_path string")
    raw = manifest.manifest_paths(df, "raw", keys=["s"])
    assert "Window" not in _plan(raw) and "Exchange" not in _plan(raw)
    assert sorted(map(tuple, raw.collect())) == [(1, 1, "b.pcap"), (1, 2, "a.OSF"), (1, 3, "c.pcap"), (1, 4, "0.pcap")]
    assert sorted(map(tuple, manifest.manifest_paths(df, "csv", keys=["s"]).collect())) == [(1, 1, "z.csv"), (2, 1, "top.csv"), (3, 1, "x.csv"), (3, 2, "y.csv")]
