"""Hard-negative mining (operator 13): scores by a two-dimensional block matrix multiply.

Rows are dealt by hash into blocks of about ``ROWS`` (anchors: ``ANCHORS``), and each
block is cut into chunks of ``DIMS`` dimensions.  As in SUMMA, a chunk of an anchor
block travels along its row of the grid of tiles and a chunk of a row block along its
column; where both meet, their product is a partial int64 tile.  The partial tiles of
one (anchor block, row block) are shuffled together and added, and the full tile is at
once reduced to what it can contribute: no tile is stored, no pair of rows is a record.

Blocks hold rows of one group of labels (``GROUPS`` of them).  Positives come from the
tiles whose two groups are equal; they join the anchor blocks, and the second multiply
keeps for every anchor and positive the first rows of its window.  Tiles of one single
label are left out there, so that each product is made once.  Whatever label or vector
a third of the rows share, blocks hold equal numbers of rows.

Edge cases: rows with a null id, label or vector, or with a null or non-finite component,
take no part, nor do vectors of another length than most, or with a component of 2^18
or more in magnitude (scores would leave int64).  A repeated row (same id, label and
vector) counts once; different rows of one id count each, and an anchor's result then
lists each of its rows' positives.  Ties go to the smaller id.  Extra columns are
ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import settle, small_batches

#: Rows of a block, anchors of an anchor block, and dimensions of a chunk.
ROWS, ANCHORS, DIMS = 4096, 128, 32
#: Groups of labels.
GROUPS = 16
#: One in how many ids is an anchor, positives of an anchor, negatives of a positive.
EVERY, POSITIVES, NEGATIVES = 100, 5, 10
#: One in how many ids has its label moved on by one, of how many labels.
MOVED, LABELS = 7, 10
#: Steps of a component, its bound, and the window of negatives in hundredths of the positive's score.
SCALE, LARGEST = 256, 1 << 18
LOW, HIGH = 30, 90

RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def whole_rows(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, v, uid) of the rows that take part, labels moved and components in whole 256ths."""
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % MOVED == 0, (label + 1) % LABELS).otherwise(label)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), F.transform(x, lambda c: F.floor(c * SCALE).cast("long")).alias("v")).distinct()
    rows = settle(rows.withColumn("uid", F.xxhash64("vec_id", "label", "v")))
    usual = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("v") == (usual["d"] if usual else 0))


def _by_group(of: dict[int, Column]) -> Column:
    """The value of the row's group ``g``."""
    out = F.lit(None)
    for g, value in of.items():
        out = F.when(F.col("g") == g, value).otherwise(out)
    return out


def _span(*ranges: tuple[int, int]) -> Column:
    """The whole numbers of the ranges [lo, hi)."""
    parts = [F.sequence(F.lit(lo), F.lit(hi - 1)) for lo, hi in ranges if hi > lo]
    return F.concat(*parts) if parts else F.array().cast("array<int>")


def _dense(key: tuple, t: pa.Table) -> pa.Table:
    """One block's rows as binary columns, a record for each chunk of dimensions; the first also carries what the rows are."""
    m = t["v"].combine_chunks().flatten().to_numpy().reshape(len(t), -1)
    most = int(np.abs(m).max()) if m.size else 0
    kind = next(k for k in (np.int16, np.int32, np.int64) if most <= np.iinfo(k).max)
    data = [m[:, lo : lo + DIMS].astype(kind).tobytes() for lo in range(0, max(1, m.shape[1]), DIMS)]
    rest = [b""] * (len(data) - 1)
    names = {c: pa.array([t[c].to_numpy().tobytes(), *rest]) for c in ("vec_id", "label", "uid")}
    same = lambda v, kind: pa.array([v] * len(data), kind)
    return pa.table({"block": same(key[0].as_py(), pa.int32()), "g": same(t["g"][0].as_py(), pa.int32()), "k": pa.array(range(len(data)), pa.int32()), "n": same(len(t), pa.int32()), "kind": same(np.dtype(kind).str, pa.string()), **names, "data": pa.array(data)})


def blocks(rows: DataFrame, counts: dict[int, int], size: int) -> tuple[DataFrame, dict[int, tuple[int, int]]]:
    """Dense blocks of about ``size`` rows of one group each, and the range of block numbers of every group."""
    of, at = {}, 0
    for g, n in sorted(counts.items()):
        of[g] = (at, at := at - (-n // size))
    block = _by_group({g: F.lit(lo) + F.pmod(F.shiftright("uid", 7), F.lit(hi - lo)) for g, (lo, hi) in of.items()}).cast("int")
    made = rows.withColumn("block", block).groupBy("block").applyInArrow(_dense, "block int, g int, k int, n int, kind string, vec_id binary, label binary, uid binary, data binary")
    return settle(made), of


def _product(batches):
    """The partial tile of an anchor chunk and a row chunk."""
    for batch in batches:
        for row in batch.to_pylist():
            a = np.frombuffer(row["a"], row["a_kind"]).reshape(row["a_n"], -1).astype(np.int64)
            b = np.frombuffer(row["b"], row["b_kind"]).reshape(row["b_n"], -1).astype(np.int64)
            # Doubles are exact while no partial sum reaches 2^53.
            exact = not a.size or not b.size or int(np.abs(a).max()) * int(np.abs(b).max()) * a.shape[1] < 1 << 53
            part = (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64) if exact else a @ b.T
            yield pa.RecordBatch.from_arrays([pa.array([row["i"]], pa.int32()), pa.array([row["j"]], pa.int32()), *[pa.array([row[c]], batch.schema.field(c).type) for c in _NAMES], pa.array([part.tobytes()])], ["i", "j", *_NAMES, "part"])


_NAMES = ("a_vec_id", "a_label", "a_uid", "asked", "vec_id", "label", "uid")
_ASKED = "array<struct<uid: bigint, positive_id: bigint, positive_uid: bigint, score: bigint>>"


def tiles(anchors: DataFrame, rows: DataFrame, of_anchors: Column, of_rows: Column, take: Callable[[dict], dict], schema: str) -> DataFrame:
    """What ``take`` makes of every full tile.  ``of_rows`` names an anchor block's row blocks, ``of_anchors`` a row block's anchor blocks."""
    left = anchors.select(F.col("block").alias("i"), "k", F.explode(of_rows).alias("j"), "asked", *[F.col(c).alias(f"a_{c}") for c in ("n", "kind", "vec_id", "label", "uid")], F.col("data").alias("a"))
    right = rows.select(F.col("block").alias("j"), "k", F.explode(of_anchors).alias("i"), F.col("n").alias("b_n"), F.col("kind").alias("b_kind"), "vec_id", "label", "uid", F.col("data").alias("b"))
    parts = left.join(right, ["i", "j", "k"]).mapInArrow(_product, f"i int, j int, a_vec_id binary, a_label binary, a_uid binary, asked {_ASKED}, vec_id binary, label binary, uid binary, part binary")

    def add(t: pa.Table) -> pa.Table:
        total = None
        for raw in t["part"]:
            part = np.frombuffer(raw.as_buffer(), np.int64)
            total = part if total is None else total + part
        # What the rows are came with the first chunk alone.
        tile = {c: np.frombuffer(b"".join(t[c].to_pylist()), np.int64) for c in _NAMES if c != "asked"}
        tile["asked"] = [x for row in t["asked"].to_pylist() for x in row or ()]
        tile["score"] = total.reshape(len(tile["a_uid"]), -1)
        found = take(tile)
        return pa.table({c: pa.array(v, pa.int64()) for c, v in found.items()}) if found else pa.table({c.split()[0]: pa.array([], pa.int64()) for c in schema.split(", ")})

    return parts.groupBy("i", "j").applyInArrow(add, schema)


def best(score: np.ndarray, ids: np.ndarray, uids: np.ndarray, among: np.ndarray, k: int) -> np.ndarray:
    """The first ``k`` of the places ``among``: highest score, then smallest id."""
    if len(among) > k:
        s = score[among]
        among = among[s >= np.partition(s, len(s) - k)[len(s) - k]]
    return among[np.lexsort((uids[among], ids[among], -score[among]))[:k]]


_POSITIVE = ("anchor", "anchor_id", "positive_id", "positive_uid", "score")
_NEGATIVE = ("anchor", "anchor_id", "positive_id", "positive_uid", "positive_score", "negative_id", "negative_uid", "negative_score")


def _table(rows: list[tuple[np.ndarray, ...]], names: tuple[str, ...]) -> dict:
    return dict(zip(names, (np.concatenate(c) for c in zip(*rows, strict=True)), strict=True)) if rows else {}


def _positives(tile: dict) -> dict:
    out = []
    for r, (a_id, a_uid, a_label) in enumerate(zip(tile["a_vec_id"], tile["a_uid"], tile["a_label"], strict=True)):
        among = np.flatnonzero((tile["label"] == a_label) & ((tile["uid"] != a_uid) | (tile["vec_id"] != a_id)))
        at = best(tile["score"][r], tile["vec_id"], tile["uid"], among, POSITIVES)
        if len(at):
            out.append((np.full(len(at), a_uid), np.full(len(at), a_id), tile["vec_id"][at], tile["uid"][at], tile["score"][r][at]))
    return _table(out, _POSITIVE)


def _negatives(tile: dict) -> dict:
    out, place = [], {u: r for r, u in enumerate(tile["a_uid"].tolist())}
    for x in tile["asked"]:
        r = place[x["uid"]]
        s, p = tile["score"][r], x["score"]
        among = np.flatnonzero((s >= -(-LOW * p // 100)) & (s <= HIGH * p // 100) & (tile["label"] != tile["a_label"][r]))
        at = best(s, tile["vec_id"], tile["uid"], among, NEGATIVES)
        if n := len(at):
            out.append((*[np.full(n, v) for v in (x["uid"], tile["a_vec_id"][r], x["positive_id"], x["positive_uid"], p)], tile["vec_id"][at], tile["uid"][at], s[at]))
    return _table(out, _NEGATIVE)


def mine(vectors: DataFrame, rows_a_block: int = ROWS, anchors_a_block: int = ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: the hard negatives of every anchor's positives."""
    spark = vectors.sparkSession
    small_batches(spark)
    rows = whole_rows(vectors).withColumn("g", F.pmod("label", F.lit(GROUPS)).cast("int"))
    anchor = F.col("vec_id") % EVERY == 0
    groups = rows.groupBy("g").agg(F.count("*").alias("n"), F.count_if(anchor).alias("anchors"), (F.min("label") == F.max("label")).alias("pure")).collect()  # GROUPS rows
    b, of_b = blocks(rows, {r["g"]: r["n"] for r in groups}, rows_a_block)
    a, of_a = blocks(rows.where(anchor), {r["g"]: r["anchors"] for r in groups if r["anchors"]}, anchors_a_block)
    if not of_a:
        return spark.createDataFrame([], RESULT)
    a = a.withColumn("asked", F.lit(None).cast(_ASKED))
    longs = lambda names: ", ".join(f"{c} long" for c in names)

    near = tiles(a, b, _by_group({g: _span(r) for g, r in of_a.items()}), _by_group({g: _span(of_b[g]) for g in of_a}), _positives, longs(_POSITIVE))
    first = Window.partitionBy("anchor", "anchor_id").orderBy(F.desc("score"), "positive_id", "positive_uid")
    near = settle(near.withColumn("r", F.row_number().over(first)).where(F.col("r") <= POSITIVES))

    # The positives join their anchors' blocks: at most POSITIVES for each anchor of a block.
    g = F.pmod(F.col("label"), F.lit(GROUPS)).cast("int")
    home = _by_group({g: F.lit(lo) + F.pmod(F.shiftright("anchor", 7), F.lit(hi - lo)) for g, (lo, hi) in of_a.items()}).cast("int")
    asked = near.join(rows.where(anchor).select(F.col("uid").alias("anchor"), F.col("vec_id").alias("anchor_id"), g.alias("g")), ["anchor", "anchor_id"])
    asked = asked.groupBy(home.alias("block")).agg(F.collect_list(F.struct(F.col("anchor").alias("uid"), "positive_id", "positive_uid", "score")).alias("asked"))
    a = a.drop("asked").join(asked, "block").withColumn("asked", F.when(F.col("k") == 0, F.col("asked")))

    last_a, last_b = (max(hi for _, hi in of.values()) for of in (of_a, of_b))
    pure = {r["g"] for r in groups if r["pure"]}
    others = lambda of, last: {g: _span((0, of[g][0]), (of[g][1], last)) if g in pure and g in of else _span((0, last)) for g in of_b}
    far = tiles(a, b, _by_group(others(of_a, last_a)), _by_group(others(of_b, last_b)), _negatives, longs(_NEGATIVE))
    hardest = Window.partitionBy("anchor", "anchor_id", "positive_uid", "positive_id").orderBy(F.desc("negative_score"), "negative_id", "negative_uid")
    ranked = far.withColumn("rank", F.row_number().over(hardest)).where(F.col("rank") <= NEGATIVES)
    return ranked.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


#: The same over all pairs, in DuckDB's SQL.
ORACLE_SQL = f"""
WITH good AS (
  SELECT DISTINCT vec_id::BIGINT AS vec_id, CASE WHEN vec_id % {MOVED} = 0 THEN (label::BIGINT + 1) % {LABELS} ELSE label::BIGINT END AS label,
         list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM good a JOIN good b ON a.vec_id <> b.vec_id WHERE a.vec_id % {EVERY} = 0),
positives AS (SELECT * FROM pairs WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {POSITIVES})
SELECT p.anchor_id, p.id AS positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id)::INT AS rank,
       n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same AND {LOW} * p.score <= 100 * n.score AND 100 * n.score <= {HIGH} * p.score
QUALIFY rank <= {NEGATIVES}"""
