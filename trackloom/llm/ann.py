"""Approximate nearest neighbours over balanced posting lists (operator 5).

Centroids come from balanced bisecting k-means on a bounded sample.  Every
vector is filed under its nearest centroid and, if it lies near a border, under
the next one too.  Centroids are searched through an in-memory neighbour graph,
on batches of vectors at once: best-first steps find the nearest, and from there
all centroids within a distance ratio of the nearest are reached over the graph.
A query reads just these lists.  The ratio is fitted on the sample: the smallest
that leads TARGET of its vectors' neighbours within the sample back to a list of
theirs.  Clustered vectors thus need few lists; vectors without any structure
need many, since all their centroids are about equally far.

Queries and vectors meet list by list in numpy, lists of more than PART vectors
in parts; the nearest of each part are chosen by products and then measured in
double precision on the original vectors.

Identical vectors are filed once, with their eleven smallest ids: ten neighbours
and the query itself are all that a search can return of them, so a vector that
a third of the rows share costs one entry.  Lists that outgrow the sample's
balance are dealt in parts, so that no task holds one.

Edge cases: vectors that are null, empty, zero, of another length than most, or
that hold null or non-finite components take no part, neither as query nor as
candidate; ties go to the smaller id; a repeated row (same id, same vector)
counts once; an empty table gives an empty result; if there are no more
candidates than neighbours asked for, all are returned.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import settle

#: Vectors that centroids and the ratio are fitted on, and centroids, at most; vectors for each list aimed at.
SAMPLE, LISTS, LIST_SIZE = 65_536, 16_384, 128
#: Lists of a vector at most, and the ratio of distances within which it gets a second one.
REPLICAS, BORDER = 2, 1.1
#: Share of the sample's neighbours that the ratio has to reach, and the sample's queries that it is fitted with.
TARGET, ASKED = 0.95, 256
#: Candidates that a query's lists hold at least, together, where there are so many.
LEAST = 400
#: Vectors of a list in a part, about; query rows at a time, and distances at a time.
PART, ROWS, CELLS = 20_000, 32, 1 << 21
#: Neighbours of a centroid, places that a search keeps open, and one in how many centroids a search begins at.
DEGREE, BEAM, ENTRY = 32, 32, 2


def _dist(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)[None], 0)


def balanced_centroids(x: np.ndarray, k: int, seed: int = 5) -> np.ndarray:
    """k centroids by bisecting: every cut splits a cell's points into two of equal size along its widest pair."""
    rng = np.random.default_rng(seed)
    cells = [(-len(x), 0, np.arange(len(x)))]
    made = 1
    while len(cells) < k and cells[0][0] < -1:
        cell = heapq.heappop(cells)[2]
        p = x[cell]
        a = p[rng.integers(len(p))]
        b = p[_dist(p, a[None])[:, 0].argmax()]
        a = p[_dist(p, b[None])[:, 0].argmax()]
        for _ in range(4):
            lean = (p @ (b - a)).argsort(kind="stable")
            left, right = lean[: len(p) // 2], lean[len(p) // 2 :]
            a, b = p[left].mean(0), p[right].mean(0)
        for half in (left, right):
            heapq.heappush(cells, (-len(half), made, cell[half]))
            made += 1
    return np.array([x[c].mean(0) for _, _, c in sorted(cells, key=lambda c: c[1])])


class CentroidGraph:
    """Neighbour graph over centroids with best-first search for batches of vectors."""

    def __init__(self, c: np.ndarray) -> None:
        self.c = c.astype(np.float32)
        n = len(c)
        deg = min(DEGREE, n - 1)
        near = []
        for lo in range(0, n, 512):
            d = _dist(self.c[lo : lo + 512], self.c)
            d[np.arange(len(d)), np.arange(lo, lo + len(d))] = np.inf
            near.append(np.argpartition(d, deg - 1, axis=1)[:, :deg] if deg else np.zeros((len(d), 0), np.int64))
        rng = np.random.default_rng(1)
        far = rng.integers(0, n, (n, min(4, n)))  # long edges keep the graph connected
        self.edges = np.concatenate([np.concatenate(near), far], axis=1)
        self.entry = np.arange(0, n, ENTRY)

    def search(self, x: np.ndarray, want: int) -> tuple[np.ndarray, np.ndarray]:
        """(centroids, squared distances) of about the ``want`` nearest for each row, nearest first; where there are fewer, the distance is infinite."""
        n = len(self.c)
        x = x.astype(np.float32)
        beam = max(BEAM, want)
        norm = (self.c * self.c).sum(1)
        own = (x * x).sum(1)
        d = _dist(x, self.c[self.entry])
        at = np.argsort(d, axis=1)[:, :beam]
        ids, d = self.entry[at], np.take_along_axis(d, at, 1)
        if ids.shape[1] < beam:
            pad = beam - ids.shape[1]
            ids = np.concatenate([ids, np.repeat(ids[:, :1], pad, 1)], 1)
            d = np.concatenate([d, np.full((len(d), pad), np.inf, np.float32)], 1)
        opened = np.zeros(ids.shape, bool)
        live = np.arange(len(x))
        for _ in range(40):
            # Each step opens the nearest few unopened places of every row's beam.
            closed = np.where(opened[live], np.inf, d[live])
            pick = np.argpartition(closed, 3, axis=1)[:, :4]
            more = np.isfinite(np.take_along_axis(closed, pick, 1)).any(1)
            live, pick = live[more], pick[more]
            if not len(live):
                break
            opened[live[:, None], pick] = True
            new = self.edges[ids[live[:, None], pick]].reshape(len(live), -1)
            nd = norm[new] + own[live, None] - 2 * np.einsum("ij,ikj->ik", x[live], self.c[new])
            all_ids = np.concatenate([ids[live], new], 1)
            all_d = np.concatenate([d[live], np.maximum(nd, 0)], 1)
            all_open = np.concatenate([opened[live], np.zeros(new.shape, bool)], 1)
            order = np.lexsort((~all_open, all_ids), axis=1)  # copies of a place side by side, opened ones first
            all_ids, all_d, all_open = (np.take_along_axis(a, order, 1) for a in (all_ids, all_d, all_open))
            same = np.zeros(all_ids.shape, bool)
            same[:, 1:] = all_ids[:, 1:] == all_ids[:, :-1]
            all_d = np.where(same, np.inf, all_d)
            best = np.argpartition(all_d, beam - 1, axis=1)[:, :beam]
            ids[live], d[live], opened[live] = (np.take_along_axis(a, best, 1) for a in (all_ids, all_d, all_open))
        order = np.argsort(d, axis=1, kind="stable")[:, :want]
        return np.take_along_axis(ids, order, 1), np.take_along_axis(d, order, 1)

    def within(self, x: np.ndarray, ratio: float, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, centroid) pairs: all within ``ratio`` of the nearest that the graph leads to, and the nearest that hold LEAST together."""
        x = x.astype(np.float32)
        n = len(self.c)
        ids, d = self.search(x, BEAM)
        bar = ratio**2 * d[:, 0]
        before = np.cumsum(np.where(np.isfinite(d), held[ids], 0), axis=1) - held[ids]
        near = np.isfinite(d) & ((d <= bar[:, None]) | (before < LEAST))
        seen = np.zeros((len(x), n), bool)
        seen[np.nonzero(near)[0], ids[near]] = True
        read = seen.copy()
        rows, at = np.nonzero(near & (d <= bar[:, None]))
        at = ids[rows, at]
        while len(rows):
            key = np.unique((rows[:, None] * n + self.edges[at]).ravel())
            rows, at = key // n, key % n
            new = ~seen[rows, at]
            rows, at = rows[new], at[new]
            seen[rows, at] = True
            inside = ((x[rows] - self.c[at]) ** 2).sum(1) <= bar[rows]
            rows, at = rows[inside], at[inside]
            read[rows, at] = True
        read[(read * held).sum(1) < LEAST] = True  # hardly any vectors nearby: all lists
        return np.nonzero(read)


def file_under(graph: CentroidGraph, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, list) pairs: the nearest list of each row, and those across a near border."""
    ids, d = graph.search(x, REPLICAS)
    near = np.isfinite(d) & (d <= BORDER**2 * d[:, :1])
    near[:, 0] = True
    return np.nonzero(near)[0], ids[near]


def fit_ratio(graph: CentroidGraph, x: np.ndarray, k: int) -> float:
    """The distance ratio that reaches TARGET of the ``k`` nearest neighbours within the sample ``x``."""
    asked = np.linspace(0, len(x) - 1, min(ASKED, len(x))).astype(np.int64)
    if len(x) < 2:
        return 1.0
    d = _dist(x[asked], x)
    d[np.arange(len(asked)), asked] = np.inf
    k = min(k, len(x) - 1)
    near = np.argpartition(d, k - 1, axis=1)[:, :k]
    lists = np.sqrt(_dist(x[asked].astype(np.float32), graph.c))
    rows, ids = file_under(graph, x[near.ravel()])
    need = np.full(near.size, np.inf)
    np.minimum.at(need, rows, lists[rows // k, ids])
    need = need.reshape(near.shape) / np.maximum(lists.min(1), 1e-12)[:, None]
    return float(np.quantile(need, TARGET))


def closest(q: np.ndarray, x: np.ndarray, entry: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of q, row of x, distance): the ``k`` nearest rows of x for each row of q, ties to the smaller entry."""
    q, x = q.astype(np.float64), x.astype(np.float64)
    own, norm = (q * q).sum(1), (x * x).sum(1)
    out = []
    for lo in range(0, len(q), max(1, CELLS // max(1, len(x)))):
        to = lo + max(1, CELLS // max(1, len(x)))
        d = own[lo:to, None] + norm[None] - 2 * q[lo:to] @ x.T
        keep = np.ones(d.shape, bool)
        if len(x) > k:
            # Products round: what may be among the nearest by the rounding's bound is measured.
            slack = 8 * (x.shape[1] + 4) * np.finfo(np.float64).eps * (own[lo:to] + norm.max())
            bar = np.partition(d, k - 1, axis=1)[:, k - 1] + slack
            keep = (d <= bar[:, None]) | ~np.isfinite(d) | ~np.isfinite(bar)[:, None]
        row, col = np.nonzero(keep)
        score = np.concatenate([np.sqrt(((q[lo + row[i : i + 65_536]] - x[col[i : i + 65_536]]) ** 2).sum(1)) for i in range(0, len(row), 65_536)] or [np.zeros(0)])
        order = np.lexsort((entry[col], score, row))
        row, col, score = row[order], col[order], score[order]
        nth = np.arange(len(row)) - np.searchsorted(row, row)
        out.append((lo + row[nth < k], col[nth < k], score[nth < k]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _vectors(batch: pa.Array) -> np.ndarray:
    return batch.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1) if len(batch) else np.zeros((0, 0))


def nearest(vectors: DataFrame, k: int = 10, every: int = 100) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found for every row whose vec_id is divisible by ``every``."""
    spark = vectors.sparkSession
    kind = "float" if vectors.schema["embedding"].dataType.elementType == T.FloatType() else "double"
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    good = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>").alias("embedding"))
    good = good.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite & F.exists("embedding", lambda v: v != 0))
    lengths = good.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if lengths is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    good = settle(good.where(F.size("embedding") == lengths["n"]))

    # One entry for each distinct vector, with the ids that a search can return of it.
    first = Window.partitionBy("embedding").orderBy("vec_id")
    entries = good.distinct().withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1)
    entries = settle(entries.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(F.col("ids")[0].alias("entry"), "ids", "embedding"))
    n = entries.count()
    sample = entries.select("embedding", "entry").orderBy(F.xxhash64("entry"), "entry").limit(SAMPLE).toArrow()
    x = _vectors(sample["embedding"].combine_chunks()).astype(np.float64)
    lists = CentroidGraph(balanced_centroids(x, int(np.clip(n // LIST_SIZE, 1, min(LISTS, len(x))))))
    ratio = fit_ratio(lists, x, k)
    graph = spark.sparkContext.broadcast(lists)

    def assign(batches):
        for b in batches:
            rows, lists = file_under(graph.value, _vectors(b.column(1)))
            yield pa.RecordBatch.from_arrays([pa.array(lists, pa.int32()), b.column(0).take(pa.array(rows))], ["list", "entry"])

    filed = settle(entries.select("entry", "embedding").mapInArrow(assign, "list int, entry long"))
    sizes = np.zeros(len(graph.value.c), np.int64)
    for row in filed.groupBy("list").count().collect():  # one row a list: at most LISTS
        sizes[row["list"]] = row["count"]
    held = spark.sparkContext.broadcast(sizes)

    def ask(batches):
        for b in batches:
            for lo in range(0, len(b), ROWS):
                c = b.slice(lo, ROWS)
                rows, lists = graph.value.within(_vectors(c.column(1)), ratio, held.value)
                # A query meets every part of a list.
                times = held.value[lists] // PART + 1
                part = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                rows = pa.array(np.repeat(rows, times))
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(lists, times), pa.int32()), pa.array(part, pa.int32()), c.column(0).take(rows), c.column(1).take(rows)], ["list", "part", "query_id", "q"])

    def deal(batches):
        for b in batches:
            parts = held.value[b.column(0).to_numpy()] // PART + 1
            part = (b.column(2).to_numpy() % parts).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(part), b.column(1)], ["list", "part", "entry"])

    def meet(asked: pa.Table, posted: pa.Table) -> pa.Table:
        if not len(asked) or not len(posted):
            return pa.table({"query_id": pa.array([], pa.int64()), "entry": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        entry = posted["entry"].to_numpy()
        row, col, score = closest(_vectors(asked["q"].combine_chunks()), _vectors(posted["embedding"].combine_chunks()), entry, k + 1)
        return pa.table({"query_id": asked["query_id"].to_numpy()[row], "entry": entry[col], "score": score})

    queries = good.where(F.col("vec_id") % every == 0).select("vec_id", "embedding").distinct()
    asked = queries.mapInArrow(ask, f"list int, part int, query_id long, q array<{kind}>")
    spread = filed.select("list", "entry", F.shiftrightunsigned(F.xxhash64("entry"), 1).alias("h")).mapInArrow(deal, "list int, part int, entry long")
    posted = spread.join(entries.select("entry", "embedding"), "entry")
    met = asked.groupBy("list", "part").cogroup(posted.groupBy("list", "part")).applyInArrow(meet, "query_id long, entry long, score double")
    # A vector filed under several lists is met several times; its first id names it.
    once = met.groupBy("query_id", "entry").agg(F.min("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy("score", "entry")
    few = once.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).join(entries.select("entry", "ids"), "entry")
    found = few.select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id")
    ranked = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
