"""Near-duplicate classes by BagMinHash (operator 1).

A document is the multiset of its five-word shingles.  Signatures come from
hierarchical Poisson processes over weights discretised to whole numbers: each
(shingle, dyadic weight interval) has a process of its own whose points carry a
time, a signature component and a place in the interval; a point counts if its
place lies below the shingle's weight, and each component keeps the earliest
point.  Two components agree with probability equal to the weighted Jaccard
similarity.  Points are drawn only up to a horizon that fills all components,
so a long text costs about as much as its hashing.

Signatures are banded; documents that share a bucket are candidates.  Candidates
are verified on their texts by exact multiset overlap.  Hot buckets never make
all pairs: first each member meets the bucket's smallest document only, the
links found are joined to classes, and then just those members that are still
in another class than that document are held against the members of other
classes: in tiles of bounded size, by larger sketches, of which only those pairs
that may reach the threshold go on to their texts.  Every candidate pair is
thereby either tested or already in one class.

Edge cases: documents without words are in no link and form classes of their
own; texts of one to four words have one shingle; equal multisets (exact copies
among them) are collapsed before banding; rows repeated under one id are one
document; rows with a null id come back with a null class.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kit
from .graph import components
from .store import free_name, join_dealt, settle, small_batches, versions

SHINGLE = 5
SIMILARITY = 0.8
#: 36 bands of 7: a pair of similarity 0.8 is missed with probability 0.0002, one of 0.3 met with 0.008.
BANDS, ROWS = 36, 7
#: Texts whose points are drawn together.
STRIDE = 48
#: Components of the sketches that members of mixed buckets are compared by, and the size of a tile of such comparisons.
SKETCH, OUTER, INNER = 1024, 128, 256
#: Ids up to which a set of documents is broadcast; it is counted before.
FEW = 500_000
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_LEVEL = np.uint64(0xC2B2AE3D27D4EB4F)


def bags(docs: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, shingle) with their counts."""
    if not len(hashes):
        return docs, hashes, np.zeros(0, np.int64)
    key = kit.mix(hashes + docs.astype(np.uint64) * _GOLD)
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    count = np.diff(np.concatenate([first, [len(key)]]))
    at = order[first]
    return docs[at], hashes[at], count


def bag_minhash(docs: np.ndarray, hashes: np.ndarray, weights: np.ndarray, n_docs: int, m: int = BANDS * ROWS) -> np.ndarray:
    """Signatures, n_docs x m; rows of texts without shingles are zero."""
    sig = np.zeros((n_docs, m), np.uint64)
    total = np.bincount(docs, weights, n_docs) if len(docs) else np.zeros(n_docs)
    todo, reach = np.flatnonzero(total > 0), m * (math.log(m) + 3)
    while len(todo):
        chosen = np.zeros(n_docs, bool)
        chosen[todo] = True
        use = chosen[docs]
        d, h, w = docs[use], hashes[use], weights[use]
        horizon = np.zeros(n_docs)
        horizon[todo] = reach / total[todo]
        best = _earliest(d, h, w, horizon, n_docs, m, sig)
        todo = todo[np.isinf(best[todo]).any(axis=1)]
        reach *= 2
    return sig


def _earliest(d, h, w, horizon, n_docs, m, sig) -> np.ndarray:
    """Earliest time of each component up to the texts' horizons; their points go to ``sig``."""
    best = np.full(n_docs * m, np.inf)
    # Dyadic weight intervals (0,1], (1,2], (2,4], ... that a weight reaches into.
    levels = np.where(w > 1, np.ceil(np.log2(np.maximum(w, 1))).astype(np.int64), 0) + 1
    p = np.repeat(np.arange(len(d)), levels)
    level = np.arange(len(p)) - np.repeat(np.cumsum(levels) - levels, levels)
    rate = np.where(level > 0, 2.0 ** (level - 1), 1.0)
    key = kit.mix(h[p] + level.astype(np.uint64) * _LEVEL)
    end = horizon[d[p]]
    # Most processes of long texts have no point before the horizon; their first draw alone tells.
    u = ((kit.mix(key + _GOLD) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
    live = np.flatnonzero(u > np.exp(-end * rate))
    simple = not (level > 0).any()
    time, index = np.zeros(len(live)), np.zeros(len(live), np.int64)
    while len(live):
        expect = (end[live] - time) * rate[live]
        n = np.maximum(expect, 1).astype(np.int64)
        own = np.repeat(np.arange(len(live)), n)
        at = np.cumsum(n) - n
        i = index[own] + np.arange(len(own)) - at[own] + 1
        q = live[own]
        r = kit.mix(key[q] + i.view(np.uint64) * _GOLD)
        step = -np.log(((r >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)
        if simple:
            place_free = True
        else:
            step /= rate[q]
            place_free = not (level[live] > 1).any()
        c = np.cumsum(step)
        t = c + np.repeat(time - c[at] + step[at], n)
        r *= np.uint64(0xD6E8FEB86659FD93)
        r ^= r >> np.uint64(32)
        comp = (((r >> np.uint64(40)) * np.uint64(m)) >> np.uint64(24)).view(np.int64)
        keep = t < np.repeat(end[live], n)
        split = np.zeros(0, bool) if place_free else level[q] > 1
        if split.any():  # the point's place in its interval; halving picks these bits one by one
            half = np.left_shift(np.int64(1), np.maximum(level[q] - 1, 0))
            place = half + 1 + ((r & np.uint64(0xFFFFFFFF)).astype(np.int64) & (half - 1))
            keep &= ~split | (place <= w[p[q]])
        cell, tk, rk = (np.repeat(d[p[live]] * m, n) + comp)[keep], t[keep], r[keep]
        np.minimum.at(best, cell, tk)
        won = tk == best[cell]
        sig.reshape(-1)[cell[won]] = rk[won]
        last = at + n - 1
        more = t[last] < end[live]
        time, index, live = t[last][more], (index + n)[more], live[more]
    return best.reshape(n_docs, m)


def _sign(col: pa.Array):
    """Yields per run of texts: weight, two digests of the multiset, band hashes."""
    data, offs = kit.as_bytes(col)
    for lo, hi, block, at in kit.blocks(data, offs, kit.BLOCK // 2):
        n = hi - lo
        _, _, wdoc, wh = kit.words(block, at)
        d, h, w = bags(*kit.shingles(wh, wdoc, n, SHINGLE))
        by = np.argsort(d, kind="stable")
        d, h, w = d[by], h[by], w[by]
        sig = np.zeros((n, BANDS * ROWS), np.uint64)
        for a in range(0, n, STRIDE):  # few texts at a time: their points then stay in the processor's cache
            x, y = np.searchsorted(d, [a, a + STRIDE])
            sig[a : a + STRIDE] = bag_minhash(d[x:y] - a, h[x:y], w[x:y], min(STRIDE, n - a))
        total = np.bincount(d, w, n).astype(np.int64) if len(d) else np.zeros(n, np.int64)
        digests = []
        for salt in (1, 2):
            part = kit.mix(h * np.uint64(2 * salt + 1) + w.astype(np.uint64) * _LEVEL + np.uint64(salt))
            acc = np.zeros(n, np.uint64)
            np.add.at(acc, d, part)
            digests.append(acc.view(np.int64))
        bands = np.zeros((n, BANDS), np.uint64)
        for r in range(ROWS):
            bands = kit.mix(bands + sig[:, r::ROWS] + np.uint64(r))
        bands += np.arange(BANDS, dtype=np.uint64) * _GOLD
        yield total, *digests, kit.mix(bands).view(np.int64)


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, weight, d1, d2, bands) for every row with an id."""

    def run(batches):
        kit.give_back()
        for b in batches:
            ids, at = b.column(0), 0
            for total, d1, d2, bands in _sign(b.column(1)):
                n = len(total)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * BANDS, pa.int32()), pa.array(bands.reshape(-1)))
                yield pa.RecordBatch.from_arrays([ids.slice(at, n), pa.array(total), pa.array(d1), pa.array(d2), lists], ["doc_id", "weight", "d1", "d2", "bands"])
                at += n
        kit.trim()

    small_batches(docs.sparkSession)
    rows = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, weight long, d1 long, d2 long, bands array<long>")


def overlap(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Exact weighted Jaccard similarity of the shingle multisets of each pair of texts."""
    n = len(a)
    out = np.zeros(n)
    (da, oa), (db, ob) = kit.as_bytes(a), kit.as_bytes(b)
    both = oa + ob
    lo = 0
    while lo < n:
        hi = min(n, max(lo + 1, int(np.searchsorted(both, both[lo] + kit.BLOCK, "right")) - 1))
        keys, counts, pairs, total = [], [], [], np.zeros(hi - lo)
        for data, offs in ((da, oa), (db, ob)):
            block, at = data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
            _, _, wdoc, wh = kit.words(block, at)
            d, h, w = bags(*kit.shingles(wh, wdoc, hi - lo, SHINGLE))
            keys.append(kit.mix(h + d.astype(np.uint64) * _GOLD))
            counts.append(w)
            pairs.append(d)
            total += np.bincount(d, w, hi - lo) if len(d) else 0
        _, ia, ib = np.intersect1d(*keys, assume_unique=True, return_indices=True)
        common = np.bincount(pairs[0][ia], np.minimum(counts[0][ia], counts[1][ib]), hi - lo) if len(ia) else np.zeros(hi - lo)
        out[lo:hi] = common / np.maximum(total - common, 1)
        lo = hi
    return out


def _texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, text) of the documents in ``ids`` (id); where they are few, which is counted, no other text is shuffled."""
    texts = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("id"), "text")
    few = ids.count() <= FEW
    return texts.join(F.broadcast(ids) if few else ids, "id", "left_semi")


def verified(pairs: DataFrame, docs: DataFrame, threshold: float) -> DataFrame:
    """The pairs (u, v) whose texts reach the threshold."""

    def run(batches):
        for b in batches:
            keep = pa.array(overlap(b.column(2), b.column(3)) >= threshold)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep)], ["u", "v"])
        kit.trim()

    pairs = settle(pairs)
    texts = _texts(docs, pairs.select(F.explode(F.array("u", "v")).alias("id")).distinct())
    a = texts.select(F.col("id").alias("u"), F.col("text").alias("ta"))
    b = texts.select(F.col("id").alias("v"), F.col("text").alias("tb"))
    # A bucket's head is in as many pairs as the bucket has members: its pairs are dealt over several tasks.
    heads = pairs.groupBy("u").agg(F.count("*").alias("n"))
    a = a.join(F.broadcast(heads) if heads.count() <= FEW else heads, "u")
    return join_dealt(pairs, a, "u", "v").join(b, "v").select("u", "v", "ta", "tb").mapInArrow(run, "u long, v long").distinct()


def sketches(texts: DataFrame) -> DataFrame:
    """(id, sketch): a byte for each of SKETCH components of a signature."""

    def run(batches):
        for batch in batches:
            for lo, hi, block, at in kit.blocks(*kit.as_bytes(batch.column(1)), kit.BLOCK // 8):
                _, _, wdoc, wh = kit.words(block, at)
                d, h, w = bags(*kit.shingles(wh, wdoc, hi - lo, SHINGLE))
                sig = bag_minhash(d, h, w, hi - lo, SKETCH).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array([r.tobytes() for r in sig], pa.binary())], ["id", "sketch"])

    return texts.mapInArrow(run, "id long, sketch binary")


def _met(inside: DataFrame, signed: DataFrame, docs: DataFrame, threshold: float) -> DataFrame:
    """Pairs (u, v) of different classes in one bucket whose sketches do not rule the threshold out.

    ``inside``: (b, id, c, far, outside) for members of mixed buckets; every ``far`` one meets all of other classes.
    A bucket is cut into tiles of at most some OUTER far members and INNER others, so that no task holds a bucket, and
    only pairs that pass leave a tile, and of all buckets that a pair shares only the first one's. A byte of a pair of similarity s agrees with probability s + (1 - s) / 256; the
    bar lies four standard deviations below the threshold's.
    """
    ids = inside.select("id").distinct()
    drawn = sketches(_texts(docs, ids).dropDuplicates(["id"]))
    drawn = settle(drawn.join(signed.select(F.col("doc_id").alias("id"), "bands").dropDuplicates(["id"]), "id"))
    sizes = inside.groupBy("b").agg(F.ceil(F.first("outside") / OUTER).cast("int").alias("no"), F.ceil(F.count("*") / INNER).cast("int").alias("ni"))
    rows = inside.join(sizes, "b").join(drawn, "id")
    spot = F.xxhash64("id")
    rows = rows.withColumns({"o": F.pmod(spot, F.col("no")).cast("int"), "i": F.pmod(F.shiftright(spot, 20), F.col("ni")).cast("int")})
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    query = rows.where("far").select("b", "o", upto("ni").alias("i"), "id", "c", F.lit(True).alias("ask"), "far", "sketch", "bands")
    data = rows.select("b", upto("no").alias("o"), "i", "id", "c", F.lit(False).alias("ask"), "far", "sketch", "bands")
    agree = threshold + (1 - threshold) / 256
    bar = SKETCH * agree - 4 * math.sqrt(SKETCH * agree * (1 - agree))

    def tile(table: pa.Table) -> pa.Table:
        ask, far = (table[c].to_numpy(zero_copy_only=False) for c in ("ask", "far"))
        ids, c = table["id"].to_numpy(), table["c"].to_numpy()
        sketch = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint8).reshape(-1, SKETCH)
        bands = table["bands"].combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
        here = table["b"][0].as_py()
        xs, ys = np.flatnonzero(ask), np.flatnonzero(~ask)
        us, vs = [], []
        for x in xs:
            y = ys[(c[ys] != c[x]) & (~far[ys] | (ids[ys] > ids[x]))]
            y = y[(sketch[y] == sketch[x]).sum(axis=1) >= bar] if len(y) else y
            y = y[bands[x][(bands[y] == bands[x]).argmax(axis=1)] == here] if len(y) else y
            us.append(np.minimum(ids[y], ids[x]))
            vs.append(np.maximum(ids[y], ids[x]))
        none = [np.zeros(0, np.int64)]
        return pa.table({"u": np.concatenate(us or none), "v": np.concatenate(vs or none)})

    return query.unionByName(data).groupBy("b", "o", "i").applyInArrow(tile, "u long, v long").distinct()


def classes(docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """(doc_id, class_id) for every row of ``docs``: class_id is the smallest doc_id linked to it, directly or not."""
    signed = settle(signatures(docs))
    groups = settle(signed.where("weight > 0").groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")))
    members = join_dealt(signed.where("weight > 0").select("doc_id", "d1", "d2"), groups, ["d1", "d2"], "doc_id").select("doc_id", "rep")
    reps = signed.join(groups.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi").where("weight > 0")
    rows = settle(reps.select(F.col("doc_id").alias("id"), F.explode("bands").alias("b")))
    heads = settle(rows.groupBy("b").agg(F.min("id").alias("head"), F.count("*").alias("n")).where("n > 1"))
    full = settle(join_dealt(rows, heads, "b", "id"), rows)  # rows of buckets with more than one member
    stars = full.where("id <> head").select(F.col("head").alias("u"), F.col("id").alias("v")).distinct()
    links = settle(verified(stars, docs, threshold))
    of = components(links)

    # Members in another class than their bucket's head: each is held against the members of other classes.
    label = lambda df, c, to: df.join(of.select(F.col("node").alias(c), F.col("component").alias(to)), c, "left").withColumn(to, F.coalesce(to, c))
    # Heads are labelled bucket by bucket, and brought to the members by the bucket, as hot heads are in many rows.
    named = label(heads.select("b", "head", "n"), "head", "hc")
    placed = settle(join_dealt(label(full.select("b", "id"), "id", "c"), named, "b", "id"))
    mixed = placed.where("c <> hc").groupBy("b").agg(F.count("*").alias("outside"))
    mixed = settle(mixed.join(heads.select("b", "n"), "b"))
    inside = settle(join_dealt(placed.where("id <> head"), mixed, "b", "id").select("b", "id", "c", (F.col("c") != F.col("hc")).alias("far"), "outside"))
    more = settle(verified(_met(inside, signed, docs, threshold), docs, threshold))
    if not more.isEmpty():
        of = components(links.unionByName(more))

    known = members.join(of, members["rep"] == of["node"], "left").select("doc_id", F.coalesce("component", "rep").alias("class_id")).distinct()
    ids = docs.select("doc_id")
    return ids.join(known.withColumnRenamed("doc_id", "k"), F.col("doc_id").cast("long") == F.col("k"), "left").select("doc_id", F.coalesce("class_id", F.col("doc_id").cast("long")).alias("class_id"))


def keep_one(docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each class: one of the smallest id; all columns stay.

    Different texts under one id are different documents, each in a class of its own text.
    Rows with a null id have no class: of those with equal texts that hold a word, one stays.
    """
    v, key, name, again, nth = (free_name(docs, c) for c in ("v", "key", "k", "again", "nth"))
    marked = settle(versions(docs.select("doc_id", "text"), "v").where("v > 0").select("doc_id", "v").distinct())
    if marked.isEmpty():
        gone = classes(docs, threshold).where("doc_id <> class_id").select("doc_id").distinct()
        kept = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    else:
        # Texts of a repeated id are told apart by a key of their own; the order of (doc_id, v) decides who stays.
        own = F.when(F.col(v) == 0, F.col("doc_id").cast("long")).otherwise(F.xxhash64("doc_id", v))
        rows = versions(docs, v).withColumn(key, own)
        of = settle(classes(rows.select(F.col(key).alias("doc_id"), "text"), threshold).where("doc_id is not null").distinct())
        place = rows.where(F.col(key).isNotNull()).select(F.col(key).alias("doc_id"), F.struct(F.col("doc_id").alias("i"), F.col(v).alias("v")).alias("place")).distinct()
        place = settle(of.join(place, "doc_id"))
        least = place.groupBy("class_id").agg(F.min("place").alias("least"), F.count("*").alias("n")).where("n > 1")
        gone = join_dealt(place, least, "class_id", "doc_id").where("place <> least").select(F.col("doc_id").alias(key)).distinct()
        kept = rows.join(gone, key, "left_anti").select(*docs.columns)
    digest = F.sha2(F.col("text"), 256)
    worded = F.col("text").rlike(r"[0-9A-Za-z]|[^\x00-\x7F]")
    same = F.coalesce(F.concat(F.lit("i"), F.col("doc_id").cast("string"), F.lit(":"), F.coalesce(digest, F.lit(""))), F.when(worded, F.concat(F.lit("t"), digest)))
    # Only keys that more than one row has send their rows through a shuffle.
    repeated = docs.join(F.broadcast(marked.select("doc_id").distinct()), "doc_id", "left_semi") if marked.count() <= FEW else docs
    twice = settle(repeated.unionByName(docs.where("doc_id is null")).select(same.alias(again)).where(F.col(again).isNotNull()).groupBy(again).count().where("count > 1").select(again))
    if twice.isEmpty():
        return kept
    paired = kept.withColumn(name, same).join(twice, F.col(name) == F.col(again), "left")
    first = paired.where(F.col(again).isNotNull()).withColumn(nth, F.row_number().over(Window.partitionBy(again).orderBy(digest))).where(F.col(nth) == 1)
    return paired.where(F.col(again).isNull()).select(*docs.columns).unionByName(first.select(*docs.columns))
