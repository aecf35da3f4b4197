"""Toxicity by weak supervision (operator 6).

1. From a bounded sample of labelled documents, words and word beginnings that
   tell toxic from clean texts are mined; they feed twelve voters (tiers of the
   word lexicon, tiers of the beginnings, and patterns of density and variety).
2. A generative label model is fitted to the votes of *all* documents: each
   voter's accuracy for either class, and factors for the most correlated pairs
   of voters, by expectation maximisation over the table of vote patterns,
   which has at most 4096 rows whatever the input.  The labels of the sample
   are one more, noisy, voter.
3. A linear classifier over the mined features is trained on posterior labels: of
   the labelled sample, and of a bounded sample of documents without a label, for
   which the model has their votes alone.  It scores every whole text in one
   narrow pass.

Labels are read only of documents whose crc32(doc_id as text) mod 4 is not 2.

Edge cases: a null or empty text is scored by the intercept; without usable
labels of both classes the score is 0 for all; conflicting labels of one
document count as toxic; null labels and ids are left out of training; of rows
repeated under one id the smallest text is trained on; every row of ``docs`` gets
a row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kit
from .store import discard, free_name, settle, small_batches

#: Labelled documents that the classifier is fitted on, and documents without a label, at most.
SAMPLE = 9_000
UNLABELLED = 3_000
#: Longest text of the sample, in bytes: longer ones are scored like all others, but not learned from.
SAMPLE_BYTES = 1 << 20
#: Texts of the sample that a feature is in at least. Features kept, at most; the z-score and the log odds ratio from which one is kept.
SEEN, FEATURES, Z, ODDS = 5, 4000, 3.2, 2.0
VOTERS = 12
BITS = 22
THRESHOLD = 0.3
PREFIX = (4, 5)


def features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, feature, words per text): one entry for each word and each beginning of a longer word."""
    s, e, d, h = kit.words(data, offs)
    low = kit.FOLD[data]
    docs, feats = [d], [h >> np.uint64(64 - BITS)]
    for k in PREFIX:
        long = np.flatnonzero(e - s > k)
        if len(long):
            head = kit.span_hash(low, s[long], s[long] + k) * np.uint64(2 * k + 1)
            docs.append(d[long])
            feats.append(kit.mix(head) >> np.uint64(64 - BITS))
    return np.concatenate(docs), np.concatenate(feats).astype(np.int64), np.bincount(d, minlength=len(offs) - 1) if len(d) else np.zeros(len(offs) - 1, np.int64)


def _distinct(d: np.ndarray, f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key = d.astype(np.int64)
    key <<= BITS
    key |= f
    key.sort()
    key = key[np.concatenate([[True], key[1:] != key[:-1]])] if len(key) else key
    return (key >> BITS).astype(np.int32), (key & ((1 << BITS) - 1)).astype(np.int32)


def mine(feats: np.ndarray, a: np.ndarray, b: np.ndarray, n1: int, n0: int) -> tuple[np.ndarray, np.ndarray]:
    """Features of toxic texts and their z-scores, strongest first, from the numbers of toxic (a of n1) and other (b of n0) texts that hold each; long texts share most words, so lift counts too."""
    seen = np.flatnonzero(a + b >= SEEN)
    feats, a, b = feats[seen], a[seen] + 0.5, b[seen] + 0.5
    odds = np.log(a / (n1 + 1 - a)) - np.log(b / (n0 + 1 - b))
    z = odds / np.sqrt(1 / a + 1 / b)
    order = np.lexsort((feats, -z))
    order = order[(z[order] >= Z) & (odds[order] >= ODDS)][:FEATURES]
    return feats[order], z[order]


class Voters:
    """Twelve votes on a text, from tiers of the mined features."""

    def __init__(self, feats: np.ndarray, z: np.ndarray) -> None:
        self.tier = np.full(1 << BITS, -1, np.int8)
        good = feats
        cuts = np.unique(np.minimum(len(good), [4, 10, 24, 60, 140, 320, 800, FEATURES]))
        lo = 0
        for t, hi in enumerate(cuts):
            self.tier[good[lo:hi]] = t
            lo = hi

    def masks(self, d: np.ndarray, f: np.ndarray, n_words: np.ndarray) -> np.ndarray:
        n = len(n_words)
        hit = self.tier[f] >= 0
        d, f = d[hit], f[hit]
        t = self.tier[f].astype(np.int64)
        count = np.bincount(d, minlength=n)
        du, fu = _distinct(d, f)
        variety = np.bincount(du, minlength=n)
        strong = np.bincount(du[self.tier[fu] <= 2], minlength=n)
        mask = np.zeros(n, np.int64)
        for k in range(8):
            mask |= (np.bincount(d[t == k], minlength=n) > 0).astype(np.int64) << k
        for k, vote in enumerate((variety >= 3, strong >= 2, count * 50 > n_words, count > variety)):
            mask |= (vote & (count > 0)).astype(np.int64) << (8 + k)
        return mask


def _tree(bits: np.ndarray, mass: np.ndarray) -> list[int]:
    """Each voter's parent: the spanning tree of most mutual information within the classes; -1 at the root."""
    info = np.zeros((VOTERS, VOTERS))
    for y in (0, 1):
        w = mass[y] / max(mass[y].sum(), 1)
        for i in range(VOTERS):
            for j in range(i):
                for a in (0, 1):
                    for b in (0, 1):
                        both = w[(bits[:, i] == a) & (bits[:, j] == b)].sum() + 1e-12
                        apart = (w[bits[:, i] == a].sum() + 1e-12) * (w[bits[:, j] == b].sum() + 1e-12)
                        info[i, j] += mass[y].sum() * both * np.log(both / apart)
    info += info.T
    parent, best, link, inside = [-1] * VOTERS, info[0].copy(), [0] * VOTERS, {0}
    while len(inside) < VOTERS:
        k = max((x for x in range(VOTERS) if x not in inside), key=lambda x: best[x])
        parent[k] = link[k]
        inside.add(k)
        for x in range(VOTERS):
            if x not in inside and info[k, x] > best[x]:
                best[x], link[x] = info[k, x], k
    return parent


def _calibrated(odds: np.ndarray, gold: np.ndarray) -> np.ndarray:
    """Log odds of the votes, scaled and shifted to the labels: correlations that the tree leaves out make them too sure."""
    x, n = np.clip(odds, -50, 50), gold.sum(axis=0)
    at = np.array([1.0, 0.0])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(at[0] * x + at[1], -500, 500)))
        w, miss = n * p * (1 - p), gold[1] - n * p
        grad = np.array([miss @ x - (at[0] - 1), miss.sum() - at[1]])
        step = np.linalg.solve([[w @ (x * x) + 1, w @ x], [w @ x, w.sum() + 1]], grad)
        at += np.clip(step, -0.25, 0.25)
        at[0] = np.clip(at[0], 0.05, 1)
    return at[0] * x + at[1]


def label_model(everyone: np.ndarray, gold: np.ndarray, rounds: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of the toxic class for each vote pattern, without and with a label (0, 1).

    ``everyone``: counts of the 2^VOTERS patterns; ``gold``: counts by label and pattern.
    Within a class each vote depends on one other vote at most; both the votes'
    accuracies and this tree of correlations are estimated, starting from the labels,
    which also calibrate the votes' joint log odds.
    """
    m = 1 << VOTERS
    bits = np.arange(m)[:, None] >> np.arange(VOTERS) & 1
    rest = np.maximum(everyone - gold.sum(axis=0), 0).astype(float)
    mass = gold.astype(float)
    honest = np.array([[0.97, 0.03], [0.1, 0.9]])  # of a label, by class
    with_label = np.zeros((2, m))
    parent = _tree(bits, mass)
    for step in range(rounds):
        size = mass.sum(axis=1)
        prior = (size + 1) / (size.sum() + 2)
        if step == rounds // 2:
            parent = _tree(bits, mass)
        joint = np.tile(np.log(prior)[:, None], (1, m))
        for y in (0, 1):
            for i, p in enumerate(parent):
                rate = (mass[y][bits[:, i] == 1].sum() + 0.5) / (size[y] + 1)
                given = np.zeros((2, 2))
                for a in (0, 1):
                    at = np.ones(m, bool) if p < 0 else bits[:, p] == a
                    given[a, 1] = (mass[y][at & (bits[:, i] == 1)].sum() + 2 * rate) / (mass[y][at].sum() + 2)
                    given[a, 0] = 1 - given[a, 1]
                joint[y] += np.log(given[bits[:, p] if p >= 0 else 0, bits[:, i]])
        votes = _calibrated(joint[1] - joint[0], gold)
        post = 1 / (1 + np.exp(-votes))
        for g in (0, 1):
            odds = np.log(honest[0, g] / honest[1, g]) - votes
            with_label[g] = 1 / (1 + np.exp(np.clip(odds, -500, 500)))
        honest = np.array([[(gold[g] * (with_label[g] if y else 1 - with_label[g])).sum() + (9 if g == y else 0.5) for g in (0, 1)] for y in (0, 1)])
        honest /= honest.sum(axis=1, keepdims=True)
        mass = np.array([rest * (1 - post) + (gold * (1 - with_label)).sum(axis=0), rest * post + (gold * with_label).sum(axis=0)])
    return post, with_label


def fit_linear(d: np.ndarray, col: np.ndarray, n: int, k: int, target: np.ndarray, l2: float = 3e-4, steps: int = 400) -> tuple[np.ndarray, float]:
    """Logistic regression of soft labels on the presence of features, by Adam over all rows."""
    w, bias = np.zeros(k), float(np.log(max(target.mean(), 1e-4) / max(1 - target.mean(), 1e-4)))
    m1, m2 = np.zeros(k + 1), np.zeros(k + 1)
    for t in range(1, steps + 1):
        z = np.bincount(d, w[col], n) + bias
        g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) / n
        grad = np.append(np.bincount(col, g[d], k) + l2 * w, g.sum())
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.99 * m2 + 0.01 * grad * grad
        move = 0.1 * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.99**t)) + 1e-9)
        w, bias = w - move[:-1], bias - move[-1]
    return w, bias


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def _patterns(docs: DataFrame, voters: Voters) -> np.ndarray:
    """How many documents cast each pattern of votes; partial counts per task, then at most 4096 sums."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(voters)

    def run(batches):
        kit.give_back()
        counts = np.zeros(1 << VOTERS, np.int64)
        for b in batches:
            for _, _, block, at in kit.blocks(*kit.as_bytes(b.column(0))):
                counts += np.bincount(shared.value.masks(*features(block, at)), minlength=1 << VOTERS)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["mask", "n"])

    out = np.zeros(1 << VOTERS, np.int64)
    for mask, n in docs.select("text").mapInArrow(run, "mask long, n long").groupBy("mask").agg(F.sum("n")).collect():
        out[mask] = n
    return out


def _sample(docs: DataFrame, labels: DataFrame, labelled: int, unlabelled: int) -> DataFrame:
    """(id, toxic, text) of documents picked by their id's hash; toxic is -1 where there is no label to learn from."""
    usable = labels.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    usable = usable.groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    ids = docs.select(F.col("doc_id").cast("long").alias("id")).where(F.col("id").isNotNull() & ~held_out(F.col("id")))
    others = ids.join(labels.select(F.col("doc_id").cast("long").alias("id")), "id", "left_anti").distinct().withColumn("toxic", F.lit(-1))
    pick = lambda df, n: df.orderBy(F.xxhash64("id"), "id").limit(n)
    chosen = pick(usable, labelled).unionByName(pick(others, unlabelled))
    texts = docs.where(F.coalesce(F.octet_length("text"), F.lit(0)) <= SAMPLE_BYTES).select(F.col("doc_id").cast("long").alias("id"), "text").join(F.broadcast(chosen), "id")
    return texts.groupBy("id", "toxic").agg(F.min("text").alias("text"))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, unlabelled: int = UNLABELLED) -> tuple[np.ndarray, np.ndarray, float]:
    """(features, weights, intercept) of the classifier; the intercept is -inf if there is nothing to learn from."""
    small_batches(docs.sparkSession)
    texts = _sample(docs, labels, sample, unlabelled)

    def run(batches):
        kit.give_back()
        for b in batches:
            at = 0
            for _, hi, block, offs in kit.blocks(*kit.as_bytes(b.column(2))):
                d, f, n_words = features(block, offs)
                key, times = np.unique(d.astype(np.int64) << BITS | f, return_counts=True)
                ends = pa.array(np.searchsorted(key >> BITS, np.arange(len(offs))), pa.int32())
                lists = [pa.ListArray.from_arrays(ends, pa.array(x.astype(np.int32))) for x in (key & ((1 << BITS) - 1), times)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, hi - at), b.column(1).slice(at, hi - at), *lists, pa.array(n_words)], ["id", "toxic", "f", "times", "n_words"])
                at = hi

    made = settle(texts.mapInArrow(run, "id long, toxic int, f array<int>, times array<int>, n_words long"))
    # The driver gets counts of features, of which there are 2^BITS at most, and then the places of the few that are kept.
    told = made.where("toxic >= 0")
    n1, n0 = (told.agg(F.count_if(F.col("toxic") == y)).first()[0] for y in (1, 0))
    if not n1 or not n0:
        return np.zeros(0, np.int64), np.zeros(0), -np.inf
    each = told.select("toxic", F.explode("f").alias("f")).groupBy("f").agg(*[F.count_if(F.col("toxic") == y).cast("int").alias(n) for n, y in (("a", 1), ("b", 0))])
    each = each.where(F.col("a") + F.col("b") >= SEEN).toArrow()
    feats, z = mine(*(each[c].to_numpy().astype(np.int64) for c in "fab"), n1, n0)
    del each
    voters = Voters(feats, z)
    wanted = docs.sparkSession.sparkContext.broadcast(np.sort(feats))

    def narrow(batches):
        for b in batches:
            sizes = b.column(2).value_lengths().to_numpy(zero_copy_only=False)
            f, times = (b.column(i).flatten().to_numpy() for i in (2, 3))
            use = np.isin(f, wanted.value)
            kept = np.bincount(np.repeat(np.arange(len(b)), sizes)[use], minlength=len(b))
            ends = pa.array(np.concatenate([[0], np.cumsum(kept)]), pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(x[use])) for x in (f, times)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *lists, b.column(4)], ["id", "toxic", "f", "times", "n_words"])

    got = made.mapInArrow(narrow, "id long, toxic int, f array<int>, times array<int>, n_words long").orderBy("id").toArrow()
    discard(made)
    toxic, n_words = (got[c].to_numpy().astype(np.int64) for c in ("toxic", "n_words"))
    lists = got["f"].combine_chunks()
    fu, times = lists.flatten().to_numpy().astype(np.int64), got["times"].combine_chunks().flatten().to_numpy()
    du = np.repeat(np.arange(len(toxic)), lists.value_lengths().to_numpy())
    masks = voters.masks(np.repeat(du, times), np.repeat(fu, times), n_words)
    gold = np.array([np.bincount(masks[toxic == y], minlength=1 << VOTERS) for y in (0, 1)])
    alone, posterior = label_model(_patterns(docs, voters), gold)
    target = np.where(toxic < 0, alone[masks], posterior[np.maximum(toxic, 0), masks])
    place = np.full(1 << BITS, -1, np.int32)
    place[feats] = np.arange(len(feats))
    w, bias = fit_linear(du, place[fu], len(toxic), len(feats), target)
    return feats, w, bias


def scorer(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float]):
    """A column function: text -> score in [0, 1]."""
    feats, w, bias = model
    shared = docs.sparkSession.sparkContext.broadcast((feats, w, bias))
    state: dict = {}

    @F.arrow_udf(T.DoubleType())
    def score(text: pa.Array) -> pa.Array:
        if "table" not in state:
            feats, w, _ = shared.value
            state["table"] = np.zeros(1 << BITS, np.float32)
            state["table"][feats] = w
        kit.give_back()
        table, bias = state["table"], shared.value[2]
        data, offs = kit.as_bytes(text)
        out = np.zeros(len(offs) - 1)
        if np.isneginf(bias):
            return pa.array(out)
        for lo, hi, block, at in kit.blocks(data, offs):
            d, f, _ = features(block, at)
            hit = table[f] != 0
            du, fu = _distinct(d[hit], f[hit])
            out[lo:hi] = np.bincount(du, table[fu], hi - lo) if len(du) else 0
        return pa.array(1 / (1 + np.exp(-np.clip(out + bias, -30, 30))))

    return score.asNondeterministic()


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    udf = scorer(docs, fit(docs, labels))
    scored = docs.select("doc_id", "text").select("doc_id", held_out(F.col("doc_id")).alias("held_out"), udf("text").alias("score"))
    return scored.select("*", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without those scored as toxic; all columns stay."""
    udf, name = scorer(docs, fit(docs, labels)), free_name(docs, "score")
    return docs.withColumn(name, udf("text")).where(F.col(name) < THRESHOLD).select(*docs.columns)
