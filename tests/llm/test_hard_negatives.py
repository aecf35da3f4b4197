"""Hard-negative mining against all pairs."""

import math
import random

from trackloom.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int, k int, block int, uid string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, 2, "u") for i, v, label in rows], SCHEMA).repartition(3)


def by_force(rows):
    good = {}
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(c is not None and math.isfinite(c) for c in v):
            label = (label + 1) % 10 if i % 7 == 0 else label
            good[i, label, tuple(math.floor(256 * c) for c in v)] = None
    widths = [len(r[2]) for r in good]
    good = [r for r in good if len(r[2]) == max(set(widths), key=lambda w: (widths.count(w), -w))]
    out = []
    for a in good:
        if a[0] % 100 == 0:
            score = lambda r, a=a: sum(x * y for x, y in zip(a[2], r[2], strict=True))
            first = lambda rs, n, score=score: sorted(((-score(r), r[0]) for r in rs), key=lambda t: t)[:n]
            for p, pid in first([r for r in good if r != a and r[1] == a[1]], 5):
                fits = [r for r in good if r[1] != a[1] and 30 * -p <= 100 * score(r) <= 90 * -p]
                out += [(a[0], pid, rank, nid, -p, -n) for rank, (n, nid) in enumerate(first(fits, 10), 1)]
    return sorted(out)


def rows_of(seed, n, dims=70, labels=10):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, 0.3) + (0.5 if d == i % 4 else 0) for d in range(dims)], rng.randrange(labels)) for i in range(n)]


def check(spark, rows, **sizes):
    assert sorted(map(tuple, hard_negatives.mine(table(spark, rows), **sizes).collect())) == by_force(rows)


def test_all_pairs(spark):
    rows = rows_of(1, 420)
    assert by_force(rows)
    check(spark, rows)
    check(spark, rows, rows_a_block=17, anchors_a_block=1)


def test_many_labels_share_groups(spark):
    check(spark, rows_of(2, 450, dims=9, labels=60), rows_a_block=40, anchors_a_block=2)


def test_hot_vector_label_and_ties(spark):
    rows = rows_of(3, 310, dims=6)
    hot = [(1000 + k, rows[100][1], 3) for k in range(150)] + [(2000 + k, rows[100][1], rows[100][2]) for k in range(20)] + [(3000 + k, [0.0] * 6, 4) for k in range(9)]
    check(spark, rows + hot, rows_a_block=50, anchors_a_block=3)


def test_edges(spark):
    odd = [(100, None, 1), (200, [0.5] * 5, None), (None, [0.5] * 5, 2), (300, [0.1, None, 0.2, 0.3, 0.4], 1), (400, [math.nan] * 5, 1), (500, [math.inf, 0.0, 0.0, 0.0, 0.0], 1), (600, [], 1), (700, [0.5] * 4, 1), (-100, [0.3, -0.2, 0.5, 0.1, 0.9], -3)]
    rows = rows_of(4, 220, dims=5) + odd
    check(spark, rows + rows[:50])
    assert hard_negatives.mine(table(spark, [])).count() == 0
    assert hard_negatives.mine(table(spark, [(1, [1.0], 1), (2, [1.0], 2)])).count() == 0
    check(spark, [(0, [1.0, 1.0], 1), (100, [0.7, 0.7], 1), (5, [0.6, 0.5], 2)])


def test_large_components(spark):
    rng = random.Random(5)
    check(spark, [(i, [rng.uniform(-2e5, 2e5) for _ in range(40)], i % 3) for i in range(201)])
