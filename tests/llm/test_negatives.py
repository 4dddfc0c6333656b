from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loglathe.llm import negatives
from tests.llm import data

SCHEMA = "vec_id bigint, embedding array<float>, label int"
DIMENSION = 8


def vectors(n=900, clusters=12, seed=4):
    """Tight clusters, a third of all rows copies of one vector, and every awkward row."""
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(DIMENSION)] for _ in range(clusters)]
    rows = []
    for i in range(n):
        if i % 3 == 0:
            rows.append((i, [0.5] * DIMENSION, i % 4))
        else:
            centre = rng.choice(centres)
            rows.append((i, [x + rng.gauss(0, 0.05) for x in centre], rng.randrange(4)))
    rows += [(None, [1.0] * DIMENSION, 1), (5000, None, 1), (5001, [1.0] * DIMENSION, None),
             (5002, [None] + [1.0] * 7, 1), (5003, [float("nan")] * DIMENSION, 1),
             (5004, [float("inf")] * DIMENSION, 1), (5005, [1.0, 2.0], 1), (5006, [], 2),
             (5007, [0.0] * DIMENSION, 3), (5100, [-1.0] * DIMENSION, 9), rows[1], rows[100],
             (7, [9.0] * DIMENSION, 9)]
    return rows


def brute(rows, anchor, positives=5, negatives_=10, least=30, most=90):
    kept = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        v = [math.floor(256 * float(np.float32(x))) for x in v]
        kept[i] = min(kept.get(i, (label, v)), (label, v))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = set()
    for a, (label, v) in kept.items():
        if not anchor(a):
            continue
        scored = sorted((-dot(v, w), i, other) for i, (other, w) in kept.items() if i != a)
        for s, p, _ in [x for x in scored if x[2] == label][:positives]:
            found = [(n, -m) for m, n, other in scored
                     if other != label and least * -s <= 100 * -m <= most * -s]
            out |= {(a, p, rank, n, -s, m) for rank, (n, m) in enumerate(found[:negatives_], 1)}
    return out


def mined(spark, rows, every=20, **options):
    table = spark.createDataFrame(rows, SCHEMA).repartition(7)
    return negatives.mine(table, F.col("vec_id") % every == 0, **options).collect()


def test_equals_brute_force(spark):
    rows = vectors()
    want = brute(rows, lambda i: i % 20 == 0)
    got = mined(spark, rows, leaf_rows=20, block_rows=16, fanout=4, sample=200)
    assert len(want) > 200 and len(got) == len(want)
    assert {tuple(r) for r in got} == want


def test_other_windows_and_a_tree_of_one_leaf(spark):
    rows = vectors(300, seed=9)
    want = brute(rows, lambda i: i % 7 == 0, positives=2, negatives_=3, least=-50, most=60)
    got = mined(spark, rows, 7, positives=2, negatives=3, least=-50, most=60)
    assert {tuple(r) for r in got} == want


def test_leaves_are_left_out_but_never_one_that_matters():
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 40, (30, 6))
    rows = (centres[rng.integers(0, 30, 3000)] + rng.normal(0, 1, (3000, 6))).round()
    tree = negatives.Tree(rows[:600], len(rows), fanout=6, leaf_rows=60)

    def seen(node, child, away):
        node.ranges[0][:, child] = np.minimum(node.ranges[0][:, child], away.min(0))
        node.ranges[1][:, child] = np.maximum(node.ranges[1][:, child], away.max(0))

    leaves = tree.place(rows, seen)
    away = negatives.distances(rows[:50], rows)
    near, far = np.full((50, 2), 3.0), np.full((50, 2), 8.0)
    near[:, 1], far[:, 1] = 60.0, 64.0
    reached = tree.reached(rows[:50], near, far)
    wanted = (away >= 3) & (away <= 8) | (away >= 60) & (away <= 64)
    assert all(reached[i, leaves[j]] for i, j in zip(*np.nonzero(wanted)))
    assert tree.leaves > 30 and reached.mean() < 0.7
    empty = tree.reached(rows[:50], far, near)
    assert not empty.any()


def test_blocks_are_bounded_and_hold_every_row(spark):
    rows = spark.createDataFrame(vectors(), SCHEMA)
    ready = negatives.prepared(rows, 256)
    space = negatives._space(ready, 200, leaf_rows=20, fanout=4)
    negatives._measure(ready, space, 16)
    blocks = negatives._blocks(ready, space, 16).collect()
    sizes = [len(b["ids"]) // 8 for b in blocks]
    assert sum(sizes) == ready.count() and max(sizes) <= 16
    # The copies fill one leaf, which has many parts.
    assert max(space.parts) >= 300 // 16


def test_awkward_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert negatives.mine(empty, F.col("vec_id") % 2 == 0).count() == 0
    assert mined(spark, [(0, [1.0], 1)], 1) == []
    assert mined(spark, [(0, [], 1), (1, [], 1), (2, [], 2)], 1) != []
    clashing = data.with_clashes(spark.createDataFrame(vectors(200), SCHEMA))
    for name in ("v", "leaf", "part", "rank", "of"):
        clashing = clashing.withColumn(name, F.lit("own"))
    out = negatives.mine(clashing, F.col("vec_id") % 20 == 0)
    assert {tuple(r) for r in out.collect()} == brute(vectors(200), lambda i: i % 20 == 0)


@pytest.mark.parametrize("size", [2.0 ** 10, 2.0 ** 20])
def test_long_vectors(spark, size):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-size, size) for _ in range(3)], i % 3) for i in range(120)]
    got = mined(spark, rows, 10, leaf_rows=10, fanout=3)
    assert {tuple(r) for r in got} == brute(rows, lambda i: i % 10 == 0)
