from __future__ import annotations

import os
import random
from collections import defaultdict

import numpy as np

from loglathe.llm import ngram_join, parity, words
from loglathe.llm.components import connected_components
from loglathe.session import shared_dir
from tests.llm import data


def shingles(text):
    w = data.words_of(text)
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def similar(a, b):
    return bool(a) and bool(b) and 100 * len(a & b) >= 75 * len(a | b)


def brute(rows):
    """Sorted ``(doc_id, size, component_id)``, and how many components have words."""
    sets = [shingles(r[1]) for r in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if similar(sets[i], sets[j]) and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = defaultdict(list)
    for g, r in zip(group, rows):
        if r[0] is not None:
            least[g].append(r[0])
    return sorted(
        ((r[0], len(s), (min(least[g]) if least[g] else None) if s else r[0])
         for r, s, g in zip(rows, sets, group)), key=repr), len(
             {g for s, g in zip(sets, group) if s})


def test_components_equal_brute_force(spark):
    rng = random.Random(5)
    rows = data.documents()
    # Chains of small edits, pairs at the very threshold, and a passage that all share.
    text = data.prose(rng, 80)
    for k in range(15):
        text = data.edited(rng, text, 2)
        rows.append((2000 + k, text, "en", "a", 0))
    for n in range(3, 40):
        w = [f"t{n}x{i}" for i in range(n + 6)]
        rows += [(3000 + n, " ".join(w[:n + 4]), "en", "a", 0), (4000 + n, " ".join(w[n // 4:]), "en", "a", 0)]
    common = data.prose(rng, 30)
    rows += [(5000 + k, common + " " + data.prose(rng, rng.randrange(1, 25)), "en", "a", 0) for k in range(40)]
    expected, groups = brute(rows)
    out = ngram_join.components(data.table(spark, rows)).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out), key=repr) == expected

    docs = data.with_clashes(data.table(spark, rows))
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    with_words = [r for r in kept.collect() if data.words_of(r["text"])]
    # A repeated id may name two components.
    assert len(with_words) == groups
    assert {r["doc_id"] for r in with_words} == {c for d, n, c in expected if n}


def test_empty_table(spark):
    assert ngram_join.components(data.table(spark, [])).count() == 0
    assert ngram_join.keep_one(data.table(spark, [])).count() == 0


def _kernel(texts):
    hashes, counts, _ = words.word_hashes([t.encode() for t in texts])
    return parity.shingle_sets(hashes, counts)


def test_similar_sets_share_a_key_under_any_order():
    rng = random.Random(9)
    for fine in (False, True):
        for size in (3, 4, 9, 30, 63, 64, 86, 120, 127, 128, 300, 700):
            pool = np.array([rng.getrandbits(64) for _ in range(2 * size)], np.uint64)
            a = np.sort(pool[:size])
            for d in range(0, size):
                # Replace, drop or add until the similarity is just at 3/4.
                b = np.sort(np.concatenate([pool[:size - d], pool[size:size + rng.randrange(d + 1)]]))
                both = len(np.intersect1d(a, b))
                if 100 * both < 75 * (len(a) + len(b) - both):
                    break
                frequent = rng.sample(pool.tolist(), size // 2)
                order = parity.Order(np.zeros(0, np.uint64), np.zeros(0, np.int64))
                keys, owner, lacking = parity.keys(
                    np.concatenate([a, b]), np.array([len(a), len(b)]), order, fine)
                order = parity.Order(np.unique(keys)[::2], np.arange(len(np.unique(keys)[::2])) + 3)
                keys, owner, lacking = parity.keys(
                    np.concatenate([a, b]), np.array([len(a), len(b)]), order, fine)
                assert len(lacking) or set(keys[owner == 0]) & set(keys[owner == 1]), (size, d)
                assert not (fine and len(lacking)), frequent


def test_sketch_distance_never_exceeds_the_difference():
    rng = random.Random(3)
    sets = [np.array(sorted({rng.getrandbits(64) for _ in range(n)}), np.uint64)
            for n in (1, 5, 40, 64, 65, 300)]
    sets += [np.union1d(s[: len(s) // 2], sets[2]) for s in sets]
    for a in sets:
        for b in sets:
            difference = len(np.setxor1d(a, b))
            assert parity.hamming(parity.sketch(a), parity.sketch(b)) <= difference
            folded = [x ^ y for x, y in zip(parity.folded(a), parity.folded(b))]
            assert sum((v & (2 ** 64 - 1)).bit_count() for v in folded) <= difference


def test_word_hashes_tell_words_apart():
    texts = ["A b  c", "", "\tä\x1cß\n", "a B C", "bc a", "x" * 3000 + " y"]
    hashes, counts, spans = words.word_hashes([t.encode() for t in texts])
    expected = [w for t in texts for w in data.words_of(t)]
    assert counts.tolist() == [len(data.words_of(t)) for t in texts]
    joined = " ".join(texts).encode()
    assert [joined[s:e].decode().lower() for s, e in spans] == [w.lower() for w in expected]
    names = defaultdict(set)
    for w, h in zip(expected, hashes.tolist()):
        names[w].add(h)
    assert all(len(v) == 1 for v in names.values())
    assert len({h for v in names.values() for h in v}) == len(names)


def test_shingles_are_distinct_sets():
    texts = ["a b c d e f", "F a b c d e f", "a b", "", "a a a a a a a a", "b a"]
    value, counts = _kernel(texts)
    assert counts.tolist() == [len(shingles(t)) for t in texts]


def test_connected_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, k) for k in range(101, 130)]
    edges += [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)]
    found = {r["node"]: r["component"] for r in connected_components(
        spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    for a, b in edges:
        if a != b:
            assert found[a] == found[b] <= min(a, b)
    assert all(found[c] == c for c in set(found.values()))
    assert {found[i] for i in range(1, 41)} == {1}


def test_rounds_leave_no_scratch_tables(spark):
    rng = random.Random(9)
    text = data.prose(rng, 90)
    rows = [(k, data.edited(rng, text, 1 + k % 9), "en", "a", 0) for k in range(60)]
    rows += [(100 + k, data.prose(rng, 40), "en", "a", 0) for k in range(20)]
    base = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(base))
    table, found = ngram_join.linked(data.table(spark, rows))
    left = {n for n in os.listdir(base) if n not in before and os.path.isdir(f"{base}/{n}")}
    used = {f.split("/")[-2] for t in (table, found) for f in t.inputFiles()}
    assert left == used


def test_few_edges_are_taken_by_one_task(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(100)] + [(900, 902), (901, 902)], "a long, b long")
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        out = connected_components(edges)
    finally:
        spark.conf.unset(setting)
    assert len(out.inputFiles()) == 1
    assert {r["node"]: r["component"] for r in out.collect()} == {
        **{k: 0 for k in range(101)}, **{k: 900 for k in (900, 901, 902)}}


def test_keys_that_several_classes_have(spark):
    rng = np.random.default_rng(4)
    key, value = rng.integers(-30, 30, 300), rng.integers(0, 9, 300)
    rows = list(zip(key.tolist(), value.tolist())) + [(100 + k, k) for k in range(50)] + [(200, 1), (200, 1)]
    out = ngram_join._meetings(spark.createDataFrame(rows, "key bigint, class bigint").repartition(3)).collect()
    expected = []
    for k in {k for k, _ in rows}:
        own = sorted({c for other, c in rows if other == k})
        expected += [(k, b, a) for a, b in zip(own, own[1:])]
    assert sorted(tuple(r) for r in out) == sorted(expected)


def test_sketches_of_many_sets():
    rng = np.random.default_rng(5)
    counts = np.array([0, 1, 70, 0, 3000, 64, 15])
    value = rng.integers(0, 1 << 63, counts.sum()).astype(np.uint64)
    ends = np.cumsum(counts)
    sets = [value[e - n:e] for e, n in zip(ends, counts)]
    sketch, folded = ngram_join._sketched(value, counts)
    assert sketch.to_pylist() == [parity.sketch(s) if len(s) else None for s in sets]
    assert folded.to_pylist() == [parity.folded(s) for s in sets]
