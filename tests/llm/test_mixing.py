from __future__ import annotations

from collections import Counter, defaultdict

import pytest

from loglathe.llm import mixing
from tests.llm import data


def expected_targets(sizes):
    """Sources by name, null last; the excess over three times a source's size is shared again."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    budget, target, full = float(sum(sizes.values())), {}, set()
    while True:
        rest = budget - sum(3 * sizes[s] for s in full)
        free = [s for s in names if s not in full]
        share = sum(weight[s] for s in free)
        target = {s: 3.0 * sizes[s] if s in full else rest * weight[s] / share for s in names}
        over = {s for s in free if target[s] > 3 * sizes[s] + 1e-9}
        if not over:
            return target
        full |= over


def test_targets_and_taken_words(spark):
    rows = data.documents()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(data.words_of(r[1]))
    target = expected_targets(sizes)
    out = mixing.taken(data.table(spark)).collect()
    assert Counter((r["doc_id"], r["size"]) for r in out) == Counter(
        (r[0], len(data.words_of(r[1]))) for r in rows)
    taken = defaultdict(int)
    for r in out:
        source = None if r["no_src"] else r["src"]
        assert r["source_size"] == sizes[source]
        assert r["target"] == pytest.approx(target[source])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[source] += r["taken"]
    for source, value in target.items():
        assert abs(taken[source] - value) <= 1


def test_order_is_fair_and_stops_at_the_budget(spark):
    rows = [(i, "w " * 10, "en", "ab"[i % 2], 20) for i in range(200)]
    out = mixing.schedule(mixing.sized(data.table(spark, rows))).filter("words > 0").collect()
    out.sort(key=lambda r: r["offset"])
    assert [r["offset"] for r in out][:3] == [0, 10, 20]
    assert out[-1]["offset"] + out[-1]["words"] <= 2000
    # Weights 1 and 2: at any time source b has given about twice as much.
    given = Counter()
    for r in out:
        given[r["src"]] += r["words"]
        assert abs(2 * given["a"] - given["b"]) <= 30


def test_reruns_agree_and_partitions_do_not_matter(spark):
    docs = data.table(spark)
    one = Counter(tuple(r) for r in mixing.taken(docs).collect())
    two = Counter(tuple(r) for r in mixing.taken(docs.repartition(5)).collect())
    assert one == two


def test_mixed_documents(spark):
    docs = data.with_clashes(data.table(spark))
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    counts = Counter((r["doc_id"], r["text"]) for r in out.collect())
    assert counts and max(Counter((k[0], k[1]) for k in counts.elements()).values()) <= 6
    assert all(data.words_of(text) for _, text in counts)


def test_mixed_gives_the_words_that_are_taken(spark):
    # One document holds nearly all words of its source, whose target is a part of them.
    rows = [(0, " long\t" * 1000, "en", "a", 0)] + [(i, "w " * 10, "en", "a", 0) for i in range(1, 6)]
    rows += [(10 + i, " v\n w" * 10, "en", "bc"[i % 2], 0) for i in range(40)]
    for docs in (data.table(spark, rows), data.table(spark)):
        due, given = Counter(), Counter()
        for r in mixing.taken(docs).collect():
            due[None if r["no_src"] else r["src"]] += r["taken"]
        texts = {r["doc_id"]: set() for r in docs.collect()}
        for r in docs.collect():
            texts[r["doc_id"]].add(r["text"] or "")
        for r in mixing.mixed(docs).collect():
            given[r["source"]] += len(data.words_of(r["text"]))
            assert any(t.startswith(r["text"]) for t in texts[r["doc_id"]])
        assert +given == +due


def test_empty_and_blank_tables(spark):
    assert mixing.taken(data.table(spark, [])).count() == 0
    assert mixing.mixed(data.table(spark, [])).count() == 0
    blank = mixing.taken(data.table(spark, [(1, None, None, None, 0), (2, " ", "en", "a", 1)])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in blank] == [(0, 0.0, 0)] * 2
