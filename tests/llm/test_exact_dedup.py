from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

from loglathe.llm import exact_dedup
from tests.llm import data


def normal(text):
    return "".join(c for c in text or "" if c not in " \t\n\x0b\f\r")


def expected(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[normal(r[1])].append((-len(r[1] or ""), r[0] is None, r[0] or 0, r[0]))
    out = Counter()
    for text, members in groups.items():
        members.sort()
        digest = hashlib.sha256(text.encode()).hexdigest()
        for k, m in enumerate(members):
            out[m[3], members[0][3], len(members), k == 0, digest] += 1
    return out


def found(docs, **options):
    return Counter(tuple(r) for r in exact_dedup.groups(docs, **options).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256").collect())


def test_groups(spark):
    rows = data.documents()
    assert found(data.table(spark)) == expected(rows)


def test_with_few_counters_the_shuffled_rest_agrees(spark):
    rows = data.documents() + [(1000 + i, f"copy {i % 3}", "en", "a", 6) for i in range(60)]
    assert found(data.table(spark, rows), counters=2) == expected(rows)


def test_frequent_digests_hold_every_heavy_one(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"t{i}", "en", "a", 1) for i in range(900)]
    table = exact_dedup.digests(data.table(spark, rows).repartition(7))
    frequent = exact_dedup.frequent_digests(table, counters=10).collect()
    hot = hashlib.sha256(b"hot").digest()
    assert hot in {bytes(r[0]) for r in frequent} and len(frequent) <= 11


def test_empty_table(spark):
    assert found(data.table(spark, [])) == Counter()


def test_deduplicate_keeps_columns_and_one_row_of_each_group(spark):
    docs = data.with_clashes(data.table(spark))
    out = exact_dedup.deduplicate(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert Counter(normal(r["text"]) for r in rows) == Counter(
        {t: 1 for t in {normal(r[1]) for r in data.documents()}})
    kept = {(r["doc_id"], normal(r["text"])) for r in rows}
    best = {(k[1], k[4]) for k in expected(data.documents())}
    assert {(i, hashlib.sha256(t.encode()).hexdigest()) for i, t in kept} == best
    assert exact_dedup.deduplicate(data.table(spark, [])).count() == 0
