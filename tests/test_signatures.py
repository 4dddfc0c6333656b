"""Templates from distinct masked lines."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from loglathe.operators import signatures, similar, templates
from loglathe.operators.normalize import learned_state, mine_raw, outcomes_unknown
from loglathe.plans.batch import EventStore, ingest_lines
from tests.conftest import OPTIONS

MODE = replace(OPTIONS, mode="signatures")


def mask(token):
    return "<*>" if any(c.isdigit() for c in token) else token


def by_hand(texts, similarity):
    """Template of every line, one signature after the other."""
    leaves = defaultdict(Counter)
    for text in texts:
        sig = tuple(mask(t) for t in text.split())
        leaves[len(sig), sig[0]][sig] += 1
    found = {}
    for counts in leaves.values():
        leaders, members = [], defaultdict(list)
        for sig, _ in sorted(counts.items(), key=lambda kv: (-kv[1], "\x1f".join(kv[0]))):
            best = max(((sum(a == b != "<*>" for a, b in zip(sig, l)), l.count("<*>"), -i)
                        for i, l in enumerate(leaders)
                        if sum(a == b != "<*>" for a, b in zip(sig, l)) / len(sig) >= similarity),
                       default=None)
            if best is None:
                leaders.append(sig)
                members[len(leaders) - 1].append(sig)
            else:
                members[-best[2]].append(sig)
        for group in members.values():
            shape = " ".join(ts[0] if len(set(ts)) == 1 else "<*>" for ts in zip(*group))
            found.update({sig: shape for sig in group})
    return [found[tuple(mask(t) for t in text.split())] for text in texts]


def mixed_lines(n, words, seed):
    rnd = random.Random(seed)
    rows = ["unit up 5 all"] * (n // 3)
    while len(rows) < n:
        if rnd.random() < 0.4:
            parts = rnd.choice(rows).split()
            parts[rnd.randrange(1, len(parts))] = rnd.choice(["x", "7", f"v{rnd.randrange(9)}"])
        else:
            parts = ["unit"] + [rnd.choice(["on", "3"] + [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(words)])
                                for _ in range(rnd.choice([3, 7]))]
        rows.append(" ".join(parts))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("words, chunk, few, similarity", [
    (6, 1000, 32, 0.4), (200, 50, 32, 0.5), (200, 50, 0, 0.5), (200, 1000, 1, 0.9)])
def test_templates_equal_a_plain_version(spark, monkeypatch, words, chunk, few, similarity):
    monkeypatch.setattr(similar, "FEW", few)
    texts = mixed_lines(900, words, seed=words + chunk)
    df = templates.tokenize_lines(spark.createDataFrame(
        list(enumerate(texts)), "seq bigint, raw_text string").repartition(5))
    mined = signatures.mine_signatures(df.select("leaf", "tokens"), similarity, chunk=chunk)
    got = signatures.with_signature_template(df, mined).orderBy("seq").select(
        F.array_join("_template", " ")).collect()
    assert [r[0] for r in got] == by_hand(texts, similarity)
    # Lines in another order give the same templates, and none is counted twice.
    again = signatures.signature_templates(mined).collect()
    assert sum(r["n_lines"] for r in again) == len(texts)
    assert {" ".join(r["template"]) for r in again} == set(by_hand(texts, similarity))


def test_lines_without_tokens_and_empty_input(spark, raw_of):
    rows = outcomes_unknown(raw_of(["|=|", "= |", "3 4", "word"]), MODE).collect()
    assert len(rows) == 4 and all(r["status"] == "normalized" for r in rows)
    assert outcomes_unknown(raw_of(["{}"]), MODE).count() == 0


def test_first_line_of_a_shape_is_understood(raw_of):
    rows = outcomes_unknown(raw_of([
        "denied|from 10.0.0.5 port 443|by gate-7", "denied|from 10.0.0.9 port 80|by gate-8",
        "something else entirely happened here on some host"]), MODE).orderBy("seq").collect()
    assert [(r["src_ip"], r["src_port"]) for r in rows] == [
        ("10.0.0.5", 443), ("10.0.0.9", 80), (None, None)]


def test_signatures_of_earlier_runs_count(spark, raw_of, folder):
    first = ["unit red moved slowly"] * 3
    second = ["unit blue moved slowly"]
    learned = mine_raw(raw_of(first), MODE)[0]
    mined = mine_raw(raw_of(second), MODE, learned_state(learned, MODE))[0]
    assert {(" ".join(r["template"]), r["n_lines"]) for r in signatures.signature_templates(mined).collect()} == {
        ("unit <*> moved slowly", 4)}
    store = EventStore(spark, folder)
    lines = spark.createDataFrame([("a.log", 1, 1, first[0])],
                                  "source_name string, line_no bigint, seq bigint, raw_text string")
    one = ingest_lines(store, lines, MODE)
    ingest_lines(store, lines, MODE, prior_run=one)
    assert store.events().count() == 2
