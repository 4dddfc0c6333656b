"""Template mining and field guessing for unrecognised lines."""

from __future__ import annotations

import random
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from loglathe.contracts import UNKNOWN_ACTION_WORDS, WILDCARD
from loglathe.functions.text import tokens
from loglathe.operators import sequential, similar, templates
from loglathe.operators.normalize import learned_state, mine_raw, outcomes_unknown
from tests.conftest import CLOCK, OPTIONS

FIRST = "ALRT|2026-08-25T14:40:02|SEV3|SRC=192.168.5.6:9100|ACT=BLOCKED|RULE=RL-882"
SECOND = "ALRT|2026-08-25T14:41:19|SEV2|SRC=203.0.113.9:5100|ACT=ALLOWED|RULE=RL-119"
SEQUENTIAL = replace(OPTIONS, mode="sequential")


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_tokens(spark):
    assert one(spark, tokens(F.lit(FIRST))) == [
        "ALRT", "2026-08-25T14:40:02", "SEV3", "SRC", "192.168.5.6:9100", "ACT", "BLOCKED",
        "RULE", "RL-882"]
    assert one(spark, tokens(F.lit(" a\t\tb\u00a0c\u2003 "))) == ["a", "b", "c"]
    assert one(spark, tokens(F.lit("|=|"))) == []


@pytest.mark.parametrize("template, text, values", [
    ("ALRT <*> <*> SRC <*> ACT <*> RULE <*>", FIRST,
     ["2026-08-25T14:40:02", "SEV3", "192.168.5.6:9100", "BLOCKED", "RL-882"]),
    ("user <*> logged in", "user johndoe logged in", ["johndoe"]),
    (None, "anything at all", []),
    ("", "anything at all", []),
    ("ALRT <*> <*> SRC <*> ACT <*> RULE <*>", "totally different shape entirely", []),
])
def test_values_of_a_given_template(spark, template, text, values):
    column = templates.template_values(F.lit(template).cast("string"), F.lit(text))
    assert one(spark, column) == values


def guess_by_hand(values):
    """The guessing rules, one value at a time."""
    import re
    address = re.compile(r"\d{1,3}(\.\d{1,3}){3}")
    words = {w: a for a, ws in UNKNOWN_ACTION_WORDS.items() for w in ws}
    src = dst = src_port = dst_port = stamp = None
    action, last = "unknown", None
    for value in values:
        host, _, port = value.partition(":")
        here = None
        if re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ?", value):
            stamp = value.rstrip("Z") + "Z"
        elif address.fullmatch(host) and re.fullmatch(r"\d{1,5}", port):
            number = int(port) if int(port) <= 65535 else None
            if src is None:
                src, src_port = host, number
            elif dst is None:
                dst, dst_port = host, number
        elif address.fullmatch(value):
            here = value
            if src is None:
                src = value
            elif dst is None:
                dst = value
        elif re.fullmatch(r"\d{1,5}", value):
            if int(value) <= 65535 and last is not None:
                if last == src and src_port is None:
                    src_port = int(value)
                elif last == dst and dst_port is None:
                    dst_port = int(value)
        elif action == "unknown":
            action = words.get(value.lower(), "unknown")
        last = here
    return stamp, src, dst, src_port, dst_port, action


def test_guesses_follow_the_rules(spark):
    rnd = random.Random(3)
    pool = ["1.1.1.1", "2.2.2.2", "3.3.3.3", "999.1.1.1", "1.1.1.1:80", "2.2.2.2:70000",
            "3.3.3.3:443", "80", "443", "70000", "123456", "BLOCKED", "allow", "Drop", "permit",
            "word", "2026-01-01T00:00:00", "2026-99-99T99:99:99Z"]
    cases = [[], ["1.1.1.1", "80"], ["1.1.1.1", "x", "80"], ["1.1.1.1", "80", "1.1.1.1", "443"]]
    cases += [[rnd.choice(pool) for _ in range(rnd.randint(1, 8))] for _ in range(400)]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, v array<string>")
    rows = df.select("i", templates.classify_tokens(F.col("v")).alias("g")).orderBy("i").collect()
    got = [tuple(r["g"][f] for f in ("timestamp", "src_ip", "dst_ip", "src_port", "dst_port",
                                     "action")) for r in rows]
    assert got == [guess_by_hand(c) for c in cases]


@pytest.mark.parametrize("options", [OPTIONS, SEQUENTIAL])
def test_second_line_of_a_shape_is_understood(raw_of, options):
    rows = outcomes_unknown(raw_of([
        FIRST, "connection from 10.0.0.5 was blocked", SECOND,
        "connection from 10.0.0.9 was allowed", "!!! not a log line at all ???", "|=|",
    ]), options).orderBy("seq").collect()
    assert len(rows) == 6
    first, _, second, plain, junk, _ = rows
    assert (first["timestamp"], first["src_ip"], first["action"]) == (CLOCK, None, "unknown")
    assert (second["timestamp"], second["src_ip"], second["src_port"], second["action"]) == (
        "2026-08-25T14:41:19Z", "203.0.113.9", 5100, "allow")
    assert (plain["src_ip"], plain["action"]) == ("10.0.0.9", "allow")
    for row in rows:
        assert (row["status"], row["parser_confidence"], row["source_format"], row["protocol"],
                row["severity"], row["device_vendor"]) == (
            "normalized", "low", "unknown", "UNKNOWN", "unknown", None)
    assert junk["src_ip"] is None


def test_two_pass_also_fills_the_first_line(raw_of):
    row = outcomes_unknown(raw_of([FIRST, SECOND]), replace(OPTIONS, mode="two_pass")).orderBy(
        "seq").first()
    assert (row["timestamp"], row["src_ip"], row["src_port"], row["action"]) == (
        "2026-08-25T14:40:02Z", "192.168.5.6", 9100, "deny")


@pytest.mark.parametrize("options", [OPTIONS, SEQUENTIAL])
def test_templates_carry_over_to_the_next_run(raw_of, options):
    learned = mine_raw(raw_of([FIRST, SECOND]), options)[0]
    row = outcomes_unknown(raw_of([FIRST]), options, learned_state(learned, options)).first()
    assert (row["src_ip"], row["action"]) == ("192.168.5.6", "deny")
    # A line that differs at one more position, where only 3 of 9 tokens are left alike:
    # one template per leaf takes it in, and a similarity of 0.4 does not.
    third = SECOND.replace("RULE", "POLICY")
    again = outcomes_unknown(raw_of([third]), options, learned_state(learned, options)).first()
    assert again["src_ip"] == ("203.0.113.9" if options is OPTIONS else None)


def random_lines(n, seed=11):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        size = rnd.choice([3, 5])
        body = [rnd.choice(["up", "down", "link", str(i)]) for _ in range(size - 1)]
        rows.append((i, " ".join([rnd.choice(["eth", "eth", "eth", f"p{i}"])] + body)))
    return rows


def running_by_hand(rows):
    leaves, seen = {}, []
    for seq, text in rows:
        parts = text.split()
        lead = WILDCARD if any(c.isdigit() for c in parts[0]) else parts[0]
        template = leaves.setdefault((len(parts), lead), list(parts))
        for p, token in enumerate(parts):
            if template[p] != token:
                template[p] = WILDCARD
        seen.append((seq, " ".join(template)))
    return seen


@pytest.mark.parametrize("small", [True, False])
def test_running_templates(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(templates, "fits_broadcast", lambda df: False)
    rows = random_lines(300)
    df = templates.tokenize_lines(spark.createDataFrame(rows, "seq bigint, raw_text string"))
    state, fits = templates.mine_leaves(df.select("leaf", "seq", "tokens"))
    assert fits is small
    got = templates.attach_by_key(df, state, "leaf", fits).select(
        "seq", templates.line_template().alias("t")).orderBy("seq").collect()
    assert [(r["seq"], r["t"]) for r in got] == running_by_hand(rows)
    assert sum(r["n_lines"] for r in state.collect()) == 300


def sequential_by_hand(rows, similarity):
    leaves, seen = {}, []
    for seq, text in rows:
        parts = text.split()
        lead = WILDCARD if any(c.isdigit() for c in parts[0]) else parts[0]
        known = leaves.setdefault((len(parts), lead), [])
        ranked = [(sum(a == b for a, b in zip(t, parts) if a != WILDCARD), t.count(WILDCARD), -i)
                  for i, t in enumerate(known)]
        best = max(ranked, default=None)
        if best is None or best[0] / len(parts) < similarity:
            known.append(list(parts))
            template = known[-1]
        else:
            template = known[-best[2]]
            template[:] = [a if a == b else WILDCARD for a, b in zip(template, parts)]
        seen.append((seq, " ".join(template)))
    return seen


@pytest.mark.parametrize("chunk, few", [(60, 32), (1000, 32), (60, 1)])
def test_sequential_templates(spark, monkeypatch, chunk, few):
    """Several rounds, or one, through arrays or the index, give what line after line gives."""
    monkeypatch.setattr(similar, "FEW", few)
    rows = random_lines(240)
    df = templates.tokenize_lines(spark.createDataFrame(rows, "seq bigint, raw_text string"))
    mined = sequential.mine_sequential(
        df.select("leaf", "seq", "tokens"), similarity=0.6, chunk_lines=chunk)
    lines = sequential.line_cluster(df, mined, 0.6)
    got = lines.select("seq", sequential.sequential_template(F.col("_cluster")).alias("t")).orderBy(
        "seq").collect()
    expected = sequential_by_hand(rows, 0.6)
    assert [(r["seq"], r["t"]) for r in got] == expected
    n_templates = sequential.cluster_templates(mined).count()
    assert n_templates > 4


def crowded_lines(n, seed=5):
    """Lines of one leaf, nearly each of which starts a template; some join one."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        if rows and rnd.random() < 0.2:
            parts = rnd.choice(rows)[1].split()
            parts[rnd.randrange(1, 8)] = f"w{i}"
        else:
            parts = ["unit"] + [f"w{rnd.randrange(400)}" for _ in range(7)]
        rows.append((i, " ".join(parts)))
    return rows


@pytest.mark.parametrize("similarity", [0.0, 0.5])
def test_thousands_of_templates_in_one_leaf(spark, similarity):
    rows = crowded_lines(4000)
    df = templates.tokenize_lines(spark.createDataFrame(rows, "seq bigint, raw_text string"))
    started = time.time()
    mined = sequential.mine_sequential(df.select("leaf", "seq", "tokens"), similarity)
    got = sequential.line_cluster(df, mined, similarity).select(
        "seq", sequential.sequential_template(F.col("_cluster")).alias("t")).orderBy("seq").collect()
    assert time.time() - started < 90
    assert [(r["seq"], r["t"]) for r in got] == sequential_by_hand(rows, similarity)
    assert mined.count() == (1 if similarity == 0 else len(
        {r["t"] for r in sequential.cluster_templates(mined).select(
            F.concat_ws(" ", F.lit("x"), "template_id").alias("t")).collect()}))
    assert mined.columns == ["leaf", "generation", "place", "born", "tokens", "breaks"]


def test_a_line_meets_candidates_only():
    """The index hands out the templates that can be similar, and far from all."""
    rnd = random.Random(1)
    known = [{"generation": 1, "place": i, "born": i, "breaks": [None] * 8,
              "tokens": ["unit"] + [f"w{rnd.randrange(400)}" for _ in range(7)]} for i in range(3000)]
    index = similar.LeafIndex(known, 0.5)
    for template in known[:50]:
        tokens = list(template["tokens"])
        tokens[3] = "other"
        found = set(index.candidates(tokens))
        alike = {i for i, t in enumerate(known) if sum(a == b for a, b in zip(t["tokens"], tokens)) >= 4}
        assert alike <= found and len(found) < 200


@pytest.mark.parametrize("few", [32, 0])
def test_older_templates_come_first(spark, monkeypatch, few):
    """What an earlier run learned is older than all of the next, through arrays and the index."""
    monkeypatch.setattr(similar, "FEW", few)
    rows = random_lines(240)
    df = templates.tokenize_lines(spark.createDataFrame(rows, "seq bigint, raw_text string"))
    lines = df.select("leaf", "seq", "tokens")
    first = sequential.mine_sequential(lines.filter("seq < 100"), 0.6)
    second = sequential.mine_sequential(
        lines.filter("seq >= 100").withColumn("seq", F.col("seq") - 100), 0.6,
        prior=sequential.cluster_state(first))
    got = sequential.line_cluster(
        df.filter("seq >= 100").withColumn("seq", F.col("seq") - 100), second, 0.6).select(
        "seq", sequential.sequential_template(F.col("_cluster")).alias("t")).orderBy("seq").collect()
    assert [(r["seq"] + 100, r["t"]) for r in got] == sequential_by_hand(rows, 0.6)[100:]


def test_leaves_too_many_to_broadcast(spark, monkeypatch):
    rng = random.Random(6)
    words = ["a", "b", "c1", "d", "ä"]
    lines = [("x" if rng.random() < 0.9 else None, rng.randrange(1 << 40),
              [rng.choice(words) for _ in range(rng.randrange(4))]) for _ in range(600)]
    lines = [(leaf and f"{len(t)} {t[0] if t else ''}", seq, t) for leaf, seq, t in lines]
    # Lines without a place count, but break nothing and make no leaf.
    lines += [("1 a", None, ["z"]), ("9", None, ["y"] * 9), ("2 a", lines[0][1], ["a", "b"])]
    schema = "leaf string, seq bigint, tokens array<string>"
    old, new = spark.createDataFrame(lines[:200], schema), spark.createDataFrame(lines[200:], schema).repartition(5)
    few, _ = templates.mine_leaves(old)
    prior = templates.leaf_state(few).localCheckpoint()
    expected = [templates.mine_leaves(new)[0].collect(), templates.mine_leaves(new, prior)[0].collect()]
    monkeypatch.setattr(templates, "fits_broadcast", lambda df: False)
    shuffled = []
    monkeypatch.setattr(templates, "attach_by_key", lambda *rest: shuffled.append(rest))
    found = [templates.mine_leaves(new)[0].collect(), templates.mine_leaves(new, prior)[0].collect()]
    key = lambda r: r["leaf"]
    for one, other in zip(expected, found):
        assert sorted(one, key=key) == sorted(other, key=key) and len(one) > 10
    # No line is shuffled with its tokens.
    assert not shuffled


def test_descriptions_of_leaves_in_any_pieces(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(templates, "HELD_CHARS", 10)
    rng = random.Random(8)
    lines = [(f"l{rng.randrange(3)}", k, "\x1f".join(rng.choice("pq") for _ in range(4))) for k in range(80)]
    rng.shuffle(lines)

    def batch(rows, names):
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)

    parts = list(templates._describe(batch(lines[k:k + 7], ["leaf", "seq", "line"]) for k in range(0, 80, 7)))
    assert len(parts) > 3
    rows = sorted((tuple(r.values()) for p in parts for r in p.to_pylist()), key=lambda r: r[0])
    table = pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows), templates._DESCRIBED)], schema=templates._DESCRIBED)
    merged = [r for p in templates._merge(iter([table.slice(0, 5), table.slice(5)])) for r in p.to_pylist()]
    assert [r["leaf"] for r in merged] == ["l0", "l1", "l2"]
    for r in merged:
        own = sorted((seq, line.split("\x1f")) for leaf, seq, line in lines if leaf == r["leaf"])
        first = own[0][1]
        breaks = [min((seq for seq, t in own if t[p] != first[p]), default=templates._NEVER) for p in range(4)]
        assert (r["seq"], r["line"].split("\x1f"), r["n_lines"]) == (own[0][0], first, len(own))
        assert r["breaks"] == breaks
