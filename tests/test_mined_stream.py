"""Templates in the state store."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from loglathe.operators import templates
from loglathe.plans.batch import EventStore
from loglathe.sources import tables
from loglathe.streaming import live, mined
from tests.conftest import OPTIONS
from tests.test_formats import CEF, DENY
from tests.test_templates import random_lines, running_by_hand


def test_descriptions_merge_like_lines_in_order():
    rnd = random.Random(2)
    for _ in range(200):
        lines = [(seq, [rnd.choice("ab") for _ in range(4)]) for seq in range(rnd.randrange(1, 9))]
        parts = {}
        for seq, tokens in rnd.sample(lines, len(lines)):
            salt = rnd.randrange(3)
            parts[salt] = mined.describe([(seq, tokens)], parts.get(salt))
        got = None
        for part in parts.values():
            got = mined.merged(got, part)
        first = lines[0][1]
        want = [next((s for s, t in lines if t[p] != first[p]), None) for p in range(4)]
        assert got == {"seq": 0, "tokens": first, "breaks": want}


def _stored(store, raw_of, texts, start):
    """Raw events as the stream's sink would append them."""
    raw = raw_of(texts).withColumn("seq", F.col("seq") + start).withColumn(
        "event_id", F.sha2(F.concat_ws("/", F.col("seq"), F.col("raw_text")), 256))
    tables.write_table(raw.coalesce(1), f"{store.stream_raw_path}/part-{start:06d}")


def test_state_store_equals_batches_and_survives_a_restart(spark, folder, raw_of):
    """Three batches over two starts give what the table-per-batch stream gives."""
    texts = [t for _, t in random_lines(120)] + [DENY, CEF]
    one, two = (EventStore(spark, f"{folder}/{k}") for k in ("one", "two"))
    for k, (a, b) in enumerate(((0, 30), (30, 70), (70, len(texts)))):
        for store in (one, two):
            raw = raw_of(texts[a:b]).withColumn("seq", F.col("seq") + a).withColumn(
                "event_id", F.sha2(F.concat_ws("/", F.col("seq"), F.col("raw_text")), 256))
            raw.coalesce(1).write.mode("append").parquet(store.stream_raw_path)
        if k != 0:
            mined.start_unknown_stream(one, f"{folder}/u", OPTIONS, available_now=True,
                                       max_files=1, salts=3).awaitTermination()
            mined.start_known_stream(one, f"{folder}/k", OPTIONS, available_now=True).awaitTermination()
            live.start_event_stream(two, f"{folder}/e", OPTIONS, available_now=True,
                                    max_files=1).awaitTermination()

    def view(store):
        return sorted(str(tuple(r)) for r in store.outcomes().drop("run").select(
            sorted(set(store.outcomes().columns) - {"run"})).collect())

    assert view(one) == view(two) and len(view(one)) == len(texts)
    leaves = {r["leaf"]: r for r in mined.current(one).collect()}
    by_hand = running_by_hand([(i, t) for i, t in enumerate(texts[:120])])
    last = {}
    for (_, template), text in zip(by_hand, texts):
        last[len(text.split()), text.split()[0] if not any(c.isdigit() for c in text.split()[0]) else "<*>"] = template
    got = {" ".join("<*>" if at is not None else t for t, at in zip(r["first_tokens"], r["break_seq"]))
           for r in leaves.values()}
    assert got == set(last.values())


def test_a_repeated_batch_and_the_size_of_the_log(spark, folder, raw_of):
    store = EventStore(spark, folder)
    schema = mined._out_schema()

    def batch(texts, start, state):
        lines = templates.tokenize_lines(raw_of(texts).withColumn("seq", F.col("seq") + start))
        lines = lines.select(*mined._LINE, "leaf")
        rows = spark.createDataFrame(
            [(None,) * len(mined._LINE) + s for s in state], schema)
        return lines.select("*", *[F.lit(None).cast(schema[c].dataType).alias(c) for c in (
            "first_seq", "first_tokens", "break_seq")]).select(schema.fieldNames()).unionByName(rows)

    first = batch(["link up a", "link down a"], 0, [("3 link", 1, ["link", "up", "a"], [None, 2, None])])
    for _ in range(2):
        mined.process_described(store, OPTIONS, first, 0)
    # Another salt meets a line alike: nothing changes, so nothing is logged.
    mined.process_described(store, OPTIONS, batch(
        ["link up a"], 5, [("3 link", 6, ["link", "up", "a"], [None, None, None])]), 1)
    log = spark.read.parquet(f"{folder}/template_changes")
    assert log.count() == 1 and log.first()["break_seq"] == [None, 2, None]
    mined.process_described(store, OPTIONS, batch(
        ["link up b"], 7, [("3 link", 6, ["link", "up", "a"], [None, None, 8])]), 2)
    assert mined.current(store).first()["break_seq"] == [None, 2, 8]
    assert store.outcomes().count() == 4


def test_backlog_takes_as_many_batches_whatever_its_size(spark, folder):
    from pathlib import Path

    from loglathe.streaming import live

    assert live.backlog_share(spark, f"{folder}/none", 8, least=10) == 10
    size = 0
    for k in range(3):
        Path(folder, f"{k}.txt").write_bytes(b"x" * (10 ** (k + 3) - size))
        size = 10 ** (k + 3)
        assert -(-size // live.backlog_share(spark, folder, 8, least=10)) == 8
