"""The tail source and the two streaming queries."""

from __future__ import annotations

import io
import os
import time

import pytest
from pyspark.sql import functions as F

from loglathe.contracts import LINES_SCHEMA
from loglathe.plans.batch import EventStore, ingest_folder
from loglathe.sources import tail
from loglathe.sources.tail import TailReader, last_line_end, lines_in_range
from loglathe.streaming import live
from tests.conftest import CLOCK, OPTIONS
from tests.test_formats import CEF, DENY
from tests.test_ingest import BAD_BODY, JSON


def write(folder, name, text, mode="w"):
    with open(f"{folder}/{name}", mode, encoding="utf-8") as f:
        f.write(text)


def polled(reader, start):
    """One poll: the texts that arrived since ``start``, and the new offset."""
    end = reader.latestOffset()
    texts = []
    for part in reader.partitions(start, end):
        for batch in reader.read(part):
            texts += batch.column("raw_text").to_pylist()
    return texts, end


def test_ranges_cover_every_line_once():
    data = b"one\n\n  two \r\nthree\rfour\nrest"
    whole = list(lines_in_range(io.BytesIO(data), 0, len(data)))
    assert [t for _, t in whole] == ["one", "two", "three", "four"]
    for cut in range(1, len(data)):
        parts = list(lines_in_range(io.BytesIO(data), 0, cut)) + list(
            lines_in_range(io.BytesIO(data), cut, len(data)))
        assert parts == whole
    assert last_line_end(io.BytesIO(data), len(data)) == data.rindex(b"\n") + 1
    assert last_line_end(io.BytesIO(b"none"), 4) == 0


def test_only_new_complete_lines(folder, caplog):
    write(folder, "a.log", "old 1\nold 2\n")
    write(folder, "skip.txt", "other\n")
    reader = TailReader({"path": folder})
    offset = reader.initialOffset()
    assert polled(reader, offset)[0] == []
    write(folder, "a.log", "new 1\n\n  new 2  \nhalf", "a")
    write(folder, "b.log", "fresh\n")
    texts, offset = polled(reader, offset)
    assert texts == ["new 1", "new 2", "fresh"]
    write(folder, "a.log", " line\n", "a")
    texts, offset = polled(reader, offset)
    assert texts == ["half line"]
    # Shrunk: nothing until it is longer than before.
    write(folder, "a.log", "tiny\n")
    assert polled(reader, offset) == ([], offset)
    assert polled(reader, offset) == ([], offset)
    assert [r.getMessage().split(" ")[:2] for r in caplog.records] == [["a.log", "shrank"]]
    write(folder, "a.log", "tiny\n" + "x" * 60 + "\nbehind\n")
    assert "behind" in polled(reader, offset)[0]


def test_earliest_and_missing_folder(folder):
    write(folder, "a.log", "one\n")
    reader = TailReader({"path": folder, "startingoffsets": "earliest"})
    assert polled(reader, reader.initialOffset())[0] == ["one"]
    nothing = TailReader({"path": f"{folder}/none"})
    assert nothing.latestOffset() == {"files": {}}
    with pytest.raises(ValueError):
        TailReader({"path": folder, "startingoffsets": "sometime"})


def test_long_files_are_split(folder):
    write(folder, "a.log", "".join(f"line {i}\n" for i in range(1000)))
    reader = TailReader({"path": folder, "startingoffsets": "earliest", "chunkbytes": "500"})
    end = reader.latestOffset()
    parts = reader.partitions({"files": {}}, end)
    assert len(parts) > 10
    rows = [row for part in parts for batch in reader.read(part) for row in batch.to_pylist()]
    assert [r["raw_text"] for r in rows] == [f"line {i}" for i in range(1000)]
    positions = [r["seq"] for r in rows]
    assert positions == sorted(set(positions))


def test_restart_goes_on_where_it_stopped(spark, folder):
    logs, out, checkpoint = f"{folder}", f"{folder}/out", f"{folder}/cp"
    write(logs, "a.log", "1\n2\n")

    def run():
        stream = (live.tail_lines(spark, logs, "earliest").writeStream.format("parquet")
                  .option("path", out).option("checkpointLocation", checkpoint)
                  .trigger(processingTime="0 seconds").start())
        stream.processAllAvailable()
        stream.stop()
        return sorted(r["raw_text"] for r in spark.read.schema(LINES_SCHEMA).parquet(out).collect())

    assert run() == ["1", "2"]
    write(logs, "a.log", "3\n", "a")
    assert run() == ["1", "2", "3"]


def test_stream_equals_batch(spark, folder):
    first = [DENY, JSON, "link from 10.0.0.5 was blocked"]
    second = [CEF, BAD_BODY, "link from 10.0.0.6 was allowed", "link from 10.0.0.7 was dropped"]
    write(folder, "a.log", "\n".join(first) + "\n")
    live_store = EventStore(spark, f"{folder}/live")
    raw = live.start_raw_stream(live.tail_lines(spark, folder, "earliest"), live_store,
                                f"{folder}/cp1", "0 seconds", ingested_at=CLOCK)
    try:
        raw.processAllAvailable()
        live.start_event_stream(
            live_store, f"{folder}/cp2", OPTIONS, available_now=True).awaitTermination()
        assert live_store.outcomes().count() == 3
        write(folder, "a.log", "\n".join(second) + "\n", "a")
        raw.processAllAvailable()
        live.start_event_stream(
            live_store, f"{folder}/cp2", OPTIONS, available_now=True).awaitTermination()
    finally:
        raw.stop()
    batch_store = EventStore(spark, f"{folder}/batch")
    ingest_folder(batch_store, folder, options=OPTIONS, ingested_at=CLOCK)

    def view(store):
        texts = store.raw().select(F.col("event_id").alias("raw_event_id"), "raw_text")
        rows = store.outcomes().join(texts, "raw_event_id").drop(
            "raw_event_id", "normalized_id", "seq", "run")
        return sorted(str(sorted(r.asDict().items(), key=str)) for r in rows.collect())

    assert view(live_store) == view(batch_store)
    assert len(view(live_store)) == 7


def test_a_repeated_batch_replaces_itself(spark, folder, raw_of):
    store = EventStore(spark, f"{folder}/s")
    raw = raw_of([DENY, "link from 10.0.0.5 was blocked"])
    for _ in range(2):
        live.process_batch(store, OPTIONS, raw, 0)
    live.process_batch(store, OPTIONS, raw_of(["link from 10.0.0.9 was allowed"]), 1)
    assert store.outcomes().count() == 3
    assert store.events().filter("action = 'allow'").first()["src_ip"] == "10.0.0.9"


def drained(reader, start):
    """Polls until nothing is left: the texts of each, and the last offset."""
    batches = []
    while True:
        texts, end = polled(reader, start)
        if end == start:
            return batches, end
        batches.append(texts)
        start = end


def bounded(folder, budget="100", **options):
    return TailReader({"path": folder, "startingoffsets": "earliest", "maxbytespertrigger": budget,
                       "statepath": f"{folder}/state", **options})


def test_a_backlog_comes_in_bounded_batches(folder):
    for k in range(7):
        write(folder, f"f{k}.log", "".join(f"{k}/{i}\n" for i in range(60)))
    write(folder, "f3.log", "y" * 350 + "\nlast\nhalf", "a")
    reader = bounded(folder)
    start = reader.initialOffset()
    end, seen, arrivals = start, [], []
    while True:
        end = reader.latestOffset()
        if end == start:
            break
        parts = reader.partitions(start, end)
        assert sum(p.stop - p.start for p in parts) <= 100
        for part in parts:
            for batch in reader.read(part):
                seen += batch.column("raw_text").to_pylist()
                arrivals += batch.column("seq").to_pylist()
        start = end
        # A new file does not wait for the whole backlog of others, nor they for it.
        if len(seen) >= 40 and not os.path.exists(f"{folder}/f9.log"):
            write(folder, "f9.log", "late\n")
    want = [f"{k}/{i}" for k in range(7) for i in range(60)] + ["y" * 350, "last", "late"]
    assert sorted(seen) == sorted(want)
    assert arrivals == sorted(set(arrivals))
    write(folder, "f3.log", " line\n", "a")
    assert drained(reader, start)[0] == [["half line"]]


def test_offsets_hold_changes_only_and_survive_restarts(folder, monkeypatch):
    monkeypatch.setattr(tail, "_SNAPSHOT_AFTER", 20)
    for k in range(300):
        write(folder, f"f{k:03d}.log", f"old {k}\n")
    reader = bounded(folder, budget="90")
    start = reader.initialOffset()
    seen = []
    for turn in range(100):
        if turn % 3 == 2:
            # A restart: Spark may ask for the next offset first, or plan the last batch again.
            reader = bounded(folder, budget="90")
            if turn % 2:
                reader.partitions(start, start)
        texts, end = polled(reader, start)
        reader.commit(end)
        assert len(end["changed"]) <= 40
        if end == start:
            break
        seen += texts
        start = end
    assert sorted(seen) == sorted(f"old {k}" for k in range(300))
    assert start["snapshot"] > 5
    assert len([f for f in os.listdir(f"{folder}/state") if f.startswith("snapshot")]) <= 6
    with pytest.raises(ValueError):
        TailReader({"path": folder, "maxbytespertrigger": "5"})


def test_driver_opens_no_file(folder, monkeypatch):
    """Ten thousand files: a poll is one listing, whatever the files hold."""
    for k in range(10_000):
        write(folder, f"f{k:05d}.log", f"line {k}\n")
    reader = bounded(folder, budget="50000")

    def refuse(*args, **kwargs):
        raise AssertionError("opened a log file")

    monkeypatch.setattr(tail, "last_line_end", refuse)
    start = reader.initialOffset()
    end = reader.latestOffset()
    assert sum(p.stop - p.start for p in reader.partitions(start, end)) == 50_000
    assert reader.latestOffset()["arrived"] == sum(len(f"line {k}\n") for k in range(10_000))


def test_rotation_shows_in_the_progress(spark, folder):
    logs = f"{folder}/logs"
    os.mkdir(logs)
    write(logs, "a.log", "one\ntwo\nthree\n")
    listener = live.RotationListener("tailed")
    spark.streams.addListener(listener)
    stream = (live.tail_lines(spark, logs, "earliest", observed="tailed", state_path=f"{folder}/state")
              .writeStream.format("parquet").option("path", f"{folder}/out")
              .option("checkpointLocation", f"{folder}/cp").trigger(processingTime="0 seconds").start())
    try:
        stream.processAllAvailable()
        write(logs, "a.log", "new\n")
        write(logs, "b.log", "four\n")
        stream.processAllAvailable()
        metrics = [dict(p.observedMetrics["tailed"].asDict()) for p in stream.recentProgress
                   if "tailed" in p.observedMetrics]
        assert sum(m["lines"] for m in metrics) == 4
        assert sum(m["shrunk_files"] for m in metrics) == 1
        assert sum(m["held_back_bytes"] for m in metrics) == 4
        deadline = time.time() + 20
        while listener.totals["shrunk_files"] < 1 and time.time() < deadline:
            time.sleep(0.2)
        assert listener.totals == {"lines": 4, "shrunk_files": 1, "held_back_bytes": 4}
    finally:
        stream.stop()
        spark.streams.removeListener(listener)
    assert sorted(r["raw_text"] for r in spark.read.schema(LINES_SCHEMA).parquet(
        f"{folder}/out").collect()) == ["four", "one", "three", "two"]
