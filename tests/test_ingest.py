"""File scans, the batch job, stored tables, and the audits."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from loglathe.contracts import NORMALIZED_EVENT_COLUMNS
from loglathe.plans import queries
from loglathe.plans.batch import EventStore, ingest_folder, ingest_lines, run_report
from loglathe.sources import files, tables
from tests.conftest import CLOCK, OPTIONS
from tests.test_formats import CEF, DENY

BAD_BODY = "Oct 12 14:32:07 FW01 %ASA-6-999999: a body of no known shape"
JSON = '{"src_ip": "198.51.100.9", "dst_ip": "10.1.1.20", "action": "blocked", "severity": "high"}'


def write(folder, name, content):
    with open(f"{folder}/{name}", "wb") as f:
        f.write(content if isinstance(content, bytes) else content.encode())


def scanned(df):
    return [(r["source_name"], r["line_no"], r["seq"], r["raw_text"])
            for r in df.orderBy("seq").collect()]


def test_scan_keeps_order_and_drops_blanks(spark, folder):
    write(folder, "b.log", "second\n\n  padded\t\n\u00a0\u2003\nlast without end")
    write(folder, "a.log", b"first\r\nbad \xff byte\n")
    write(folder, "c.txt", "not a log\n")
    assert scanned(files.scan_logs(spark, folder)) == [
        ("a.log", 1, 1, "first"), ("a.log", 2, 2, "bad \ufffd byte"),
        ("b.log", 1, 3, "second"), ("b.log", 2, 4, "padded"), ("b.log", 3, 5, "last without end")]


def test_scan_of_nothing_is_empty(spark, folder):
    assert files.scan_logs(spark, folder).count() == 0
    assert files.scan_logs(spark, f"{folder}/none").count() == 0


def test_one_file(spark, folder):
    write(folder, "x.log", "a\nb\n")
    assert [r["raw_text"] for r in files.read_log_file(spark, f"{folder}/x.log").orderBy(
        "seq").collect()] == ["a", "b"]
    with pytest.raises(OSError):
        files.read_log_file(spark, f"{folder}/missing.log")


def test_line_numbers_over_many_splits(spark, folder):
    write(folder, "big.log", "".join(f"line {i}\n\n" for i in range(20000)))
    write(folder, "small.log", "one\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        lines = files.scan_logs(spark, folder)
        assert lines.rdd.getNumPartitions() > 5
        rows = scanned(lines)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert rows[:-1] == [("big.log", i + 1, i + 1, f"line {i}") for i in range(20000)]
    assert rows[-1] == ("small.log", 1, 20001, "one")


@pytest.fixture
def store(spark, folder):
    write(folder, "fw.log", f"{DENY}\n{BAD_BODY}\n")
    write(folder, "mixed.log", f"{JSON}\n{CEF}\nconnection from 10.0.0.5 was blocked\n")
    store = EventStore(spark, f"{folder}/store")
    ingest_folder(store, folder, options=OPTIONS, run="one", ingested_at=CLOCK)
    return store


def test_nothing_is_lost_and_everything_is_traceable(store):
    assert store.raw().count() == 5
    events = store.events()
    assert events.columns == NORMALIZED_EVENT_COLUMNS
    linked = {r["raw_text"]: r["source_format"] for r in events.join(
        store.raw(), F.col("raw_event_id") == F.col("event_id")).collect()}
    assert linked == {DENY: "syslog", JSON: "json", CEF: "cef",
                      "connection from 10.0.0.5 was blocked": "unknown"}
    bad = store.quarantine().collect()
    assert [(r["detected_format"], r["status"], r["error_reason"]) for r in bad] == [
        ("syslog", "parse_error", "body")]
    audit = queries.traceability_audit(store.raw(), store.outcomes()).first().asDict()
    assert audit == {"n_raw": 5, "n_normalized": 4, "n_quarantined": 1, "n_lost": 0,
                     "n_orphans": 0, "n_wrong_format": 0}
    left = queries.raw_without_event(store.raw(), events).collect()
    assert [r["raw_text"] for r in left] == [BAD_BODY]
    summary, totals = run_report(store)
    assert [tuple(r) for r in summary.collect()] == [
        ("cef", "normalized", 1), ("json", "normalized", 1), ("syslog", "normalized", 1),
        ("syslog", "parse_error", 1), ("unknown", "normalized", 1)]
    assert tuple(totals.first()) == (5, 4, 1)


def test_audit_sees_orphans_and_losses(store):
    lost = queries.traceability_audit(
        store.raw(), store.outcomes().filter("source_format <> 'cef'")).first()
    assert lost["n_lost"] == 1
    orphan = queries.traceability_audit(
        store.raw().filter(F.col("raw_text") != JSON), store.outcomes()).first()
    assert orphan["n_orphans"] == 1
    event = store.events().filter("source_format = 'json'").first()
    detail = queries.event_detail(
        store.events(), store.raw().filter(F.col("raw_text") != JSON),
        event["normalized_id"]).first()
    assert detail["src_ip"] == "198.51.100.9" and detail["raw_text"] is None


def test_vocabulary_audit(store):
    assert set(queries.vocabulary_audit(store.events()).first()) == {0}
    odd = store.events().withColumn("action", F.lit("open")).withColumn(
        "severity", F.lit(None).cast("string"))
    found = queries.vocabulary_audit(odd).first().asDict()
    assert (found["n_bad_action"], found["n_bad_severity"], found["n_bad_protocol"]) == (4, 4, 0)


def test_reads_by_id_and_text(store):
    raw = store.raw().filter(F.col("raw_text") == BAD_BODY).first()
    assert queries.raw_by_id(store.raw(), raw["event_id"]).first()["raw_text"] == BAD_BODY
    assert queries.raw_by_id(store.raw(), "absent").count() == 0
    assert queries.raw_by_text(store.raw(), DENY).count() == 1
    event = store.events().filter("source_format = 'cef'").first()
    assert queries.linked_raw_of(
        store.events(), store.raw(), event["normalized_id"]).first()["raw_text"] == CEF
    assert queries.linked_raw_of(store.events(), store.raw(), "absent").count() == 0


def test_filters_and_empty_states(spark, store):
    events = store.events()

    def count(*picked):
        return queries.filter_events(events, **queries.widget_filters(*picked)).count()

    assert count() == 4
    assert count("json") == 1
    assert count("All", "deny") == 3
    assert count("All", "All", " 10.1.1.20 ") == 2
    assert count("cef", "allow") == 0
    none = queries.filter_events(events, action="drop")
    assert queries.empty_state(events, none) == "no_match"
    assert queries.empty_state(events, events) is None
    empty = EventStore(spark, f"{store.root}/unused").events()
    assert queries.empty_state(empty, empty) == "nothing_ingested"


def test_a_repeated_run_replaces_itself_and_another_appends(spark, folder, store):
    write(folder, "fw.log", f"{DENY}\n{BAD_BODY}\n")
    ingest_folder(store, folder, options=OPTIONS, run="one", ingested_at=CLOCK)
    assert (store.raw().count(), store.outcomes().count()) == (5, 5)
    assert tables.duplicate_ids(store.events(), "normalized_id").count() == 0
    ingest_folder(store, folder, options=OPTIONS, run="two", ingested_at=CLOCK)
    assert store.raw().count() == 10
    assert tables.duplicate_ids(store.events(), "normalized_id").count() == 0
    assert queries.linked_raw(store.events(), store.raw()).count() == 8
    audit = queries.traceability_audit(store.raw(), store.outcomes()).first().asDict()
    assert audit == {"n_raw": 10, "n_normalized": 8, "n_quarantined": 2, "n_lost": 0,
                     "n_orphans": 0, "n_wrong_format": 0}
    ingest_folder(store, folder, options=OPTIONS, run="three", dedup=True, ingested_at=CLOCK)
    assert store.raw().count() == 10


def test_same_named_files_of_two_folders_are_different_lines(spark, folder):
    import tempfile
    other = tempfile.mkdtemp(prefix="loglathe-test-", dir="/tmp")
    for place in (folder, other):
        write(place, "fw.log", f"{DENY}\n")
    store = EventStore(spark, f"{folder}/store")
    ingest_folder(store, folder, options=OPTIONS, run="one", dedup=True, ingested_at=CLOCK)
    ingest_folder(store, other, options=OPTIONS, run="two", dedup=True, ingested_at=CLOCK)
    ingest_folder(store, other, options=OPTIONS, run="three", dedup=True, ingested_at=CLOCK)
    assert store.raw().count() == 2


def test_a_scan_loses_nothing_when_splits_change_before_it_runs(spark, folder):
    write(folder, "big.log", "".join(f"line {i}\n" for i in range(20000)))
    settings = ("spark.sql.files.maxPartitionBytes", "spark.sql.leafNodeDefaultParallelism")
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        spark.conf.set(settings[0], "20000")
        spark.conf.set(settings[1], "4")
        lines = files.scan_logs(spark, folder)
        spark.conf.set(settings[0], "70000")
        spark.conf.set(settings[1], "2")
        rows = scanned(lines)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert rows == [("big.log", i + 1, i + 1, f"line {i}") for i in range(20000)]


@pytest.mark.parametrize("mode", ["running", "sequential"])
def test_templates_of_an_unknown_run_or_mode_are_an_error(spark, folder, mode):
    from dataclasses import replace
    options = replace(OPTIONS, mode=mode)
    store = EventStore(spark, f"{folder}/store-{mode}")
    lines = spark.createDataFrame(
        [("s", 1, 1, "link from 10.0.0.5 was blocked")],
        "source_name string, line_no bigint, seq bigint, raw_text string")
    with pytest.raises(ValueError):
        ingest_lines(store, lines, options, run="a", prior_run="no-such-run")
    ingest_lines(store, lines, options, run="b")
    other = replace(options, mode="two_pass" if mode == "running" else "running")
    with pytest.raises(ValueError):
        ingest_lines(store, lines, other, run="c", prior_run="b")
    with pytest.raises(ValueError):
        ingest_lines(store, lines, replace(options, depth=options.depth + 1), run="d", prior_run="b")


@pytest.mark.parametrize("mode", ["running", "sequential"])
def test_templates_learned_by_an_earlier_run(spark, folder, raw_of, mode):
    from dataclasses import replace
    options = replace(OPTIONS, mode=mode)
    store = EventStore(spark, f"{folder}/{mode}")

    def lines(*texts):
        rows = [("s", i, i, t) for i, t in enumerate(texts)]
        return spark.createDataFrame(
            rows, "source_name string, line_no bigint, seq bigint, raw_text string")

    ingest_lines(store, lines("link from 10.0.0.5 was blocked", "link from 10.0.0.6 was allowed"),
                 options, run="a")
    ingest_lines(store, lines("link from 10.0.0.7 was dropped"), options, run="b", prior_run="a")
    row = store.outcomes("b").first()
    assert (row["src_ip"], row["action"]) == ("10.0.0.7", "drop")


def test_lines_per_source(spark, folder):
    write(folder, "a.log", "1\n2\n")
    write(folder, "b.log", "3\n")
    rows = queries.lines_per_source(files.scan_logs(spark, folder)).collect()
    assert [(r["source_name"], r["n_lines"]) for r in rows] == [("a.log", 2), ("b.log", 1), (None, 3)]
