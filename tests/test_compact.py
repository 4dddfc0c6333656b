"""Compaction, paging, and what the write refuses."""

from __future__ import annotations

import os
import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from loglathe.operators.normalize import outcomes
from loglathe.plans import audit, compact, queries
from loglathe.plans.batch import EventStore
from loglathe.sources import tables
from tests.conftest import OPTIONS
from tests.test_formats import CEF, DENY
from tests.test_ingest import BAD_BODY, JSON


def batches(spark, folder, raw_of, n=6):
    """A store with ``n`` batch folders over three days, as a stream leaves them."""
    store = EventStore(spark, folder)
    for k in range(n):
        options = replace(OPTIONS, normalized_at=f"2026-03-0{k % 3 + 1}T0{k}:00:00Z")
        raw = raw_of([DENY, JSON, CEF, BAD_BODY, f"link from 10.0.0.{k} was blocked"], source=f"s{k}")
        tables.write_outcomes(outcomes(raw, options), store.outcome_path, f"b{k:012d}")
    return store


def view(store):
    return sorted(str(r) for r in store.outcomes().select(
        "run", "raw_event_id", "status", "source_format", "normalized_at", "src_ip", "error_reason").collect())


def test_reads_agree_before_during_and_after(spark, folder, raw_of):
    store = batches(spark, folder, raw_of)
    before = view(store)
    assert len(before) == 30 and compact.closed_runs(store) == [f"b{k:012d}" for k in range(4)]
    # A job that dies once the generation is written, before it is published.
    compact.write_generation(store, compact.closed_runs(store)[:3], "g000000")
    assert view(store) == before
    assert compact.compact(store) == "g000000"
    # Swapped, with the replaced folders still there.
    assert view(store) == before
    assert len(tables.run_names(spark, store.outcome_path)) == 6
    assert compact.drop_replaced(store) == 4 and view(store) == before
    assert compact.drop_replaced(store) == 0
    one = store.outcomes("b000000000001")
    assert one.count() == 5 and store.outcomes("b000000000005").count() == 5
    # Later batches, and the next generation.
    options = replace(OPTIONS, normalized_at="2026-03-04T09:00:00Z")
    for k in (6, 7):
        tables.write_outcomes(outcomes(raw_of([DENY], source=f"s{k}"), options), store.outcome_path, f"b{k:012d}")
    after = view(store)
    assert compact.compact(store) == "g000001" and view(store) == after
    compact.drop_replaced(store)
    assert view(store) == after and len(after) == 32
    assert tables.run_names(spark, store.outcome_path) == ["b000000000006", "b000000000007"]
    assert compact.compact(store) is None
    # One file per day, status and format.
    files = store.spark.read.parquet(tables.generation_path(store.outcome_path, "g000000")).inputFiles()
    assert len(files) <= 3 * 5
    assert queries.traceability_audit(
        store.raw(), store.outcomes()).first()["n_normalized"] == sum("status='normalized'" in r for r in after)


@pytest.mark.parametrize("size", [1, 4, 7, 100])
def test_pages_are_the_whole_list_in_pieces(spark, folder, raw_of, size):
    store = batches(spark, folder, raw_of)
    compact.compact(store)
    whole = [tuple(r) for r in queries.newest_first(store.events()).collect()]
    got, key = [], None
    for _ in range(3 if size < 100 else 1):
        rows = compact.page(store, size, key).collect()
        got += [tuple(r) for r in rows]
        if not rows:
            break
        key = rows[-1]["normalized_at"], rows[-1]["normalized_id"]
    assert got == whole[:len(got)] and len(got) == min(len(whole), 3 * size if size < 100 else size)


def test_a_page_reads_the_days_it_needs(spark, folder, raw_of):
    store = batches(spark, folder, raw_of, 9)
    compact.compact(store, keep=0)
    compact.drop_replaced(store)
    plan = compact.page(store, 5)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    assert re.search(r"PartitionFilters: \[[^\]]*day#\d+ = 2026-03-03", plan)
    two = compact.page(store, 13)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*day#\d+ IN \(2026-03-03,2026-03-02\)", two)
    assert compact.page(store, 5, ("2026-02-28T00:00:00Z", "")).count() == 0
    assert compact.page(EventStore(spark, f"{folder}/none"), 5).count() == 0


@pytest.mark.parametrize("column, value, message", [
    ("action", "open", "action takes no such word: open"),
    ("severity", None, "severity takes no such word: null"),
    ("timestamp", None, "timestamp must not be null"),
    ("raw_event_id", None, "raw_event_id must not be null"),
    ("status", "lost", "status takes no such word: lost"),
])
def test_the_write_refuses_what_the_contract_forbids(spark, folder, raw_of, column, value, message):
    store = EventStore(spark, folder)
    good = outcomes(raw_of([DENY, BAD_BODY, JSON]), OPTIONS)
    tables.write_outcomes(good, store.outcome_path, "one")
    bad = good.withColumn(column, F.when(F.col("source_format") == "json", F.lit(value)).otherwise(F.col(column)))
    for run in ("one", "two"):
        with pytest.raises(Exception, match=message):
            tables.write_outcomes(bad, store.outcome_path, run)
    assert os.listdir(store.outcome_path) == ["run=one"]
    assert store.outcomes().count() == 3


def test_the_write_refuses_repeated_ids(spark, folder, raw_of):
    store = EventStore(spark, folder)
    good = outcomes(raw_of([DENY, JSON]), OPTIONS)
    with pytest.raises(tables.DuplicateKey):
        tables.write_outcomes(good.union(good.limit(1)), store.outcome_path, "one")
    assert not os.path.exists(store.outcome_path) or os.listdir(store.outcome_path) == []
    tables.write_outcomes(good, store.outcome_path, "one", against=store.outcomes())
    with pytest.raises(tables.DuplicateKey):
        tables.write_outcomes(good, store.outcome_path, "two", against=store.outcomes())
    assert store.outcomes().count() == 2
    # The same run again replaces itself.
    tables.write_outcomes(good, store.outcome_path, "one")
    assert store.outcomes().count() == 2


def test_the_audit_scans_changed_runs_only(spark, folder, raw_of, monkeypatch):
    store = EventStore(spark, folder)
    for run, texts in (("one", [DENY, JSON, BAD_BODY]), ("two", [CEF, "link up"])):
        raw = raw_of(texts, source=run)
        tables.write_raw(raw, store.raw_path, run)
        tables.write_outcomes(outcomes(raw, OPTIONS), store.outcome_path, run)
    scanned = []
    whole = queries.traceability_audit

    def counted(raw, outcome):
        scanned.append(1)
        return whole(raw, outcome)

    monkeypatch.setattr(queries, "traceability_audit", counted)
    expected = tuple(whole(store.raw(), store.outcomes()).first())
    assert tuple(audit.incremental(store).first()) == expected and len(scanned) == 2
    assert tuple(audit.incremental(store).first()) == expected and len(scanned) == 2
    # A run that lost an outcome, and one whose outcomes have no raw rows.
    raw = store.raw("one")
    tables.write_outcomes(outcomes(raw.filter(F.col("raw_text") != JSON), OPTIONS), store.outcome_path, "one")
    tables.write_outcomes(outcomes(raw_of([CEF], source="z"), OPTIONS), store.outcome_path, "three")
    row = audit.incremental(store).first()
    assert len(scanned) == 4 and (row["n_lost"], row["n_orphans"]) == (1, 1)
    assert tuple(row) == tuple(whole(store.raw(), store.outcomes()).first())
    # Compaction moves outcomes without changing them.
    compact.compact(store)
    compact.drop_replaced(store)
    assert tuple(audit.incremental(store).first()) == tuple(row)
