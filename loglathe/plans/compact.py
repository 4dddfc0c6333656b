"""Compaction of the folders that micro-batches leave behind.

A stream writes a folder per batch. ``compact`` rewrites the closed ones into one *generation*:
few files per day of processing, status and format. The steps are such that a reader sees every
event once at any time, and a job that dies anywhere is repeated safely:

1. the generation is written to a folder that no reader looks at yet;
2. one small file, the manifest, names it and the runs it replaces. From here on readers take the
   generation and leave those runs out;
3. ``drop_replaced`` deletes the folders of replaced runs, at a later time, so that queries planned
   before the swap still find their files.

The manifest also counts events per day, which lets ``page`` read no more days than a page needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglathe.contracts import NORMALIZED_EVENT_COLUMNS, STATUS_NORMALIZED
from loglathe.plans import queries
from loglathe.plans.batch import EventStore
from loglathe.sources import folders, tables

# A repeated batch rewrites its folder, so the newest batches of a stream stay as they are.
KEEP = 2
FILE_ROWS = 5_000_000


def closed_runs(store: EventStore, keep: int = KEEP) -> list[str]:
    """Batches of streams (letter and number) but the newest of each, and all batch runs."""
    streams: dict[str, list[str]] = {}
    runs = []
    for run in tables.run_names(store.spark, store.outcome_path):
        if len(run) == 13 and run[1:].isdigit():
            streams.setdefault(run[0], []).append(run)
        else:
            runs.append(run)
    gone = tables.replaced_runs(store.spark, store.outcome_path)
    runs += [run for batches in streams.values() for run in sorted(batches)[:len(batches) - keep]]
    return sorted(set(runs) - gone)


def write_generation(store: EventStore, runs: list[str], generation: str) -> dict:
    """Write one generation, unseen yet; returns its manifest."""
    source = tables.read_runs(store.spark, store.outcome_path, runs)
    target = tables.generation_path(store.outcome_path, generation)
    rows = source.withColumn("day", F.coalesce(F.substring("normalized_at", 1, 10), F.lit("none")))
    keys = ["day", "status", "source_format"]
    # A day may hold most rows: rebalancing splits it by size instead of sending it to one task.
    rows.hint("rebalance", *[F.col(k) for k in keys]).write.mode("overwrite").option(
        "maxRecordsPerFile", FILE_ROWS).partitionBy(*keys).parquet(target)
    written = store.spark.read.parquet(target)
    days = written.filter(F.col("status") == STATUS_NORMALIZED).groupBy("day").count()
    return {"generation": generation, "replaces": runs,
            "days": {str(r["day"]): r["count"] for r in days.collect()}}


def compact(store: EventStore, keep: int = KEEP) -> str | None:
    """Rewrite all closed runs into a generation; its name, or None if there are fewer than two."""
    runs = closed_runs(store, keep)
    if len(runs) < 2:
        return None
    # The name follows from what is there, so a repeated job overwrites its own leftovers.
    generation = f"g{len(tables.manifests(store.spark, store.outcome_path)):06d}"
    manifest = write_generation(store, runs, generation)
    tables.publish(store.spark, store.outcome_path, manifest)
    return generation


def drop_replaced(store: EventStore, keep_templates: int = KEEP) -> int:
    """Delete folders that no reader needs: replaced runs, and template states of older batches."""
    gone = tables.replaced_runs(store.spark, store.outcome_path)
    there = [run for run in tables.run_names(store.spark, store.outcome_path) if run in gone]
    for run in there:
        folders.delete(store.spark, f"{store.outcome_path}/run={run}")
    states = [run for run in tables.run_names(store.spark, store.template_path)
              if len(run) == 13 and run[0] == "b" and run[1:].isdigit()]
    for run in sorted(states)[:-keep_templates]:
        folders.delete(store.spark, f"{store.template_path}/run={run}")
    return len(there)


def page(store: EventStore, size: int, before: tuple[str, str] | None = None) -> DataFrame:
    """Events, newest first, that follow the key ``(normalized_at, normalized_id)`` of the last one seen.

    Only the days that the page can reach are read, by the counts in the manifests, and the best
    ``size`` rows are kept per task; nothing is sorted as a whole.
    """
    found = tables.manifests(store.spark, store.outcome_path)
    counts: dict[str, int] = {}
    for manifest in found:
        for day, n in manifest["days"].items():
            counts[day] = counts.get(day, 0) + n
    last_day = before[0][:10] if before else None
    days, have = [], 0
    for day in sorted((d for d in counts if last_day is None or d <= last_day), reverse=True):
        days.append(day)
        # Of the cursor's own day an unknown part is left.
        have += 0 if day == last_day else counts[day]
        if have >= size:
            break
    parts = tables.fresh_outcomes(store.spark, store.outcome_path)
    if found:
        compacted = tables.compacted_outcomes(store.spark, store.outcome_path)
        parts = parts.unionByName(compacted.filter(F.col("day").isin(days)).drop("day"))
    rows = parts.filter(F.col("status") == STATUS_NORMALIZED).select(NORMALIZED_EVENT_COLUMNS)
    if before:
        at, last = before
        rows = rows.filter((F.col("normalized_at") < at) | (
            (F.col("normalized_at") == at) & (F.col("normalized_id") > last)))
    return queries.newest_first(rows).limit(size)
