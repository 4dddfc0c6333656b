"""The traceability audit, run by run, over what has changed since the last one.

Event ids name their run, so a raw row and its outcome belong to the same run, and the audit of a
store is the sum of the audits of its runs. Each run's counts are kept beside the store together with
a digest of the files they were counted from; a run whose files are the same is not read again. Streams
count as one run, since their batches share the raw table; so do the runs of a compacted generation as long as
some run in it is new.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame

from loglathe.plans import queries
from loglathe.plans.batch import EventStore
from loglathe.sources import folders, tables

COUNTS = ["n_raw", "n_normalized", "n_quarantined", "n_lost", "n_orphans", "n_wrong_format"]
_STREAM = "stream"


def _is_stream(run: str) -> bool:
    return len(run) == 13 and run[0] in "buk" and run[1:].isdigit()


def _units(store: EventStore) -> dict[str, list[str]]:
    """What is audited together: a batch run by itself, all batches of streams at once."""
    spark = store.spark
    runs = {*tables.run_names(spark, store.raw_path), *tables.run_names(spark, store.outcome_path),
            *tables.replaced_runs(spark, store.outcome_path)}
    units = {run: [run] for run in runs if not _is_stream(run)}
    streamed = sorted(run for run in runs if _is_stream(run))
    if streamed or folders.exists(spark, store.stream_raw_path):
        units[_STREAM] = streamed
    return units


def _digest(store: EventStore, unit: str, runs: list[str], generations: dict[str, str]) -> str:
    """Of the files that hold a unit's rows."""
    spark = store.spark
    if unit == _STREAM:
        paths = [store.stream_raw_path]
    else:
        paths = [f"{store.raw_path}/run={unit}"]
    for run in runs:
        paths.append(generations.get(run) or f"{store.outcome_path}/run={run}")
    seen = [folders.contents(spark, path) for path in dict.fromkeys(paths)]
    return hashlib.sha256(json.dumps(seen).encode()).hexdigest()


def _rows(store: EventStore, unit: str, runs: list[str]) -> tuple[DataFrame, DataFrame]:
    if unit != _STREAM:
        return store.raw(unit), store.outcomes(unit)
    outcome = store.outcomes()
    raw = tables.read_raw(store.spark, f"{store.raw_path}/run=none", None, store.stream_raw_path)
    return raw, outcome.filter(outcome["run"].isin(runs))


def incremental(store: EventStore) -> DataFrame:
    """The row of ``traceability_audit`` for the whole store; unchanged runs are not read."""
    spark = store.spark
    generations = {run: tables.generation_path(store.outcome_path, m["generation"])
                   for m in tables.manifests(spark, store.outcome_path) for run in m["replaces"]}
    total = dict.fromkeys(COUNTS, 0)
    for unit, runs in sorted(_units(store).items()):
        place = f"{store.root}/audits/{unit}.json"
        digest = _digest(store, unit, runs, generations)
        kept = folders.read_json(spark, place) if folders.exists(spark, place) else None
        if kept is None or kept["files"] != digest:
            row = queries.traceability_audit(*_rows(store, unit, runs)).first()
            kept = {"files": digest, "counts": {name: row[name] for name in COUNTS}}
            folders.write_json(spark, place, kept)
        for name in COUNTS:
            total[name] += kept["counts"][name]
    return spark.createDataFrame([tuple(total[n] for n in COUNTS)], ", ".join(f"{n} bigint" for n in COUNTS))
