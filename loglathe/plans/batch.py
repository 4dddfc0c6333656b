"""The batch job: files or lines to raw events to routed outcomes."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from loglathe.functions.clock import utc_now
from loglathe.operators.normalize import (
    NormalizeOptions, learned_state, mine_raw, normalized_events, outcomes, to_raw_events,
)
from loglathe.plans import queries
from loglathe.sources import tables
from loglathe.sources.files import scan_logs


@dataclass(frozen=True)
class EventStore:
    """The stored tables below one folder."""

    spark: SparkSession
    root: str

    @property
    def raw_path(self) -> str:
        return f"{self.root}/raw"

    @property
    def stream_raw_path(self) -> str:
        """Raw events of the stream. Its sink keeps a log of files, which hides all others."""
        return f"{self.root}/raw_stream"

    @property
    def outcome_path(self) -> str:
        return f"{self.root}/outcomes"

    @property
    def template_path(self) -> str:
        return f"{self.root}/templates"

    def raw(self, run: str | None = None) -> DataFrame:
        """Raw events of one batch run, or of all runs and the stream."""
        return tables.read_raw(self.spark, self.raw_path, run,
                               self.stream_raw_path if run is None else None)

    def outcomes(self, run: str | None = None) -> DataFrame:
        return tables.read_outcomes(self.spark, self.outcome_path, run)

    def events(self) -> DataFrame:
        return normalized_events(self.outcomes())

    def quarantine(self) -> DataFrame:
        return tables.read_quarantine(self.spark, self.outcome_path)


def ingest_lines(store: EventStore, lines: DataFrame, options: NormalizeOptions | None = None,
                 run: str | None = None, prior_run: str | None = None, dedup: bool = False,
                 ingested_at: str | None = None) -> str:
    """Store raw events, then their outcomes and the learned templates; returns the run.

    The raw table is complete before any line is parsed, and parsing reads it back
    from there. ``prior_run`` carries on with the templates that run had learned.
    ``dedup`` skips lines stored already: same path, number and text. Otherwise a file that
    is ingested twice is stored twice, as events of their own.
    """
    run = run or uuid.uuid4().hex
    clock = ingested_at or utc_now()
    options = options or NormalizeOptions()
    options = replace(options, normalized_at=options.normalized_at or clock)

    raw = to_raw_events(lines, clock, run)
    if dedup:
        raw = tables.new_only(raw, store.raw())
    tables.write_raw(raw, store.raw_path, run)

    stored = store.raw(run)
    prior = None
    if prior_run is not None:
        prior = tables.read_templates(store.spark, store.template_path, prior_run, options)
    mined = mine_raw(stored, options, prior)
    tables.write_templates(learned_state(mined[0], options), store.template_path, run, options)
    tables.write_outcomes(outcomes(stored, options, mined=mined), store.outcome_path, run)
    return run


def ingest_folder(store: EventStore, path: str, glob: str = "*.log", **kwargs) -> str:
    """Ingest all matching files of a folder; see ``ingest_lines``."""
    return ingest_lines(store, scan_logs(store.spark, path, glob), **kwargs)


def run_report(store: EventStore, run: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Counts by format and status, and the totals."""
    outcome = store.outcomes(run)
    return queries.run_summary(outcome), queries.run_totals(outcome)
