"""Continuous ingestion as two streaming queries.

The first stores raw events and does nothing else, so no parsing trouble can hold
it up. The second follows the stored raw events and writes their outcomes. Both
use the column functions of the batch job.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from loglathe.contracts import LINES_SCHEMA, RAW_EVENT_SCHEMA
from loglathe.functions.clock import ISO_UTC, utc_now
from loglathe.operators.normalize import (
    NormalizeOptions, learned_state, mine_raw, outcomes, to_raw_events,
)
from loglathe.plans.batch import EventStore
from loglathe.sources import folders, tables, tail

POLL_INTERVAL = "1.5 seconds"
# Names the stream in event ids. The number of a streamed line is its byte position, so the
# same line has other ids when a batch run stores it.
STREAM_RUN = "stream"


def tail_lines(spark: SparkSession, path: str, starting: str = "latest", glob: str = "*.log",
               max_bytes: int | None = None, state_path: str | None = None,
               observed: str | None = None) -> DataFrame:
    """New lines of the log files in a folder, as a stream.

    ``latest`` leaves out what is there at the start, ``earliest`` begins with it. ``max_bytes``
    bounds a micro-batch; it needs ``state_path``, a folder that belongs to this query as its checkpoint does.
    With ``observed`` the progress of the query has metrics of that name: ``lines``,
    ``shrunk_files`` (files found shorter than before, once each time) and ``held_back_bytes``, what such
    files hold now and is not read.
    """
    tail.register(spark)
    reader = spark.readStream.format(tail.FORMAT).option("startingOffsets", starting).option(
        "pathGlobFilter", glob)
    if state_path is not None:
        reader = reader.option("statePath", state_path)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    if observed is None:
        return reader.load(path)
    lines = reader.option("notices", "true").load(path).observe(
        observed, F.count("raw_text").alias("lines"), F.count("shrunk_to").alias("shrunk_files"),
        F.coalesce(F.sum("shrunk_to"), F.lit(0)).alias("held_back_bytes"))
    return lines.filter("raw_text IS NOT NULL").select(LINES_SCHEMA.fieldNames())


def backlog_share(spark: SparkSession, path: str, batches: int, least: int) -> int:
    """``max_bytes`` by which a stream reads what lies in a folder now in about so many micro-batches.

    Each batch costs the same seconds for its offsets and commits, so with batches of a fixed size a
    longer backlog would take ever more of them. Batches are cut into tasks whatever their size.
    """
    size = sum(length for _, length, _ in folders.contents(spark, path))
    return max(least, -(-size // batches))


class RotationListener(StreamingQueryListener):
    """Adds up, over all batches of queries it hears of, the metrics named ``observed``."""

    def __init__(self, observed: str) -> None:
        self.observed = observed
        self.totals = {"lines": 0, "shrunk_files": 0, "held_back_bytes": 0}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.observed)
        if row is not None:
            for name in self.totals:
                self.totals[name] += row[name]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def start_raw_stream(lines: DataFrame, store: EventStore, checkpoint: str,
                     interval: str = POLL_INTERVAL,
                     ingested_at: str | None = None) -> StreamingQuery:
    """Lines to stored raw events.

    The file sink keeps a log of committed files, so that a batch repeated after a
    failure is not seen twice by readers of the table.
    """
    raw = to_raw_events(lines, ingested_at or "", STREAM_RUN)
    if ingested_at is None:
        now = F.current_timestamp()
        raw = raw.withColumns({
            "ingested_at": F.date_format(now, ISO_UTC), "ingested_ts": F.date_trunc("second", now)})
    return (
        raw.select(RAW_EVENT_SCHEMA.fieldNames()).writeStream.format("parquet")
        .option("path", store.stream_raw_path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(processingTime=interval).start()
    )


def _run_of(batch_id: int) -> str:
    return f"b{batch_id:012d}"


def process_batch(store: EventStore, options: NormalizeOptions, raw: DataFrame,
                  batch_id: int) -> None:
    """Outcomes of one micro-batch, with templates carried on from the batch before.

    Every table gets the folder of this batch, which a repeated run overwrites with
    the same content: the state it starts from is the one of the previous batch.
    """
    options = replace(options, normalized_at=options.normalized_at or utc_now())
    prior = None
    if batch_id > 0:
        prior = tables.read_templates(
            store.spark, store.template_path, _run_of(batch_id - 1), options)
    mined = mine_raw(raw, options, prior)
    run = _run_of(batch_id)
    tables.write_templates(learned_state(mined[0], options), store.template_path, run, options)
    tables.write_outcomes(outcomes(raw, options, mined=mined), store.outcome_path, run)


def start_event_stream(store: EventStore, checkpoint: str,
                       options: NormalizeOptions | None = None, interval: str = POLL_INTERVAL,
                       available_now: bool = False,
                       max_files: int | None = None) -> StreamingQuery:
    """Stored raw events to outcomes; ``available_now`` catches up and ends."""
    options = options or NormalizeOptions()
    reader = store.spark.readStream.schema(RAW_EVENT_SCHEMA)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    writer = (
        reader.parquet(store.stream_raw_path).writeStream
        .foreachBatch(lambda raw, batch_id: process_batch(store, options, raw, batch_id))
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()
