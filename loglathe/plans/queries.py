"""The questions asked of the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglathe.contracts import RAW_EVENT_COLUMNS, STATUS_NORMALIZED, STATUS_PARSE_ERROR, VOCABULARIES
from loglathe.functions.clock import ist_display
from loglathe.operators.detect import detect_format


# -- events ------------------------------------------------------------------

def newest_first(events: DataFrame) -> DataFrame:
    """By processing time; the id makes the order of equal times stable."""
    return events.orderBy(F.desc("normalized_at"), "normalized_id")


def filter_events(events: DataFrame, source_format: str | None = None,
                  action: str | None = None, ip: str | None = None,
                  ordered: bool = True) -> DataFrame:
    """Optional exact filters, combined with AND; ``ip`` is source or destination."""
    if source_format is not None:
        events = events.filter(F.col("source_format") == source_format)
    if action is not None:
        events = events.filter(F.col("action") == action)
    if ip is not None:
        events = events.filter((F.col("src_ip") == ip) | (F.col("dst_ip") == ip))
    return newest_first(events) if ordered else events


def widget_filters(source_format: str = "All", action: str = "All", ip: str = "") -> dict:
    """Filter arguments from what a person picked: "All" and blank mean no filter."""
    return {
        "source_format": None if source_format == "All" else source_format,
        "action": None if action == "All" else action,
        "ip": ip.strip() or None,
    }


def headline(events: DataFrame) -> DataFrame:
    return events.agg(
        F.count("*").alias("n_events"), F.count_distinct("source_format").alias("n_formats"))


def parser_path(events: DataFrame) -> DataFrame:
    low = F.count_if(F.col("parser_confidence") == "low")
    return events.agg((F.count("*") - low).alias("n_known_format"), low.alias("n_fallback"))


def empty_state(events: DataFrame, filtered: DataFrame) -> str | None:
    """Why there is nothing to show, or None if there is."""
    if not filtered.isEmpty():
        return None
    return "nothing_ingested" if events.isEmpty() else "no_match"


def event_detail(events: DataFrame, raw: DataFrame, normalized_id: str,
                 show_ist: bool = False) -> DataFrame:
    """One event beside its raw row; the raw columns are null if that is missing."""
    one = events.filter(F.col("normalized_id") == normalized_id)
    side = raw.select("event_id", "raw_text", "source_name", "source_format_hint", "ingested_at")
    # The event is at most one row, so its side of the join is broadcast.
    detail = side.join(F.broadcast(one), side.event_id == one.raw_event_id, "right")
    if show_ist:
        detail = detail.withColumns({
            c: ist_display(F.col(c)) for c in ("timestamp", "normalized_at", "ingested_at")})
    return detail


# -- raw events ----------------------------------------------------------------

def raw_by_id(raw: DataFrame, event_id: str) -> DataFrame:
    return raw.filter(F.col("event_id") == event_id).select(RAW_EVENT_COLUMNS)


def raw_by_text(raw: DataFrame, text: str) -> DataFrame:
    return raw.filter(F.col("raw_text") == text).select("event_id", "raw_text", "source_name")


def lines_per_source(lines: DataFrame) -> DataFrame:
    """Counts by source in name order, then the total (a null source)."""
    return (
        lines.rollup("source_name").agg(
            F.count("*").alias("n_lines"), F.grouping("source_name").alias("is_total"))
        .orderBy("is_total", "source_name")
    )


# -- run summaries ---------------------------------------------------------------

def run_summary(outcome: DataFrame) -> DataFrame:
    return (
        outcome.groupBy("detected_format", "status").agg(F.count("*").alias("n_lines"))
        .orderBy("detected_format", "status")
    )


def run_totals(outcome: DataFrame) -> DataFrame:
    return outcome.agg(
        F.count("*").alias("n_lines"),
        F.count_if(F.col("status") == STATUS_NORMALIZED).alias("n_normalized"),
        F.count_if(F.col("status") == STATUS_PARSE_ERROR).alias("n_parse_errors"),
    )


# -- links and audits ----------------------------------------------------------------

def linked_raw(events: DataFrame, raw: DataFrame) -> DataFrame:
    """Every event with its raw row. Ids are unique hashes, so the join has no hot key."""
    side = raw.select(*[F.col(c).alias(c) for c in RAW_EVENT_COLUMNS])
    return (
        events.select("normalized_id", "raw_event_id")
        .join(side, F.col("raw_event_id") == F.col("event_id"), "left")
        .select("normalized_id", *RAW_EVENT_COLUMNS)
    )


def linked_raw_of(events: DataFrame, raw: DataFrame, normalized_id: str) -> DataFrame:
    """The raw row of one event; empty if either is missing."""
    one = events.filter(F.col("normalized_id") == normalized_id).select(
        F.col("raw_event_id").alias("event_id"))
    return raw.join(F.broadcast(one), "event_id", "left_semi").select(RAW_EVENT_COLUMNS)


def raw_without_event(raw: DataFrame, events: DataFrame) -> DataFrame:
    """Raw rows that no normalised event points to."""
    return raw.join(
        events.select(F.col("raw_event_id").alias("event_id")), "event_id", "left_anti",
    ).select("event_id", "source_name", "raw_text")


def vocabulary_audit(events: DataFrame) -> DataFrame:
    """For each column with a closed vocabulary, how many events hold another word or none."""
    return events.agg(*[
        F.count_if(F.col(name).isNull() | ~F.col(name).isin(words)).alias(f"n_bad_{name}")
        for name, words in VOCABULARIES.items()])


def traceability_audit(raw: DataFrame, outcome: DataFrame) -> DataFrame:
    """One row of counts; all but the first three must be zero.

    A single full join on the id answers everything. The format is detected before
    the join, so that texts are not shuffled.
    """
    left = raw.select("event_id", detect_format(F.col("raw_text")).alias("format_now"))
    right = outcome.select(
        F.col("raw_event_id").alias("event_id"), "status", "source_format")
    both = left.join(right, "event_id", "full")
    has_raw, has_outcome = F.col("format_now").isNotNull(), F.col("status").isNotNull()
    return both.agg(
        F.count_if(has_raw).alias("n_raw"),
        F.count_if(F.col("status") == STATUS_NORMALIZED).alias("n_normalized"),
        F.count_if(F.col("status") == STATUS_PARSE_ERROR).alias("n_quarantined"),
        F.count_if(has_raw & ~has_outcome).alias("n_lost"),
        F.count_if(~has_raw & has_outcome).alias("n_orphans"),
        F.count_if(has_raw & has_outcome & (F.col("format_now") != F.col("source_format")))
        .alias("n_wrong_format"),
    )

