"""Every operator as a named query over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loglathe import fixtures
from loglathe.contracts import (
    LINES_SCHEMA, NORMALIZED_EVENT_COLUMNS, QUARANTINE_COLUMNS, RAW_EVENT_COLUMNS,
)
from loglathe.functions.clock import ist_display
from loglathe.operators import detect, enrich, sequential, signatures, templates
from loglathe.operators.normalize import (
    NormalizeOptions, mine_raw, outcomes, outcomes_known, outcomes_of_known_formats,
    outcomes_unknown, parse_errors, unknown_lines,
)
from loglathe.operators.skew import attach_by_key
from loglathe.plans import audit, batch, compact, queries
from loglathe.session import configure_session, discard, materialize, scratch_path
from loglathe.sources import dimensions, files, tables
from loglathe.streaming import live, mined

Query = Callable[[SparkSession, str], DataFrame]

OPTIONS = NormalizeOptions(assumed_year=fixtures.ASSUMED_YEAR, normalized_at=fixtures.CLOCK)
TWO_PASS = NormalizeOptions(assumed_year=fixtures.ASSUMED_YEAR, normalized_at=fixtures.CLOCK,
                            mode=templates.MODE_TWO_PASS)

_OUTCOME_COLUMNS = ["detected_format", "status", "error_reason", *NORMALIZED_EVENT_COLUMNS]

SEQUENTIAL = NormalizeOptions(assumed_year=fixtures.ASSUMED_YEAR, normalized_at=fixtures.CLOCK,
                              mode=templates.MODE_SEQUENTIAL)

SIGNATURES = NormalizeOptions(assumed_year=fixtures.ASSUMED_YEAR, normalized_at=fixtures.CLOCK,
                              mode=templates.MODE_SIGNATURES)

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure_session(spark), sf_dir)

    QUERIES[function.__name__] = run
    return run


_raw = fixtures.raw_events
_STORES: dict[tuple[str, str], batch.EventStore] = {}


def _store(spark: SparkSession, sf_dir: str) -> batch.EventStore:
    """The tables the batch job leaves behind, built once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORES:
        store = batch.EventStore(spark, scratch_path(spark, "store"))
        lines = files.clean_lines(fixtures.log_lines(spark, sf_dir))
        batch.ingest_lines(store, lines, OPTIONS, fixtures.RUN, ingested_at=fixtures.CLOCK)
        _STORES[key] = store
    return _STORES[key]


# -- sources and sinks ---------------------------------------------------------

@query
def log_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "landed")
    files.land_lines(fixtures.log_lines(spark, sf_dir), path)
    return files.scan_chunks(spark, path)


@query
def clean_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.clean_lines(fixtures.log_lines(spark, sf_dir)).select(
        "seq", "source_name", "raw_text")


@query
def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir).select(RAW_EVENT_COLUMNS)


@query
def normalized_events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _store(spark, sf_dir).events()


QUERIES["normalized_events"] = QUERIES.pop("normalized_events_table")


@query
def raw_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    return queries.raw_by_id(raw, raw.agg(F.min("event_id")).first()[0])


@query
def geo_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The range table with the number of events whose source each range decides."""
    ranges = dimensions.geo_ranges(spark)
    events = _store(spark, sf_dir).events().select("src_ip")
    hits = enrich.with_range(events, ranges, "src_ip", "hit").groupBy(
        F.col("hit.ord").alias("ord")).agg(F.count("*").alias("n"))
    return ranges.join(hits, "ord", "left").select(
        "ord", "cidr", "country", F.col("prefix_len").cast("bigint").alias("prefix_len"),
        F.coalesce("n", F.lit(0)).alias("n_events"))


# -- detection and routing -----------------------------------------------------

@query
def detect_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir).filter(detect.is_json_object(F.col("raw_text"))).select(
        "seq", "raw_text")


@query
def detect_cef(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir).filter(detect.is_cef(F.col("raw_text"))).select("seq", "raw_text")


@query
def detect_syslog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir).filter(detect.is_syslog(F.col("raw_text"))).select(
        "seq", "raw_text")


@query
def detect_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir).select(
        "seq", detect.detect_format(F.col("raw_text")).alias("detected_format"))


@query
def normalize_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcomes(_raw(spark, sf_dir), OPTIONS).select(_OUTCOME_COLUMNS)


@query
def parse_error_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_errors(outcomes_of_known_formats(_raw(spark, sf_dir), OPTIONS))


QUERIES["parse_errors"] = QUERIES.pop("parse_error_rows")


@query
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _store(spark, sf_dir).quarantine().select(QUARANTINE_COLUMNS)


# -- normalisation per format ----------------------------------------------------

@query
def normalize_syslog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcomes_known(_raw(spark, sf_dir), "syslog", OPTIONS).select(_OUTCOME_COLUMNS)


@query
def normalize_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcomes_known(_raw(spark, sf_dir), "json", OPTIONS).select(_OUTCOME_COLUMNS)


@query
def normalize_cef(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcomes_known(_raw(spark, sf_dir), "cef", OPTIONS).select(_OUTCOME_COLUMNS)


@query
def normalize_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcomes_unknown(_raw(spark, sf_dir), OPTIONS).select(_OUTCOME_COLUMNS)


@query
def normalize_unknown_two_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcomes_unknown(_raw(spark, sf_dir), TWO_PASS).select(_OUTCOME_COLUMNS)


@query
def normalize_unknown_sequential(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcomes_unknown(_raw(spark, sf_dir), SEQUENTIAL).select(_OUTCOME_COLUMNS)


@query
def normalize_unknown_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcomes_unknown(_raw(spark, sf_dir), SIGNATURES).select(_OUTCOME_COLUMNS)


# -- template mining -------------------------------------------------------------

@query
def tokenize_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unknown_lines(_raw(spark, sf_dir)).select(
        "seq", F.size("tokens").cast("bigint").alias("n_tokens"),
        F.array_join("tokens", " ").alias("token_text"))


def _with_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    state, small = mine_raw(raw, OPTIONS)
    return attach_by_key(unknown_lines(raw), state, "leaf", small)


@query
def mine_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_templates(spark, sf_dir).select(
        "seq", "leaf", templates.line_template().alias("template"))


@query
def template_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _with_templates(spark, sf_dir).withColumn("template", templates.line_template())
    values = templates.template_values(F.col("template"), F.col("raw_text"))
    return lines.select("seq", F.array_join(values, " ").alias("value_text"))


@query
def classify_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields guessed from all tokens of a line, not only from those at wildcards."""
    lines = unknown_lines(_raw(spark, sf_dir))
    return lines.select("seq", templates.classify_tokens(F.col("tokens")).alias("guess")).select(
        "seq", "guess.*")


@query
def template_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    state, _ = mine_raw(_raw(spark, sf_dir), OPTIONS)
    return templates.template_table(state).select(
        "leaf_key", F.col("template_id").cast("bigint").alias("template_id"),
        F.array_join("template", " ").alias("template"), "n_lines")


@query
def mine_templates_sequential(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    mined, _ = mine_raw(raw, SEQUENTIAL)
    return sequential.line_cluster(unknown_lines(raw), mined).select(
        "seq", "leaf", sequential.sequential_template(F.col("_cluster")).alias("template"))


@query
def mine_templates_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    mined, _ = mine_raw(raw, SIGNATURES)
    return signatures.with_signature_template(unknown_lines(raw), mined).select(
        "seq", "leaf", F.array_join("_template", " ").alias("template"))


@query
def template_table_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    mined, _ = mine_raw(_raw(spark, sf_dir), SIGNATURES)
    return signatures.signature_templates(mined).select(
        "leaf_key", F.array_join("template", " ").alias("template"), "n_signatures", "n_lines")


@query
def template_table_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The templates of free text: all lines of all documents, many rare shapes."""
    lines = templates.tokenize_lines(fixtures.document_lines(spark, sf_dir))
    # Mining reads the lines several times; they are cut and tokenised once.
    tokens = materialize(lines.select("leaf", "seq", "tokens"), "text-lines")
    state, _ = templates.mine_leaves(tokens)
    discard(spark, tokens)
    return templates.template_table(state).select(
        "leaf_key", F.sha2(F.array_join("template", " "), 256).alias("template_hash"), "n_lines")


# -- joins and enrichment ----------------------------------------------------------

@query
def linked_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark, sf_dir)
    return queries.linked_raw(store.events(), store.raw())


@query
def geo_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _store(spark, sf_dir).events().select("normalized_id", "src_ip")
    return enrich.with_country(events, dimensions.geo_ranges(spark))


@query
def geo_country_longest_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _store(spark, sf_dir).events().select("normalized_id", "src_ip")
    return enrich.with_country(events, dimensions.geo_ranges(spark),
                               policy=enrich.LONGEST_PREFIX)


@query
def known_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _store(spark, sf_dir).events().select("normalized_id", "src_ip")
    return enrich.with_known_bad(events, dimensions.known_bad_ips(spark))


@query
def lossless_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark, sf_dir)
    return queries.raw_without_event(store.raw(), store.events())


@query
def traceability_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark, sf_dir)
    return queries.traceability_audit(store.raw(), store.outcomes())


@query
def traceability_audit_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.incremental(_compacted(spark, sf_dir))


@query
def vocabulary_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries.vocabulary_audit(_store(spark, sf_dir).events())


@query
def duplicate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.duplicate_ids(_store(spark, sf_dir).events(), "normalized_id")


# -- reads -----------------------------------------------------------------------------

@query
def all_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries.newest_first(_store(spark, sf_dir).events())


# Three runs on three days. Each mines its own templates, which decide the fields of unknown lines.
_DAYS = {"mon": "2024-02-05T08:00:00Z", "tue": "2024-02-06T08:00:00Z", "wed": "2024-02-07T08:00:00Z"}


def _known_ip() -> Column:
    return F.when(F.col("source_format") != "unknown", F.col("src_ip")).alias("src_ip")


def _compacted(spark: SparkSession, sf_dir: str) -> batch.EventStore:
    """A store whose first two runs are compacted, once per application."""
    key = (spark.sparkContext.applicationId, f"compacted {sf_dir}")
    if key not in _STORES:
        store = batch.EventStore(spark, scratch_path(spark, "days"))
        lines = files.clean_lines(fixtures.log_lines(spark, sf_dir))
        for k, (run, clock) in enumerate(_DAYS.items()):
            options = NormalizeOptions(assumed_year=fixtures.ASSUMED_YEAR, normalized_at=clock)
            batch.ingest_lines(store, lines.filter(F.col("seq") % 3 == k), options, run,
                               ingested_at=fixtures.CLOCK)
            if run == "tue":
                compact.compact(store)
        compact.drop_replaced(store)
        _STORES[key] = store
    return _STORES[key]


@query
def compacted_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events of a store in which compaction has taken the place of some runs."""
    return _compacted(spark, sf_dir).events().select(
        "normalized_id", "normalized_at", "source_format", _known_ip())


@query
def events_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page behind the first hundred events of one day; it goes on into the day before."""
    store = _compacted(spark, sf_dir)
    day = store.events().filter(F.col("normalized_at") == _DAYS["tue"])
    last = day.orderBy(F.desc("normalized_id")).offset(100).first()
    return compact.page(store, 250, (last["normalized_at"], last["normalized_id"])).select(
        "normalized_id", "normalized_at", "source_format", _known_ip())


@query
def filter_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries.filter_events(_store(spark, sf_dir).events(), "json", "deny")


@query
def filter_by_ip(spark: SparkSession, sf_dir: str) -> DataFrame:
    picked = queries.widget_filters("All", "All", " 10.1.1.20 ")
    return queries.filter_events(_store(spark, sf_dir).events(), **picked)


@query
def headline(spark: SparkSession, sf_dir: str) -> DataFrame:
    denied = queries.filter_events(_store(spark, sf_dir).events(), action="deny", ordered=False)
    return queries.headline(denied)


@query
def parser_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries.parser_path(_store(spark, sf_dir).events())


@query
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries.run_summary(_store(spark, sf_dir).outcomes())


@query
def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries.run_totals(_store(spark, sf_dir).outcomes())


@query
def lines_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries.lines_per_source(_raw(spark, sf_dir)).select(
        "source_name", "n_lines", F.col("is_total").cast("bigint").alias("is_total"))


@query
def enriched_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.enriched_events(
        _store(spark, sf_dir).events(), dimensions.geo_ranges(spark),
        dimensions.known_bad_ips(spark), show_ist=True)


@query
def event_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark, sf_dir)
    chosen = store.events().agg(F.min("normalized_id")).first()[0]
    return queries.event_detail(store.events(), store.raw(), chosen, show_ist=True)


@query
def raw_by_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries.raw_by_text(_raw(spark, sf_dir), "CEF:0|Kestrel|cut short")


@query
def ist_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _store(spark, sf_dir).events().select(
        "normalized_id", "timestamp", ist_display(F.col("timestamp")).alias("timestamp_ist"))


QUERIES["ist_display"] = QUERIES.pop("ist_labels")


# -- streaming ---------------------------------------------------------------------------

def _append_files(lines: DataFrame, path: str) -> None:
    """Text files whose names follow the order of the lines."""
    lines.repartitionByRange("seq").sortWithinPartitions("seq").select("raw_text").write.mode(
        "append").text(path)


@query
def tail_new_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files already there are the baseline; only what arrives afterwards is delivered."""
    lines = fixtures.log_lines(spark, sf_dir)
    folder, out = scratch_path(spark, "tailed"), scratch_path(spark, "tail-out")
    _append_files(lines, folder)
    stream = live.tail_lines(spark, folder, "latest", "*.txt").writeStream.format(
        "parquet").option("path", out).option("checkpointLocation", scratch_path(spark, "cp"))
    running = stream.trigger(processingTime="0 seconds").start()
    running.processAllAvailable()
    _append_files(lines, folder)
    running.processAllAvailable()
    running.stop()
    return spark.read.schema(LINES_SCHEMA).parquet(out).select("raw_text")


@query
def linked_raw_reingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw row of every event in a store that took the same lines in twice."""
    store = batch.EventStore(spark, scratch_path(spark, "twice"))
    lines = files.clean_lines(fixtures.log_lines(spark, sf_dir))
    for run in ("one", "two"):
        batch.ingest_lines(store, lines, OPTIONS, run, ingested_at=fixtures.CLOCK)
    return queries.linked_raw(store.events(), store.raw())


@query
def stream_after_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text and format of all events of a store that a batch run and a stream share."""
    store = batch.EventStore(spark, scratch_path(spark, "shared"))
    lines = fixtures.log_lines(spark, sf_dir)
    batch.ingest_lines(store, files.clean_lines(lines.filter("seq % 2 = 0")), OPTIONS, fixtures.RUN,
                       ingested_at=fixtures.CLOCK)
    folder = scratch_path(spark, "tailed")
    _append_files(lines.filter("seq % 2 = 1"), folder)
    first = live.start_raw_stream(
        live.tail_lines(spark, folder, "earliest", "*.txt"), store, scratch_path(spark, "cp"),
        interval="0 seconds", ingested_at=fixtures.CLOCK)
    first.processAllAvailable()
    first.stop()
    second = live.start_event_stream(
        store, scratch_path(spark, "cp"), OPTIONS, available_now=True)
    second.awaitTermination()
    linked = queries.linked_raw(store.events(), store.raw())
    return linked.join(store.events().select("normalized_id", "source_format"), "normalized_id").select(
        "raw_text", "source_format")


@query
def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events that the two streaming queries make of the same lines."""
    folder = scratch_path(spark, "tailed")
    _append_files(fixtures.log_lines(spark, sf_dir), folder)
    store = batch.EventStore(spark, scratch_path(spark, "live"))
    first = live.start_raw_stream(
        live.tail_lines(spark, folder, "earliest", "*.txt"), store, scratch_path(spark, "cp"),
        interval="0 seconds", ingested_at=fixtures.CLOCK)
    first.processAllAvailable()
    first.stop()
    second = live.start_event_stream(
        store, scratch_path(spark, "cp"), OPTIONS, available_now=True)
    second.awaitTermination()
    events = store.events().join(
        store.raw().select(F.col("event_id").alias("raw_event_id"), "raw_text"), "raw_event_id")
    return events.drop("normalized_id", "raw_event_id")


@query
def stream_unknown_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unrecognised lines in several micro-batches, with templates in the state store."""
    folder = scratch_path(spark, "tailed")
    _append_files(fixtures.log_lines(spark, sf_dir), folder)
    store = batch.EventStore(spark, scratch_path(spark, "live"))
    first = live.start_raw_stream(
        live.tail_lines(spark, folder, "earliest", "*.txt",
                        max_bytes=live.backlog_share(spark, folder, 8, least=1 << 21),
                        state_path=scratch_path(spark, "tail-state")), store, scratch_path(spark, "cp"),
         interval="0 seconds", ingested_at=fixtures.CLOCK)
    first.processAllAvailable()
    first.stop()
    mined.start_unknown_stream(
        store, scratch_path(spark, "cp"), OPTIONS, available_now=True, max_files=16).awaitTermination()
    events = store.events().join(
        store.raw().select(F.col("event_id").alias("raw_event_id"), "raw_text"), "raw_event_id")
    return events.drop("normalized_id", "raw_event_id")
