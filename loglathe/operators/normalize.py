"""Route every raw event to its parser and shape the outcome."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglathe.contracts import (
    NORMALIZED_EVENT_COLUMNS, PARSED_FIELDS, STATUS_NORMALIZED, STATUS_PARSE_ERROR,
)
from loglathe.functions.clock import utc_now
from loglathe.functions.text import sha256_of, strip
from loglathe.operators import formats as known_formats
from loglathe.operators import sequential, signatures, templates
from loglathe.operators.detect import detect_format, json_in_array, json_in_object
from loglathe.operators.skew import attach_by_key
from loglathe.operators.stages import Stages, apply_stages, side_by_side
from loglathe.session import materialize


@dataclass(frozen=True)
class NormalizeOptions:
    """``assumed_year`` dates lines without a year; default: the year of ingestion.

    ``mode`` picks how templates of unrecognised lines are mined:
    ``running`` keeps one template per leaf, as it stands when a line arrives;
    ``two_pass`` applies the final template to all lines, earlier ones included;
    ``sequential`` keeps several templates per leaf, split by ``similarity``;
    ``signatures`` also keeps several, mined from distinct masked lines whatever their order.
    """

    assumed_year: int | None = None
    normalized_at: str | None = None
    mode: str = templates.MODE_RUNNING
    depth: int = templates.DEFAULT_DEPTH
    similarity: float = templates.DEFAULT_SIMILARITY

    def __post_init__(self) -> None:
        if self.mode not in templates.MODES:
            raise ValueError(f"mode must be one of {templates.MODES}: {self.mode}")


def to_raw_events(lines: DataFrame, ingested_at: str | None = None,
                  run: str | None = None) -> DataFrame:
    """Give every line its identity and ingestion time.

    ``content_id`` hashes the place of a line (path, or else source, and number) and its
    text. ``event_id`` also names the run, so a line that is ingested twice is two events.
    Both are hashes: random ids would change when a lost task is redone and break the
    link from normalised events.
    """
    place = "source_path" if "source_path" in lines.columns else "source_name"
    lines = lines.withColumn("content_id", sha256_of(F.col(place), F.col("line_no"), F.col("raw_text")))
    event_id = F.col("content_id") if run is None else sha256_of(F.lit(run), F.col("content_id"))
    stamp = F.lit(ingested_at or utc_now())
    return lines.select(
        event_id.alias("event_id"),
        "raw_text", "source_name",
        F.lit(None).cast("string").alias("source_format_hint"),
        stamp.alias("ingested_at"),
        F.try_to_timestamp(stamp).alias("ingested_ts"),
        "line_no", "seq", "content_id",
    )


@known_formats.rebuilt_on_change
def _known_stages(formats: tuple[str, ...], detect: bool, assumed_year: int | None) -> Stages:
    text, only = F.col("_text"), len(formats) == 1
    # The JSON value is parsed once, for detection and for the fields.
    in_array = json_in_array(text)
    is_json = F.col("_json_array").isNotNull() & json_in_object(text).isNotNull()
    if detect:
        in_array = F.when(text.startswith("{"), in_array)
    else:
        in_array = F.when(json_in_object(text).isNotNull(), in_array)
    stages: Stages = [
        {"_text": strip(F.col("raw_text"))},
        {"_json_array": in_array},
        {"detected_format": F.lit(formats[0]) if only else known_formats.format_of(
            text, {"json": is_json})},
    ]
    stages += side_by_side([known_formats.stages_of(name, only, assumed_year) for name in formats])
    stages.append({"found": F.coalesce(*[f"_{name}" for name in formats])})
    return stages + known_formats.finish_stages()


def parse_known(raw: DataFrame, options: NormalizeOptions,
                formats: tuple[str, ...] | None = None,
                detect: bool = True) -> DataFrame:
    """Detect and parse in one pass; adds ``detected_format`` and ``parsed``.

    ``formats``: all known ones, or the one to keep to. With ``detect=False`` every line is taken to be of the one format named.
    """
    formats = formats or known_formats.names()
    if detect and len(formats) == 1:
        raw = raw.filter(detect_format(F.col("raw_text")) == formats[0])
    stages = _known_stages(formats, detect, options.assumed_year)
    return apply_stages(raw, stages, keep=["detected_format", "parsed"])


def unknown_lines(raw: DataFrame, depth: int = templates.DEFAULT_DEPTH) -> DataFrame:
    unknown = raw.filter(detect_format(F.col("raw_text")) == "unknown")
    return templates.tokenize_lines(unknown, depth=depth)


def mine_raw(raw: DataFrame, options: NormalizeOptions,
             prior: DataFrame | None = None) -> tuple[DataFrame, bool]:
    """What is learned from the unrecognised lines among ``raw``, and if it is small.

    ``prior`` is what earlier runs have learned, in the form of ``learned_state``.
    """
    lines = unknown_lines(raw, options.depth).select("leaf", "seq", "tokens")
    if options.mode == templates.MODE_SEQUENTIAL:
        return sequential.mine_sequential(lines, options.similarity, prior=prior), False
    if options.mode == templates.MODE_SIGNATURES:
        return signatures.mine_signatures(lines, options.similarity, prior=prior), False
    # Detection and tokenising run once; mining reads the stored tokens several times.
    return templates.mine_leaves(materialize(lines, "unknown-lines"), prior)


def learned_state(mined: DataFrame, options: NormalizeOptions) -> DataFrame:
    """What a later run has to know of the templates mined so far."""
    if options.mode == templates.MODE_SEQUENTIAL:
        return sequential.cluster_state(mined)
    if options.mode == templates.MODE_SIGNATURES:
        return signatures.signature_state(mined)
    return templates.leaf_state(mined)


@cache
def _guess_of_values() -> Column:
    return templates.classify_tokens(F.col("_values"))


def with_guess(df: DataFrame, mined: tuple[DataFrame, bool],
               options: NormalizeOptions) -> DataFrame:
    """Add ``_guess``, the fields guessed from ``tokens``, where there is a ``leaf``."""
    state, small = mined
    here = F.col("leaf").isNotNull()
    if options.mode == templates.MODE_SEQUENTIAL:
        df = sequential.line_cluster(df, state, options.similarity)
        values = sequential.sequential_values(F.col("_cluster"))
    elif options.mode == templates.MODE_SIGNATURES:
        df = signatures.with_signature_template(df, state)
        values = signatures.template_values_at(F.col("_template"), F.col("tokens"))
    else:
        df = attach_by_key(df, state.select("leaf", "break_seq"), "leaf", small)
        values = templates.mined_values(options.mode)
    df = df.withColumn("_values", F.when(here, values))
    return df.withColumn("_guess", F.when(here, _guess_of_values()))


def outcomes(raw: DataFrame, options: NormalizeOptions | None = None,
             prior: DataFrame | None = None,
             mined: tuple[DataFrame, bool] | None = None) -> DataFrame:
    """One row per raw event: its format, status, error reason and event columns."""
    options = options or NormalizeOptions()
    mined = mined or mine_raw(raw, options, prior)
    df = parse_known(raw, options)
    df = templates.tokenize_lines(df, F.col("detected_format") == "unknown", options.depth)
    return _shape(with_guess(df, mined, options), options)


def outcomes_known(raw: DataFrame, fmt: str, options: NormalizeOptions | None = None,
                   detect: bool = True) -> DataFrame:
    """Outcomes of the events detected as one known format, or of all events as if so."""
    options = options or NormalizeOptions()
    return _shape(parse_known(raw, options, (fmt,), detect), options)


def outcomes_of_known_formats(raw: DataFrame,
                              options: NormalizeOptions | None = None) -> DataFrame:
    """Outcomes of all events in a known format, in one pass and without mining."""
    options = options or NormalizeOptions()
    df = _shape(parse_known(raw, options), options)
    return df.filter(F.col("detected_format") != "unknown")


def outcomes_unknown(raw: DataFrame, options: NormalizeOptions | None = None,
                     prior: DataFrame | None = None) -> DataFrame:
    """Outcomes of the events in no known format."""
    options = options or NormalizeOptions()
    mined = mine_raw(raw, options, prior)
    return outcomes_of_leaves(unknown_lines(raw, options.depth), mined, options)


def outcomes_of_leaves(lines: DataFrame, mined: tuple[DataFrame, bool],
                       options: NormalizeOptions) -> DataFrame:
    """Outcomes of ``unknown_lines`` whose leaves are described already."""
    df = lines.withColumn("detected_format", F.lit("unknown"))
    return _shape(with_guess(df, mined, options), options)


def evaluate_once(df: DataFrame, passed: list[str], *computed: Column) -> DataFrame:
    """Passed columns and computed ones, where a filter never re-computes the latter.

    The optimiser pushes a filter on a computed column below its definition by
    repeating that definition, which multiplies a long chain of parsing steps. A
    generator of one row is not crossed by such filters, while filters on the passed
    columns still reach the scan.
    """
    return df.select(*passed, F.inline(F.array(F.struct(*computed))))


@cache
def _output_columns(has_parsed: bool, has_guess: bool) -> list[Column]:
    """``PARSED_FIELDS`` from ``parsed`` and / or ``_guess``."""
    fixed = {"protocol": "UNKNOWN", "severity": "unknown", "device_vendor": None,
             "error_reason": None}

    def field(name: str) -> Column:
        if not has_guess:
            return F.col("parsed")[name]
        if name in fixed:
            guess = F.lit(fixed[name]).cast("string")
        elif name == "timestamp":
            guess = F.coalesce(F.col("_guess")[name], F.col("ingested_at"))
        else:
            guess = F.col("_guess")[name]
        if not has_parsed:
            return guess
        return F.when(F.col("detected_format") == "unknown", guess).otherwise(
            F.col("parsed")[name])

    return [field(name).alias(name) for name in PARSED_FIELDS]


@cache
def _outcome_columns(normalized_at: str) -> list[Column]:
    fmt = F.col("detected_format")
    failed = F.col("error_reason").isNotNull()
    # A failed line has an outcome but no event.
    event = F.when(~failed, F.struct(
        F.sha2(F.concat("raw_event_id", F.lit("n")), 256).alias("normalized_id"),
        *[F.col(name) for name in PARSED_FIELDS if name != "error_reason"],
        F.when(fmt == "unknown", "low").otherwise("high").alias("parser_confidence"),
        F.lit(normalized_at).alias("normalized_at"),
    ))
    return [
        fmt.alias("detected_format"),
        F.when(failed, STATUS_PARSE_ERROR).otherwise(STATUS_NORMALIZED).alias("status"),
        F.col("error_reason"), fmt.alias("source_format"), event.alias("_event"),
    ]


def _shape(df: DataFrame, options: NormalizeOptions) -> DataFrame:
    """The fixed output columns."""
    fields = _output_columns("parsed" in df.columns, "_guess" in df.columns)
    df = df.select(F.col("event_id").alias("raw_event_id"), "source_name", "seq",
                   "detected_format", *fields)
    columns = _outcome_columns(options.normalized_at or utc_now())
    df = evaluate_once(df, ["raw_event_id", "source_name", "seq"], *columns)
    return df.select("*", "_event.*").drop("_event")


def normalized_events(outcome: DataFrame) -> DataFrame:
    return outcome.filter(F.col("status") == STATUS_NORMALIZED).select(NORMALIZED_EVENT_COLUMNS)


def parse_errors(outcome: DataFrame) -> DataFrame:
    return outcome.filter(F.col("status") == STATUS_PARSE_ERROR).select(
        "raw_event_id", "source_name", "detected_format", "status", "error_reason")
