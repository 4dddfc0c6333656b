"""The stored tables: raw events, routed outcomes, and learned templates.

Every write goes to its own ``run=<id>`` folder and overwrites that folder only, so
a repeated run replaces its own output and appending needs no transaction log.
Point lookups by id or address are served by Parquet bloom filters in place of
secondary indexes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loglathe.contracts import (
    NORMALIZED_EVENT_SCHEMA, QUARANTINE_COLUMNS, RAW_EVENT_SCHEMA, STATUS_NORMALIZED, STATUS_PARSE_ERROR,
    VOCABULARIES,
)
from loglathe.operators.normalize import NormalizeOptions, normalized_events
from loglathe.operators.similar import TEMPLATE_SCHEMA
from loglathe.operators.signatures import SIGNATURE_STATE_SCHEMA
from loglathe.operators.templates import LEAF_STATE_SCHEMA, MODE_SEQUENTIAL, MODE_SIGNATURES
from loglathe.sources import folders

RAW_BLOOM = ["event_id"]
OUTCOME_BLOOM = ["raw_event_id", "normalized_id", "src_ip", "dst_ip"]

OUTCOME_SCHEMA = T.StructType(
    [T.StructField("source_name", T.StringType()), T.StructField("seq", T.LongType()),
     T.StructField("error_reason", T.StringType())]
    + [f for f in NORMALIZED_EVENT_SCHEMA.fields if f.name != "source_format"]
    + [T.StructField("status", T.StringType()), T.StructField("source_format", T.StringType())]
)


def _write(df: DataFrame, path: str, bloom: list[str], partition_by: list[str]) -> None:
    # Filters sized by the values found, not by the largest size allowed.
    writer = df.write.mode("overwrite").option("parquet.bloom.filter.adaptive.enabled", "true")
    for column in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def _existing(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table, or an empty one where nothing was written yet."""
    found = _existing(spark, path, schema)
    return spark.createDataFrame([], schema) if found is None else found


def write_table(df: DataFrame, path: str) -> None:
    _write(df, path, [], [])


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return _read(spark, path, schema)


# -- raw events ------------------------------------------------------------

def write_raw(raw: DataFrame, path: str, run: str = "0") -> None:
    _write(raw.select(RAW_EVENT_SCHEMA.fieldNames()), f"{path}/run={run}", RAW_BLOOM, [])


def read_raw(spark: SparkSession, path: str, run: str | None = None,
             stream_path: str | None = None) -> DataFrame:
    """One run, or all runs and what a stream has stored in a folder of its own."""
    targets = [path if run is None else f"{path}/run={run}", *filter(None, [stream_path])]
    found = [table.select(RAW_EVENT_SCHEMA.fieldNames()) for table in (
        _existing(spark, target, RAW_EVENT_SCHEMA) for target in targets) if table is not None]
    if not found:
        return spark.createDataFrame([], RAW_EVENT_SCHEMA)
    return reduce(DataFrame.unionByName, found)


def new_only(raw: DataFrame, stored: DataFrame) -> DataFrame:
    """Leave out lines that were stored before (the same file ingested twice)."""
    return raw.join(stored.select("content_id"), "content_id", "left_anti")


# -- outcomes: normalised events and quarantine ------------------------------

def _enforced(outcome: DataFrame) -> DataFrame:
    """The same rows; a value that the contract forbids fails the task that meets it."""
    event = F.col("status") == STATUS_NORMALIZED

    def checked(name: str, bad: Column, what: str) -> Column:
        message = F.concat(F.lit(f"{name} {what}: "), F.coalesce(F.col(name).cast("string"), F.lit("null")),
                           F.lit(" of raw event "), F.coalesce("raw_event_id", F.lit("null")))
        return F.when(bad, F.raise_error(message)).otherwise(F.col(name))

    columns = {}
    for field in NORMALIZED_EVENT_SCHEMA.fields:
        words = VOCABULARIES.get(field.name)
        if words is not None:
            columns[field.name] = checked(
                field.name, event & ~F.coalesce(F.col(field.name).isin(words), F.lit(False)),
                "takes no such word")
        elif not field.nullable:
            needed = F.lit(True) if field.name == "raw_event_id" else event
            columns[field.name] = checked(field.name, needed & F.col(field.name).isNull(), "must not be null")
    columns["status"] = checked(
        "status", ~F.coalesce(F.col("status").isin(STATUS_NORMALIZED, STATUS_PARSE_ERROR), F.lit(False)),
        "takes no such word")
    return outcome.withColumns(columns)


class DuplicateKey(ValueError):
    """An event id that occurs more than once."""


def write_outcomes(outcome: DataFrame, path: str, run: str = "0",
                   against: DataFrame | None = None) -> None:
    """One parse and one write feed both the event table and the quarantine.

    ``status`` and ``source_format`` are partition columns: reading events never
    touches failures, and a format filter prunes folders.

    The contract is enforced: a word outside a closed vocabulary, a null where none may be and a
    repeated id are errors. Rows go to a hidden folder first and take the run's place when all
    is well, so a failed run leaves no folder and the former content of a repeated run stays. Ids name
    their run, so those of other runs can only repeat if someone passes them on; ``against``, stored
    outcomes of other runs, is compared too if given.
    """
    spark = outcome.sparkSession
    hidden = f"{path}/_staged-{run}"
    try:
        _write(_enforced(outcome.select(OUTCOME_SCHEMA.fieldNames())), hidden, OUTCOME_BLOOM,
               ["status", "source_format"])
        ids = spark.read.schema(OUTCOME_SCHEMA).parquet(hidden).select("raw_event_id")
        repeated = duplicate_ids(ids, "raw_event_id").select("raw_event_id")
        if against is not None:
            repeated = repeated.unionByName(against.select("raw_event_id").join(ids, "raw_event_id", "left_semi"))
        first = repeated.first()
        if first is not None:
            raise DuplicateKey(f"raw_event_id occurs more than once: {first[0]}")
        folders.move(spark, hidden, f"{path}/run={run}")
    finally:
        folders.delete(spark, hidden)


def run_names(spark: SparkSession, path: str) -> list[str]:
    return [n.removeprefix("run=") for n in folders.names(spark, path) if n.startswith("run=")]


# Generations are what compaction makes of runs; see ``plans.compact``.

def generation_path(path: str, generation: str) -> str:
    return f"{path}_compacted/generation={generation}"


def manifests(spark: SparkSession, path: str) -> list[dict]:
    folder = f"{path}_compacted/_manifests"
    return [folders.read_json(spark, f"{folder}/{n}") for n in folders.names(spark, folder)
            if n.endswith(".json") and not n.startswith("_")]


def publish(spark: SparkSession, path: str, manifest: dict) -> None:
    folders.write_json(spark, f"{path}_compacted/_manifests/{manifest['generation']}.json", manifest)


def replaced_runs(spark: SparkSession, path: str) -> set[str]:
    return {run for manifest in manifests(spark, path) for run in manifest["replaces"]}


def read_runs(spark: SparkSession, path: str, runs: list[str]) -> DataFrame:
    """Outcomes of the named runs, with the run's name."""
    if not runs:
        return spark.createDataFrame([], OUTCOME_SCHEMA).withColumn("run", F.lit(None).cast("string"))
    found = spark.read.schema(T.StructType([*OUTCOME_SCHEMA.fields, T.StructField("run", T.StringType())]))
    return found.option("basePath", path).parquet(*[f"{path}/run={run}" for run in runs])


def fresh_outcomes(spark: SparkSession, path: str) -> DataFrame:
    """Outcomes that no generation holds yet."""
    gone = replaced_runs(spark, path)
    return read_runs(spark, path, [run for run in run_names(spark, path) if run not in gone])


def compacted_outcomes(spark: SparkSession, path: str) -> DataFrame:
    """Outcomes in published generations, with run and day."""
    schema = T.StructType([*OUTCOME_SCHEMA.fields, T.StructField("run", T.StringType()),
                           T.StructField("day", T.StringType())])
    targets = [generation_path(path, m["generation"]) for m in manifests(spark, path)]
    return spark.read.schema(schema).option("basePath", f"{path}_compacted").parquet(*targets).select(
        schema.fieldNames())


def read_outcomes(spark: SparkSession, path: str, run: str | None = None) -> DataFrame:
    gone = replaced_runs(spark, path)
    if not gone:
        target = path if run is None else f"{path}/run={run}"
        stored = _read(spark, target, OUTCOME_SCHEMA)
    elif run is not None and run not in gone:
        stored = _read(spark, f"{path}/run={run}", OUTCOME_SCHEMA)
    else:
        stored = compacted_outcomes(spark, path).drop("day")
        stored = stored.filter(F.col("run") == run) if run is not None else stored.unionByName(
            fresh_outcomes(spark, path))
    return stored.withColumn("detected_format", F.col("source_format"))


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return normalized_events(read_outcomes(spark, path))


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    return read_outcomes(spark, path).filter(F.col("status") == "parse_error").select(
        QUARANTINE_COLUMNS)


def duplicate_ids(df: DataFrame, id_column: str) -> DataFrame:
    """Primary-key audit: ids that occur more than once."""
    return df.groupBy(id_column).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


# -- learned templates -------------------------------------------------------

def _state_schema(options: NormalizeOptions) -> T.StructType:
    if options.mode == MODE_SEQUENTIAL:
        return T.StructType.fromDDL(TEMPLATE_SCHEMA)
    if options.mode == MODE_SIGNATURES:
        return T.StructType.fromDDL(SIGNATURE_STATE_SCHEMA)
    return LEAF_STATE_SCHEMA


def _template_folder(path: str, run: str, options: NormalizeOptions) -> str:
    """What was learned depends on the mode and its settings, so the folder names them."""
    kind = f"{options.mode}-depth{options.depth}"
    if options.mode in (MODE_SEQUENTIAL, MODE_SIGNATURES):
        kind += f"-similarity{options.similarity}"
    return f"{path}/run={run}/kind={kind}"


def write_templates(state: DataFrame, path: str, run: str, options: NormalizeOptions) -> None:
    """One folder per run: what was learned up to and including that run."""
    _write(state.select(_state_schema(options).fieldNames()),
           _template_folder(path, run, options), [], [])


def read_templates(spark: SparkSession, path: str, run: str,
                   options: NormalizeOptions) -> DataFrame:
    """What a run had learned; an unknown run, or one mined otherwise, is an error."""
    folder = _template_folder(path, run, options)
    found = _existing(spark, folder, _state_schema(options))
    if found is None:
        raise ValueError(f"run {run!r} has stored no templates of this kind: {folder}")
    return found
