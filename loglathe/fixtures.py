"""Deterministic mixed-format log lines derived from the ``events`` table."""

from __future__ import annotations

import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglathe.operators.normalize import evaluate_once, to_raw_events
from loglathe.session import scratch_path
from loglathe.sources.files import clean_lines
from loglathe.sources.tables import read_raw, write_raw

LOG_LINES_SQL = (Path(__file__).parent / "fixtures.sql").read_text()

ASSUMED_YEAR = 2024
CLOCK = "2024-02-01T00:00:00Z"
RUN = "fixture"


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give a stored table partitions that keep all cores busy.

    A row group of Parquet is read by one task, whatever the number of splits: a file of few row groups
    has splits without rows, and all other cores would idle. So rows are counted per split, by the
    footers alone. Where no split has more than twice a core's share, the case of large inputs in many
    row groups, the table is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"))
    largest, rows = splits.agg(F.max("n"), F.sum("n")).first()
    if rows is None or largest * cores <= 2 * rows:
        return df
    return df.repartition(max(cores, df.rdd.getNumPartitions()), key)


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(source_name, line_no, seq, raw_text)`` before cleaning."""
    events = spread(spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", "user_id", "event_type", "ts", "value"), "event_id")
    view = f"events_{uuid.uuid4().hex}"
    events.createOrReplaceTempView(view)
    lines = spark.sql(LOG_LINES_SQL.replace("FROM events)", f"FROM {view})"))
    spark.catalog.dropTempView(view)
    return evaluate_once(
        lines, ["seq"], F.col("source_name"), F.col("raw_text"),
    ).select("source_name", F.col("seq").alias("line_no"), "seq", "raw_text")


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of all documents, in document order, as ``(seq, raw_text)``."""
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"),
                  "doc_id")
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("i", "raw_text"))
    # A string has fewer than 2 ** 31 bytes, so a document has fewer lines than the factor.
    seq = F.col("doc_id") * F.lit(1 << 31) + F.col("i")
    return clean_lines(lines.select(seq.alias("seq"), "raw_text"))


_RAW_TABLES: dict[tuple[str, str], str] = {}


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table of these lines, stored once per application like any raw table.

    Every later step reads stored raw events, as in production, where the raw write
    is committed before parsing starts.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _RAW_TABLES:
        path = scratch_path(spark, "raw")
        write_raw(to_raw_events(clean_lines(log_lines(spark, sf_dir)), CLOCK, RUN), path)
        _RAW_TABLES[key] = path
    return read_raw(spark, _RAW_TABLES[key])
