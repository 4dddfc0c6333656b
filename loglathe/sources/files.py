"""Log files as lines in arrival order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loglathe.contracts import LINES_SCHEMA
from loglathe.functions.text import strip
from loglathe.operators.skew import fits_broadcast
from loglathe.session import cut_lineage, materialize

# One entry per file split: some hundred thousand at 100 TB.
_SPLITS_MAX_ROWS = 2_000_000
_SPLITS_MAX_BYTES = 512 * 1024 * 1024

_SPLIT_KEY = ["source_name", "_file", "_block"]


def clean_lines(lines: DataFrame) -> DataFrame:
    """Strip every line and drop the blank ones."""
    return lines.withColumn("raw_text", strip(F.col("raw_text"))).filter(F.col("raw_text") != "")


def in_file_order(df: DataFrame, key: list[str]) -> DataFrame:
    """Add ``line_no`` (from 1 within a source) and ``seq`` (from 1 over all sources).

    ``key`` names source, file and split offset. Only the row counts of the splits
    are ordered; the rows stay in the partition that read them, however long a file
    is. Sources follow each other in name order, and so do the files of a source.
    """
    source, file, block = key
    # Split boundaries follow the parallelism of the moment. Stored, each row keeps the split
    # and the place it was read at, however often the lines are evaluated later.
    df = materialize(df.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    splits = df.groupBy(*key).agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    earlier = W.partitionBy(source).orderBy(file, block).rowsBetween(
        W.unboundedPreceding, -1)
    splits = cut_lineage(splits.withColumn("_skip", F.coalesce(
        F.sum("_n").over(earlier), F.lit(0))))
    # One row per source.
    before = W.orderBy(source).rowsBetween(W.unboundedPreceding, -1)
    sources = splits.groupBy(source).agg(F.sum("_n").alias("_n")).withColumn(
        "_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    offsets = splits.join(sources, source).select(*key, "_first", "_skip", "_before")
    if fits_broadcast(splits, _SPLITS_MAX_ROWS, _SPLITS_MAX_BYTES):
        offsets = F.broadcast(offsets)
    line_no = F.col("_skip") + F.col("_row") - F.col("_first") + 1
    return (
        df.join(offsets, key)
        .withColumn("line_no", line_no)
        .withColumn("seq", F.col("_before") + F.col("line_no"))
    )


def _numbered(text: DataFrame, source: Column) -> DataFrame:
    lines = text.select(
        source.alias("source_name"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_path").alias("source_path"),
        F.col("_metadata.file_block_start").alias("_block"),
        # Bytes that are not UTF-8 become U+FFFD and do not stop the read.
        F.make_valid_utf8("value").alias("raw_text"),
    )
    return in_file_order(clean_lines(lines), _SPLIT_KEY).select(
        *LINES_SCHEMA.fieldNames(), "source_path")


def _or_empty(spark: SparkSession, read: Callable[[], DataFrame]) -> DataFrame:
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], LINES_SCHEMA)
        raise


def scan_logs(spark: SparkSession, path: str, glob: str = "*.log") -> DataFrame:
    """All non-blank lines of the matching files right below a folder.

    The source of a line is its file name; ``source_path`` is the whole path. A missing or
    empty folder has no lines.
    """
    return _or_empty(spark, lambda: _numbered(
        spark.read.option("pathGlobFilter", glob).text(f"{path.rstrip('/')}/{glob}"),
        F.col("_metadata.file_name")))


def scan_chunks(spark: SparkSession, path: str, glob: str = "*.txt") -> DataFrame:
    """All non-blank lines of landed chunks (see ``land_lines``), sources from folders."""
    return _or_empty(spark, lambda: _numbered(
        spark.read.option("pathGlobFilter", glob).text(path),
        F.col("source_name").cast("string"))).drop("source_path")


def read_log_file(spark: SparkSession, path: str) -> DataFrame:
    """The non-blank lines of one file; raises OSError if it cannot be found."""
    try:
        return _numbered(spark.read.text(path), F.col("_metadata.file_name"))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"could not read log file {path!r}") from error
        raise


def land_lines(lines: DataFrame, path: str) -> None:
    """Store lines as immutable text chunks below ``source_name=<name>``.

    Chunk names follow ``seq``, so that a scan finds the lines in order again.
    """
    (
        lines.repartitionByRange("seq").sortWithinPartitions("source_name", "seq")
        .select("source_name", "raw_text")
        .write.partitionBy("source_name").text(path)
    )
