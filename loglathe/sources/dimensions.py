"""The small lookup tables: address ranges with countries, known-bad addresses."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loglathe.contracts import GEO_RANGES, KNOWN_BAD_IPS
from loglathe.functions.ip import ipv4_number, network_number
from loglathe.functions.text import strip
from loglathe.sources.files import in_file_order


def _bundled(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    columns = [list(column) for column in zip(*rows)]
    return spark.createDataFrame(pa.table(columns, names=names))


def _csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV table with a header, and ``ord``, the row number in the file."""
    rows = spark.read.csv(path, header=True, schema=schema, enforceSchema=False).select(
        "*", F.lit("").alias("_source"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"))
    return in_file_order(rows, ["_source", "_file", "_block"]).withColumnRenamed("seq", "ord")


def geo_ranges(spark: SparkSession, path: str | None = None) -> DataFrame:
    """``(ord, cidr, country, prefix_len, network)``; host bits are masked.

    ``network`` holds the leading ``prefix_len`` bits. A malformed range fails the
    job. IPv6 ranges are kept, without a network, as no IPv4 address is in them.
    """
    if path is None:
        rows = [(i, cidr, country) for i, (cidr, country) in enumerate(GEO_RANGES, start=1)]
        table = _bundled(spark, rows, ["ord", "cidr", "country"])
    else:
        table = _csv(spark, path, "cidr string, country string")
    cidr = strip(F.col("cidr"))
    length_text = F.split_part(cidr, F.lit("/"), F.lit(2))
    table = table.select(
        "ord", cidr.alias("cidr"), strip(F.col("country")).alias("country"),
        ipv4_number(F.split_part(cidr, F.lit("/"), F.lit(1))).alias("_address"),
        F.when(length_text == "", 32).otherwise(length_text.try_cast("int")).alias("prefix_len"),
    )
    is_v6 = F.contains("cidr", F.lit(":"))
    valid = F.col("_address").isNotNull() & F.col("prefix_len").between(0, 32)
    message = F.concat(F.lit("not an address range: "), F.coalesce("cidr", F.lit("null")))
    network: Column = (
        F.when(is_v6, F.lit(None))
        .when(valid, network_number(F.col("_address"), F.col("prefix_len")))
        .otherwise(F.raise_error(message).cast("bigint"))
    )
    return table.select("ord", "cidr", "country", "prefix_len", network.alias("network"))


def known_bad_ips(spark: SparkSession, path: str | None = None) -> DataFrame:
    """``(ip)``, without repeats; a file is a CSV with the header ``ip``."""
    if path is None:
        return _bundled(spark, [(ip,) for ip in KNOWN_BAD_IPS], ["ip"])
    table = spark.read.csv(path, header=True, schema="ip string", enforceSchema=False)
    return table.select(strip(F.col("ip")).alias("ip")).distinct()
