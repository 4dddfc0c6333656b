"""Enrichment at read time: country, known-bad flag, display time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglathe.contracts import DISPLAY_COLUMNS
from loglathe.functions.clock import ist_display
from loglathe.functions.ip import ipv4_number, network_number
from loglathe.functions.text import strip
from loglathe.operators.skew import attach_by_key, fits_broadcast

FIRST_MATCH = "first_match"
LONGEST_PREFIX = "longest_prefix"


def _best(policy: str):
    """The order in which matching ranges compete; the least wins."""
    if policy == LONGEST_PREFIX:
        return F.struct((-F.col("prefix_len")).alias("rank"), "ord", "country")
    return F.struct(F.col("ord").alias("rank"), "ord", "country")


def with_range(events: DataFrame, ranges: DataFrame, ip: str, out: str,
               policy: str = FIRST_MATCH, small: bool | None = None) -> DataFrame:
    """Add ``out``, a struct with ``ord`` and ``country`` of the range of an address.

    Instead of a range join there is one equality join per prefix length that occurs
    (at most 33) on the leading bits of the address. All are broadcast joins while
    the range table is small, so events are not shuffled. A table too large for that
    is met by the distinct addresses only.
    """
    nets = ranges.filter(F.col("network").isNotNull()).groupBy("prefix_len", "network").agg(
        F.min(_best(policy)).alias("hit"))
    lengths = sorted(row["prefix_len"] for row in nets.select("prefix_len").distinct().collect())
    if small is None:
        small = fits_broadcast(nets)
    if not lengths:
        none = F.lit(None)
        return events.withColumn(out, F.struct(
            none.cast("bigint").alias("rank"), none.cast("bigint").alias("ord"),
            none.cast("string").alias("country")))
    address = ipv4_number(strip(F.col(ip)))
    if small:
        df = events.withColumn("_address", address)
        for n in lengths:
            one = nets.filter(F.col("prefix_len") == n).select(
                F.col("network").alias(f"_net{n}"), F.col("hit").alias(f"_hit{n}"))
            df = df.join(F.broadcast(one),
                         network_number(F.col("_address"), n) == F.col(f"_net{n}"), "left")
        best = F.array_min(F.array(*[f"_hit{n}" for n in lengths]))
        return df.withColumn(out, best).drop(
            "_address", *[f"_net{n}" for n in lengths], *[f"_hit{n}" for n in lengths])
    addresses = events.select(F.col(ip)).filter(address.isNotNull()).distinct()
    per_length = addresses.withColumn("_address", address).withColumn(
        "prefix_len", F.explode(F.array(*[F.lit(n) for n in lengths])))
    per_length = per_length.withColumn(
        "network", network_number(F.col("_address"), F.col("prefix_len")))
    found = per_length.join(nets, ["prefix_len", "network"]).groupBy(ip).agg(
        F.min("hit").alias(out))
    return attach_by_key(events, found, ip, small=False)


def with_country(events: DataFrame, ranges: DataFrame, ip: str = "src_ip",
                 out: str = "src_country", policy: str = FIRST_MATCH,
                 small: bool | None = None) -> DataFrame:
    """The country of the first range, in table order, that holds the address."""
    df = with_range(events, ranges, ip, "_range", policy, small)
    return df.withColumn(out, F.col("_range.country")).drop("_range")


def with_known_bad(events: DataFrame, bad: DataFrame, ip: str = "src_ip",
                   out: str = "src_flagged_bad", small: bool | None = None) -> DataFrame:
    """Whether the address is on the list; false without an address."""
    listed = bad.select(F.col("ip").alias("_ip"), F.lit(True).alias("_listed"))
    if small is None:
        small = fits_broadcast(listed)
    df = attach_by_key(events.withColumn("_ip", strip(F.col(ip))), listed, "_ip", small)
    return df.withColumn(out, F.col("_listed").isNotNull()).drop("_ip", "_listed")


def enriched_events(events: DataFrame, ranges: DataFrame, bad: DataFrame,
                    show_ist: bool = False) -> DataFrame:
    """The event table as displayed; enrichment is never stored."""
    df = with_known_bad(with_country(events, ranges), bad)
    if show_ist:
        df = df.withColumns({c: ist_display(F.col(c)) for c in ("timestamp", "normalized_at")})
    return df.select(DISPLAY_COLUMNS)
