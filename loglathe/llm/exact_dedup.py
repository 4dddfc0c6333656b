"""Exact deduplication with a split for frequent digests.

Misra-Gries summaries find the digests that hold more than a fixed share of all rows.
Their groups are counted exactly, and each group's winner is broadcast: rows of frequent
digests are decided where they are read. All other rows are grouped by an ordinary
shuffle, in which no digest is frequent any more.

Cases: a null text counts as empty; all texts without a visible character form one group;
a null ``doc_id`` loses ties against any other; of rows that agree in everything, one
stays. An empty table gives an empty table. Extra columns pass through ``deduplicate``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglathe.llm.common import ASCII_SPACE, discard, stored, text_or_empty

# Counters of a summary. At most COUNTERS + 1 digests can be called frequent, so what is
# broadcast has at most that many rows of about 100 bytes.
COUNTERS = 1024


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.translate(text, ASCII_SPACE, "").cast("binary"), 256))


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id``, the row's number, code points of the text, digest of the normalised text."""
    text = text_or_empty()
    return docs.select(
        "doc_id",
        F.monotonically_increasing_id().alias("row"),
        F.length(text).cast("long").alias("size"),
        _digest(text).alias("digest"),
    )


def _summaries(counters: int):
    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[bytes, int] = {}
        for batch in batches:
            counted = pa.array(batch.column(0)).value_counts()
            for digest, n in zip(counted.field(0).to_pylist(), counted.field(1).to_pylist()):
                kept[digest] = kept.get(digest, 0) + n
            if len(kept) > counters:
                # Take off the count of the first that does not fit, from all.
                cut = int(np.partition(np.fromiter(kept.values(), np.int64), -counters - 1)[
                    -counters - 1])
                kept = {d: n - cut for d, n in kept.items() if n > cut}
        yield pa.RecordBatch.from_pydict(
            {"digest": pa.array(list(kept), pa.binary()),
             "n": pa.array(list(kept.values()), pa.int64())})

    return summarise


def frequent_digests(table: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """At most ``counters + 1`` digests, with all that hold at least 2 / (counters + 1) of the rows.

    A summary undercounts a digest by at most its rows / (counters + 1). Summed over all
    summaries, a digest of twice that share of the rows keeps at least the share, and no
    more than ``counters + 1`` digests can keep so much.
    """
    rows = table.count()
    summaries = table.select("digest").mapInArrow(
        _summaries(counters), "digest binary, n bigint")
    return (
        summaries.groupBy("digest").agg(F.sum("n").alias("n"))
        .filter(F.col("n") * (counters + 1) >= rows)
        .select("digest")
    )


def _winners(table: DataFrame) -> DataFrame:
    # Most code points first, then the smallest doc_id.
    order = F.struct(-F.col("size"), F.col("doc_id").isNull(), "doc_id", "row")
    return table.groupBy("digest").agg(
        F.min(order).alias("first"), F.count("*").alias("group_size"),
    ).select("digest", F.col("first.doc_id").alias("keep_id"),
             F.col("first.row").alias("keep_row"), "group_size")


def decide(table: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Adds ``keep_id``, ``keep_row`` and ``group_size`` to a stored table of digests."""
    frequent = stored(frequent_digests(table, counters), "frequent")
    hot_rows = table.join(F.broadcast(frequent), "digest", "left_semi")
    # At most counters + 1 rows again.
    winners = stored(_winners(hot_rows), "winners")
    hot = table.join(F.broadcast(winners), "digest")
    rest = table.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    return hot.unionByName(rest.join(_winners(rest), "digest"))


def groups(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """One row per document: its group, the row that stays, and whether it is that row."""
    table = stored(digests(docs), "digests")
    return decide(table, counters).select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def deduplicate(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The documents that stay, with all their columns; texts are shuffled once, by digest.

    Rows that agree in ``doc_id``, size and digest cannot be told apart by them; where a
    winner is such a row, any one of its rows stays.
    """
    spark = docs.sparkSession
    key = ["digest", "size", "id", "no_id"]
    named = docs.select(F.struct(*docs.columns).alias("doc")).select(
        "doc", F.length(F.coalesce("doc.text", F.lit(""))).cast("long").alias("size"),
        _digest(F.coalesce("doc.text", F.lit(""))).alias("digest"),
        F.coalesce("doc.doc_id", F.lit(0)).alias("id"), F.col("doc.doc_id").isNull().alias("no_id"))
    table = stored(digests(docs), "digests")
    won = stored(
        decide(table, counters).filter((F.col("row") == F.col("keep_row"))).select(
            "digest", "size", F.coalesce("doc_id", F.lit(0)).alias("id"),
            F.col("doc_id").isNull().alias("no_id")), "kept")
    repeated = stored(
        table.groupBy("digest", "size", F.coalesce("doc_id", F.lit(0)).alias("id"),
                      F.col("doc_id").isNull().alias("no_id"))
        .agg(F.count("*").alias("n")).filter("n > 1").drop("n").join(won, key, "left_semi"),
        "repeated")
    discard(spark, table)
    if repeated.isEmpty():
        return named.join(won, key, "left_semi").select("doc.*")
    single = named.join(won.join(repeated, key, "left_anti"), key, "left_semi")
    several = named.join(repeated, key, "left_semi").dropDuplicates(key)
    return single.unionByName(several).select("doc.*")
