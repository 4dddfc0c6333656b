"""Attach a per-key table to a large, possibly skewed, table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A table is broadcast only when measured below both bounds.
BROADCAST_MAX_ROWS = 200_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
# After the heaviest HOT_KEYS keys are taken out, no key holds more than
# 1 / HOT_KEYS of the rows.
HOT_KEYS = 64


def measured_size(df: DataFrame) -> tuple[int, int]:
    """Rows and approximate bytes (as JSON text, an upper estimate for short fields)."""
    size = F.length(F.to_json(F.struct(*df.columns)))
    row = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("b")).first()
    return row["n"], row["b"]


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                   max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    rows, size = measured_size(df)
    return rows <= max_rows and size <= max_bytes


def attach_by_key(big: DataFrame, dim: DataFrame, key: str, small: bool,
                  hot_keys: int = HOT_KEYS) -> DataFrame:
    """Left join ``dim`` (unique on ``key``) to ``big``, whatever the skew of ``key``.

    ``small`` is the outcome of a size check on ``dim``; then one broadcast join does.
    Otherwise rows split three ways. Rows of the heaviest keys meet their at most
    ``hot_keys`` entries of ``dim`` by broadcast and are never shuffled; rows
    without a key skip the join; all others are joined by shuffle, where no key is
    heavy any more.
    """
    if small:
        return big.join(F.broadcast(dim), key, "left")
    heavy = (
        big.filter(F.col(key).isNotNull()).groupBy(key).count()
        .orderBy(F.desc("count"), key).limit(hot_keys).select(key)
    )
    hot_dim = dim.join(F.broadcast(heavy), key, "left_semi")
    keyless = big.filter(F.col(key).isNull())
    keyed = big.filter(F.col(key).isNotNull())
    added = [c for c in dim.columns if c != key]
    types = dict(zip(dim.columns, [f.dataType for f in dim.schema.fields]))
    blank: list[Column] = [F.lit(None).cast(types[c]).alias(c) for c in added]
    parts = [
        # ``heavy`` drives the hot branch, so that a hot key absent from ``dim`` stays.
        keyed.join(F.broadcast(heavy.join(hot_dim, key, "left")), key, "inner"),
        keyed.join(F.broadcast(heavy), key, "left_anti").join(dim, key, "left"),
        keyless.select("*", *blank),
    ]
    return reduce(DataFrame.unionByName, parts)
