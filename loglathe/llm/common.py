"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglathe.session import discard, scratch_path  # noqa: F401

# The six ASCII white-space characters (fixed values): space, and 0x09 to 0x0D.
ASCII_SPACE = " \t\n\x0b\f\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    The result no longer depends on executors that computed it, and it is computed once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Rows of a few numbers that one task takes alone sooner than they are shuffled.
FEW = 100_000


def together(table: DataFrame) -> tuple[DataFrame, bool]:
    """A stored table, in one partition if it is measured to have at most ``FEW`` rows, and whether it has.

    What is grouped or joined in one partition is not shuffled, however many partitions a shuffle has.
    """
    few = table.count() <= FEW
    return (table.coalesce(1), True) if few else (table, False)


# What an operator's tasks keep in a Python worker, which outlives stages: by operator, key and value.
_KEPT: dict[str, tuple] = {}


def kept(operator: str, key, make: Callable):
    """``make(key)``, kept in this Python worker for later tasks of the operator."""
    if operator not in _KEPT or _KEPT[operator][0] != key:
        _KEPT[operator] = (key, make(key))
    return _KEPT[operator][1]


def let_go(operator: str | None = None) -> None:
    """Drop what other operators keep in this Python worker."""
    for other in [name for name in _KEPT if name != operator]:
        del _KEPT[other]


def hand_back() -> None:
    """Return memory that Arrow holds unused."""
    pa.default_memory_pool().release_unused()


def lean(run: Callable, operator: str | None = None) -> Callable:
    """A function for ``mapInArrow`` that leaves no memory behind in its Python worker.

    Spark uses a worker again for whatever comes next, beside an executor's heap.
    """
    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go(operator)
        try:
            yield from run(batches)
        finally:
            hand_back()

    return tasks


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have, whatever the case of its names."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def power_of_two(value: float, least: int, most: int) -> int:
    """The next power of two at or above ``value`` within the two bounds."""
    size = least
    while size < value and size < most:
        size *= 2
    return size


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))
