"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in a fixed pseudo-random order, as often over as
its target asks for. A document's virtual finish time is the number of words its source
has given up to its end, divided by the source's target, so that all sources reach time 1
together. The mix is every document in order of finish time, cut at the total budget; of
the document in which a source reaches its target, only the words due are taken.

The running sums never put a source into one task: documents fall into hash ranges of
their source, and only the totals of these ranges are summed in order.

Cases: a null or blank text has size 0 and gives no words; a null source is a source of its
own, last in order; a null ``doc_id`` is shuffled like an empty one. Rows that agree in
everything get the same places in some order. Without any words all targets are 0. An empty
table gives an empty table. Texts may have any length. Of equal finish times the first source comes
first. Further columns, of any name, are kept by ``mixed`` and left out by ``taken``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loglathe.llm.common import WORD_PATTERN, fresh, power_of_two, stored, text_or_empty

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
# Rows of a hash range, roughly; ranges of one source never exceed MAX_RANGES, which is
# what one task has to sum up in order.
RANGE_ROWS = 32
MAX_RANGES = 2 ** 20
MAX_TIME_RANGES = 2 ** 14
SEED = "mix"


def sized(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """``doc_id``, source, number of words and shuffle key of each document."""
    return docs.select(
        "doc_id",
        F.coalesce("source", F.lit("")).alias("src"),
        F.col("source").isNull().alias("no_src"),
        F.regexp_count(text_or_empty(), F.lit(WORD_PATTERN + "+")).cast("long").alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
              .cast("binary")).alias("place"),
        F.xxhash64(text_or_empty()).alias("text_hash"),
    )


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS,
            repeats: int = MAX_REPEATS, share: float = 1.0) -> DataFrame:
    """One row per source: its size and how many words the mix should take from it.

    The budget is shared by weight; no target exceeds ``repeats`` times its source's size,
    and what is over goes to the others by weight. That is one common rate, the largest of
    the rates that arise when the k sources that fill up first are full.
    """
    per_source = sizes.groupBy("src", "no_src").agg(F.sum("size").alias("source_size"))
    # One row per source goes through these windows.
    by_name = W.orderBy("no_src", "src")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    filling = W.orderBy(F.col("cap") / F.col("weight"), "no_src", "src")
    full = filling.rowsBetween(W.unboundedPreceding, -1)
    everything = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    budget = F.col("all_size") * F.lit(share) if share != 1.0 else F.col("all_size")
    return (
        per_source.withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * repeats)
        .withColumn("all_size", F.sum("source_size").over(everything))
        .withColumn("all_weight", F.sum("weight").over(everything))
        .withColumn("rate", (budget - F.coalesce(F.sum("cap").over(full), F.lit(0)))
                    / (F.col("all_weight") - F.coalesce(F.sum("weight").over(full), F.lit(0))))
        .withColumn("rate", F.max("rate").over(everything))
        .select("src", "no_src", "source_size", "weight",
                F.least(F.col("cap").cast("double"), F.col("rate") * F.col("weight"))
                .alias("target"))
    )


def _clip(value: Column, high: Column) -> Column:
    return F.greatest(F.lit(0).cast("long"), F.least(value, high))


def schedule(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS,
             repeats: int = MAX_REPEATS, share: float = 1.0) -> DataFrame:
    """One row per document and pass that gives words, in the global order of the mix.

    ``offset`` counts the words of the mix before this row, ``words`` those it gives.
    A document that gives none keeps one row. ``src, no_src, range, rank`` name a document.
    """
    n = sizes.count()
    ranges = power_of_two(n / RANGE_ROWS, 16, MAX_RANGES)
    head = F.conv(F.substring("place", 1, 8), 16, 10).cast("long")
    placed = sizes.withColumn("range", F.floor(head * F.lit(ranges) / F.lit(2.0 ** 32)))
    key = ["src", "no_src", "range"]
    totals = placed.groupBy(*key).agg(F.sum("size").alias("range_size"))
    earlier = W.partitionBy("src", "no_src").orderBy("range").rowsBetween(
        W.unboundedPreceding, -1)
    starts = totals.withColumn(
        "start", F.coalesce(F.sum("range_size").over(earlier), F.lit(0))
    ).drop("range_size").join(targets(sizes, weights, repeats, share), ["src", "no_src"])
    inside = W.partitionBy(*key).orderBy("place", "doc_id", "size").rowsBetween(
        W.unboundedPreceding, W.currentRow)
    queued = (
        placed.join(starts, key)
        .withColumn("rank", F.row_number().over(inside))
        .withColumn("before", F.col("start") + F.sum("size").over(inside) - F.col("size"))
    )
    # Words given so far when a pass begins, and the words still due then.
    due = F.floor("target").cast("long")
    passes = queued.select("*", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("turn"))
    given = F.col("turn") * F.col("source_size") + F.col("before")
    passes = (
        passes.withColumn("words", _clip(due - given, F.col("size")))
        .filter((F.col("words") > 0) | (F.col("turn") == 0))
        .withColumn("finish", F.when(F.col("words") > 0,
                                     (given + F.col("words")) / F.col("target"))
                    # Gives nothing, so any time will do.
                    .otherwise(head / F.lit(2.0 ** 32)))
    )
    return _truncated(passes, sizes, share, power_of_two(n / RANGE_ROWS, 16, MAX_TIME_RANGES))


def _truncated(passes: DataFrame, sizes: DataFrame, share: float, slots: int) -> DataFrame:
    """Order by finish time over all sources and stop at the budget."""
    budget = sizes.agg(F.floor(F.coalesce(F.sum("size"), F.lit(0)) * F.lit(share)).alias("n")).first()[0]
    passes = stored(passes.withColumn(
        "slot", F.least(F.floor(F.col("finish") * slots), F.lit(slots - 1))), "passes")
    # At most MAX_TIME_RANGES rows are summed in order.
    starts = passes.groupBy("slot").agg(F.sum("words").alias("slot_words")).withColumn(
        "slot_start", F.coalesce(F.sum("slot_words").over(
            W.orderBy("slot").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ).drop("slot_words")
    inside = W.partitionBy("slot").orderBy(
        "finish", "no_src", "src", "turn", "place", "rank").rowsBetween(
        W.unboundedPreceding, W.currentRow)
    return (
        passes.join(starts, "slot")
        .withColumn("offset", F.col("slot_start") + F.sum("words").over(inside) - F.col("words"))
        .withColumn("words", _clip(F.lit(budget) - F.col("offset"), F.col("words")))
        .drop("slot", "slot_start")
    )


def taken(docs: DataFrame, **options) -> DataFrame:
    """One row per document: sizes, target, and the words the mix takes from it."""
    mix = schedule(stored(sized(docs), "sizes"), **options)
    return mix.groupBy("src", "no_src", "range", "rank").agg(
        F.first("doc_id").alias("doc_id"), F.first("size").alias("size"),
        F.first("source_size").alias("source_size"), F.first("target").alias("target"),
        F.first("text_hash").alias("text_hash"), F.sum("words").alias("taken"),
    ).drop("range", "rank")


def _first_words(n: Column) -> Column:
    """The text up to its word ``n``, which is not its last, and the space after it."""
    parts = F.split("text", rf"(?<={WORD_PATTERN[:-1]})[\x20\x09-\x0D]+", n + 1)
    return F.substring(F.col("text"), F.lit(1), F.length("text") - F.length(F.element_at(parts, -1)))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """Documents as often as the mix takes them, the last time up to the words due; all columns kept.

    So the words of each source are those of ``taken``. Only ``text`` is ever cut. Rows that
    agree in ``doc_id``, source and text count as one that is taken for all.
    """
    names = fresh(docs, "id_", "src_", "no_src_", "hash_", "whole_", "rest_", "turn_")
    id_, src, no_src, hash_, whole, rest, turn = names
    group = stored(taken(docs, **options).groupBy("doc_id", "src", "no_src", "text_hash").agg(
        F.sum("taken").alias("taken"), F.first("size").alias("size"), F.count("*").alias("rows")
    ).filter("taken > 0"), "copies")
    renamed = group.select(
        F.col("doc_id").alias(id_), F.col("src").alias(src), F.col("no_src").alias(no_src),
        F.col("text_hash").alias(hash_), F.floor(F.col("taken") / F.col("size")).cast("int").alias(whole),
        (F.col("taken") % F.col("size")).cast("int").alias(rest), "rows")
    same = (
        (F.xxhash64(text_or_empty()) == F.col(hash_)) & F.col("doc_id").eqNullSafe(F.col(id_))
        & (F.coalesce("source", F.lit("")) == F.col(src)) & (F.col("source").isNull() == F.col(no_src)))
    once = docs.join(renamed.filter("rows = 1").drop("rows"), same)
    repeated = renamed.filter("rows > 1").drop("rows")
    if not repeated.isEmpty():
        once = once.unionByName(docs.join(repeated, same).dropDuplicates(names[:4]))
    last = F.when(F.col(rest) > 0, 1).otherwise(0)
    every = once.withColumn(turn, F.explode(F.sequence(F.lit(1), F.col(whole) + last)))
    text = F.when(F.col(turn) > F.col(whole), _first_words(F.col(rest))).otherwise(F.col("text"))
    return every.select(*[text.alias(c) if c.lower() == "text" else F.col(c) for c in docs.columns])
