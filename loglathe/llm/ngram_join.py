"""Near duplicates: documents whose sets of word shingles have a Jaccard similarity of 3/4.

Each set is named by a hash, so that copies are one class, and gives the keys of its parity
sketch (see ``parity``). Similar sets share a key. Not all pairs that share one are looked
at: classes that meet under a key are first linked with a few others there, in three
linear rounds; after that only classes of different components still matter. For these
the last round compares every pair that shares a key, by sizes and by parity bits
inside the join, so no link between components is lost. What may be similar by the parity
sketches is verified on the whole sets.

Cases: a null text or one without words has an empty set and is linked with nothing; fewer
words than a shingle are one shingle; a null ``doc_id`` never names a component, unless
all its documents have none. Repeated rows fall into one class. Hashes of shingles and sets
have 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loglathe.llm import parity, words
from loglathe.llm.common import discard, fresh, lean, stored, text_or_empty, together
from loglathe.llm.components import connected_components
from loglathe.operators.skew import fits_broadcast

# Documents whose keys say which contents are frequent: a share of all, and so many at least.
# This orders the keys and cannot change a result. FREQUENT bounds what is sent to all
# tasks: 16 bytes each.
SAMPLE_SHARE = 0.15
SAMPLE_LEAST = 10_000
FREQUENT = 500_000

_ROWS = pa.schema([
    ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_shingles", pa.int64()),
    ("class", pa.int64()), ("sketch", pa.binary()), ("folded", pa.list_(pa.int64())),
    ("keys", pa.list_(pa.int64())), ("lacking", pa.bool_())])
_DDL = ("doc_id bigint, text_hash bigint, n_shingles bigint, class bigint, sketch binary, "
        "folded array<bigint>, keys array<bigint>, lacking boolean")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"),
                       F.xxhash64(text_or_empty()).alias("text_hash"))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A few hundred rows at a time, so that what Python makes of them stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            yield batch.slice(start, 512)


def _sets(batches: Iterator[pa.RecordBatch]):
    """Pieces of batches with the shingle sets of their texts."""
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            rows = batch.slice(start, 512)
            for first, piece in words.chunks(rows.column(1).to_pylist()):
                hashes, counts, _ = words.word_hashes(piece)
                yield rows.slice(first, len(piece)), *parity.shingle_sets(hashes, counts)


def _sketched(value: np.ndarray, counts: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Sketches of sets, none for those that are empty, and folded ones."""
    whole, begin = parity.sketches(value, counts)
    none = pa.array(counts == 0)
    sketch = pa.Array.from_buffers(pa.binary(), len(counts), [
        None, pa.py_buffer(begin.astype(np.int32).tobytes()), pa.py_buffer(whole.tobytes())])
    folded = parity.folded_all(value, counts)
    offsets = np.arange(len(counts) + 1) * folded.shape[1]
    return (pc.if_else(none, None, sketch),
            pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(folded.ravel())))


def _described(order: parity.Order | None, fine_bands: tuple[int, ...] = ()):
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, value, counts in _sets(batches):
            names, sizes = parity.set_digest(value, counts).view(np.int64), counts
            if fine_bands:
                wanted = np.isin(parity.band_of(counts), fine_bands)
                value = value[np.repeat(wanted, counts)]
                counts = np.where(wanted, counts, 0)
            key, owner, lacking = parity.keys(value, counts, order, bool(fine_bands))
            by_owner = np.argsort(owner, kind="stable")
            offsets = np.append(0, np.cumsum(np.bincount(owner, minlength=len(counts))))
            lists = pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()), pa.array(key[by_owner].view(np.int64)))
            if order is None or fine_bands:
                # The keys alone are wanted.
                sketch, folded = (pa.nulls(len(counts), _ROWS.field(name).type) for name in ("sketch", "folded"))
            else:
                sketch, folded = _sketched(value, counts)
            yield pa.RecordBatch.from_arrays([
                rows.column(0), rows.column(2), pa.array(sizes, pa.int64()), pa.array(names), sketch, folded,
                lists, pa.array(np.isin(np.arange(len(counts)), lacking))], schema=_ROWS)

    return lean(describe)


def frequency_order(docs: DataFrame) -> parity.Order:
    """Which contents of blocks occur three times or more in a sample of documents."""
    rows = docs.count()
    share = max(SAMPLE_SHARE, SAMPLE_LEAST / max(rows, 1))
    part = docs.filter(F.pmod(F.xxhash64(F.lit("order"), "doc_id"), F.lit(1 << 20))
                       < int((1 << 20) * share))
    # A set has a key once, so copies are left out as a whole.
    sets = part.mapInArrow(_described(None), _DDL).filter("n_shingles > 0").select(
        "class", "keys").dropDuplicates(["class"])
    seen = sets.select(F.explode("keys").alias("key")).groupBy("key").count().filter("count >= 3").orderBy(
        F.desc("count"), "key").limit(FREQUENT).toArrow()
    return parity.Order(np.array(seen["key"].to_numpy(), np.int64).view(np.uint64),
                        np.array(seen["count"].to_numpy(), np.int64))


def described(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Name, size and sketches of every document's set (stored), and ``key, class`` rows."""
    texts = _texts(docs)
    order = frequency_order(texts)
    table = stored(texts.mapInArrow(_described(order), _DDL), "sets")
    key_rows = table.select(F.explode("keys").alias("key"), "class")
    bands = sorted(int(r[0]) for r in table.filter("lacking").select(
        F.floor(F.log2("n_shingles")).alias("b")).distinct().collect())
    if bands:
        # At most 64 bands exist. Sets too crowded for their blocks, and all they may meet,
        # also give finer keys, of which they never lack any.
        near = tuple(sorted({b + k for b in bands for k in (-1, 0, 1)}))
        finer = texts.mapInArrow(_described(order, near), _DDL)
        key_rows = key_rows.unionByName(finer.select(F.explode("keys").alias("key"), "class"))
    return table, key_rows


def _meetings(key_rows: DataFrame) -> DataFrame:
    """``key, class, previous``: the classes of every key that several classes have (stored)."""
    # Most keys have one class. A sort by key alone, which is fast, finds the others.
    own = W.partitionBy("key")
    several = key_rows.select("key", "class", F.min("class").over(own).alias("x"), F.max("class").over(own).alias("y")
                              ).filter("x <> y").select("key", "class")
    previous = F.lag("class").over(own.orderBy("class"))
    return stored(several.withColumn("previous", previous).filter("previous <> class"), "chain")


class _Linker:
    """Verified links so far, as the component of each class."""

    def __init__(self, docs: DataFrame, table: DataFrame):
        self.spark, self.texts = docs.sparkSession, _texts(docs)
        classes = table.filter("n_shingles > 0").groupBy("class").agg(
            F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"),
            F.first("folded").alias("folded"), F.min(F.struct("doc_id", "text_hash")).alias("row"))
        self.classes = stored(classes, "classes")
        self.components: DataFrame | None = None
        # Those of the first round.
        self.links: DataFrame | None = None
        self.scratch = [self.classes]
        self.few = True

    def named(self, members: DataFrame) -> DataFrame:
        """``members (key, class)`` with the component of each class."""
        if self.components is None:
            return members.withColumn("component", F.col("class"))
        names = self.components.withColumnRenamed("node", "class")
        return members.join(F.broadcast(names) if self.few else names, "class", "left"
                            ).withColumn("component", F.coalesce("component", "class"))

    def link(self, pairs: DataFrame) -> None:
        """Verify pairs ``(a, b)`` of classes and merge the components of those similar."""
        pairs = stored(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
                       "pairs")
        likely = stored(self._likely(*together(pairs)), "likely")
        discard(self.spark, pairs)
        if not likely.isEmpty():
            self._merge(self._similar(*together(likely)))
        discard(self.spark, likely)

    def _merge(self, found: DataFrame) -> None:
        edges, old = found, self.components
        if old is not None:
            edges = found.unionByName(old.select(F.col("node").alias("a"), F.col("component").alias("b")))
        contracted = connected_components(edges)
        self.components, self.few = together(stored(contracted, "components"))
        discard(self.spark, contracted)
        if old is None:
            self.links = together(found)[0]
            self.scratch.append(found)
        else:
            discard(self.spark, old, found)

    def _likely(self, pairs: DataFrame, few: bool) -> DataFrame:
        """Pairs whose sizes and sketches allow a similarity of 3/4."""
        one = self.classes.select(F.col("class").alias("a"), F.col("n").alias("n_a"),
                                  F.col("sketch").alias("sketch_a"))
        two = self.classes.select(F.col("class").alias("b"), F.col("n").alias("n_b"),
                                  F.col("sketch").alias("sketch_b"))
        pairs = F.broadcast(pairs) if few else pairs

        def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _slices(batches):
                rows = batch.to_pydict()
                keep = [7 * parity.hamming(x, y) <= n + m for x, y, n, m in zip(
                    rows["sketch_a"], rows["sketch_b"], rows["n_a"], rows["n_b"])]
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

        return one.join(pairs, "a").join(two, "b").filter(
            4 * F.least("n_a", "n_b") >= 3 * F.greatest("n_a", "n_b")
        ).select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b").mapInArrow(
            lean(near), "a bigint, b bigint")

    def _similar(self, pairs: DataFrame, few: bool) -> DataFrame:
        """Pairs with a Jaccard similarity of 3/4 or more, by the whole sets (stored)."""
        ends = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
        wanted = stored(self.classes.join(F.broadcast(ends) if few else ends, "class").select(
            "class", "row.doc_id", "row.text_hash"), "wanted")
        # Few rows meet all texts; beyond a measured size the texts are shuffled instead.
        side = F.broadcast(wanted) if fits_broadcast(wanted) else wanted
        texts = self.texts.alias("t").join(
            side.alias("w"), (F.col("t.text_hash") == F.col("w.text_hash"))
            & F.col("t.doc_id").eqNullSafe(F.col("w.doc_id"))).select(
            "w.class", "t.text", "t.text_hash").dropDuplicates(["class"])

        def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows, value, counts in _sets(batches):
                ends = np.cumsum(counts)
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(
                    [value[e - n:e].tobytes() for e, n in zip(ends, counts)], pa.binary())],
                    names=["class", "members"])

        sets = stored(texts.mapInArrow(lean(shingles), "class bigint, members binary"), "members")

        def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _slices(batches):
                keep = []
                for x, y in zip(batch.column("members_a"), batch.column("members_b")):
                    # Views of the batch, no copies.
                    x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * both >= 75 * (len(x) + len(y) - both))
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

        one = sets.select(F.col("class").alias("a"), F.col("members").alias("members_a"))
        two = sets.select(F.col("class").alias("b"), F.col("members").alias("members_b"))
        found = stored(one.join(F.broadcast(pairs) if few else pairs, "a").join(two, "b").select(
            "a", "b", "members_a", "members_b").mapInArrow(lean(similar), "a bigint, b bigint"), "links")
        discard(self.spark, wanted, sets)
        return found


def _mixed(linker: _Linker, members: DataFrame) -> tuple[DataFrame, bool]:
    """Members of those keys under which several components still meet (stored), and whether they are few.

    Of keys with the very same classes one stays: the others would only repeat its pairs.
    """
    named = linker.named(members)
    per_key = named.groupBy("key").agg(
        F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("rows"),
        F.bit_xor(F.xxhash64("class")).alias("one"), F.bit_xor(F.xxhash64(F.lit("other"), "class")).alias("two"))
    mixed = per_key.filter("x <> y").groupBy("rows", "one", "two").agg(F.min("key").alias("key"))
    return together(stored(named.join(mixed, "key", "left_semi"), "mixed"))


def _neighbours(mixed: DataFrame, salt: int) -> DataFrame:
    """Each class with the one before it under its key, in an order drawn by ``salt``."""
    order = W.partitionBy("key").orderBy(F.xxhash64("class", F.lit(salt)))
    return mixed.select(F.col("class").alias("b"), "component", F.lag("class").over(order).alias("a"),
                        F.lag("component").over(order).alias("other")
                        ).filter("other <> component").select("a", "b")


def _hubs(mixed: DataFrame, links: DataFrame) -> DataFrame:
    """Each class with the class of most links under its key."""
    degree = links.select(F.explode(F.array("a", "b")).alias("class")).groupBy("class").agg(
        F.count("*").alias("degree"))
    # Keys of many classes are few against all rows, and each is summed before it is sent.
    best = mixed.join(degree, "class").groupBy("key").agg(
        F.max(F.struct("degree", "class", "component")).alias("hub"))
    return mixed.join(best, "key").filter("hub.component <> component").select(
        F.col("hub.class").alias("a"), F.col("class").alias("b"))


def _across(mixed: DataFrame, linker: _Linker, few_rows: bool) -> DataFrame:
    """All pairs of different components under a key that sizes and sketches leave possible.

    Of two components one at least is not the key's largest, so only rows outside the
    largest component of a key meet all of the key's rows. Sketches are compared inside the
    join, in a fixed width, so that it gives few pairs but those worth verifying.
    """
    largest = mixed.groupBy("key", "component").agg(F.count("*").alias("rows")).groupBy("key").agg(
        F.max(F.struct("rows", "component")).alias("top")).select("key", "top.component")
    full = stored(linker.classes.select("class", "n", "folded").join(
        F.broadcast(mixed) if few_rows else mixed, "class"), "folded")
    linker.scratch.append(full)
    few = full.join(largest, ["key", "component"], "left_anti")
    x, y = few.alias("x"), full.alias("y")

    def apart(words: int):
        return sum((F.bit_count(F.col("x.folded")[k].bitwiseXOR(F.col("y.folded")[k]))
                    for k in range(words)), F.lit(0))

    # A part of the words already rules out most pairs.
    both = F.col("x.n") + F.col("y.n")
    possible = (
        (F.col("x.component") != F.col("y.component"))
        & (4 * F.least("x.n", "y.n") >= 3 * F.greatest("x.n", "y.n"))
        & (7 * apart(parity.FOLDED_BITS // 512) <= both) & (7 * apart(parity.FOLDED_BITS // 64) <= both))
    return x.join(y, (F.col("x.key") == F.col("y.key")) & possible).select(
        F.col("x.class").alias("a"), F.col("y.class").alias("b"))


def linked(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The described documents, and the component of every class that has a link."""
    spark = docs.sparkSession
    table, key_rows = described(docs)
    chain = _meetings(key_rows)
    linker = _Linker(docs, table)
    linker.link(chain.select(F.col("previous").alias("a"), F.col("class").alias("b")))
    last = chain
    members = chain.select("key", F.explode(F.array("previous", "class")).alias("class")).distinct()
    for propose in (lambda m: _hubs(m, linker.links) if linker.links is not None else _neighbours(m, 0),
                    lambda m: _neighbours(m, 1), lambda m: _neighbours(m, 2),
                    lambda m: _across(m, linker, few)):
        mixed, few = _mixed(linker, members)
        discard(spark, last)
        last = mixed
        if mixed.isEmpty():
            break
        linker.link(propose(mixed))
        # What a round no longer mixes, no later one does.
        members = mixed.select("key", "class")
    discard(spark, last, *linker.scratch)
    return table, linker.components


def components(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, text_hash, n_shingles, component_id``.

    ``component_id`` is the smallest ``doc_id`` that links lead to. ``first`` marks one row
    of each component (the first of those with this id), and every document without words.
    """
    table, found = linked(docs)
    table = table.select("doc_id", "text_hash", "n_shingles", "class")
    named = table.withColumn("component", F.col("class"))
    if found is not None:
        named = table.join(found.withColumnRenamed("node", "class"), "class", "left").withColumn(
            "component", F.coalesce("component", "class"))
    filled = named.filter("n_shingles > 0")
    # Stored apart, so that the join may split the rows of a large component over tasks.
    least = stored(filled.groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("least")), "least")
    with_words = filled.join(least, "component").select(
        "doc_id", "text_hash", "n_shingles", F.col("least.doc_id").alias("component_id"),
        (F.col("doc_id").eqNullSafe(F.col("least.doc_id"))
         & (F.col("text_hash") == F.col("least.text_hash"))).alias("first"))
    without = named.filter("n_shingles = 0").select(
        "doc_id", "text_hash", "n_shingles", F.col("doc_id").alias("component_id"),
        F.lit(True).alias("first"))
    return with_words.unionByName(without)


def keep_one(docs: DataFrame) -> DataFrame:
    """The first document of every component, with all its columns.

    Rows are told apart by ``doc_id`` and text; of rows that agree in both, where they are
    the first of a component, one stays.
    """
    id_, hash_ = fresh(docs, "kept_id", "kept_hash")
    kept = components(docs).filter("first").select(
        F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_), "n_shingles")
    # Only rows with words can be repeated in a component.
    counts = stored(kept.groupBy(id_, hash_).agg(
        F.count("*").alias("n"), F.max("n_shingles").alias("words")), "kept")
    condition = (F.xxhash64(text_or_empty()) == F.col(hash_)) & F.col("doc_id").cast(
        "long").eqNullSafe(F.col(id_))
    repeated = "n > 1 AND words > 0"
    out = docs.join(counts.filter(f"NOT ({repeated})"), condition, "left_semi")
    several = counts.filter(repeated)
    if several.isEmpty():
        return out
    again = docs.join(several.select(id_, hash_), condition).dropDuplicates([id_, hash_])
    return out.unionByName(again.select(*docs.columns))
