"""Hard negatives by a multiway hyperplane tree in the manner of GNAT.

For each anchor the closest rows of its own label are its positives. A row of another label
is a hard negative of an anchor and a positive where its score lies in a window below the
positive's score. Scores are inner products of integer vectors.

**Tree.** Rows are put on a sphere by one more coordinate, so that the distance from a
query to a row follows from their score alone, and a window of scores is an annulus around the
query. A node has several split points; every row goes to the nearest one (the
hyperplanes between split points part the space). The node keeps, per split point and
child, the least and the largest distance from that point to all rows below that child. A
query's annulus says how far from each split point a wanted row can be; a child whose
range misses that interval for any split point is left out with all below it.

**Work.** Split points come from at most about ``SAMPLE`` rows; ranges and counts cover all rows. Rows
lie in blocks of a leaf, and a leaf of many rows (copies, say) is dealt over as many parts as it
needs. Anchors are routed to the leaves they cannot do without, a few hundred in a pack; packs
meet blocks in one join, and each pair is one matrix product. The sample also gives every
anchor a first bound on what its best scores must reach, which narrows the annulus and the
rows reported per block. Nothing is approximate: only rows proven outside are left out.

Cases: rows without id, label or vector, or with a component that is null or not finite, take no
part. Of rows with the same id the one with the least label, then least vector, takes part. A vector shorter
than others counts as filled up with zeros. Ties go to the smaller id. An anchor without positives, and a
positive without negatives, give no rows, as does an empty table. Further columns, whatever their names,
are not looked at. Components saturate at 2 ** 31 after scaling. Scores are exact while squared lengths stay
below 2 ** 53; beyond, they wrap as 64-bit integers do, and no leaf is left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loglathe.llm.common import stored

SAMPLE = 16_384
FANOUT = 12
LEAF_ROWS = 1_024
MAX_LEAVES = 4_096
BLOCK_ROWS = 1_024
PACK_ROWS = 256
_SATURATED = 2.0 ** 31
_EXACT = 2.0 ** 53
# Allowance for rounding in distances, as a share of the sphere's radius.
_SLACK = 1e-6


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


@dataclass
class Node:
    """``children`` are nodes or leaf numbers; ``ranges[:, i, j]`` bounds the distances from split
    point ``i`` to all rows below child ``j``."""

    points: np.ndarray
    children: list[Node | int]
    number: int
    ranges: np.ndarray = field(init=False)

    def __post_init__(self):
        k = len(self.points)
        self.ranges = np.stack([np.full((k, k), np.inf), np.full((k, k), -np.inf)])


class Tree:
    def __init__(self, sample: np.ndarray, rows: int, fanout: int = FANOUT,
                 leaf_rows: int = LEAF_ROWS, max_leaves: int = MAX_LEAVES):
        self.nodes: list[Node] = []
        self.leaves = 0
        share = rows / max(1, len(sample))
        self.leaf_rows = max(leaf_rows, rows / max_leaves)
        self.fanout, self.share = fanout, share
        self.root = self._grown(sample)
        self.slack = _SLACK * float(np.sqrt((sample * sample).sum(1).max(initial=1)))

    def _grown(self, sample: np.ndarray) -> Node | int:
        points = self._apart(sample) if len(sample) * self.share > self.leaf_rows else sample[:0]
        if len(points) < 2:
            self.leaves += 1
            return self.leaves - 1
        node = Node(points, [], len(self.nodes))
        self.nodes.append(node)
        nearest = distances(sample, points).argmin(1)
        node.children = [self._grown(sample[nearest == j]) for j in range(len(points))]
        return node

    def _apart(self, sample: np.ndarray) -> np.ndarray:
        """Split points far from each other: each next one is the farthest of some candidates."""
        step = max(1, len(sample) // (4 * self.fanout))
        candidates = sample[::step]
        chosen = [0]
        away = distances(candidates, candidates[:1])[:, 0]
        while len(chosen) < self.fanout:
            far = int(away.argmax())
            if away[far] <= 0:
                break
            chosen.append(far)
            away = np.minimum(away, distances(candidates, candidates[far:far + 1])[:, 0])
        return candidates[chosen]

    def place(self, rows: np.ndarray, seen: Callable | None = None) -> np.ndarray:
        """The leaf of each row; ``seen(node, child, distances)`` hears of all on the way."""
        leaves = np.zeros(len(rows), np.int64)

        def down(node: Node | int, which: np.ndarray) -> None:
            if isinstance(node, int):
                leaves[which] = node
                return
            away = distances(rows[which], node.points)
            nearest = away.argmin(1)
            for j in np.unique(nearest):
                if seen:
                    seen(node, j, away[nearest == j])
                down(node.children[j], which[nearest == j])

        if len(rows):
            down(self.root, np.arange(len(rows)))
        return leaves

    def reached(self, queries: np.ndarray, near: np.ndarray, far: np.ndarray) -> np.ndarray:
        """Per query and leaf, whether the leaf may hold a row at a distance from ``near`` to
        ``far``. Both have a column per annulus; one that has ``far < near`` is empty."""
        out = np.zeros((len(queries), self.leaves), bool)

        def down(node: Node | int, which: np.ndarray, open_: np.ndarray) -> None:
            if isinstance(node, int):
                out[which, node] = True
                return
            away = distances(queries[which], node.points)[:, None, :]
            inner = np.maximum(away - far[which][:, :, None], near[which][:, :, None] - away)
            outer = away + far[which][:, :, None]
            low, high = node.ranges[0] - self.slack, node.ranges[1] + self.slack
            for j in range(len(node.points)):
                kept = open_ & ((inner <= high[:, j]) & (outer >= low[:, j])).all(2)
                some = kept.any(1)
                if some.any():
                    down(node.children[j], which[some], kept[some])

        open_ = near <= far
        some = np.flatnonzero(open_.any(1))
        if len(some):
            down(self.root, some, open_[some])
        return out


# -- rows as arrays ----------------------------------------------------------------

@dataclass
class Space:
    """What all tasks share: the tree, the sphere, the sample, and how many parts a leaf has."""

    dimension: int
    radius: float
    kind: str
    exact: bool
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    tree: Tree | None = None
    parts: np.ndarray | None = None

    def matrix(self, column: pa.ListArray) -> np.ndarray:
        """Integer vectors, short ones filled up with zeros."""
        ends = column.offsets.to_numpy()
        flat, sizes = column.values.to_numpy()[ends[0]:ends[-1]], np.diff(ends)
        if (sizes == self.dimension).all():
            return flat.reshape(len(column), self.dimension)
        out = np.zeros((len(column), self.dimension), np.int64)
        out[np.arange(self.dimension)[None, :] < sizes[:, None]] = flat
        return out

    def on_sphere(self, vectors: np.ndarray) -> np.ndarray:
        x = vectors.astype(np.float64)
        rest = np.sqrt(np.maximum(self.radius ** 2 - (x * x).sum(1), 0))
        return np.column_stack([x, rest])

    def as_query(self, vectors: np.ndarray) -> np.ndarray:
        return np.column_stack([vectors.astype(np.float64), np.zeros(len(vectors))])

    def scores(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if self.exact:
            return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
        return a.astype(np.int64) @ b.astype(np.int64).T

    def distance_of(self, queries: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """The distance at which a row of a given score lies (a column per score)."""
        square = (queries.astype(np.float64) ** 2).sum(1)[:, None] + self.radius ** 2 - 2.0 * scores
        return np.sqrt(np.maximum(square, 0))


def prepared(embeddings: DataFrame, scale: int) -> DataFrame:
    """``vec_id, label, v`` of the rows that take part."""
    def usable(x: Column) -> Column:
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    def scaled(x: Column) -> Column:
        x = x.cast("double") * scale
        return F.floor(F.greatest(F.least(x, F.lit(_SATURATED)), F.lit(-_SATURATED))).cast("bigint")

    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"),
                             F.col("label").cast("bigint").alias("label"), "embedding")
    rows = rows.filter("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").filter(
        F.forall("embedding", usable))
    rows = rows.select("vec_id", F.struct("label", F.transform("embedding", scaled).alias("v")).alias("row"))
    # Repeats of an id are merged before and after the shuffle.
    return rows.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.label", "row.v")


def _space(rows: DataFrame, sample: int, **tree_options) -> Space | None:
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    largest = F.coalesce(F.array_max(F.transform("v", F.abs)), F.lit(0))
    n, dimension, most, top = rows.agg(
        F.count("*"), F.max(F.size("v")), F.max(square), F.max(largest)).first()
    if not n:
        return None
    share = min(1.0, sample / n)
    picked = rows.filter(
        F.pmod(F.xxhash64(F.lit("gnat"), "vec_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    table = picked.orderBy("vec_id").toArrow().combine_chunks()
    kind = "<i2" if top < 2 ** 15 else "<i4" if top < 2 ** 31 else "<i8"
    space = Space(max(1, dimension), float(np.sqrt(most)), kind, most < _EXACT,
                  table.column("vec_id").to_numpy(), table.column("label").to_numpy(),
                  np.zeros((0, max(1, dimension)), np.int64))
    if table.num_rows:
        space.vectors = space.matrix(table.column("v").chunk(0)).astype(kind)
    space.tree = Tree(space.on_sphere(space.vectors), n, **tree_options)
    return space


def _measure(rows: DataFrame, space: Space, part_rows: int) -> None:
    """Ranges of every node and counts of every leaf, over all rows, into ``space``."""
    shared = rows.sparkSession.sparkContext.broadcast(space)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = shared.value
        tree, counts = space.tree, np.zeros(space.tree.leaves, np.int64)
        low = [node.ranges[0].copy() for node in tree.nodes]
        high = [node.ranges[1].copy() for node in tree.nodes]

        def seen(node, child, away):
            low[node.number][:, child] = np.minimum(low[node.number][:, child], away.min(0))
            high[node.number][:, child] = np.maximum(high[node.number][:, child], away.max(0))

        for batch in batches:
            leaves = tree.place(space.on_sphere(space.matrix(batch.column(0))), seen)
            counts += np.bincount(leaves, minlength=tree.leaves)
        out = [(-1, 0, int(j), 0.0, 0.0, int(counts[j])) for j in np.flatnonzero(counts)]
        for node in tree.nodes:
            for i, j in zip(*np.nonzero(np.isfinite(low[node.number]))):
                out.append((node.number, int(i), int(j), low[node.number][i, j],
                            high[node.number][i, j], 0))
        columns = list(zip(*out)) or [[]] * 6
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                         names=["node", "i", "j", "low", "high", "n"])

    found = rows.select("v").mapInArrow(
        run, "node int, i int, j int, low double, high double, n bigint").groupBy(
        "node", "i", "j").agg(F.min("low"), F.max("high"), F.sum("n")).toArrow()
    counts = np.zeros(space.tree.leaves, np.int64)
    for node, i, j, low, high, n in zip(*(c.to_pylist() for c in found.columns)):
        if node < 0:
            counts[j] = n
        else:
            space.tree.nodes[node].ranges[:, i, j] = low, high
    space.parts = np.ceil(counts / part_rows).astype(np.int64)
    shared.unpersist()


_BLOCK = "leaf int, part int, ids binary, labels binary, vectors binary"


def _blocks(rows: DataFrame, space: Space, block_rows: int) -> DataFrame:
    """All rows in blocks of at most ``block_rows``, by leaf and part."""
    shared = rows.sparkSession.sparkContext.broadcast(space)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, place = shared.value, None
        for batch in batches:
            vectors = space.matrix(batch.column(2))
            leaves = space.tree.place(space.on_sphere(vectors))
            parts = np.maximum(space.parts[leaves], 1)
            if place is None:
                # Rows of a leaf go round its parts, from a start that differs from task to task.
                place = np.full(space.tree.leaves, int(batch.column(0)[0].as_py()) % 997)
            order = np.argsort(leaves, kind="stable")
            first = np.searchsorted(leaves[order], leaves[order])
            turn = np.empty(len(leaves), np.int64)
            turn[order] = np.arange(len(leaves)) - first
            part = (place[leaves] + turn) % parts
            place += np.bincount(leaves, minlength=space.tree.leaves)
            packed = [v.tobytes() for v in vectors.astype(space.kind)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(leaves, pa.int32()), pa.array(part, pa.int32()), batch.column(0),
                 batch.column(1), pa.array(packed, pa.binary())],
                names=["leaf", "part", "vec_id", "label", "v"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, labels, vectors = None, [], [], []

        def block():
            row = [[key[0]], [key[1]], [np.array(ids, "<i8").tobytes()],
                   [np.array(labels, "<i8").tobytes()], [b"".join(vectors)]]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(row, (pa.int32(), pa.int32(), *[pa.binary()] * 3))],
                names=["leaf", "part", "ids", "labels", "vectors"])

        for batch in batches:
            for leaf, part, vec_id, label, v in zip(*(c.to_pylist() for c in batch.columns)):
                if ids and (key != (leaf, part) or len(ids) == block_rows):
                    yield block()
                    ids, labels, vectors = [], [], []
                key = (leaf, part)
                ids.append(vec_id)
                labels.append(label)
                vectors.append(v)
        if ids:
            yield block()

    return (
        rows.select("vec_id", "label", "v")
        .mapInArrow(dealt, "leaf int, part int, vec_id bigint, label bigint, v binary")
        .repartition("leaf", "part").sortWithinPartitions("leaf", "part", "vec_id")
        .mapInArrow(packed, _BLOCK)
    )


# -- searching ---------------------------------------------------------------------------

# A pack: anchors, and per anchor its windows of scores, the lower end narrowed (``low``,
# ``high``), and what the window belongs to (a positive, or nothing).
_PACK = ("leaf int, part int, a_ids binary, a_labels binary, a_vectors binary, low binary, "
         "high binary, of binary")


def _routed(anchors: DataFrame, space: Space, windows_of: Callable, width: int, wanted: int,
            same: bool) -> DataFrame:
    """Packs of anchors for every leaf and part they have to meet.

    ``anchors`` has ``vec_id, label, v`` and more, from which ``windows_of(batch, n)`` makes ``low``,
    ``high`` and ``of``, each with ``width`` columns. ``wanted`` rows are sought per window, of the same
    or of other labels.
    """
    shared = anchors.sparkSession.sparkContext.broadcast(space)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = shared.value
        for whole in batches:
            for start in range(0, whole.num_rows, PACK_ROWS):
                batch = whole.slice(start, PACK_ROWS)
                ids, labels = (batch.column(k).to_numpy() for k in (0, 1))
                vectors = space.matrix(batch.column(2))
                low, high, of = windows_of(batch, len(ids))
                low = _narrowed(space, ids, labels, vectors, low, high, wanted, same)
                leaves = _leaves_for(space, vectors, low, high)
                rows = []
                for leaf in np.flatnonzero(leaves.any(0)):
                    on = leaves[:, leaf]
                    fields = [ids[on].astype("<i8"), labels[on].astype("<i8"), vectors[on].astype(space.kind),
                              low[on].astype("<i8"), high[on].astype("<i8"), of[on].astype("<i8")]
                    content = [np.ascontiguousarray(f).tobytes() for f in fields]
                    rows += [(int(leaf), part, *content) for part in range(space.parts[leaf])]
                for at in range(0, len(rows), 64):
                    columns = zip(*rows[at:at + 64])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.int32(), *[pa.binary()] * 6))],
                        names=["leaf", "part", "a_ids", "a_labels", "a_vectors", "low", "high", "of"])

    return anchors.mapInArrow(run, _PACK)


def _narrowed(space: Space, ids, labels, vectors, low, high, wanted: int, same: bool) -> np.ndarray:
    """Lower ends raised to what the sample proves that the last wanted row reaches."""
    low = low.copy()
    if not len(space.ids):
        return low
    scores = space.scores(vectors, space.vectors)
    fit = (labels[:, None] == space.labels[None, :]) == same
    fit &= ids[:, None] != space.ids[None, :]
    for k in range(low.shape[1]):
        inside = fit & (scores >= low[:, k:k + 1]) & (scores <= high[:, k:k + 1])
        for i in np.flatnonzero(inside.sum(1) >= wanted):
            found = scores[i, inside[i]]
            low[i, k] = np.partition(found, len(found) - wanted)[len(found) - wanted]
    return low


def _leaves_for(space: Space, vectors, low, high) -> np.ndarray:
    some = low <= high
    if not space.exact:
        return np.repeat(some.any(1)[:, None], space.tree.leaves, 1)
    # High scores are near ones.
    near = np.where(some, space.distance_of(vectors, high.astype(np.float64)), np.inf)
    far = np.where(some, space.distance_of(vectors, low.astype(np.float64)), -np.inf)
    return space.tree.reached(space.as_query(vectors), near - space.tree.slack, far + space.tree.slack)


def _met(packs: DataFrame, blocks: DataFrame, space: Space, width: int, wanted: int,
         same: bool) -> DataFrame:
    """``anchor_id, of, vec_id, score``: per window and block the best rows inside the window."""
    small = Space(space.dimension, space.radius, space.kind, space.exact, space.ids[:0],
                  space.labels[:0], space.vectors[:0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                a_ids, a_labels, a, low, high, of, ids, labels, b = (
                    np.frombuffer(batch.column(k)[row].as_py(), t) for k, t in enumerate(
                        ("<i8", "<i8", small.kind, "<i8", "<i8", "<i8", "<i8", "<i8", small.kind)))
                scores = small.scores(a.reshape(len(a_ids), -1), b.reshape(len(ids), -1))
                low, high, of = (x.reshape(len(a_ids), width) for x in (low, high, of))
                fit = (a_labels[:, None] == labels[None, :]) == same
                fit &= a_ids[:, None] != ids[None, :]
                out = []
                for k in range(width):
                    inside = fit & (scores >= low[:, k:k + 1]) & (scores <= high[:, k:k + 1])
                    for i in np.flatnonzero(inside.any(1)):
                        at = np.flatnonzero(inside[i])
                        if len(at) > wanted:
                            at = at[np.lexsort((ids[at], -scores[i, at]))[:wanted]]
                        out.append((np.full(len(at), a_ids[i]), np.full(len(at), of[i, k]), ids[at],
                                    scores[i, at]))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(c), pa.int64()) for c in zip(*out)],
                        names=["anchor_id", "of", "vec_id", "score"])

    pairs = packs.join(blocks, ["leaf", "part"]).select(
        "a_ids", "a_labels", "a_vectors", "low", "high", "of", "ids", "labels", "vectors")
    return pairs.mapInArrow(run, "anchor_id bigint, of bigint, vec_id bigint, score bigint")


def _best(found: DataFrame, keys: list[str], wanted: int) -> DataFrame:
    order = W.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= wanted)


_OUT = ("anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, "
        "negative_score bigint")
_NO_LIMIT = 2 ** 62


def mine(embeddings: DataFrame, anchor: Column, positives: int = 5, negatives: int = 10,
         least: int = 30, most: int = 90, scale: int = 256, sample: int = SAMPLE,
         block_rows: int = BLOCK_ROWS, **tree_options) -> DataFrame:
    """Hard negatives of ``embeddings(vec_id, label, embedding)``.

    ``anchor`` is a condition on ``vec_id``. Per anchor the best ``positives`` rows of its label, and per
    anchor and positive the best ``negatives`` rows of other labels whose score is ``least`` to
    ``most`` hundredths of the positive's: ``anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score``. ``tree_options``: see ``Tree``.
    """
    spark = embeddings.sparkSession
    rows = stored(prepared(embeddings, scale), "vectors")
    space = _space(rows, sample, **tree_options)
    if space is None:
        return spark.createDataFrame([], _OUT)
    _measure(rows, space, block_rows)
    blocks = stored(_blocks(rows, space, block_rows), "vector-blocks")
    anchors = rows.filter(anchor).select("vec_id", "label", "v")

    def everything(batch, n):
        return np.full((n, 1), -_NO_LIMIT), np.full((n, 1), _NO_LIMIT), np.zeros((n, 1), np.int64)

    packs = _routed(anchors, space, everything, 1, positives, same=True)
    close = _best(_met(packs, blocks, space, 1, positives, same=True), ["anchor_id"], positives)
    close = stored(close.select("anchor_id", F.col("vec_id").alias("positive_id"),
                                F.col("score").alias("positive_score"), "rank"), "positives")

    def below_positives(batch, n):
        """A window per positive; the window names the positive by its rank."""
        low, high = np.ones((n, positives), np.int64), np.zeros((n, positives), np.int64)
        for i, found in enumerate(batch.column(3).to_pylist()):
            for p in found:
                # Whole scores s with least * score <= 100 * s <= most * score.
                low[i, p["rank"] - 1] = -(-least * p["positive_score"] // 100)
                high[i, p["rank"] - 1] = most * p["positive_score"] // 100
        return low, high, np.tile(np.arange(1, positives + 1), (n, 1))

    per_anchor = close.groupBy("anchor_id").agg(
        F.collect_list(F.struct("rank", "positive_score")).alias("found"))
    with_windows = anchors.join(per_anchor, anchors["vec_id"] == per_anchor["anchor_id"]).select(
        "vec_id", "label", "v", "found")
    packs = _routed(with_windows, space, below_positives, positives, negatives, same=False)
    hard = _best(_met(packs, blocks, space, positives, negatives, same=False), ["anchor_id", "of"],
                 negatives)
    named = close.select("anchor_id", F.col("rank").cast("bigint").alias("of"), "positive_id", "positive_score")
    return hard.join(named, ["anchor_id", "of"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
