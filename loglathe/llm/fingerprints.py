"""Document fingerprints from prefix polynomial hashes.

The prefix array of a text holds, for every position, a polynomial hash of all before it,
modulo two primes. The hash of any span is a difference of two entries, so equality of
spans takes constant time and the longest common extension of two positions a binary
search. A fingerprint is the text's length and its prefix array at two kinds of positions:
up to ``MARKS`` evenly spaced ones, and anchors chosen by content, ``ANCHORS`` or so, where
the hash of a window ends in enough zero bits. Two fingerprints are compared by longest
common extensions, in place on the coarser of their two grids, and at any offset from the
anchors that both texts have; the larger share counts. So text that is shifted or moved
still agrees.

Cases: a null text is empty, and two empty texts are alike (1.0). Documents follow each
other by ``doc_id``, nulls last; rows with the same id by text. A single document is its
own next one. An empty table gives an empty table.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglathe.llm.common import text_or_empty
from loglathe.llm.words import mix

# Two primes below 2 ** 31, so that products fit 64 bits, and a base for each.
MODULI = (2_147_483_647, 2_147_483_629)
BASES = (1_103_515_245, 1_664_525_013)
MARKS = 32
# Anchors of a text, at most twice as many on average, and code points of their windows.
ANCHORS = 64
WINDOW = 12
_SLICE_ROWS = 256

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(which: int, n: int) -> np.ndarray:
    """Powers 0 to n - 1 of a base, kept and doubled as texts get longer."""
    table, p = _powers[which], MODULI[which]
    while len(table) < n:
        step = np.uint64(pow(BASES[which], len(table), p))
        table = np.concatenate([table, table * step % np.uint64(p)])
    _powers[which] = table
    return table[:n]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)


def prefixes(codes: np.ndarray, start: int = 0) -> list[np.ndarray]:
    """Prefix arrays (one per modulus) of code points that begin at position ``start``."""
    arrays = []
    for which, p in enumerate(MODULI):
        terms = (codes + np.uint64(1)) * powers(which, start + len(codes))[start:] % np.uint64(p)
        # Fewer than 2 ** 33 terms below 2 ** 31 cannot overflow.
        arrays.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms)]) % np.uint64(p))
    return arrays


def span_hash(arrays: list[np.ndarray], start: int, end: int, at: int = 0) -> tuple[int, ...]:
    """Hash of a span, as if it began at position ``at`` (not before ``start``)."""
    return tuple(
        (int(a[end]) - int(a[start])) * pow(BASES[i], at - start, MODULI[i]) % MODULI[i]
        for i, a in enumerate(arrays))


def equal_spans(a, i: int, b, j: int, n: int) -> bool:
    """Whether n positions from i in one text equal those from j in the other."""
    at = max(i, j)
    return span_hash(a, i, i + n, at) == span_hash(b, j, j + n, at)


def longest_extension(a, i: int, b, j: int) -> int:
    """How far the texts agree from position i in one and j in the other."""
    low, high = 0, min(len(a[0]) - 1 - i, len(b[0]) - 1 - j)
    while low < high:
        middle = (low + high + 1) // 2
        if equal_spans(a, i, b, j, middle):
            low = middle
        else:
            high = middle - 1
    return low


def window_hashes(arrays: list[np.ndarray]) -> np.ndarray:
    """A hash of 32 bits of the window at every position that has a whole one."""
    n = len(arrays[0]) - 1
    if n < WINDOW:
        return np.zeros(0, np.uint64)
    p = np.uint64(MODULI[0])
    spans = (arrays[0][WINDOW:] + p - arrays[0][:-WINDOW]) % p
    # Moved to begin at one place: multiplied by what is missing to the power n.
    moved = spans * powers(0, n + 1)[n - np.arange(n - WINDOW + 1)] % p
    # That depends on n, so it is moved back.
    return mix(moved * np.uint64(pow(BASES[0], -n, MODULI[0])) % p) >> np.uint64(32)


def anchors_of(arrays: list[np.ndarray]) -> tuple[int, np.ndarray, np.ndarray, list[int]]:
    """Zero bits asked of a window, the anchors' window hashes and positions, prefix hashes.

    Of equal windows the first is an anchor, so that repetitive texts have few.
    """
    n = len(arrays[0]) - 1
    bits = max(0, (n // (2 * ANCHORS)).bit_length())
    hashes = window_hashes(arrays)
    at = np.flatnonzero((hashes & np.uint64((1 << bits) - 1)) == 0)
    _, first = np.unique(hashes[at], return_index=True)
    at = at[np.sort(first)]
    marks = (arrays[0][at] << np.uint64(32) | arrays[1][at]).tolist()
    return bits, hashes[at], at, marks


class Mark:
    """A fingerprint: the even grid and the anchors."""

    def __init__(self, arrays: list[np.ndarray]):
        self.grid = fingerprint(arrays)
        self.bits, self.windows, self.at, self.hashes = anchors_of(arrays)

    def __str__(self) -> str:
        packed = (self.windows.astype("<u4").tobytes() + self.at.astype("<u4").tobytes()
                  + np.array(self.hashes, "<u8").tobytes())
        return f"{as_text(self.grid)}:{self.bits}:{base64.b64encode(packed).decode()}"

    def coarse(self, bits: int) -> tuple[np.ndarray, list[int], list[int]]:
        """Windows, positions and prefix hashes of the anchors with so many zero bits, and the end."""
        kept = np.flatnonzero((self.windows & np.uint64((1 << bits) - 1)) == 0)
        end = self.grid[0]
        return (self.windows[kept], [*self.at[kept].tolist(), end],
                [*(self.hashes[k] for k in kept), self.grid[2][-1]])


def _same_span(a, b, i: int, j: int, t: int) -> bool:
    """Whether the texts agree from anchors i and j over t further anchors."""
    (_, at, x), (_, to, y) = a, b
    if at[i + t] - at[i] != to[j + t] - to[j]:
        return False
    shift = at[i] - to[j]
    one, other = _minus(x[i + t], x[i]), _minus(y[j + t], y[j])
    if shift < 0:
        one, other, shift = other, one, -shift
    return all(u == v * pow(base, shift, p) % p for u, v, base, p in zip(one, other, BASES, MODULI))


def moved_likeness(one: Mark, other: Mark) -> float:
    """Share of the longer text in stretches from a common anchor on, wherever they lie."""
    n, m = one.grid[0], other.grid[0]
    if n == m and one.grid[2][-1] == other.grid[2][-1]:
        return 1.0
    bits = max(one.bits, other.bits)
    a, b = one.coarse(bits), other.coarse(bits)
    _, mine, theirs = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    pairs = dict(zip(mine.tolist(), theirs.tolist()))
    same, i = 0, -1
    for start in sorted(pairs):
        if start < i:
            continue
        j = pairs[start]
        low, high = 0, min(len(a[1]) - 1 - start, len(b[1]) - 1 - j)
        while low < high:
            middle = (low + high + 1) // 2
            if _same_span(a, b, start, j, middle):
                low = middle
            else:
                high = middle - 1
        same += a[1][start + low] - a[1][start]
        i = start + low
    # Different texts are never quite alike, also if all of one is found in another order.
    return min(same, max(n, m) - 1) / max(n, m)


def step_of(n: int) -> int:
    """The grid of a text: the least power of two with at most ``MARKS`` steps."""
    step = 1
    while n > step * MARKS:
        step *= 2
    return step


def fingerprint(arrays: list[np.ndarray]) -> tuple[int, int, list[int]]:
    """Length, grid, and the combined prefix hashes at the grid and at the end."""
    n = len(arrays[0]) - 1
    step = step_of(n)
    at = np.append(np.arange(0, n + 1, step), n)
    return n, step, (arrays[0][at] << np.uint64(32) | arrays[1][at]).tolist()


def as_text(mark: tuple[int, int, list[int]]) -> str:
    return f"{mark[0]}:{mark[1]}:" + "".join(f"{h:016x}" for h in mark[2][1:])


def _minus(x: int, y: int) -> tuple[int, int]:
    return ((x >> 32) - (y >> 32)) % MODULI[0], ((x & 0xFFFFFFFF) - (y & 0xFFFFFFFF)) % MODULI[1]


def likeness(one: tuple[int, int, list[int]], other: tuple[int, int, list[int]]) -> float:
    """Share of the longer text that agrees in place, as far as the common grid shows."""
    (n, step, a), (m, other_step, b) = one, other
    if n == m and a[-1] == b[-1]:
        return 1.0
    grid = max(step, other_step)
    a, b = a[:-1:grid // step], b[:-1:grid // other_step]
    # The prefixes' difference is the same at both ends of a span that agrees.
    apart = [_minus(x, y) for x, y in zip(a, b)]
    same, i, last = 0, 0, len(apart) - 1
    while i < last:
        low, high = i, last
        while low < high:
            middle = (low + high + 1) // 2
            # Agreement up to here; the search assumes that it does not come back by chance.
            if apart[middle] == apart[i]:
                low = middle
            else:
                high = middle - 1
        same += low - i
        # Behind the part that agrees there is one step that does not.
        i = low + 1
    return same * grid / max(n, m)


def alike(one: Mark, other: Mark) -> float:
    """Likeness in place or at any offset, whichever shows more."""
    return max(likeness(one.grid, other.grid), moved_likeness(one, other))


def edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


class _Document:
    def __init__(self, doc_id, text: str):
        self.doc_id, self.text = doc_id, text
        self.codes = code_points(text)
        self.arrays = prefixes(self.codes)
        self.mark = Mark(self.arrays)

    def before(self, following: "_Document") -> tuple:
        text = edited(self.text, following.text)
        keep = len(self.text) - len(self.text) // 2
        tail = prefixes(following.codes[:len(self.text) // 2], keep)
        arrays = [np.concatenate([a[:keep + 1], (t[1:] + a[keep]) % np.uint64(p)])
                  for a, t, p in zip(self.arrays, tail, MODULI)]
        mark = Mark(arrays)
        return (self.doc_id, len(self.text), hashlib.sha256(text.encode()).hexdigest(),
                str(self.mark), str(mark), alike(self.mark, mark), alike(self.mark, following.mark))


COLUMNS = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
           "edited_fingerprint string, near_edited double, near_next double")
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                    ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                    ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one range in order, then the first row of the next range as a guard."""
    held, rows, ended = None, [], False
    for batch in batches:
        for start in range(0, batch.num_rows, _SLICE_ROWS):
            piece = batch.slice(start, _SLICE_ROWS)
            for doc_id, text, guard in zip(*(piece.column(k).to_pylist() for k in range(3))):
                if ended:
                    continue
                document = _Document(doc_id, text)
                if held is not None:
                    rows.append(held.before(document))
                held, ended = document, guard
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)
                rows = []


def in_ranges(docs: DataFrame) -> DataFrame:
    """``doc_id, text, guard``: ranges of ids, one per partition, each in order.

    Behind each range comes, as a guard, the first row of the range that follows, so no
    partition needs another's rows. Only one split value and one first id per range reach
    the driver.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select(F.col("doc_id").cast("double").alias("id"))
    cuts = ids.approxQuantile("id", [i / parts for i in range(1, parts)], 0.05 / parts) if (
        parts > 1) else []
    cuts = sorted(set(cuts))
    texts = docs.select("doc_id", text_or_empty().alias("text"),
                        F.coalesce(F.col("doc_id").cast("double"), F.lit(float("nan"))).alias("id"))
    if cuts:
        # A null id goes to the bucket behind all others.
        texts = Bucketizer(splits=[float("-inf"), *cuts, float("inf")], inputCol="id", outputCol="range",
                           handleInvalid="keep").transform(texts)
    else:
        texts = texts.withColumn("range", F.isnan("id").cast("int"))
    ranged = texts.select("doc_id", "text", F.col("range").cast("int").alias("range"))
    firsts = sorted(tuple(r) for r in ranged.groupBy("range").agg(F.min("doc_id")).collect())
    if not firsts:
        return ranged.select("doc_id", "text", F.lit(False).alias("guard"))
    before = [(r, first, firsts[k - 1][0]) for k, (r, first) in enumerate(firsts)]
    guards = F.broadcast(spark.createDataFrame(before, "first_range int, first bigint, before int"))
    sent = F.explode(F.when(F.col("before").isNull(), F.array(F.struct(
        F.col("range").alias("part"), F.lit(False).alias("guard")))).otherwise(F.array(
            F.struct(F.col("range").alias("part"), F.lit(False).alias("guard")),
            F.struct(F.col("before").alias("part"), F.lit(True).alias("guard")))))
    return (
        ranged.join(guards, (F.col("range") == F.col("first_range"))
                    & F.col("doc_id").eqNullSafe(F.col("first")), "left")
        .select("doc_id", "text", sent.alias("to"))
        .select("doc_id", "text", "to.*")
        .repartitionById(len(cuts) + 2, F.col("part"))
        .sortWithinPartitions("guard", F.col("doc_id").asc_nulls_last(), "text")
        .select("doc_id", "text", "guard")
    )


def compare_neighbours(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are."""
    return in_ranges(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).mapInArrow(
        _compare, COLUMNS)
