"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the only examples with a class. Everything else is unlabelled: it
holds toxic texts too, in a share that is known, the *class prior*. Taking unlabelled for
clean would teach the classifier to excuse the toxic ones among them, so the risk of the
clean class is estimated without any clean example: the risk of calling all texts clean,
less the prior times the risk of calling the toxic ones clean. That difference cannot be
negative in truth; where the estimate falls below zero, the classifier has begun to learn
its examples by heart, and the step goes back up instead.

The classifier is logistic over the presence of hashed character grams. All of it runs
over whole texts and all rows, in passes whose results are sums:

1. grams of the confirmed texts, then how many unlabelled texts have these grams;
2. every text as the numbers of its significant grams, stored once, without the text;
3. per step, both gradients and risks as sums over that small table.

Only per-gram sums reach the driver, at most ``2 ** BITS`` of them, whatever the corpus.
Nothing is sampled.

Inputs of a score are the text alone. Cases: a null text is empty and has a score like any
other; labels without ``doc_id`` or ``toxic`` are ignored, and several of one document count
as the worst; labels without a document count for the prior only. Without confirmed texts every score is the prior,
and 0 without any label. Texts of any length are read whole, in slices of ``SLICE_BYTES``.
Equal texts get equal scores, so ties and repeated rows need no rule. An empty table gives an empty
table. Columns of other names are kept or left out as each function says.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loglathe.llm.common import fresh, stored, text_or_empty
from loglathe.operators.skew import attach_by_key, fits_broadcast

BITS = 20
GRAM_BYTES = 5
# Grams of so many confirmed texts, that are LIFT times as frequent there as in all texts (or as
# rare), by so many standard errors, make up the classifier, the most significant ones if there are
# more. Without the factor a large corpus would make ever smaller differences count.
MIN_CONFIRMED = 5
LIFT = 2.0
SIGNIFICANT = 5.0
WIDTH = 1 << 14
STEPS, RATE, DECAY = 30, 0.2, 1e-5
THRESHOLD = 0.7
# A table of ids is broadcast below both bounds.
BROADCAST_ROWS, BROADCAST_BYTES = 2_000_000, 64 << 20
SLICE_BYTES = 1 << 16
_SLICE_ROWS = 512
_WORD = re.compile(r"\w+")
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0x100000001B3)


def grams(text: str) -> np.ndarray:
    """The distinct hashed grams of a text, ascending.

    Grams are runs of bytes over lower-case words with single spaces between and around.
    """
    codes = np.frombuffer(f" {' '.join(_WORD.findall(text.lower()))} ".encode(), np.uint8)
    found = []
    for start in range(0, max(1, len(codes) - GRAM_BYTES + 1), SLICE_BYTES):
        piece = codes[start:start + SLICE_BYTES + GRAM_BYTES - 1].astype(np.uint64)
        n = len(piece) - GRAM_BYTES + 1
        if n <= 0:
            break
        value = np.zeros(n, np.uint64)
        for k in range(GRAM_BYTES):
            value = (value ^ piece[k:k + n]) * _STEP
        found.append(np.unique(value * _FACTOR >> np.uint64(64 - BITS)))
    if not found:
        return np.zeros(0, np.int64)
    return (found[0] if len(found) == 1 else np.unique(np.concatenate(found))).astype(np.int64)


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


@dataclass
class Model:
    """``grams`` (ascending) are what the classifier knows, with ``weights``, the constant last."""

    grams: np.ndarray
    weights: np.ndarray
    constant: float | None = None

    def numbers(self, text: str) -> np.ndarray:
        """Which of the known grams a text has."""
        return numbers(text, self.grams)

    def score(self, text: str) -> float:
        if self.constant is not None:
            return self.constant
        return float(sigmoid(self.weights[self.numbers(text)].sum() + self.weights[-1]))


def numbers(text: str, known: np.ndarray) -> np.ndarray:
    found = grams(text)
    at = np.searchsorted(known, found)
    at[at == len(known)] = 0
    return at[known[at] == found] if len(known) else at[:0]


# -- counting grams ------------------------------------------------------------

def _counted(texts: DataFrame, wanted: np.ndarray | None = None) -> DataFrame:
    """``gram, n``: in how many texts a gram is; only ``wanted`` grams if given."""
    only = None
    if wanted is not None:
        mask = np.zeros(1 << BITS, bool)
        mask[wanted] = True
        only = texts.sparkSession.sparkContext.broadcast(np.packbits(mask))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << BITS, np.int64)
        for batch in batches:
            for text in _texts(batch.column(0)):
                counts[grams(text)] += 1
        if only is not None:
            counts[~np.unpackbits(only.value).astype(bool)] = 0
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen, pa.int64()), pa.array(counts[seen], pa.int64())], names=["gram", "n"])

    return texts.mapInArrow(run, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))


def _texts(column: pa.Array) -> Iterator[str]:
    for start in range(0, len(column), _SLICE_ROWS):
        yield from column.slice(start, _SLICE_ROWS).to_pylist()


def _collected(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """At most ``2 ** BITS`` pairs of numbers."""
    table = counts.toArrow()
    gram, n = (table.column(k).to_numpy() for k in (0, 1))
    order = np.argsort(gram)
    return gram[order], n[order]


def significant(confirmed: np.ndarray, all_: np.ndarray, n_confirmed: int, n_all: int) -> np.ndarray:
    """Standard errors between the share of confirmed texts and of all texts with a gram."""
    share = (confirmed + all_) / (n_confirmed + n_all)
    error = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / n_confirmed + 1 / n_all))
    return np.abs(confirmed / n_confirmed - all_ / n_all) / error


# -- learning -------------------------------------------------------------------

def encoded(docs: DataFrame, known: np.ndarray) -> DataFrame:
    """The columns before ``text`` and, in its place, ``numbers`` of its known grams."""
    shared = docs.sparkSession.sparkContext.broadcast(known)
    kept = docs.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _SLICE_ROWS):
                piece = batch.slice(start, _SLICE_ROWS)
                rows = [numbers(text, shared.value).astype(np.int32)
                        for text in piece.column(len(kept)).to_pylist()]
                ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(
                    pa.array(ends, pa.int32()), pa.array(np.concatenate(rows), pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns[:-1], lists], names=[*kept, "numbers"])

    schema = T.StructType([*docs.schema.fields[:-1],
                           T.StructField("numbers", T.ArrayType(T.IntegerType()))])
    return docs.mapInArrow(run, schema)


def _logits(lists: pa.ListArray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logit per row, and the number and row of every gram."""
    ends = lists.offsets.to_numpy()
    flat = lists.values.to_numpy()[ends[0]:ends[-1]]
    rows = np.repeat(np.arange(len(lists)), np.diff(ends))
    return np.bincount(rows, weights[flat], len(lists)) + weights[-1], flat, rows


# Numbers behind the constant's: risks of confirmed texts called toxic and clean, of all called clean.
_TOXIC, _CLEAN, _ALL = 1, 2, 3


def sums(rows: DataFrame, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Over ``confirmed, numbers``: the gradient of the clean risk summed over confirmed rows and
    over all rows, and the three risks summed."""
    shared = rows.sparkSession.sparkContext.broadcast(weights)
    width = len(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, width + 3))
        for batch in batches:
            confirmed = batch.column(0).to_numpy(zero_copy_only=False).astype(bool)
            z, flat, at = _logits(batch.column(1), shared.value)
            slope = sigmoid(z)
            for k, part in enumerate((confirmed, np.ones(len(z), bool))):
                total[k, :width - 1] += np.bincount(flat, (slope * part)[at], width - 1)
                total[k, width - 1] += slope[part].sum()
            total[0, width - 1 + _TOXIC] += _softplus(-z[confirmed]).sum()
            total[0, width - 1 + _CLEAN] += _softplus(z[confirmed]).sum()
            total[0, width - 1 + _ALL] += _softplus(z).sum()
        seen = np.flatnonzero(total.any(0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen, pa.int64()), pa.array(total[0, seen]), pa.array(total[1, seen])],
            names=["number", "confirmed", "every"])

    table = rows.mapInArrow(run, "number bigint, confirmed double, every double").groupBy(
        "number").agg(F.sum("confirmed"), F.sum("every")).toArrow()
    total = np.zeros((2, width + 3))
    at = table.column(0).to_numpy()
    total[0, at], total[1, at] = table.column(1).to_numpy(), table.column(2).to_numpy()
    shared.unpersist()
    return total[0, :width], total[1, :width], total[0, width:]


def direction(confirmed: np.ndarray, every: np.ndarray, risks: np.ndarray, mean: np.ndarray,
              n_confirmed: int, n_all: int, prior: float) -> np.ndarray:
    """The gradient of the non-negative risk; ``mean``: how often confirmed rows have a gram."""
    clean = every / n_all - prior * confirmed / n_confirmed
    if risks[_ALL - 1] / n_all - prior * risks[_CLEAN - 1] / n_confirmed < 0:
        return -clean
    toxic = confirmed / n_confirmed - mean
    return prior * toxic + clean


def learn(rows: DataFrame, width: int, mean: np.ndarray, n_confirmed: int, n_all: int, prior: float,
          steps: int = STEPS) -> np.ndarray:
    """Weights after ``steps`` full steps (Adam) over ``confirmed, numbers``."""
    w = np.zeros(width + 1)
    w[-1] = np.log(prior / (1 - prior))
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        gradient = direction(*sums(rows, w), mean, n_confirmed, n_all, prior)
        gradient[:-1] += DECAY * w[:-1]
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient ** 2
        # Shorter and shorter steps: the risk turns back and forth where it meets zero.
        rate = RATE * (1 - (step - 1) / steps)
        w -= rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
    return w


def _marks(labels: DataFrame) -> DataFrame:
    return labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))


def _with_flags(docs: DataFrame, confirmed_ids: DataFrame, learn_from: Column) -> DataFrame:
    """``doc_id, learning, confirmed, text``."""
    ids = confirmed_ids.withColumn("confirmed", F.lit(True))
    small = fits_broadcast(ids, BROADCAST_ROWS, BROADCAST_BYTES)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return attach_by_key(rows, ids, "doc_id", small).select(
        "doc_id", F.coalesce(learn_from, F.lit(True)).alias("learning"),
        (F.coalesce("confirmed", F.lit(False)) & F.coalesce(learn_from, F.lit(True))).alias("confirmed"), "text")


def fit(docs: DataFrame, labels: DataFrame, learn_from: Column | None = None,
        prior: float | None = None, steps: int = STEPS) -> tuple[Model, DataFrame | None]:
    """A model, and all documents as ``doc_id, learning, confirmed, numbers`` (None if the model is
    a constant).

    ``learn_from`` is a condition on ``doc_id``: neither labels nor texts of other rows are
    learned from. ``prior`` is the share of toxic texts; default: among labelled rows.
    """
    learn_from = F.lit(True) if learn_from is None else learn_from
    marks = stored(_marks(labels).filter(F.coalesce(learn_from, F.lit(True))), "toxic-labels")
    share = marks.agg(F.avg("toxic")).first()[0]
    prior = share if prior is None else prior
    rows = _with_flags(docs, marks.filter("toxic = 1").select("doc_id"), learn_from)
    n_all, n_confirmed = rows.filter("learning").agg(
        F.count("*"), F.count_if("confirmed")).first()
    nothing = np.zeros(0, np.int64)
    if not n_confirmed or not prior:
        return Model(nothing, np.zeros(1), float(prior or 0)), None
    prior = min(max(float(prior), 1e-6), 1 - 1e-6)
    texts = rows.filter("learning")
    gram, n = _collected(_counted(texts.filter("confirmed").select("text")).filter(
        F.col("n") >= MIN_CONFIRMED))
    at, all_ = _collected(_counted(texts.select("text"), gram))
    # Each such gram is in all texts as well, so both lists agree.
    lift = np.log(n / n_confirmed) - np.log(all_ / n_all)
    apart = np.where(np.abs(lift) >= np.log(LIFT), significant(n, all_, n_confirmed, n_all), 0)
    best = np.argsort(-apart, kind="stable")[:WIDTH]
    best = np.sort(best[apart[best] >= SIGNIFICANT])
    known, mean = at[best], np.append(n[best], n_confirmed) / n_confirmed
    table = stored(encoded(rows, known), "toxic-grams")
    # Each task of a step gives a number per gram, so a step takes no more tasks than run at once.
    rows = table.filter("learning").select("confirmed", "numbers").coalesce(
        docs.sparkSession.sparkContext.defaultParallelism)
    weights = learn(rows, len(known), mean,
                    n_confirmed, n_all, prior, steps)
    return Model(known, weights), table


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score of its text; a name taken already gets underscores."""
    name, argument = fresh(docs, name, "argument")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _SLICE_ROWS):
                piece = batch.slice(start, _SLICE_ROWS)
                scores = [shared.value.score(text) for text in piece.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns[1:], pa.array(scores, pa.float64())], names=[*kept, name])

    kept = docs.columns
    return docs.select(F.coalesce(docs["text"], F.lit("")).alias(argument), *[docs[c] for c in kept]).mapInArrow(
        run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def _scored(table: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` from the numbers of known grams."""
    shared = table.sparkSession.sparkContext.broadcast(model.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = _logits(batch.column(1), shared.value)[0]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sigmoid(z))], names=["doc_id", "score"])

    return table.select("doc_id", "numbers").mapInArrow(run, "doc_id bigint, score double")


def judge(docs: DataFrame, labels: DataFrame, learn_from: Column | None = None,
          prior: float | None = None, threshold: float = THRESHOLD, steps: int = STEPS) -> DataFrame:
    """``doc_id, score, predicted`` (1 from ``threshold`` on)."""
    model, table = fit(docs, labels, learn_from, prior, steps)
    if table is None:
        found = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                            F.lit(model.constant).alias("score"))
    else:
        found = _scored(table, model)
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
