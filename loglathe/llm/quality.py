"""Document quality by co-training two views.

One view sees the words of a text, the other its metadata: source, language, length and
the make-up of lines and characters. Both are logistic regressions on labelled rows. Then
the views exchange labels over some rounds: each labels those of all other rows it is sure
of, and the other view learns from them; how sure it must be shows on labelled rows kept
aside. At last each view is calibrated on those, and a regression on the calibrated views
scores every document.

The fit takes at most about ``LABELLED`` labelled rows, chosen by a hash of ``doc_id``, one for each
``doc_id``; every other row of the corpus takes part in every round. Words are hashed to ``WIDTH``
columns, so what the driver holds besides the labelled rows' column numbers has one bound at any
size. A round is one pass: rows give their pseudo-labels as sums per column and class, namely of
the slope of the loss and of a bound of its curvature, at the weights the round began with. These
describe a parabola above the loss of the pseudo-labels, which is added to the loss of the labels;
pseudo-labels of a class weigh like labels each, and together as much as the labels of that class
at most. Sums are of whole numbers, so they depend on no order. All documents are then
scored over their whole text, in one pass without a shuffle.

A document is good when its quality is 1 and it is not toxic. Several labels of one
document count as the worst. Cases: a null text is empty; null source or language is a
value of its own; labels without ``doc_id``, quality or document are ignored (a null toxic
counts as 0). With no labels, or labels of one class only, every score is that class's
share, or 1 without any labels; an empty table gives an empty table. Where every row is labelled
and chosen there is nothing to exchange. Texts may have any length. Repeated rows get equal
scores; rows that tie in certainty are all handed over. Further columns, of any name, are kept by
``keep_good`` and left out by ``judge``.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loglathe.llm.common import discard, fresh, lean, stored

LABELLED = 12_000
# Columns that words are hashed to.
WIDTH = 1 << 18
MIN_DOCUMENTS = 5
ROUNDS = 3
# A view hands over labels that were right this often on the rows kept aside, and only words
# whose use differs between the classes by so many standard errors enter the text view.
SURE = 0.97
SIGNIFICANT = 3.0
# Among pseudo-labels, which may be any number, a word must also be so much more frequent in one class.
TIMES = 2.0
KEEP = 0.5
_SLICE_ROWS = 256
_ROUND_ROWS = 2048
# Words whose column a task remembers.
_REMEMBERED = 1 << 17
# Units of residuals and metadata in sums of whole numbers.
_UNIT = 1 << 12
_META_UNIT = 1 << 8
_TOKEN = re.compile(r"\w+|[^\w\s]+")
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_SIGN = np.zeros(256, bool)
_SIGN[33:127] = True
_SIGN[48:58] = _SIGN[65:91] = _SIGN[97:123] = False


def tokens(text: str) -> list[str]:
    return _TOKEN.findall(text.lower())


class Columns(dict):
    """The column of each word."""

    def __missing__(self, word: str) -> int:
        if len(self) >= _REMEMBERED:
            self.clear()
        at = self[word] = zlib.crc32(word.encode()) % WIDTH
        return at

    def of(self, distinct: set[str]) -> np.ndarray:
        return np.unique(np.fromiter(map(self.__getitem__, distinct), np.int32, len(distinct)))


def shape(text: str, words: list[str], distinct: int) -> list[float]:
    """Numbers about the make-up of a text."""
    counts = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256)
    size = max(1, int(counts.sum()))
    lines = text.count("\n") + 1
    n = max(1, len(words))
    return [np.log1p(len(text)), np.log1p(lines), np.log1p(len(text) / lines), np.log1p(len(words)),
            counts[_UPPER].sum() / size, counts[_DIGIT].sum() / size, counts[_SPACE].sum() / size,
            counts[_SIGN].sum() / size, distinct / n, np.log1p(len(text) / n),
            np.log(distinct + 1) / np.log(n + 2)]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


class Sparse:
    """Rows of column numbers, each present or absent."""

    def __init__(self, rows: list[np.ndarray], width: int):
        self.width, self.sizes = width, np.array([len(r) for r in rows], np.int64)
        self.columns = np.concatenate([*rows, np.zeros(0, np.int32)])
        self.rows = np.repeat(np.arange(len(rows)), self.sizes)

    def only(self, used: np.ndarray) -> Sparse:
        """The same rows, of the columns in ``used`` (ascending) alone, numbered anew."""
        at = np.full(self.width, -1)
        at[used] = np.arange(len(used))
        found, out = at[self.columns], Sparse([], len(used))
        out.sizes, out.columns, out.rows = self.sizes, found[found >= 0], self.rows[found >= 0]
        return out

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, weights[self.columns], len(self.sizes))

    def summed(self, residual: np.ndarray) -> np.ndarray:
        return np.bincount(self.columns, residual[self.rows], self.width)


class Dense:
    def __init__(self, values: np.ndarray):
        self.values, self.width = values, values.shape[1]

    def times(self, weights):
        return self.values @ weights

    def summed(self, residual):
        return self.values.T @ residual


class Parabola:
    """A bound of a loss from above: exact in value and slope at the weights ``at``."""

    def __init__(self, at: np.ndarray, slope: np.ndarray, curve: np.ndarray):
        self.at, self.slope, self.curve = at, slope, curve

    def only(self, used: np.ndarray) -> Parabola:
        return Parabola(self.at[used], self.slope[used], self.curve[used])


def logistic(x, target: np.ndarray, weight: np.ndarray, decay: float, steps: int = 120,
             rate: float = 0.1, also: Parabola | None = None) -> np.ndarray:
    """Weights of a regularised logistic regression, the constant last, by Adam."""
    w = np.zeros(x.width + 1) if also is None else also.at.copy()
    first, second = np.zeros_like(w), np.zeros_like(w)
    weight = weight / max(weight.sum(), 1e-9)
    for step in range(1, steps + 1):
        residual = weight * (_sigmoid(x.times(w[:-1]) + w[-1]) - target)
        gradient = np.append(x.summed(residual) + decay * w[:-1], residual.sum())
        if also is not None:
            gradient += also.slope + also.curve * (w - also.at)
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient ** 2
        w -= rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
    return w


def _sure_from(certain: np.ndarray, right: np.ndarray) -> float:
    """The least certainty from which on labels are right often enough."""
    order = np.argsort(-certain, kind="stable")
    share = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
    enough = np.flatnonzero((share >= SURE) & (np.arange(len(order)) >= 9))
    return float(certain[order[enough[-1]]]) if len(enough) else np.inf


class Model:
    """What the fit leaves: a weight per column of words, and those of the metadata."""

    def __init__(self, rows: list[dict]):
        """``rows``: ``words`` (columns, ascending), ``shape``, ``source``, ``lang``, ``good``."""
        labels = [r["good"] for r in rows]
        self.constant: float | None = None
        # Pseudo-labels handed over per round: by the metadata and by the text, bad and good ones.
        self.handed: list[list[list[int]]] = []
        if len(set(labels)) < 2:
            self.constant = float(labels[0]) if labels else 1.0
            return
        named = Counter((k, r[k]) for r in rows for k in ("source", "lang"))
        self.names = {name: i for i, name in enumerate(sorted(
            (n for n, count in named.items() if count >= MIN_DOCUMENTS), key=repr))}
        raw = np.array([r["shape"] for r in rows])
        self.mean, self.scale = raw.mean(0), raw.std(0) + 1e-6
        # Every fifth labelled row is kept aside for calibration.
        parts = rows[::5], [r for k, r in enumerate(rows) if k % 5]
        (self._aside, self._base), (self._tried, self._target) = (
            [self.matrices(part) for part in parts],
            [np.array([float(r["good"]) for r in part]) for part in parts])
        self._fit_views(None, None, None)

    def matrices(self, rows: list[dict]) -> tuple[Sparse, Dense]:
        return (Sparse([r["words"] for r in rows], WIDTH),
                Dense(self.metadata(np.array([r["shape"] for r in rows]), [r["source"] for r in rows],
                                    [r["lang"] for r in rows])))

    def metadata(self, shapes: np.ndarray, sources: list, langs: list) -> np.ndarray:
        x = np.clip((shapes.reshape(-1, len(self.mean)) - self.mean) / self.scale, -8, 8)
        named = np.zeros((len(x), len(self.names)))
        for kind, values in (("source", sources), ("lang", langs)):
            at = np.array([self.names.get((kind, v), -1) for v in values], np.int64)
            known = np.flatnonzero(at >= 0)
            named[known, at[known]] = 1
        # In units of the sums, so that a row is the same wherever it is seen.
        return np.rint(np.concatenate([x, x * x / 4, named], 1) * _META_UNIT) / _META_UNIT

    def logits(self, x: tuple[Sparse, Dense]) -> list[np.ndarray]:
        """Of the text and of the metadata, rounded: the last bits depend on the number of rows."""
        return [np.round(part.times(w[:-1]) + w[-1], 9) for part, w in zip(x, (self.text, self.meta))]

    def _fit_views(self, text: Parabola | None, meta: Parabola | None, apart: np.ndarray | None) -> None:
        """Both views from the labels and from what the other one handed over."""
        target = self._target
        share = min(max(target.mean(), 0.05), 0.95)
        # Both classes weigh alike.
        weight = np.where(target > 0, 0.5 / share, 0.5 / (1 - share))
        words, numbers = self._base
        n, good, whole = words.summed(np.ones(len(target))), words.summed(target), target.mean()
        used = _significant(n, good, whole)
        if apart is not None:
            used |= apart
        used = np.flatnonzero(used)
        own = None if text is None else text.only(np.append(used, WIDTH))
        few = logistic(words.only(used), target, weight, 1e-4, also=own)
        self.text = np.zeros(WIDTH + 1)
        self.text[used], self.text[-1] = few[:-1], few[-1]
        self.meta = logistic(numbers, target, weight, 1e-4, also=meta)
        # From which certainty on a view hands over labels: bad ones, good ones.
        self.least = [[_sure_from(sign * z, self._tried == label) for label, sign in ((0, -1), (1, 1))]
                      for z in self.logits(self._aside)]

    def sums(self, rows: tuple[Sparse, Dense]) -> np.ndarray:
        """What unlabelled rows hand over: count, slope and curvature of each column, by class.

        Columns are those of the words, the text's constant, those of the metadata, its constant.
        """
        words, numbers = rows
        z = self.logits(rows)
        units = np.rint(numbers.values * _META_UNIT)
        # Text learns what the metadata is sure of, and the other way round.
        given = [[sign * z[1 - view] >= self.least[1 - view][label] for label, sign in ((0, -1), (1, 1))]
                 for view in range(2)]
        out = np.zeros((2, 3, WIDTH + 1 + numbers.width + 1), np.int64)
        for label in range(2):
            # Being sure of both classes is being sure of none.
            told = [given[view][label] & ~given[view][1 - label] for view in range(2)]
            slope = [np.rint((_sigmoid(z[view]) - label) * _UNIT) * told[view] for view in range(2)]
            size = (words.sizes + 1) * told[0]
            norm = (np.abs(units).sum(1) + _META_UNIT) * told[1]
            for k, (by_text, by_meta) in enumerate((
                    (told[0] * 1.0, (units != 0).T @ (told[1] * 1.0)),
                    (slope[0], units.T @ slope[1]), (size * 1.0, np.abs(units).T @ norm))):
                out[label, k, :WIDTH] = words.summed(by_text)
                out[label, k, WIDTH] = by_text.sum()
                out[label, k, WIDTH + 1:-1] = by_meta
            out[label, :, -1] = told[1].sum(), slope[1].sum() * _META_UNIT, norm.sum() * _META_UNIT
        return out

    def learn(self, sums: np.ndarray) -> None:
        """Fit both views again, with the sums of all unlabelled rows."""
        text, meta = sums[:, :, :WIDTH + 1].astype(float), sums[:, :, WIDTH + 1:].astype(float)
        meta[:, 1:] /= _META_UNIT
        meta[:, 2] /= _META_UNIT
        self.handed.append([[int(v[label, 0, -1]) for label in range(2)] for v in (text, meta)])
        of_base = [(self._target == label).sum() for label in range(2)]

        def bound(v: np.ndarray, at: np.ndarray) -> Parabola | None:
            slope, curve = np.zeros(v.shape[2]), np.zeros(v.shape[2])
            for label in range(2):
                n = v[label, 0, -1]
                if n:
                    each = 0.5 * min(1.0, n / max(of_base[label], 1)) / n
                    slope += each * v[label, 1] / _UNIT
                    curve += each * v[label, 2] / 4
            return Parabola(at, slope, curve)

        bad, good = text[0, 0, :-1], text[1, 0, :-1]
        n_bad, n_good = text[0, 0, -1], text[1, 0, -1]
        apart = _significant(bad + good, good, n_good / max(n_bad + n_good, 1))
        often_bad, often_good = (bad + 0.5) / (n_bad + 1), (good + 0.5) / (n_good + 1)
        apart &= np.maximum(often_bad / often_good, often_good / often_bad) >= TIMES
        self._fit_views(bound(text, self.text), bound(meta, self.meta), apart)

    def calibrate(self) -> None:
        """Platt's calibration of each view, then one more regression on both."""
        views, one = self.logits(self._aside), np.ones(len(self._tried))
        self.calibration = [logistic(Dense(z[:, None] / 4), self._tried, one, 1e-3, 300) for z in views]
        self.combined = logistic(Dense(self._calibrated(*views)), self._tried, one, 1e-3, 300)
        # Only weights are needed from here on.
        del self._aside, self._base, self._tried, self._target

    def _calibrated(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        z = [c[0] * v / 4 + c[1] for c, v in zip(self.calibration, (text, meta))]
        return np.stack([np.clip(z[0], -8, 8), np.clip(z[1], -8, 8), np.minimum(*z).clip(-8, 8)], 1)

    def score(self, texts: list[str], sources: list, langs: list,
              columns: Columns) -> tuple[np.ndarray, ...]:
        """Calibrated score of each view, and the combined one."""
        if self.constant is not None:
            flat = np.full(len(texts), self.constant)
            return flat, flat, flat
        found = [described(t, columns) for t in texts]
        x = (Sparse([words for words, _ in found], WIDTH),
             Dense(self.metadata(np.array([numbers for _, numbers in found]), sources, langs)))
        z = self._calibrated(*self.logits(x))
        return (_sigmoid(z[:, 0]), _sigmoid(z[:, 1]),
                _sigmoid(z @ self.combined[:-1] + self.combined[-1]))


def _significant(n: np.ndarray, good: np.ndarray, share: float) -> np.ndarray:
    """Columns whose share of good rows differs from ``share`` by more than chance."""
    apart = np.abs(good - n * share) / np.sqrt(np.maximum(n * share * (1 - share), 1e-9))
    return (apart >= SIGNIFICANT) & (n >= MIN_DOCUMENTS)


def described(text: str, columns: Columns) -> tuple[np.ndarray, list[float]]:
    """Columns of a text's words, and its shape."""
    words = tokens(text)
    distinct = set(words)
    return columns.of(distinct), shape(text, words, len(distinct))


_FEATURES = pa.schema([("doc_id", pa.int64()), ("words", pa.binary()), ("shape", pa.binary()),
                       ("source", pa.string()), ("lang", pa.string()), ("good", pa.int32())])
_FEATURES_DDL = "doc_id bigint, words binary, shape binary, source string, lang string, good int"


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    columns = Columns()
    for batch in batches:
        for start in range(0, batch.num_rows, _SLICE_ROWS):
            piece = batch.slice(start, _SLICE_ROWS)
            found = [described(t, columns) for t in piece.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                piece.column(0), pa.array([w.tobytes() for w, _ in found], pa.binary()),
                pa.array([np.array(v).tobytes() for _, v in found], pa.binary()),
                *(piece.column(k) for k in (2, 3, 4))], schema=_FEATURES)


def _rows(batch: pa.RecordBatch) -> list[dict]:
    rows = batch.to_pylist()
    for row in rows:
        row["words"], row["shape"] = np.frombuffer(row["words"], np.int32), np.frombuffer(row["shape"])
    return rows


_SUMS = ("n_bad", "slope_bad", "curve_bad", "n_good", "slope_good", "curve_good")


def exchange(features: DataFrame, model: Model) -> np.ndarray:
    """Sums of what all unlabelled rows hand over; a row of numbers per column and task is moved."""
    shared = features.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for start in range(0, batch.num_rows, _ROUND_ROWS):
                own = shared.value.sums(shared.value.matrices(_rows(batch.slice(start, _ROUND_ROWS))))
                total = own if total is None else total + own
        if total is not None:
            used = np.flatnonzero(total[:, 0].any(0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int64()), *(pa.array(v[used], pa.int64()) for v in total.reshape(6, -1))],
                names=["at", *_SUMS])

    # At most a row per column, whatever the size of the corpus.
    table = features.filter("good IS NULL").mapInArrow(
        lean(run), ", ".join(f"{name} bigint" for name in ("at", *_SUMS))).groupBy("at").agg(
        *(F.sum(name).alias(name) for name in _SUMS)).toArrow()
    shared.destroy()
    out = np.zeros((6, WIDTH + 1 + len(model.meta)), np.int64)
    if table.num_rows:
        out[:, table["at"].to_numpy()] = [table[name].to_numpy() for name in _SUMS]
    return out.reshape(2, 3, -1)


def _chosen(df: DataFrame, bound: int, salt: str) -> DataFrame:
    """About ``bound`` rows by a hash of ``doc_id``, or all."""
    rows = df.count()
    if rows <= bound:
        return df
    at = F.pmod(F.xxhash64(F.lit(salt), "doc_id"), F.lit(1 << 20))
    return df.filter(at < int((1 << 20) * bound / rows))


def featured(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> DataFrame:
    """Word columns and shape of every document, and ``good`` for the labelled ones the fit takes."""
    marks = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(
        F.min(F.when((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), 1)
              .otherwise(0)).cast("int").alias("good"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.coalesce("text", F.lit("")).alias("text"), "source", "lang")
    # At most about ``labelled`` rows of two numbers.
    return texts.join(F.broadcast(_chosen(marks, labelled, "labels")), "doc_id", "left").select(
        "doc_id", "text", "source", "lang", "good").mapInArrow(lean(_features), _FEATURES_DDL)


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, rounds: int = ROUNDS) -> Model:
    """Both views from a bounded number of labelled rows and from all others."""
    features = stored(featured(docs, labels, labelled), "quality-features")
    known = features.filter("good IS NOT NULL").groupBy("doc_id").agg(
        F.min(F.struct("words", "shape", "source", "lang", "good")).alias("row")).select("doc_id", "row.*")
    rows = [row for batch in known.toArrow().to_batches(max_chunksize=_ROUND_ROWS) for row in _rows(batch)]
    rows.sort(key=lambda r: r["doc_id"])
    model = Model(rows)
    if model.constant is None:
        for _ in range(rounds):
            sums = exchange(features, model)
            if not sums[:, 0].any():
                break
            model.learn(sums)
        model.calibrate()
    discard(docs.sparkSession, features)
    return model


def scored(docs: DataFrame, model: Model, *names: str) -> DataFrame:
    """``docs`` and three scores: of the text, of the metadata, of both."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = list(docs.columns)
    at = [kept.index(c) for c in ("text", "source", "lang")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = Columns()
        for batch in batches:
            for start in range(0, batch.num_rows, _SLICE_ROWS):
                piece = batch.slice(start, _SLICE_ROWS)
                texts, sources, langs = (piece.column(k).to_pylist() for k in at)
                scores = shared.value.score([t or "" for t in texts], sources, langs, columns)
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns, *(pa.array(s, pa.float64()) for s in scores)],
                    names=[*kept, *names])

    added = [T.StructField(name, T.DoubleType()) for name in names]
    return docs.mapInArrow(lean(run), T.StructType([*docs.schema.fields, *added]))


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, the score of each view and of both, and whether the document is kept."""
    docs = docs.select("doc_id", "text", "source", "lang")
    return scored(docs, fit(docs, labels), "text_score", "meta_score", "score").select(
        "doc_id", "text_score", "meta_score", "score", (F.col("score") >= KEEP).alias("keep"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are kept, with all their columns."""
    names = fresh(docs, "text_score", "meta_score", "score")
    return scored(docs, fit(docs, labels), *names).filter(
        F.col(names[2]) >= KEEP).select(*docs.columns)
