"""Fill-in-the-middle examples by piece tables.

A piece table is a list of descriptors ``(buffer, start, stop)`` over buffers that never
change: the text of a document, and one string with the three sentinels. Cutting a
document splits a descriptor in two; an arrangement puts the descriptors and sentinels in
a new order. No text is copied until the pieces are streamed, to a digest or to the
output. Restoring makes a piece table over the *output*, splits off the sentinels, drops
them, and puts the rest into the inverse order.

Where a document is cut, and how it is arranged, follows from a hash of ``doc_id`` alone,
so every run gives the same examples. A document is cut between *units*: lines, or single
characters.

Cases: a null text is empty; an empty text, and one that holds a sentinel, stays plain; a
null id hashes as an empty one. Texts of any length are taken whole: besides the text
itself a document needs one number per unit and at most five descriptors. Rows are
independent, so ties do not arise, repeated rows give equal results, an empty table gives an
empty table, and further columns are kept or left out as each function says, whatever their
names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loglathe.llm.common import fresh

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SENTINELS = PREFIX + SUFFIX + MIDDLE
PLAIN, PSM, SPM = "plain", "psm", "spm"
UNITS = {"line": re.compile(r"[^\n]*\n|[^\n]+"), "char": re.compile(r".", re.DOTALL)}
# Documents in a hundred that are cut, and of these the ones with the suffix first.
RATE, SPM_SHARE, SEED = 100, 50, "7"
_TEXT, _MARKS = 0, 1
_SLICE_ROWS = 256
_STREAM_CHARS = 1 << 18


class Piece(NamedTuple):
    buffer: int
    start: int
    stop: int

    @property
    def size(self) -> int:
        return self.stop - self.start


PREFIX_PIECE, SUFFIX_PIECE, MIDDLE_PIECE = (
    Piece(_MARKS, at, at + len(PREFIX)) for at in range(0, len(SENTINELS), len(PREFIX)))
# Part numbers (0 prefix, 1 middle, 2 suffix) and sentinels in the order of each form.
ARRANGEMENTS: dict[str, tuple[int | Piece, ...]] = {
    PSM: (PREFIX_PIECE, 0, SUFFIX_PIECE, 2, MIDDLE_PIECE, 1),
    SPM: (SUFFIX_PIECE, 2, PREFIX_PIECE, 0, MIDDLE_PIECE, 1),
}


class PieceTable:
    """A text as descriptors over ``buffers``."""

    def __init__(self, buffers: Sequence[str], pieces: Sequence[Piece]):
        self.buffers, self.pieces = buffers, list(pieces)

    @classmethod
    def over(cls, text: str) -> PieceTable:
        return cls((text, SENTINELS), [Piece(_TEXT, 0, len(text))])

    def cut(self, at: int) -> int:
        """Split so that a piece begins at position ``at``; returns which one."""
        before = 0
        for k, piece in enumerate(self.pieces):
            if at <= before:
                return k
            if at < before + piece.size:
                middle = piece.start + at - before
                self.pieces[k:k + 1] = [piece._replace(stop=middle), piece._replace(start=middle)]
                return k + 1
            before += piece.size
        return len(self.pieces)

    def parts(self, *cuts: int) -> list[list[Piece]]:
        """The pieces between ascending cuts; a part may be empty."""
        ends = [0, *(self.cut(at) for at in cuts), None]
        return [self.pieces[a:b] for a, b in zip(ends, ends[1:])]

    def arranged(self, pieces: Sequence[Piece]) -> PieceTable:
        return PieceTable(self.buffers, pieces)

    def streamed(self) -> Iterator[str]:
        """The text, a bounded slice at a time."""
        for buffer, start, stop in self.pieces:
            for at in range(start, stop, _STREAM_CHARS):
                yield self.buffers[buffer][at:min(stop, at + _STREAM_CHARS)]

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for text in self.streamed():
            digest.update(text.encode())
        return digest.hexdigest()

    def text(self) -> str:
        return "".join(self.streamed())


class Example(NamedTuple):
    """How one document is cut: units, form, characters of prefix and middle, and its pieces."""

    n: int
    form: str
    prefix_chars: int | None
    middle_chars: int | None
    table: PieceTable


def arrange(doc_id: int | None, text: str, rate: int = RATE, spm_share: int = SPM_SHARE,
            seed: str = SEED, unit: str = "line") -> Example:
    """Cut one document at two places and arrange its parts."""
    ends = [0, *(found.end() for found in UNITS[unit].finditer(text))]
    n = len(ends) - 1
    table = PieceTable.over(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k:k + 8], 16) for k in range(0, 32, 8))
    if not text or h3 % 100 >= rate or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return Example(n, PLAIN, None, None, table)
    first, second = sorted(ends[h % (n + 1)] for h in (h1, h2))
    form = SPM if h4 % 100 < spm_share else PSM
    parts = table.parts(first, second)
    order = [[step] if isinstance(step, Piece) else parts[step] for step in ARRANGEMENTS[form]]
    return Example(n, form, first, second - first,
                   table.arranged([piece for pieces in order for piece in pieces]))


def restored(output: str, form: str) -> PieceTable | None:
    """The pieces of ``output`` in the order of the text it was made from.

    A sentinel is one that the text does not hold, so the first of each kind is the one
    put in. None if ``output`` does not have the sentinels of its form in their order.
    """
    table = PieceTable.over(output)
    if form == PLAIN:
        return table
    if form not in ARRANGEMENTS:
        return None
    steps, parts, at = ARRANGEMENTS[form], {}, 0
    for k in range(0, len(steps), 2):
        mark = SENTINELS[steps[k].start:steps[k].stop]
        if not output.startswith(mark, at):
            return None
        begin = at + len(mark)
        if k + 2 < len(steps):
            at = output.find(SENTINELS[steps[k + 2].start:steps[k + 2].stop], begin)
            if at < 0:
                return None
        else:
            at = len(output)
        parts[steps[k + 1]] = (begin, at)
    pieces = []
    for part in sorted(parts):
        begin, end = parts[part]
        first, last = table.cut(begin), table.cut(end)
        # A later cut may split pieces, but never those between two earlier cuts.
        pieces += table.pieces[first:last]
    return table.arranged(pieces)


_SHAPE = {"n": pa.int64(), "form": pa.string(), "prefix_chars": pa.int64(),
          "middle_chars": pa.int64()}
_SPARK = {pa.int64(): T.LongType(), pa.string(): T.StringType()}


def _mapped(docs: DataFrame, kept: list[str], names: Sequence[str], types: Sequence[pa.DataType],
            row_of) -> DataFrame:
    """``kept`` columns and those that ``row_of`` makes of the first two columns."""
    arguments = docs.columns[:2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _SLICE_ROWS):
                piece = batch.slice(start, _SLICE_ROWS)
                rows = [row_of(a, b) for a, b in zip(
                    piece.column(0).to_pylist(), piece.column(1).to_pylist())]
                made = [pa.array(values, kind) for values, kind in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays(
                    piece.columns[len(arguments):] + made, names=[*kept, *names])

    schema = T.StructType([*docs.schema.fields[2:], *(
        T.StructField(name, _SPARK[kind]) for name, kind in zip(names, types))])
    return docs.mapInArrow(run, schema)


def _with_arguments(docs: DataFrame, first: Column, second: Column) -> DataFrame:
    """Two arguments ahead of all columns."""
    one, two = fresh(docs, "argument_1", "argument_2")
    return docs.select(first.alias(one), second.alias(two), *[docs[c] for c in docs.columns])


def _arguments(docs: DataFrame) -> tuple[Column, Column]:
    return docs["doc_id"].cast("string"), F.coalesce(docs["text"], F.lit(""))


def transform(docs: DataFrame, output: str = "output", **options) -> DataFrame:
    """All columns of ``docs``, then ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and the
    example's text. A name that ``docs`` has already gets underscores in front. For
    ``options`` see ``arrange``."""
    names = fresh(docs, *_SHAPE, output)

    def row_of(doc_id, text):
        example = arrange(doc_id, text, **options)
        return *example[:4], example.table.text()

    return _mapped(_with_arguments(docs, *_arguments(docs)), docs.columns, names,
                   [*_SHAPE.values(), pa.string()], row_of)


def restore(examples: DataFrame, output: str = "output", form: str = "form",
            text: str = "restored") -> DataFrame:
    """All columns of ``examples`` and the text rebuilt from output and form; null where the
    output is null or not of its form."""
    name, = fresh(examples, text)

    def row_of(out, kind):
        table = None if out is None else restored(out, kind)
        return (None if table is None else table.text(),)

    return _mapped(_with_arguments(examples, examples[output], examples[form]), examples.columns,
                   [name], [pa.string()], row_of)


def digests(docs: DataFrame, **options) -> DataFrame:
    """``doc_id``, how its document is cut, and digests of the example and of the text that is
    rebuilt from it."""

    def row_of(doc_id, text):
        example = arrange(doc_id, text, **options)
        back = restored(example.table.text(), example.form)
        return *example[:4], example.table.sha256(), None if back is None else back.sha256()

    only = docs.select("doc_id", "text")
    return _mapped(
        _with_arguments(only, *_arguments(only)).drop("text"), ["doc_id"],
        [*_SHAPE, "output_sha256", "restored_sha256"],
        [*_SHAPE.values(), pa.string(), pa.string()], row_of)
