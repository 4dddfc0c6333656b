"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

A suffix-matching automaton over the vocabulary reports, for every position of a piece of
text, the tokens that end there. Of these exactly one is the last token of the prefix that
ends there: the one that may follow the last token of the prefix before it. Two tokens may
stand side by side when no merge crosses the border between them while both are built.
Following the stored tokens back from the end gives the ids that merging pairs in order of
rank would give, in time that does not depend on the order of merges.

Cases: a null text is empty and has no tokens; special tokens in a text are recognised, as
the vocabulary file says. Long pieces without white space take time in proportion.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from loglathe.llm.common import kept, lean, text_or_empty

# How text is cut before merging (fixed value): contractions, words, numbers, other signs
# and white space, each with at most one space before it.
_SPACE = r"\x09-\x0D\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
PIECES = regex.compile(
    r"'(?:s|t|re|ve|m|ll|d)| ?\p{L}+| ?\p{N}+| ?[^%s\p{L}\p{N}]+|[%s]+(?![^%s])|[%s]+"
    .replace("%s", _SPACE), regex.V0)
# The same for texts below U+0250, where a few ranges name all letters and numbers.
_LATIN_LETTER = r"A-Za-z\xAA\xB5\xBA\xC0-\xD6\xD8-\xF6\xF8-\u024F"
_LATIN_NUMBER = r"0-9\xB2\xB3\xB9\xBC-\xBE"
LATIN_PIECES = re.compile(
    r"'(?:s|t|re|ve|m|ll|d)| ?[%l]+| ?[%n]+| ?[^%s%l%n]+|[%s]+(?![^%s])|[%s]+"
    .replace("%s", r"\x09-\x0D\x20\x85\xA0")
    .replace("%l", _LATIN_LETTER).replace("%n", _LATIN_NUMBER))
_BEYOND_LATIN = re.compile("[^\x00-\u024F]")
# Entries of the two generations of the memory of pieces, each; about 200 bytes an entry.
MEMORY = 300_000
_PAIR_MEMORY = 400_000
_SLICE_ROWS = 256
_NEVER = 1 << 60


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary.

    Printable bytes stand for themselves, the others for the code points from 256 on.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(256, 512))
    return [chr(b) if b in set(printable) else chr(next(others)) for b in range(256)]


class Encoder:
    """A vocabulary with its merges; keeps the pieces of text it has met, in bounded memory."""

    def __init__(self, definition: bytes):
        file = json.loads(definition)
        model = file["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.texts = {i: t for t, i in self.ids.items()}
        self.rank: dict[tuple[int, int], int] = {}
        # How a token is made: rank of its merge, left part, right part.
        self.made: dict[int, tuple[int, int, int]] = {}
        for rank, (left, right) in enumerate(
                m.split(" ") if isinstance(m, str) else m for m in model["merges"]):
            pair = (self.ids[left], self.ids[right])
            self.rank[pair] = rank
            self.made.setdefault(self.ids[left + right], (rank, *pair))
        self.special = {t["content"]: t["id"] for t in file.get("added_tokens", [])}
        self.texts.update({i: t for t, i in self.special.items()})
        letters = byte_letters()
        byte = {c: b for b, c in enumerate(letters)}
        # What each id stands for, as bytes and in decimal.
        self.bytes = {
            i: bytes(map(byte.__getitem__, t)) if all(c in byte for c in t) else t.encode()
            for i, t in self.texts.items()}
        self.decimal = {i: str(i) for i in self.texts}
        self.pairs: dict[int, bool] = {}
        # Tokens that merging makes of their own text; others never occur.
        whole = {i for i in self.ids.values() if i not in self.made}
        for token, (rank, left, right) in sorted(self.made.items(), key=lambda m: m[1][0]):
            if left in whole and right in whole and self._border(left, right, rank):
                whole.add(token)
        # Bytes are written as the code points 0 to 255.
        self.whole = {self.bytes[i].decode("latin-1"): i for t, i in self.ids.items()
                      if i in whole and t not in self.special}
        self.automaton = ahocorasick.Automaton()
        for text, token in self.whole.items():
            self.automaton.add_word(text, token)
        self.automaton.make_automaton()
        self.length = {i: len(t) for t, i in self.whole.items()}
        self.split = regex.compile("(" + "|".join(
            regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")"
        ) if self.special else None
        self.young: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}

    def _border(self, a: int, b: int, until: int) -> bool:
        """Whether no merge crosses the border of two tokens before rank ``until``.

        Back in time, the two tokens fall apart; of the parts at the border the one made
        later falls apart first. ``until_a`` and ``until_b`` are the ranks at which the
        parts become something larger. Of equal merges the left one comes first.
        """
        until_a = until_b = until
        while True:
            rank = self.rank.get((a, b))
            if rank is not None and rank < until_a and rank <= until_b:
                return rank == until
            made_a, made_b = self.made.get(a), self.made.get(b)
            if made_a is None and made_b is None:
                return True
            if made_b is None or (made_a is not None and made_a[0] > made_b[0]):
                until_a, a = made_a[0], made_a[2]
            else:
                until_b, b = made_b[0], made_b[1]

    def compatible(self, left: int, right: int) -> bool:
        """Whether two tokens may stand side by side."""
        if len(self.pairs) >= _PAIR_MEMORY:
            self.pairs.clear()
        known = self.pairs[left << 32 | right] = self._border(left, right, _NEVER)
        return known

    def piece(self, text: str) -> tuple[int, ...]:
        """Ids of one piece, whose bytes are written as the code points 0 to 255."""
        if text in self.whole:
            return (self.whole[text],)
        length, pairs = self.length, self.pairs
        last = [-1] * (len(text) + 1)
        for end, token in self.automaton.iter(text):
            end += 1
            if last[end] < 0:
                begin = end - length[token]
                if begin:
                    before = last[begin]
                    fits = pairs.get(before << 32 | token)
                    if fits is None:
                        fits = self.compatible(before, token)
                    if not fits:
                        continue
                last[end] = token
        ids, at = [], len(text)
        while at:
            token = last[at]
            ids.append(token)
            at -= length[token]
        return tuple(ids[::-1])

    def _learn(self, piece: str) -> tuple[int, ...]:
        ids = self.old.get(piece)
        if ids is None:
            ids = (self.special[piece],) if piece in self.special else self.piece(
                piece if piece.isascii() else piece.encode().decode("latin-1"))
        if len(self.young) >= MEMORY:
            self.old, self.young = self.young, {}
        self.young[piece] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        pattern = PIECES if _BEYOND_LATIN.search(text) else LATIN_PIECES
        if self.split is not None and any(s in text for s in self.special):
            cut = []
            for k, part in enumerate(self.split.split(text)):
                cut.extend([part] if k % 2 else pattern.findall(part))
        else:
            cut = pattern.findall(text)
        found = list(map(self.young.get, cut))
        if None in found:
            learn = self._learn
            found = [ids or self.young.get(p) or learn(p) for ids, p in zip(found, cut)]
        return list(chain.from_iterable(found))

    def decode_bytes(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        """Bytes that are not UTF-8 become replacement characters."""
        return self.decode_bytes(ids).decode("utf-8", "replace")


def _encoder(definition: bytes) -> Encoder:
    return kept("bpe", definition, Encoder)


def vocabulary(spark: SparkSession, path: str):
    """The vocabulary file, of a few megabytes at most, for all executors."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def map_texts(docs: DataFrame, path: str, row_of, columns: str, names: list[str]) -> DataFrame:
    """``doc_id`` and what ``row_of(encoder, text)`` gives for each text."""
    definition = vocabulary(docs.sparkSession, path)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(definition.value)
        for batch in batches:
            for at in range(0, batch.num_rows, _SLICE_ROWS):
                piece = batch.slice(at, _SLICE_ROWS)
                rows = [row_of(encoder, t) for t in piece.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), *(pa.array(c) for c in zip(*rows))], names=["doc_id", *names])

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(
        lean(run, "bpe"), f"doc_id {id_type}, {columns}")


def _ids(encoder: Encoder, text: str) -> tuple:
    return (np.array(encoder.encode(text), np.int32),)


def _ids_that_decode(encoder: Encoder, text: str) -> tuple:
    ids = encoder.encode(text)
    if encoder.decode(ids) != text:
        raise ValueError(f"token ids do not decode to their text, which begins {text[:80]!r}")
    return (np.array(ids, np.int32),)


def encode(docs: DataFrame, path: str, verify: bool = False) -> DataFrame:
    """``doc_id`` and the token ids of its whole text.

    With ``verify`` all ids are decoded again, and a text that does not come back is an error.
    """
    return map_texts(docs, path, _ids_that_decode if verify else _ids, "ids array<int>", ["ids"])


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and the text of its ids; null ids give an empty text."""
    definition = vocabulary(tokens.sparkSession, path)
    id_type = tokens.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(definition.value)
        for batch in batches:
            for at in range(0, batch.num_rows, _SLICE_ROWS):
                piece = batch.slice(at, _SLICE_ROWS)
                texts = [encoder.decode(ids or []) for ids in piece.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return tokens.select("doc_id", "ids").mapInArrow(lean(run, "bpe"), f"doc_id {id_type}, text string")


def _digest(encoder: Encoder, text: str) -> tuple:
    ids = encoder.encode(text)
    listed = ",".join(map(encoder.decimal.__getitem__, ids))
    decoded = encoder.decode(ids)
    return (len(ids), hashlib.sha256(listed.encode()).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest())


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Number of tokens, digest of the ids, digest of the text decoded from them."""
    return map_texts(docs, path, _digest,
                     "n_tokens bigint, ids_sha256 string, decoded_sha256 string",
                     ["n_tokens", "ids_sha256", "decoded_sha256"])
