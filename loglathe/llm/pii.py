"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Kinds ``email, ip, card, phone`` are the base: a span that passes its validator is always
reported. ``iban`` (mod 97) and ``secret`` are reported from a score of ``THRESHOLD`` on;
the score of every span starts from what its validator is worth and rises with words near
it that speak of that kind. Scanning takes time in proportion to the text, whatever runs
of letters or digits it holds.

Cases: a null text is empty; a text without spans gives an empty list; positions are code
points, end exclusive. Repeated rows are reported as often as they occur.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglathe.llm.common import text_or_empty

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "secret")
THRESHOLD = 0.5
CONTEXT_CHARS = 40
CONTEXT_BONUS = 0.2
_SLICE_ROWS = 256

# Words that speak of a kind (fixed values).
CONTEXT = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "credit", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
    "iban": ("iban", "bank", "account", "transfer"),
    "secret": ("password", "passwd", "secret", "token", "key", "api"),
}
_CONTEXT = {k: re.compile("|".join(rf"\b{w}" for w in words), re.I) for k, words in CONTEXT.items()}

# The part of an address from its sign on; what stands before it is read backwards.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A match never begins inside a run of digits, whose beginning would have matched.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{1,4}){3,8}(?![A-Za-z0-9])")
_SECRET = re.compile(
    r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])"
    r"|(?<![A-Za-z])(?:password|passwd|secret|token|api_?key) ?[=:] ?\"?([A-Za-z0-9_/+-]{8,})")
_NOT_DIGIT = re.compile(r"[^0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

Span = tuple[str, int, int, float]


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def mod97(iban: str) -> bool:
    compact = iban.replace(" ", "")
    if not 15 <= len(compact) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int, float]]:
    free = 0
    for found in _DOMAIN.finditer(text):
        start = found.start()
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < found.start():
            yield start, found.end(), 0.8
            free = found.end()


def _ips(text: str) -> Iterator[tuple[int, int, float]]:
    for found in _IP.finditer(text):
        # A part above 255 has three digits at least behind its zeros.
        if all(len(p) <= 3 or not p[:-3].strip("0") for p in found[0].split(".")) and all(
                int(p[-3:]) <= 255 for p in found[0].split(".")):
            yield found.start(), found.end(), 0.6


def _cards(text: str) -> Iterator[tuple[int, int, float]]:
    for found in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", found[0]) if found.end() - found.start() >= 16 else ""
        if 16 <= len(digits) <= 19 and luhn(digits):
            yield found.start(), found.end(), 0.8


def _phones(text: str) -> Iterator[tuple[int, int, float]]:
    for found in _PHONE.finditer(text):
        if 8 <= len(_NOT_DIGIT.sub("", found[0])) <= 15:
            yield found.start(), found.end(), 0.6


def _ibans(text: str) -> Iterator[tuple[int, int, float]]:
    for found in _IBAN.finditer(text):
        if mod97(found[0]):
            yield found.start(), found.end(), 0.8


def _secrets(text: str) -> Iterator[tuple[int, int, float]]:
    for found in _SECRET.finditer(text):
        group = 1 if found[1] else 0
        mixed = any(c.isdigit() for c in found[group])
        yield found.start(group), found.end(group), 0.6 if mixed else 0.3


_FINDERS: dict[str, tuple[Callable, Callable[[str], bool]]] = {
    "email": (_emails, lambda text: "@" in text),
    "ip": (_ips, lambda text: True),
    "card": (_cards, lambda text: True),
    "phone": (_phones, lambda text: "+" in text),
    "iban": (_ibans, lambda text: True),
    "secret": (_secrets, lambda text: "AKIA" in text or "=" in text or ":" in text),
}


def find(text: str) -> list[Span]:
    """All reported spans of a text, by kind and then by start."""
    spans = []
    for kind in KINDS:
        finder, possible = _FINDERS[kind]
        if not possible(text):
            continue
        for start, end, score in finder(text):
            near = text[max(0, start - CONTEXT_CHARS):start] + " " + text[end:end + CONTEXT_CHARS]
            if _CONTEXT[kind].search(near):
                score += CONTEXT_BONUS
            if kind in BASE_KINDS or score >= THRESHOLD:
                spans.append((kind, start, end, round(score, 2)))
    return spans


_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                            ("score", pa.float64())]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys = ("kind", "start", "end", "score")
    for batch in batches:
        for at in range(0, batch.num_rows, _SLICE_ROWS):
            piece = batch.slice(at, _SLICE_ROWS)
            spans = [[dict(zip(keys, s)) for s in find(t)] for t in piece.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array(spans, _SPAN)], names=["doc_id", "spans"])


def find_spans(docs: DataFrame) -> DataFrame:
    """``doc_id`` and its spans: kind, start, end (code points) and score."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(
        _scan, f"doc_id {id_type}, "
        "spans array<struct<kind:string, start:bigint, end:bigint, score:double>>")


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _count_of(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def report(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of the base spans, and all spans as text."""
    found = find_spans(docs)
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    counts = [_count_of(kind).alias(f"n_{kind}") for kind in BASE_KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"))
