"""Text helpers as native column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from loglathe.contracts import EXTRA_DELIMITERS

# Everything Unicode counts as white space, plus the four ASCII separators
# U+001C..U+001F that text tools strip as well (fixed values).
WHITESPACE = "".join(chr(point) for point in (
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
    *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
))
_WHITESPACE_RUN = f"[{WHITESPACE}]+"
_SEPARATOR = "\x01"


def strip(text: Column) -> Column:
    """Trim white space of any kind from both ends.

    Trimming against a long set of characters is slow and seldom needed, so texts
    with a visible ASCII character at both ends are passed on as they are. The last one is
    read as a byte, since finding the last character walks through the whole text; in UTF-8
    such a byte is a character of its own.
    """
    last = F.substring(text.cast("binary"), -1, 1)
    return F.when(
        F.ascii(text).between(0x21, 0x7E) & last.between(F.lit(b"\x21"), F.lit(b"\x7e")), text
    ).otherwise(F.trim(text, F.lit(WHITESPACE)))


def capture(text: Column, pattern: str, groups: int) -> Column:
    """All groups of the first match as ``array<string>``, null without a match.

    One test and one rewrite give every group, where ``regexp_extract`` runs the
    pattern once per group; only texts that hold the separator themselves go that
    way. The pattern has to cover the whole text.
    """
    rewrite = _SEPARATOR.join(f"${i}" for i in range(1, groups + 1))
    parts = F.split(F.regexp_replace(text, F.lit(pattern), F.lit(rewrite)), _SEPARATOR, -1)
    one_by_one = F.array(*[F.regexp_extract(text, pattern, i) for i in range(1, groups + 1)])
    return F.when(text.rlike(pattern), F.when(
        F.contains(text, F.lit(_SEPARATOR)), one_by_one).otherwise(parts))


def tokens(text: Column, delimiters: str = EXTRA_DELIMITERS) -> Column:
    """Split on white space and on the literal delimiters, without empty tokens."""
    spaced = strip(F.translate(text, delimiters, " " * len(delimiters)))
    return F.when(spaced == "", F.array().cast("array<string>")).otherwise(
        F.split(spaced, _WHITESPACE_RUN))


def word_key(word: Column) -> Column:
    """The form in which words are looked up. Keep it in a column of its own."""
    return F.lower(strip(word))


def map_words(key: Column, table: Mapping[str, Sequence[str]], default: str) -> Column:
    """Look the key of a word up in a vocabulary table."""
    expr = None
    for value, words in table.items():
        hit = key.isin(*words)
        expr = F.when(hit, value) if expr is None else expr.when(hit, value)
    return expr.otherwise(F.lit(default))


def to_bigint(text: Column) -> Column:
    """Whole-number text to BIGINT; signs and single inner underscores are allowed."""
    plain = F.when(text.rlike(r"^[0-9]{1,18}$"), text.try_cast("bigint"))
    digits = strip(text)
    return plain.when(
        digits.rlike(r"^[+-]?[0-9]+(_[0-9]+)*$"),
        F.translate(digits, "_", "").try_cast("bigint"),
    )


def sha256_of(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("\x1f", *parts), 256)
