"""Format detection by the shape of a line."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loglathe.functions.text import strip

# Line shapes (fixed values)
BSD_SYSLOG_SHAPE = r"^[A-Z][a-z]{2}\s+\d{1,2}\s+\d{2}:\d{2}:\d{2}\s+\S+"
IETF_SYSLOG_SHAPE = r"^<\d{1,3}>\d+\s+\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}"


def json_in_array(text: Column) -> Column:
    """The text parsed as the only element of a JSON array (a VARIANT), else null."""
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))


def json_in_object(text: Column) -> Column:
    """The text parsed as the only value of a JSON object (a VARIANT), else null."""
    return F.try_parse_json(F.concat(F.lit('{"w":'), text, F.lit("}")))


def is_strict_json(text: Column) -> Column:
    """Whether the whole text is one JSON value.

    The parser stops after the first value and would accept trailing text. A text
    that parses both inside an array and inside an object cannot have any: what
    continues an array (``, 1``) does not continue an object (``, "k": 1``).
    """
    return json_in_array(text).isNotNull() & json_in_object(text).isNotNull()


def starts_strict_json(text: Column) -> Column:
    # The CASE keeps the JSON parser away from lines of other formats.
    return F.when(text.startswith("{"), is_strict_json(text)).otherwise(False)


def is_json_object(raw_text: Column) -> Column:
    return starts_strict_json(strip(raw_text))


def has_cef_shape(text: Column) -> Column:
    return text.startswith("CEF:")


def has_syslog_shape(text: Column) -> Column:
    return text.rlike(BSD_SYSLOG_SHAPE) | text.rlike(IETF_SYSLOG_SHAPE)


def is_cef(raw_text: Column) -> Column:
    return has_cef_shape(strip(raw_text))


def is_syslog(raw_text: Column) -> Column:
    return has_syslog_shape(strip(raw_text))


def detect_format(raw_text: Column) -> Column:
    """The format of a line by its shape; null and blank are unknown."""
    # The entries name the shapes above, so they are imported when they are needed.
    from loglathe.operators import formats
    return formats.format_of(strip(raw_text))
