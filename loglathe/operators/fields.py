"""From the texts a parser found to typed event fields, shared by all formats.

A parser only has to find texts. It yields a struct ``found`` with the fields of
``FOUND_FIELDS``; ``formats.finish_stages`` then does the typing and the vocabulary mapping
once for all formats, which keeps the generated code of a mixed scan small.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loglathe.contracts import CEF_SEVERITY_WORDS
from loglathe.functions.text import map_words

FOUND_FIELDS = [
    "epoch", "time", "src_ip", "dst_ip", "src_port", "dst_port", "action", "protocol",
    "device_vendor", "severity", "error_reason",
]


def found_struct(**fields: Column) -> Column:
    """``epoch`` is a double, all other fields are strings; absent ones are null."""
    unknown = set(fields) - set(FOUND_FIELDS)
    if unknown:
        raise ValueError(f"not event fields: {sorted(unknown)}")
    return F.struct(*[
        fields.get(name, F.lit(None)).cast("double" if name == "epoch" else "string").alias(name)
        for name in FOUND_FIELDS
    ])


def device_severity(level: Column) -> Column:
    """Firewall level 0 to 7, lower is worse."""
    return (
        F.when(level <= 2, "critical").when(level == 3, "high").when(level == 4, "medium")
        .when(level.isin(5, 6), "low").otherwise("unknown")
    )


def cef_severity(key: Column, level: Column) -> Column:
    """CEF level 0 to 10, or a word."""
    return (
        F.when(level.isNull(), map_words(key, CEF_SEVERITY_WORDS, "unknown"))
        .when(level.between(0, 3), "low").when(level.between(4, 6), "medium")
        .when(level.between(7, 8), "high").when(level.between(9, 10), "critical")
        .otherwise("unknown")
    )
