"""CEF lines: a header of pipe-separated fields and ``key=value`` extensions."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from loglathe.contracts import CEF_KEYS
from loglathe.functions.text import strip
from loglathe.operators.fields import found_struct
from loglathe.operators.stages import Stages

# Extension syntax (fixed values): a key starts the text or follows white space.
_KEY = r"[a-zA-Z][a-zA-Z0-9_.]*"
_PAIR = rf"(?s)(?:^|\s)({_KEY})=(.*?)(?=\s{_KEY}=|$)"


def _first_of(aliases: list[str]) -> Column:
    return F.coalesce(*[
        F.get("_cef_values", F.array_position("_cef_keys", alias).cast("int") - 1)
        for alias in aliases
    ])


@cache
def cef_stages(only: bool) -> Stages:
    """``_cef``, the texts found in ``_text``; null for lines of other formats."""
    when = F.lit(True) if only else F.col("detected_format") == "cef"
    text = F.col("_text")
    head = [F.get("_cef_head", F.lit(i)) for i in range(8)]

    def pairs(group: int) -> Column:
        return F.regexp_extract_all(head[7], F.lit(_PAIR), F.lit(group))

    is_epoch = F.col("_cef_time").rlike(r"^[0-9]+$")
    error = (
        F.when(F.col("_cef_head").isNull(), "prefix").when(F.size("_cef_head") < 8, "header")
    )
    fields = {f: _first_of(aliases) for f, aliases in CEF_KEYS.items() if f != "timestamp"}
    return [
        {"_cef_head": F.when(when & text.startswith("CEF:"),
                             F.split(F.substr(text, F.lit(5)), r"\|", 8))},
        # Newest pair first, so that the first hit of a key is its last occurrence.
        # An empty value counts as absent.
        {"_cef_keys": F.reverse(F.transform(pairs(1), lambda k: F.lower(k))),
         "_cef_values": F.reverse(F.transform(
             pairs(2), lambda v: F.nullif(strip(v), F.lit(""))))},
        {"_cef_time": _first_of(CEF_KEYS["timestamp"])},
        {"_cef": F.when(when, found_struct(
            epoch=F.when(is_epoch, F.col("_cef_time").try_cast("double")),
            time=F.when(~is_epoch, F.col("_cef_time")),
            device_vendor=F.nullif(strip(head[1]), F.lit("")),
            severity=strip(head[6]),
            error_reason=error, **fields))},
    ]
