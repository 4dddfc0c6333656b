"""The known log formats, one entry each.

Detection, routing and shaping go through these entries, in their order. A new format is one call of
``register``: how a line of it looks, the stages that find its texts, and how its words read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from loglathe import contracts
from loglathe.contracts import (
    CEF_ACTION_WORDS, JSON_ACTION_WORDS, JSON_SEVERITY_WORDS, PROTOCOL_WORDS,
)
from loglathe.functions.clock import ISO_PARTS, from_epoch, from_iso_parts, iso_parts
from loglathe.functions.text import map_words, to_bigint, word_key
from loglathe.operators import detect
from loglathe.operators.cef import cef_stages
from loglathe.operators.fields import cef_severity, device_severity
from loglathe.operators.json_events import json_stages
from loglathe.operators.stages import Stages
from loglathe.operators.syslog import syslog_stages


def _words(table) -> Callable[[Column], Column]:
    return lambda key: map_words(key, table, "unknown")


@dataclass(frozen=True)
class LogFormat:
    """``matches`` tells a line by its stripped text.

    ``stages(only, assumed_year)`` are column steps over ``_text`` that end in ``_<name>``, a
    ``fields.found_struct`` (null for lines of other formats, told by ``detected_format`` unless ``only``).
    ``action(key)`` and ``severity(key, level)`` map the lower-cased word, and the number, that were found.
    With ``needs_time`` an event without a usable time is a parse error; otherwise it takes its
    ingestion time.
    """

    name: str
    matches: Callable[[Column], Column]
    stages: Callable[[bool, int | None], Stages]
    action: Callable[[Column], Column] = _words(JSON_ACTION_WORDS)
    severity: Callable[[Column, Column], Column] = lambda key, level: map_words(
        key, JSON_SEVERITY_WORDS, "unknown")
    needs_time: bool = False


_ENTRIES: dict[str, LogFormat] = {}


def register(entry: LogFormat) -> None:
    """Add a format behind those there are, or put it in the place of its namesake."""
    _ENTRIES[entry.name] = entry
    if entry.name not in contracts.FORMATS:
        contracts.FORMATS.insert(len(contracts.FORMATS) - 1, entry.name)
    _forget()


def unregister(name: str) -> None:
    del _ENTRIES[name]
    contracts.FORMATS.remove(name)
    _forget()


# Plans that were built for the entries of the time.
_CACHES: list[Callable] = []


def rebuilt_on_change(function):
    """A cached builder of columns that depends on the entries."""
    cached = cache(function)
    _CACHES.append(cached)
    return cached


def _forget() -> None:
    for cached in _CACHES:
        cached.cache_clear()


def names() -> tuple[str, ...]:
    return tuple(_ENTRIES)


def stages_of(name: str, only: bool, assumed_year: int | None) -> Stages:
    return _ENTRIES[name].stages(only, assumed_year)


def format_of(text: Column, known: dict[str, Column] | None = None) -> Column:
    """The first format that a stripped text matches, else unknown.

    ``known`` has tests that were evaluated already.
    """
    found = None
    for name, entry in _ENTRIES.items():
        hit = (known or {}).get(name)
        hit = entry.matches(text) if hit is None else hit
        found = F.when(hit, name) if found is None else found.when(hit, name)
    return found.otherwise("unknown")


def _per_format(of: Callable[[LogFormat], Column], otherwise: Column) -> Column:
    """One expression per distinct rule, chosen by the detected format."""
    found = None
    for name, entry in _ENTRIES.items():
        here = F.col("detected_format") == name
        found = F.when(here, of(entry)) if found is None else found.when(here, of(entry))
    return found.otherwise(otherwise)


@rebuilt_on_change
def finish_stages() -> Stages:
    """From ``found`` and ``detected_format`` to the typed struct ``parsed``."""
    found = F.col("found")
    action_key, protocol_key, severity_key = (
        F.col(f"_{name}_key") for name in ("action", "protocol", "severity"))
    severity = _per_format(lambda e: e.severity(severity_key, F.col("_level")), F.lit("unknown"))
    action = _per_format(lambda e: e.action(action_key), F.lit("unknown"))
    timed = [name for name, entry in _ENTRIES.items() if entry.needs_time]
    bad_date = F.col("detected_format").isin(timed) & F.col("_time").isNull() if timed else F.lit(False)
    parsed = F.when(found.isNotNull(), F.struct(
        F.coalesce("_time", "ingested_at").alias("timestamp"),
        found["src_ip"].alias("src_ip"),
        found["dst_ip"].alias("dst_ip"),
        to_bigint(found["src_port"]).alias("src_port"),
        to_bigint(found["dst_port"]).alias("dst_port"),
        action.alias("action"),
        map_words(protocol_key, PROTOCOL_WORDS, "UNKNOWN").alias("protocol"),
        found["device_vendor"].alias("device_vendor"),
        severity.alias("severity"),
        F.coalesce(found["error_reason"], F.when(bad_date, "timestamp")).alias("error_reason"),
    ))
    from_text = F.when(F.size("_iso") == ISO_PARTS, from_iso_parts(F.col("_iso")))
    return [
        {"_iso": iso_parts(found["time"]),
         "_level": to_bigint(found["severity"]),
         **{f"_{name}_key": word_key(found[name]) for name in ("action", "protocol", "severity")}},
        {"_time": F.when(found["epoch"].isNotNull(), from_epoch(found["epoch"]))
         .otherwise(from_text)},
        {"parsed": parsed},
    ]


register(LogFormat("json", detect.starts_strict_json, lambda only, year: json_stages(only)))
register(LogFormat("cef", detect.has_cef_shape, lambda only, year: cef_stages(only),
                   action=_words(CEF_ACTION_WORDS), severity=cef_severity))
register(LogFormat("syslog", detect.has_syslog_shape, syslog_stages,
                   severity=lambda key, level: device_severity(level), needs_time=True))
