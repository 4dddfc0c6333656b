"""Timestamps: everything ends up as ``YYYY-MM-DDTHH:MM:SSZ`` text in UTC."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from loglathe.functions.text import capture, strip

ISO_UTC = "yyyy-MM-dd'T'HH:mm:ss'Z'"
_IST_DISPLAY = "dd MMM yyyy, hh:mm:ss a 'IST'"

# Calendar limits of the years 1 to 9999 in epoch seconds.
_MIN_SECONDS, _MAX_SECONDS = -62135596800, 253402300799
# Epoch numbers above this are milliseconds.
_MILLIS_FROM = 10_000_000_000

# Extended or basic date, then optionally any separator, a time, a fraction, an offset.
_ISO_PATTERN = (
    r"(?s)^(\d{4})(-?)(\d{2})\2(\d{2})"
    r"(?:.(\d{2})(?:(:?)(\d{2})(?:\6(\d{2})(?:[.,]\d+)?)?)?"
    r"(?:([+-])(\d{2})(?::?(\d{2})(?::?(\d{2})(?:\.\d+)?)?)?)?)?$"
)


def utc_now() -> str:
    """The driver's clock, taken once per job so that task retries agree."""
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def format_utc(ts: Column) -> Column:
    return F.date_format(ts, ISO_UTC)


def from_epoch(number: Column) -> Column:
    """Epoch seconds or milliseconds (a double) to UTC text; null out of range."""
    seconds = F.when(number > _MILLIS_FROM, number / 1000).otherwise(number)
    whole = F.floor(seconds)
    return F.when(
        seconds.between(_MIN_SECONDS, _MAX_SECONDS),
        format_utc(F.timestamp_seconds(whole)),
    )


ISO_PARTS = 12


def iso_parts(text: Column) -> Column:
    """The groups of ISO-8601 text, null if malformed; input of ``from_iso_parts``.

    Keep the result in a column of its own: the next step reads it many times.
    """
    return capture(F.replace(strip(text), F.lit("Z"), F.lit("+00:00")), _ISO_PATTERN, ISO_PARTS)


def from_iso_parts(parts: Column) -> Column:
    """UTC text; a time without an offset is UTC; null if there is no such date."""
    def number(i: int) -> Column:
        text = F.get(parts, F.lit(i))
        return F.when(text == "", 0).otherwise(text.try_cast("int"))

    local = F.try_make_timestamp(*[number(i) for i in (0, 2, 3, 4, 6, 7)])
    offset = number(9) * 3600 + number(10) * 60 + number(11)
    shift = F.when(F.get(parts, F.lit(8)) == "-", -offset).otherwise(offset)
    valid = (number(7) < 60) & (offset < 86400)
    return F.when(valid, format_utc(F.timestamp_seconds(F.unix_seconds(local) - shift)))


def bsd_as_iso(month: Column, day: Column, time: Column, year: Column) -> Column:
    """A date without a year (``Oct 12 14:32:07``) as ISO text; null for no such month."""
    position = F.instr(F.lit("JanFebMarAprMayJunJulAugSepOctNovDec"), month)
    month_no = F.when(position % 3 == 1, F.lpad(
        F.floor((position + 2) / 3).cast("string"), 2, "0"))
    return F.concat(year.cast("string"), F.lit("-"), month_no, F.lit("-"),
                    F.lpad(day, 2, "0"), F.lit("T"), time)


def ist_display(utc_text: Column) -> Column:
    """Stored UTC text as an Indian-time label; anything else is left unchanged."""
    stamp = F.when(
        utc_text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}Z$"),
        F.try_to_timestamp(utc_text, F.lit("y-M-d'T'H:m:s'Z'")))
    shown = F.date_format(F.from_utc_timestamp(stamp, "Asia/Kolkata"), _IST_DISPLAY)
    return F.coalesce(shown, utc_text)
