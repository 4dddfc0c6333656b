"""JSON object lines whose producers disagree on key names."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from loglathe.contracts import JSON_KEYS
from loglathe.operators.fields import found_struct
from loglathe.operators.stages import Stages

# Fields that count only when the JSON value is a string.
_WORD_FIELDS = ["action", "protocol", "severity"]
_PORT_FIELDS = ["src_port", "dst_port"]
# Fields of which any value is taken as text.
_TEXT_FIELDS = ["src_ip", "dst_ip", "device_vendor"]
_SEPARATOR = "\x01"


def _names() -> Column:
    """The lower-cased keys of ``_js_map``, in its order, by one call for all of them."""
    return F.split(F.lower(F.array_join(F.map_keys("_js_map"), _SEPARATOR)), _SEPARATOR, -1)


def _plain(names: Column) -> Column:
    """Whether these are the lower-cased keys one by one, and no two of them agree."""
    # No key at all, or one that holds the separator, gives another number of names.
    return (F.size(names) == F.size("_js_map")) & (F.size(F.array_distinct(names)) == F.size(names))


def _last_of(lowered: Column) -> Column:
    """A lower-cased key with the value of the last key that reads so."""
    lower = F.transform("_js_keys", lambda k: F.lower(k))
    key = F.get("_js_keys", F.array_position(lower, lowered).cast("int") - 1)
    return F.struct(lowered.alias("key"), F.try_element_at("_js_map", key).alias("value"))


def _first_of(aliases: list[str]) -> Column:
    """The value of the first of these keys that has one; a JSON null is as good as an absent key."""
    values = [F.try_element_at("_js_at", F.lit(alias)) for alias in aliases]
    return F.coalesce(*[F.when(~F.is_variant_null(value), value) for value in values])


@cache
def json_stages(only: bool) -> Stages:
    """``_json``, the texts found in ``_text``; null for lines of other formats.

    ``_json_array`` holds the line parsed as the only element of an array, null if
    that fails.
    """
    when = F.lit(True) if only else F.col("detected_format") == "json"
    wanted = sorted({alias for aliases in JSON_KEYS.values() for alias in aliases})
    known = F.array(*[F.lit(alias) for alias in wanted])

    def text_of(field: str, *kinds: str) -> Column:
        """The text of a value, of these kinds alone: STRING, BIGINT (443.0 is a DECIMAL), and so on."""
        value = F.col(f"_js_{field}")
        text = value.cast("string")
        return F.when(F.schema_of_variant(value).isin(*kinds), text) if kinds else text

    when_string = {f: text_of(f, "STRING") for f in _WORD_FIELDS}
    when_whole = {f: text_of(f, "BIGINT", "STRING") for f in _PORT_FIELDS}
    as_text = {f: text_of(f) for f in _TEXT_FIELDS}
    error = (
        F.when(F.col("_js").isNull(), "json").when(F.col("_js_map").isNull(), "not_object")
    )
    return [
        {"_js": F.when(when, F.try_variant_get("_json_array", "$[0]", "variant")),
         "_js_map": F.when(when & F.startswith("_text", F.lit("{")), F.try_variant_get(
             "_json_array", "$[0]", "map<string,variant>"))},
        {"_js_names": _names(),
         # A VARIANT keeps its keys sorted; the text still has them in document order, which counts
         # where two keys differ in case alone. Newest key first, so that the first hit of a
         # lower-cased key is the last one.
         "_js_keys": F.when(F.col("_js_map").isNotNull() & ~_plain(_names()),
                            F.reverse(F.array_distinct(F.json_object_keys("_text"))))},
        # Functions of array elements are interpreted, so they are kept for lines that need them.
        {"_js_at": F.when(_plain(F.col("_js_names")), F.map_from_arrays(
            "_js_names", F.map_values("_js_map"))).otherwise(F.map_from_entries(F.transform(
                F.array_intersect(F.transform("_js_keys", lambda k: F.lower(k)), known), _last_of)))},
        {f"_js_{field}": _first_of(aliases) for field, aliases in JSON_KEYS.items()},
        {"_json": F.when(when, found_struct(
            epoch=F.when(F.schema_of_variant("_js_timestamp") != "STRING",
                         F.col("_js_timestamp").cast("string").try_cast("double")),
            time=text_of("timestamp", "STRING"),
            error_reason=error, **when_string, **when_whole, **as_text))},
    ]
