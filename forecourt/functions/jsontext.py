"""Functions over JSON text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from forecourt.fixed_values import PREVIEW_CHARS


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def accident_flag(c: Column | str, pattern: str = "accident") -> Column:
    """Whether the history's icon mentions ``pattern``; anything unreadable is false."""
    icon = F.lower(F.get_json_object(_col(c), "$.icon"))
    return F.coalesce(icon.contains(pattern), F.lit(False))


def owner_count(c: Column | str) -> Column:
    """Entries of ``history``: 0 when the object lacks it, null when it is not a
    list or the text is not an object."""
    text = _col(c)
    listed = F.json_array_length(F.get_json_object(text, "$.history"))
    # only texts without a listed history are parsed for their keys
    absent = ~F.array_contains(F.json_object_keys(text), "history")
    return F.coalesce(listed, F.when(absent, F.lit(0))).cast("bigint")


def service_event_count(c: Column | str) -> Column:
    """``number`` as a whole count: fractions are cut, text counts only when it
    holds a whole number, true counts one, zero and anything else become null."""
    text = _col(c)
    number = F.get_json_object(text, "$.number")
    # only a number that is not whole needs a look at how it was written
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(text), "$.number", "variant"))
    cut = (F.when(kind == "BOOLEAN", (number == "true").cast("bigint"))
           .when(kind != "STRING", number.try_cast("double").try_cast("bigint")))
    return F.nullif(F.coalesce(number.try_cast("bigint"), cut), F.lit(0).cast("bigint"))


def json_list_size(c: Column | str) -> Column:
    """Length of a JSON list; 0 when null or not a list."""
    return F.coalesce(F.json_array_length(_col(c)), F.lit(0)).cast("bigint")


def json_preview(c: Column | str, chars: int = PREVIEW_CHARS) -> Column:
    """The first characters of a value's JSON text."""
    return F.substring(_col(c), 1, chars)
