"""Column expressions shared by the operators. All are built-ins, so they stay on the JVM side."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def truth(condition: Column, on_null: bool = False) -> Column:
    """A two-valued condition: NULL becomes `on_null`."""
    return F.coalesce(condition, F.lit(on_null))


def lookup(key: Column, values: Mapping[str, str], default: str | None = None) -> Column:
    """Map a key to a text through a literal map."""
    pairs = [F.lit(item) for pair in values.items() for item in pair]
    found = F.try_element_at(F.create_map(*pairs), key)
    return found if default is None else F.coalesce(found, F.lit(default))


def share(part: Column, whole: Column) -> Column:
    """part / whole as DOUBLE; 0 for an empty whole."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(share(part, whole) * 100, digits)


def minutes_between(earlier: Column, later: Column) -> Column:
    """Whole minutes, days included."""
    return F.timestamp_diff("MINUTE", earlier, later)


def iso_utc(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def thousands(n: Column) -> Column:
    return F.format_number(n, 0)


def embedded_json(text: Column, kind: str = "object") -> Column:
    """The part of a text from the first opening to the last closing bracket; NULL if there is none."""
    pattern = r"(?s)\{.*\}" if kind == "object" else r"(?s)\[.*\]"
    found = F.regexp_extract(text, pattern, 0)
    return F.when(found != "", found)


def suffix_number(text: Column, prefix: str) -> Column:
    """The integer after `prefix`; NULL if the text has another form."""
    digits = F.regexp_extract(text, f"^{prefix}([0-9]+)$", 1)
    return digits.try_cast("int")


def is_json(text: Column) -> Column:
    """Whether a text is exactly one JSON value. The parser alone would accept a value followed by anything."""
    wrapped = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    one = F.try_variant_get(wrapped, "$[0]", "variant").isNotNull() & F.try_variant_get(wrapped, "$[1]", "variant").isNull()
    return F.coalesce(one, F.lit(False))
