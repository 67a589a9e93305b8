"""Resolve key paths inside an event's VARIANT columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventloom.schema import KeyPath


def _quoted(part: str) -> str | None:
    """One bracketed path segment, so that a dot in a key stays part of that key."""
    if "'" not in part:
        return f"['{part}']"
    if '"' not in part:
        return f'["{part}"]'
    return None


def value_at(path: KeyPath | None, as_type: str = "variant") -> Column:
    """The value at a full path, null where the path does not lead to one.

    The whole path is a single variant_get wherever the keys can be quoted, which lets Spark read
    only that field of a shredded VARIANT column and push comparisons on it into the scan.
    """
    if path is None or not path.parts:
        return F.lit(None).cast(as_type)
    at: Column = F.col(path.column)
    pending = ""
    for part in path.parts:
        segment = _quoted(part)
        if segment is not None:
            pending += segment
            continue
        # A key holding both quote marks has no path syntax: step into it as a map entry.
        if pending:
            at = F.try_variant_get(at, "$" + pending, "variant")
            pending = ""
        at = F.element_at(at.try_cast("map<string,variant>"), part)
    if pending or as_type != "variant":
        at = F.try_variant_get(at, "$" + pending, as_type)
    return at


def type_at(path: KeyPath | None) -> Column:
    """Name of the type found at a path ('STRING', 'BIGINT', 'VOID' for JSON null, ...)."""
    return F.schema_of_variant(value_at(path))


def string_at(path: KeyPath | None) -> Column:
    """The value at a path if it really is a string; no casts from other types."""
    return F.when(type_at(path) == "STRING", value_at(path, "string"))


def integer_at(path: KeyPath | None) -> Column:
    """The value at a path if it really is a 64-bit integer; no casts from other types."""
    return F.when(type_at(path) == "BIGINT", value_at(path, "bigint"))
