"""Typed predicates over an event's key-value pairs, built in Python and compiled to a Column.

    kv("k") >= 50
    (kv("service", "name").matches("api-*")) & ~kv("level", auto=True).eq("debug")

A path that leads nowhere, or to JSON null, makes a comparison false, so its negation keeps the
event. Numbers are compared with numeric leaves only and text with string leaves only.
"""

from __future__ import annotations

import re
import string

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventloom.functions.keypaths import string_at, type_at, value_at
from eventloom.schema import KeyPath

COMPARE = {
    "eq": lambda a, b: a == b,
    "lt": lambda a, b: a < b,
    "le": lambda a, b: a <= b,
    "gt": lambda a, b: a > b,
    "ge": lambda a, b: a >= b,
}
LONG_RANGE = range(-(2**63), 2**63)


class KvLeaf:
    """A key path waiting for a comparison."""

    def __init__(self, path: KeyPath) -> None:
        self.path = path

    def eq(self, value: str | int | float | bool | None, case_sensitive: bool = False) -> Column:
        if value is None:
            return _settled(type_at(self.path) == "VOID")
        if isinstance(value, bool):
            same = value_at(self.path, "boolean") == F.lit(value)
            return _settled((type_at(self.path) == "BOOLEAN") & same)
        if isinstance(value, str):
            text = string_at(self.path)
            if case_sensitive:
                return _settled(text == F.lit(value))
            return _settled(folded(text) == folded(F.lit(value)))
        return self._number("eq", value)

    def matches(self, pattern: str, case_sensitive: bool = False) -> Column:
        """Whole-string wildcard match: * is any run of characters, ? any one; backslash escapes."""
        regex = wildcard_to_regex(pattern, case_sensitive)
        return _settled(string_at(self.path).rlike(regex))

    def exists(self) -> Column:
        """True where the path leads to any value, JSON null included."""
        return value_at(self.path).isNotNull()

    def __lt__(self, value: int | float) -> Column:
        return self._number("lt", value)

    def __le__(self, value: int | float) -> Column:
        return self._number("le", value)

    def __gt__(self, value: int | float) -> Column:
        return self._number("gt", value)

    def __ge__(self, value: int | float) -> Column:
        return self._number("ge", value)

    def _number(self, op: str, value: int | float) -> Column:
        if isinstance(value, bool) or not isinstance(value, (int, float)):
            raise TypeError(f"numeric comparison needs a number, got {value!r}")
        compare = COMPARE[op]
        kind = type_at(self.path)
        as_double = compare(value_at(self.path, "double"), F.lit(float(value)))
        if isinstance(value, int) and value in LONG_RANGE:
            on_integers = compare(value_at(self.path, "bigint"), F.lit(value).cast("bigint"))
        else:
            on_integers = as_double
        on_fractions = kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT")
        return _settled(F.when(kind == "BIGINT", on_integers).when(on_fractions, as_double))


def kv(*parts: str, auto: bool = False) -> KvLeaf:
    """Start a predicate on a key path; user-generated namespace unless auto=True."""
    return KvLeaf(KeyPath(auto, parts))


def wildcard_to_regex(pattern: str, case_sensitive: bool) -> str:
    body, escaped = [], False
    for char in pattern:
        if escaped:
            body.append(re.escape(char))
            escaped = False
        elif char == "\\":
            escaped = True
        elif char == "*":
            body.append(".*")
        elif char == "?":
            body.append(".")
        else:
            body.append(re.escape(char))
    if escaped:
        body.append(re.escape("\\"))
    flags = "(?s)" if case_sensitive else "(?si)"
    return flags + r"\A" + "".join(body) + r"\z"


def folded(text: Column) -> Column:
    return F.translate(text, string.ascii_lowercase, string.ascii_uppercase)


def _settled(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))
