"""Chosen keys kept as plain typed columns beside the VARIANT columns, so that predicates on them reach the scan.

A kept key has five columns: the kind of what is found there, and its value as 64-bit integer, fraction, text or truth
value, each null unless the leaf has that type. Predicates on them never are null and name plain columns only, so
parquet skips row groups by their statistics and the VARIANT column is not read.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.keypaths import integer_at, string_at, type_at, value_at
from eventloom.functions.predicates import COMPARE, LONG_RANGE, KvLeaf, folded, wildcard_to_regex
from eventloom.schema import KeyPath

PREFIX = "kept_"
EXACT = 2**53  # below it every integer is a double


def kept_column(path: KeyPath, what: str) -> str:
    """Readable, and unique by a digest: names that differ in case or punctuation only stay apart."""
    digest = hashlib.md5(json.dumps(path.parts).encode()).hexdigest()[:12]
    return f"{PREFIX}{path.namespace}_{re.sub('[^A-Za-z0-9]+', '_', '_'.join(path.parts))[:40]}_{digest}_{what}"


def keep_keys(events: DataFrame, paths: Iterable[KeyPath]) -> DataFrame:
    """Add the columns of each path; do this before store_events."""
    added = {}
    for path in paths:
        kind = F.regexp_extract(type_at(path), "^[A-Z]+", 0)  # without a decimal's digits or an object's fields
        fraction = F.when(kind.isin("DECIMAL", "DOUBLE", "FLOAT"), value_at(path, "double"))
        flag = F.when(kind == "BOOLEAN", value_at(path, "boolean"))
        for what, value in (
            ("kind", kind), ("long", integer_at(path)), ("fraction", fraction), ("text", string_at(path)), ("flag", flag)
        ):
            added[kept_column(path, what)] = value
    return events.withColumns(added)


def kept_columns(events: DataFrame) -> set[str]:
    return {name for name in events.columns if name.startswith(PREFIX)}


class KeptLeaf(KvLeaf):
    """A kept key path waiting for a comparison, with the meaning of KvLeaf."""

    def _column(self, what: str) -> Column:
        return F.col(kept_column(self.path, what))

    def eq(self, value: str | int | float | bool | None, case_sensitive: bool = False) -> Column:
        if value is None:
            return _sure(self._column("kind"), lambda kind: kind == "VOID")
        if isinstance(value, bool):
            return _sure(self._column("flag"), lambda flag: flag == F.lit(value))
        if isinstance(value, str):
            if case_sensitive:
                return _sure(self._column("text"), lambda text: text == F.lit(value))
            return _sure(self._column("text"), lambda text: folded(text) == folded(F.lit(value)))
        return self._number("eq", value)

    def matches(self, pattern: str, case_sensitive: bool = False) -> Column:
        regex = wildcard_to_regex(pattern, case_sensitive)
        return _sure(self._column("text"), lambda text: text.rlike(regex))

    def exists(self) -> Column:
        return self._column("kind").isNotNull()

    def _number(self, op: str, value: int | float) -> Column:
        if isinstance(value, bool) or not isinstance(value, (int, float)):
            raise TypeError(f"numeric comparison needs a number, got {value!r}")
        on_fractions = _sure(self._column("fraction"), lambda x: COMPARE[op](x, F.lit(float(value))))
        return _sure(self._column("long"), lambda x: _on_integers(op, x, value)) | on_fractions


def leaf_of(events: DataFrame, path: KeyPath) -> KvLeaf:
    """The leaf that reads a kept key's columns where the table has them, else the VARIANT column."""
    return KeptLeaf(path) if kept_column(path, "kind") in events.columns else KvLeaf(path)


def _on_integers(op: str, x: Column, value: int | float) -> Column:
    """A 64-bit integer against a number; fractions are moved to the next integer, so that the scan can compare."""
    if isinstance(value, int) and value in LONG_RANGE:
        return COMPARE[op](x, F.lit(value).cast("bigint"))
    if not (math.isfinite(value) and abs(value) < EXACT):
        return COMPARE[op](x.cast("double"), F.lit(float(value)))
    if op == "eq" and not float(value).is_integer():
        return F.lit(False)
    bound = math.ceil(value) if op in ("ge", "lt") else math.floor(value)
    return COMPARE[op](x, F.lit(bound).cast("bigint"))


def _sure(column: Column, test) -> Column:
    """False, not null, where there is no value; in a form that the scan takes."""
    return column.isNotNull() & test(column)
