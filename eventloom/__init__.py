"""Log events as Spark tables: many log streams per DataFrame, one row per event."""

from eventloom.functions.predicates import kv
from eventloom.schema import KeyPath, ReaderOptions

__all__ = ["KeyPath", "ReaderOptions", "kv"]
