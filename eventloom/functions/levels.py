"""Log level names and codes."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventloom.schema import LEVEL_NAMES

_KNOWN = LEVEL_NAMES[1:]
# One ASCII character (so exactly one byte), then a level name. (?s) lets that be a newline.
_AFTER_FIRST_BYTE = r"(?s)\A\p{ASCII}(" + "|".join(_KNOWN) + ")"


def level_from_name(name: Column) -> Column:
    """Code of a level name in any ASCII case, 0 for anything else.

    Only a-z are folded: Unicode folding would turn some non-ASCII names into level names.
    """
    folded = F.translate(name, string.ascii_lowercase, string.ascii_uppercase)
    place = F.array_position(F.array(*[F.lit(n) for n in _KNOWN]), folded)
    return F.coalesce(place, F.lit(0)).cast("tinyint")


def level_from_logtype(logtype: Column) -> Column:
    """Code of the level name that starts at the second byte of a message template, else 0."""
    name = F.regexp_extract(logtype, _AFTER_FIRST_BYTE, 1)
    place = F.array_position(F.array(*[F.lit(n) for n in _KNOWN]), name)
    return F.coalesce(place, F.lit(0)).cast("tinyint")


def level_name(code: Column) -> Column:
    """Name of a level code, null outside the known codes."""
    return F.try_element_at(F.array(*[F.lit(n) for n in LEVEL_NAMES]), code.cast("int") + 1)
