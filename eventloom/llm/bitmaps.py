"""Filters of fixed size over 64-bit hashes: a bit for each of the 2^bits values of a hash's top bits."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bitmap_of(frame: DataFrame, column: str, bits: int) -> np.ndarray:
    """The filter of a BIGINT column's values: 2^(bits - 6) rows at most come to the driver, however many values there are."""
    word = F.shiftrightunsigned(column, 64 - bits + 6)
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned({column}, {64 - bits}) & 63 as int))")
    found = frame.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    bitmap = np.zeros(1 << bits - 6, np.int64)
    bitmap[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return bitmap.view(np.uint64)


def is_set(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bits = 5 + len(bitmap).bit_length()
    place = hashes >> np.uint64(64 - bits)
    return bitmap[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1) == 1
