"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.session import fresh_dir, settle

__all__ = ["bind", "join_small", "settle", "settle_packed", "sifted"]


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once however often `use` mentions it, also inside lambdas."""
    return F.transform(F.array(value), use)[0]


SIEVE_BITS = (20, 26)  # bits of a sieve, within these bounds


def sifted(big: DataFrame, small: DataFrame, on: str) -> tuple[DataFrame, DataFrame]:
    """(rows of big that may have a partner in small, rows that surely have none), by a bitmap of hashed keys.

    Whatever the sizes, at most 2^(SIEVE_BITS - 6) rows of the bitmap are broadcast; beyond about 2^26 keys more
    rows without a partner count as possible ones. `small` is a settled table, its key of the same type.
    """
    bits = min(max((32 * small.count()).bit_length(), SIEVE_BITS[0]), SIEVE_BITS[1])
    hashed = F.xxhash64(on)
    word = F.shiftrightunsigned(hashed, 64 - bits + 6)
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(xxhash64(`{on}`), {64 - bits}) & 63 as int))")
    sieve = settle(small.groupBy(word.alias("_word")).agg(F.bit_or(bit).alias("_bits")), "sieve")
    held = big.withColumn("_word", word).join(F.broadcast(sieve), "_word", "left")
    found = F.coalesce(F.col("_bits").bitwiseAND(bit) != 0, F.lit(False))
    return held.where(found).select(*big.columns), held.where(~found).select(*big.columns)


def join_small(big: DataFrame, small: DataFrame, on: str | list[str], how: str, max_rows: int = 1_000_000, sift: bool = False) -> DataFrame:
    """Join with a settled table: broadcast if it has at most `max_rows` rows, else by a shuffle.

    The bound is checked by a count of the stored table; the result does not depend on it. With `sift`, for a big
    table of wide rows of which few have a partner, only rows that may have one are shuffled; big is then read
    twice by a left or an anti join.
    """
    if small.limit(max_rows + 1).count() <= max_rows:
        return big.join(F.broadcast(small), on, how)
    if not sift or not isinstance(on, str) or big.schema[on].dataType != small.schema[on].dataType:
        return big.join(small, on, how)
    near, apart = sifted(big, small, on)
    joined = near.join(small, on, how)
    return joined if how in ("inner", "left_semi") else joined.unionByName(apart, allowMissingColumns=True)


def settle_packed(frame: DataFrame, label: str) -> DataFrame:
    """settle() for a table of the input's size: compressed harder."""
    spark, path = frame.sparkSession, fresh_dir(frame.sparkSession, label)
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
