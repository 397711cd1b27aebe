"""Bits for the places of 64-bit hashes, by which most rows can be left out before a shuffle."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 2 to this power is the largest number of bits of a table; 8 MB.
FILTER_BITS = 26
# Places for each hash, about, in a table that needn't be the largest.
PLACES = 64


def present(hashes: DataFrame) -> np.ndarray:
    """The table of the hashes in the first column.

    It has 2 to the power of `FILTER_BITS` places at most whatever the input, and fewer for few hashes, as functions that hold it are
    kept by the driver. Hashes may share a place, so whoever uses it must bear rows too many. The driver gets a row
    for every 64 places of the largest table that hold any.
    """
    name = hashes.columns[0]
    place = f"shiftrightunsigned({name}, {64 - FILTER_BITS})"
    words = hashes.selectExpr(
        f"cast(shiftrightunsigned({place}, 6) AS int) AS word", f"shiftleft(1L, cast({place} & 63 AS int)) AS bit"
    )
    words = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    at, bits = words["word"].to_numpy().astype(np.int64), words["bits"].to_numpy().view(np.uint64)
    power = max(6, (PLACES * len(at)).bit_length())
    if power > FILTER_BITS - 6:
        table = np.zeros(1 << FILTER_BITS - 6, np.uint64)
        table[at] = bits
        return table
    # The first bits of a hash are its place, so a word of the largest table falls into one place.
    at >>= FILTER_BITS - 6 - power
    table = np.zeros(1 << power - 6, np.uint64)
    np.bitwise_or.at(table, at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
    return table


def among(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash may be in the table; where not, it isn't."""
    place = hashes.view(np.uint64) >> np.uint64(64 - (64 * len(table) - 1).bit_length())
    return (table[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def may_be_in(table: np.ndarray, hash_: Column) -> Column:
    """`among` as a column; only the hashes go to Python. They must not be null."""

    @F.arrow_udf("boolean")
    def found(hashes: pa.Array) -> pa.Array:
        return pa.array(among(table, hashes.to_numpy(zero_copy_only=False)))

    return found(hash_)
