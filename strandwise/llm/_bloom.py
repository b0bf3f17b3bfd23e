"""A set of 64-bit values as a bitmap of fixed size: it thins rows out before a shuffle, the join after it stays exact."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._text import mix

#: 2**24 bits, 2 MB, however many values; with more values it only lets more through.
BITS = 24


def places(values: np.ndarray) -> np.ndarray:
    return (mix(values.astype(np.int64).view(np.uint64)) >> np.uint64(64 - BITS)).astype(np.int64)


def bitmap(df: DataFrame, column: str) -> np.ndarray:
    """The bitmap of an integer column without nulls, as bytes of 0 and 1 packed 8 to one; gathered in parts of 64 bits."""

    def parts(batches):
        seen = np.zeros(0, np.int64)
        for b in batches:
            seen = np.union1d(seen, places(b.column(0).to_numpy(zero_copy_only=False)))
        if len(seen):
            word, first = np.unique(seen >> 6, return_index=True)
            bits = np.bitwise_or.reduceat(np.uint64(1) << (seen & 63).astype(np.uint64), first)
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(bits.view(np.int64))], ["word", "bits"])

    rows = df.select(F.col(column).cast("long")).mapInArrow(parts, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    out = np.zeros(1 << (BITS - 6), np.int64)
    got = rows.toArrow()  # at most 2**18 rows
    out[got["word"].to_numpy()] = got["bits"].to_numpy()
    return out.view(np.uint64)


def may_have(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = places(values)
    return (bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0


def which(bits: np.ndarray, col: pa.Array) -> np.ndarray:
    """Which integers of a column may be in the set; null is not."""
    ok = col.is_valid().to_numpy(zero_copy_only=False)
    return ok & may_have(bits, col.fill_null(0).to_numpy(zero_copy_only=False))


def among(df: DataFrame, column: str, bits: np.ndarray) -> Column:
    """Whether a row's integer may be in the set; null is not."""
    cast = df.sparkSession.sparkContext.broadcast(bits)

    @F.arrow_udf("boolean")
    def test(col: pa.Array) -> pa.Array:
        return pa.array(which(cast.value, col))

    return test(F.col(column).cast("long"))
