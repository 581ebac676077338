"""Bit filters of 64-bit codes: bounded in size, built by Spark, read by tasks as numbers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A filter has 16 bits a code and MOST_BITS bits (64 MB) at most; PACKED words of 64 bits travel in a row.
LEAST_BITS, MOST_BITS, PACKED = 1 << 16, 1 << 29, 64


def code_bits(codes: DataFrame, code: str = "code") -> np.ndarray:
    """The filter of distinct codes as 64-bit words; it reaches the driver as at most 131,072 rows of packed words."""
    words = min(MOST_BITS, max(LEAST_BITS, 1 << (16 * codes.count()).bit_length())) // 64
    marked = codes.select(F.pmod(F.shiftrightunsigned(code, 6), F.lit(words)).alias("word"), F.col(code).bitwiseAND(63).cast("int").alias("bit"))
    bits = marked.groupBy("word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits"))
    each = [F.bit_or(F.when(F.col("word") % PACKED == k, F.col("bits")).otherwise(0)) for k in range(PACKED)]
    packed = bits.groupBy(F.expr(f"word div {PACKED}").alias("row")).agg(F.array(*each).alias("packed")).toArrow()
    out = np.zeros((words // PACKED, PACKED), np.int64)
    if packed.num_rows:
        out[packed.column("row").to_numpy()] = packed.column("packed").combine_chunks().flatten().to_numpy().reshape(-1, PACKED)
    return out.ravel().view(np.uint64)


def passing(bits: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Places of the codes (uint64) that may be in the filter."""
    word = ((codes >> np.uint64(6)) % np.uint64(len(bits))).astype(np.int64)
    return np.flatnonzero(bits[word] >> (codes & np.uint64(63)) & np.uint64(1))
