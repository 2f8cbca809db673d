"""A set of hash beginnings as a bitmap of fixed size, to drop rows early that a join would drop.

The size does not depend on the data; a fuller bitmap lets more rows pass, and the join still decides.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a hash that are looked up: 2 ** 26 of them are 8 MB.
BITS = 26


def bitmap(rows: DataFrame, slot: Column) -> np.ndarray:
    """Bitmap of the values (0 to 2 ** BITS - 1) of a column."""
    found = (
        rows.select(F.shiftright(slot, 6).alias("at"), slot.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
        .groupBy("at")
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
        .toArrow()  # at most 2 ** (BITS - 6) rows
    )
    out = np.zeros(1 << (BITS - 6), np.int64)
    out[found.column("at").to_numpy()] = found.column("bits").to_numpy()
    return out.view(np.uint64)


def holds(bits: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (bits[(slots >> 6).astype(np.int64)] >> (slots & 63).astype(np.uint64)) & np.uint64(1) == 1
