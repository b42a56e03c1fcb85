"""A filter of fixed size for hashes, built by Spark: which of 2^22 slots hold one of some hashes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

SLOTS = 1 << 22
_PER_ROW = 32_768  # bits of one bitmap row


def slot_filter(df: DataFrame, hashes: Column | str) -> np.ndarray:
    """A flag per slot, 512 KB on its way however many hashes there are.  More hashes let more
    strangers through; whoever uses the filter joins exactly afterwards."""
    slot = F.col(hashes) if isinstance(hashes, str) else hashes
    slot = slot.bitwiseAND(F.lit(SLOTS - 1)) + 1
    rows = df.groupBy(F.bitmap_bucket_number(slot).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")).collect()
    flags = np.zeros(SLOTS, bool)
    for r in rows:
        bits = np.unpackbits(np.frombuffer(bytes(r.bits), np.uint8), bitorder="little")
        flags[(r.bucket - 1) * _PER_ROW:(r.bucket - 1) * _PER_ROW + len(bits)] = bits.astype(bool)
    return flags


def passes(flags: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return flags[(hashes & hashes.dtype.type(SLOTS - 1)).astype(np.int64)]
