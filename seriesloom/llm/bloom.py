"""Bloom bits of a column of 64-bit values: a filter before a shuffle, never instead of a join."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from seriesloom.llm import textkit as K

#: Bits of one piece; the whole is 2**20 to 2**28 bits (32 MB) whatever the number of values.
WIDTH = 1 << 16
#: Values up to which the bits sort out nearly all others; beyond, callers may choose a join.
MOST = (1 << 28) // 8


def places(values: np.ndarray, k: int, size: int) -> np.ndarray:
    step = K.GOLDEN * np.full(1, k, dtype=np.uint64)
    return (K.mix(values.astype(np.int64).view(np.uint64) + step) & np.uint64(size - 1)).astype(np.int64)


def may_hold(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    """False for values that are surely absent."""
    found = np.ones(len(values), dtype=bool)
    for k in (1, 2):
        at = places(values, k, len(bits) * 8)
        found &= (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
    return found


def bits_of(values: DataFrame) -> np.ndarray:
    """Packed Bloom bits of the only column of ``values``."""
    size = 1 << min(28, max(20, (16 * values.count()).bit_length()))

    def mark(batches):
        bits = np.zeros(size // 8, dtype=np.uint8)
        for batch in batches:
            for k in (1, 2):
                at = places(batch.column(0).to_numpy(), k, size)
                np.bitwise_or.at(bits, at >> 3, (128 >> (at & 7)).astype(np.uint8))
        for k, part in enumerate(bits.reshape(-1, WIDTH // 8)):
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([part.tobytes()])], ["slice", "bits"])

    def unite(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                x = np.frombuffer(part, dtype=np.uint8)
                total[k] = total[k] | x if k in total else x
        for k, x in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([x.tobytes()])], ["slice", "bits"])

    total = np.zeros((size // WIDTH, WIDTH // 8), dtype=np.uint8)
    for r in values.mapInArrow(K.tidied(mark), "slice bigint, bits binary").repartition("slice").mapInArrow(unite, "slice bigint, bits binary").collect():
        total[r.slice] = np.frombuffer(r.bits, dtype=np.uint8)
    return total.reshape(-1)
