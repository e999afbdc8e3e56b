"""A bit table over 64-bit hashes: tells tasks which hashes can be among many, none missed."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits of the table: 16 a hash, between these bounds (a table of 16 MB at most); of a block: 64 KB.
LEAST_BITS, MOST_BITS, BLOCK_BITS = 16, 27, 19


def bit_table(hashes: DataFrame, column: str, n: int) -> tuple[bytes, int]:
    """The table (its bytes and the number of its bits as a power of 2) of ``n`` hashes.

    Tasks set the bits of a block each, so a block is one row of at most 64 KB and the driver
    only puts the blocks side by side."""
    bits = min(MOST_BITS, max(LEAST_BITS, int(max(n, 1) * 16 - 1).bit_length()))
    block = min(bits, BLOCK_BITS)
    slot = F.shiftrightunsigned(F.col(column), 64 - bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for places in batch.column(1):
                cells = np.zeros(1 << block, np.uint8)
                cells[places.values.to_numpy()] = 1
                rows.append(np.packbits(cells, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], ["block", "cells"])

    cells = hashes.select(slot.alias("slot")).distinct()
    cells = cells.groupBy(F.shiftright("slot", block).cast("int").alias("block")).agg(
        F.collect_list(F.col("slot").bitwiseAND(F.lit((1 << block) - 1)).cast("int")).alias("places"))
    table = bytearray(1 << bits - 3)
    for r in cells.mapInArrow(run, "block int, cells binary").collect():
        table[r["block"] << block - 3:(r["block"] + 1) << block - 3] = r["cells"]
    return bytes(table), bits


def held(table: bytes, bits: int, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes the table lets pass."""
    cells, slot = np.frombuffer(table, np.uint8), hashes >> np.uint64(64 - bits)
    return (cells[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def passing(hashes: DataFrame, column: str) -> Callable[[Column], Column]:
    """A test that every hash in ``hashes`` passes and few others do, for columns of hashes.

    Only the hashes go to the tasks' Python, so rows that fail it need not be shuffled to
    learn that they have no partner in a join."""
    table, bits = bit_table(hashes, column, hashes.count())
    shipped = hashes.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("boolean")
    def test(found: pd.Series) -> pd.Series:
        return pd.Series(held(shipped.value, bits, found.to_numpy().view(np.uint64)))

    return test
