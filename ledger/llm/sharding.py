"""Even shards by histogram sort.

Rows are ordered by a 64-bit key: the upper bits come from the text, the lower ones from
the id, so copies of one text lie side by side and a text that many rows share can still
be cut.  Splitters are found without sorting: bytes are counted exactly below candidate
boundaries (equal cells of the key space), the cells that hold a wanted splitter or too
many rows are refined, and so on until every splitter is within tolerance.  Only then are
the rows exchanged, once, by shard and cell, and numbered.

The histogram holds at most ``2 ** FIRST`` cells in the first round and ``2 ** NEXT`` for
each refined cell after it; at most ``MOST_ROWS`` parts plus the splitters' cells are
refined, so its size does not depend on the data.

Defined results: NULL text has no bytes (size 8); rows with equal id and text are told
apart only by their order; an empty table gives an empty result; only the id and the text
column are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledger.llm.common import staged

KEY_BITS, ID_BITS = 63, 24
FIRST, NEXT = 10, 6
# A cell with more than this part of the rows is refined, so no task numbers more of them.
MOST_ROWS = 512
TOLERANCE = 0.0005
OVERHEAD = 8


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, size, text_crc32, key`` with keys of ``KEY_BITS`` bits (never negative)."""
    text = F.col(text_col).cast("string")
    low = (1 << ID_BITS) - 1
    of_text = F.shiftrightunsigned(F.xxhash64(text), 64 - KEY_BITS).bitwiseAND(F.lit(~low))
    key = of_text.bitwiseOR(F.xxhash64(F.lit(1), F.col(id_col)).bitwiseAND(F.lit(low)))
    return docs.select(F.col(id_col), (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
                       F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"), key.alias("key"))


def prefix(bits: int) -> Column:
    """The key's upper ``bits`` bits: the number of its cell of that fineness."""
    return F.shiftright(F.col("key"), KEY_BITS - bits)


def refine(rows: DataFrame, shards: int) -> tuple[list[int], dict[int, list[int]]]:
    """(the first key of each shard but the first, the refined cells by number of bits)."""
    n_rows, n_bytes = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    wanted = [n_bytes * k / shards for k in range(1, shards)]
    allowed = max(1.0, TOLERANCE * n_bytes / shards)
    splitters: list[int] = [1 << KEY_BITS] * len(wanted)
    missing = set(range(len(wanted))) if n_rows else set()
    refined: dict[int, list[int]] = {}
    bits, parent_bits, inside, below = FIRST, 0, rows, {0: 0}
    while True:
        cells: dict[int, list[tuple[int, int, int]]] = {}
        for cell, size, count in inside.groupBy(prefix(bits).alias("cell")).agg(F.sum("size"), F.count(F.lit(1))).collect():
            cells.setdefault(cell >> (bits - parent_bits), []).append((cell, size, count))
        again: dict[int, int] = {}
        for parent, own in cells.items():
            at = below[parent]
            for cell, size, count in sorted(own):
                for k in [k for k in missing if at <= wanted[k] <= at + size]:
                    near = min(wanted[k] - at, at + size - wanted[k])
                    if near <= allowed or count == 1 or bits == KEY_BITS:
                        splitters[k] = (cell + (wanted[k] - at > at + size - wanted[k])) << (KEY_BITS - bits)
                        missing.discard(k)
                    else:
                        again[cell] = at
                if count > max(1, n_rows // MOST_ROWS) and bits < KEY_BITS:
                    again[cell] = at
                at += size
        if not again:
            return splitters, refined
        refined[bits], below = sorted(again), again
        inside = inside.where(prefix(bits).isin(refined[bits]))
        bits, parent_bits = min(KEY_BITS, bits + NEXT), bits


def cell_of(refined: dict[int, list[int]]) -> Column:
    """The first key of the finest counted cell that holds the row."""
    levels = [*refined, min(KEY_BITS, max(refined) + NEXT)] if refined else [FIRST]
    out = None
    for bits in reversed(levels):
        here = F.shiftleft(prefix(bits), KEY_BITS - bits)
        out = here if out is None else F.when(prefix(bits).isin(refined[bits]), out).otherwise(here)
    return out


def even_shards(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, size, text_crc32, shard, slot``: contiguous key ranges of near equal bytes.

    ``slot`` numbers a shard's rows from 0 in key order: the rows before a cell are summed
    over the cells (a bounded table), the rows of a cell are numbered in its own task.
    """
    rows = staged(sized(docs, id_col, text_col), "sized")
    splitters, refined = refine(rows, shards)
    shard = sum((F.when(F.col("key") >= F.lit(s), 1).otherwise(0) for s in splitters if s < 1 << KEY_BITS), F.lit(0))
    placed = rows.withColumn("shard", shard.cast("int")).withColumn("cell", cell_of(refined))
    counts = placed.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("shard", "cell", F.coalesce(before, F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("shard", "cell").orderBy("key", id_col))
    # The cells are a bounded table (see above), so they may be sent to every task.
    out = placed.withColumn("own", own).join(F.broadcast(offsets), ["shard", "cell"])
    return out.select(id_col, "size", "text_crc32", "shard", (F.col("before") + F.col("own") - 1).cast("long").alias("slot"))
