"""Benchmark decontamination by greedy string tiling.

1. Seeds: every run of ``SEED`` words of a benchmark item is hashed.  A bit table of fixed
   size tells the tasks that read the documents which runs can be seeds at all; only those
   leave the scan and meet the real seeds in a join.
2. A document and an item are a candidate pair where the item's words that shared seeds
   cover reach the wanted share of the item.  Tiles consist of shared seeds, so this bound
   loses no pair.  Pairs are looked for by an item's deciding seeds alone: its seeds that most
   documents hold are left aside as long as they cannot reach that share by themselves, so a
   pair that reaches it shares one of the others.  A line that many items and documents
   have in common so makes no pairs; the common seeds only meet pairs that a rarer one found.
3. For each candidate pair running Karp-Rabin finds the longest common runs of words: the
   longest non-overlapping matches are marked, the search length is lowered, and so on
   down to ``SEED``.  Marked words are not used again, so passages that were reordered are
   found piece by piece and a repeated passage counts once.
4. A pair is contaminated when its tiles cover ``COVERAGE`` of the item's words.

Words are compared lower-cased (A-Z) and without ASCII punctuation.

Defined results: NULL and empty texts or items match nothing; an item of fewer words than
a seed is looked for whole (``item_words`` tells such matches, the pipeline drops nothing for
them); equal matches are taken in the order of their places; rows
that repeat an id with different texts are documents of their own, rows equal in id and text
are taken once; rows without an id match nothing; of items that repeat an id each text is an
item of its own; only the named columns are read; empty tables give an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledger.llm.bits import bit_table, held
from ledger.llm.common import staged
from ledger.llm.hashing import FOLD_ALNUM, shingles, word_hashes

SEED = 5
COVERAGE = 0.6


def _runs(words: np.ndarray, size: int) -> np.ndarray:
    return shingles(words, min(size, len(words))) if len(words) else np.zeros(0, np.uint64)


def keyed(rows: DataFrame, id_col: str, text_col: str, key: str, text: str) -> DataFrame:
    """``key struct<id, v>, text``: a row is named by its id and its text's hash, so texts that
    repeat an id stay apart.  Rows without an id are left out."""
    whole = F.col(text_col).cast("string")
    return rows.where(F.col(id_col).isNotNull()).select(F.struct(F.col(id_col).alias("id"), F.xxhash64(whole).alias("v")).alias(key), whole.alias(text))


def item_seeds(items: DataFrame, id_col: str, text_col: str, size: int = SEED) -> DataFrame:
    """``item, n_words, place, seed``: each run of ``size`` words of each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, offsets = word_hashes(batch.column(1), FOLD_ALNUM)
            ids = batch.column(0).to_pylist()
            for item, a, b in zip(ids, offsets[:-1], offsets[1:]):
                seeds = _runs(words[a:b], size)
                n = len(seeds)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * n, batch.column(0).type), pa.array([int(b - a)] * n, pa.int64()), pa.array(np.arange(n), pa.int64()),
                     pa.array(seeds.view(np.int64))], ["item", "n_words", "place", "seed"])

    rows = keyed(items, id_col, text_col, "item", "text").dropDuplicates(["item"])
    return rows.mapInArrow(run, f"item {rows.schema['item'].dataType.simpleString()}, n_words bigint, place bigint, seed bigint")


def deciding_seeds(seeds: DataFrame, found: DataFrame, size: int = SEED, coverage: float = COVERAGE) -> DataFrame:
    """``item, seed``: of each item's seeds that documents hold (``found(seed, c)``, ``c`` how many)
    the rarest, such that the others together cover less than ``coverage`` of the item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, decide = [], []
            for row, (n, uses) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                covered, step = set(), min(size, n)
                for use in uses:
                    more = {p for place in use["places"] for p in range(place, place + step)} - covered
                    if len(covered) + len(more) < n * coverage:
                        covered |= more
                    else:
                        own.append(row)
                        decide.append(use["seed"])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(own, pa.int64())), pa.array(decide, pa.int64())], ["item", "seed"])

    uses = seeds.join(found, "seed").groupBy("item", "n_words", "seed", "c").agg(F.collect_list("place").alias("places"))
    # One item's seeds, those of most documents first.
    rows = uses.groupBy("item", "n_words").agg(F.sort_array(F.collect_list(F.struct("c", "seed", "places")), asc=False).alias("uses"))
    return rows.mapInArrow(run, f"item {seeds.schema['item'].dataType.simpleString()}, seed bigint")


def matching_runs(docs: DataFrame, table: bytes, bits: int, short: list[int], id_col: str, text_col: str, size: int = SEED) -> DataFrame:
    """``doc, seed``: the distinct runs of each document that the bit table lets pass.
    ``short``: lengths below ``size`` that items have as a whole."""
    shipped = docs.sparkSession.sparkContext.broadcast(table)
    sizes = sorted({size, *short})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, offsets = word_hashes(batch.column(1), FOLD_ALNUM)
            for k in sizes:
                runs = shingles(words, k)
                hits = np.flatnonzero(held(shipped.value, bits, runs))
                doc = np.searchsorted(offsets, hits, "right") - 1
                whole = hits + k <= offsets[doc + 1]
                both = np.unique(np.stack([doc[whole].astype(np.uint64), runs[hits[whole]]]), axis=1) if whole.any() else np.zeros((2, 0), np.uint64)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(both[0].astype(np.int64))), pa.array(both[1].view(np.int64))],
                                                 ["doc", "seed"])

    rows = keyed(docs, id_col, text_col, "doc", "text")
    return rows.mapInArrow(run, f"doc {rows.schema['doc'].dataType.simpleString()}, seed bigint")


def tiles(test: np.ndarray, text: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(place in test, place in text, length) of the greedy tiling of two word sequences.

    From the longest length that can match downwards by halves: all runs of the length are
    hashed on both sides; equal ones that are unmarked are extended as far as they go, the
    longest are marked first.  A match of twice the length starts the search again there.
    A match that a longer tile has partly taken is put back with what is left before that
    tile, so the longest unmarked match always comes next.
    """
    free_a, free_b = np.ones(len(test), bool), np.ones(len(text), bool)
    found: list[tuple[int, int, int]] = []
    length = max(least, min(len(test), len(text)))
    while length >= least:
        matches, longest = [], 0
        starts: dict[int, list[int]] = {}
        for i, h in enumerate(shingles(test, length).tolist()):
            if free_a[i:i + length].all():
                starts.setdefault(h, []).append(i)
        runs = shingles(text, length)
        for j in np.flatnonzero(np.isin(runs, np.fromiter(starts, np.uint64, len(starts)))).tolist() if starts else []:
            if not free_b[j:j + length].all():
                continue
            for i in starts[int(runs[j])]:
                n = length
                while i + n < len(test) and j + n < len(text) and free_a[i + n] and free_b[j + n] and test[i + n] == text[j + n]:
                    n += 1
                longest = max(longest, n)
                matches.append((-n, i, j))
        if longest >= 2 * length:
            length = longest
            continue
        heapq.heapify(matches)
        while matches:
            n, i, j = heapq.heappop(matches)
            free = free_a[i:i - n] & free_b[j:j - n]
            if free.all():
                free_a[i:i - n] = free_b[j:j - n] = False
                found.append((i, j, -n))
                continue
            # What is left behind the tile begins a match of its own.
            n = int(free.argmin())
            if n >= length:
                heapq.heappush(matches, (-n, i, j))
        if length == least:
            break
        length = max(least, length // 2)
    return found


def contaminated(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_col: str, item_text: str, size: int,
                 coverage: float) -> DataFrame:
    """``doc, item, n_tiles, covered, item_words, coverage`` of the pairs, documents and items
    named by id and text."""
    seeds = staged(item_seeds(items, item_col, item_text, size), "seeds")
    table, bits = bit_table(seeds, "seed", seeds.count())
    short = [r[0] for r in seeds.where(F.col("n_words") < size).select("n_words").distinct().collect()]
    hits = matching_runs(docs, table, bits, short, id_col, text_col, size).join(seeds.select("seed").distinct(), "seed", "left_semi")
    hits = staged(hits, "hits")
    found = staged(hits.groupBy("seed").agg(F.count(F.lit(1)).alias("c")), "found")
    deciding = staged(deciding_seeds(seeds, found, size, coverage), "deciding")
    first = staged(hits.join(deciding, "seed").select("doc", "item").distinct(), "first")
    # The pair's shared seeds are looked up from the item's side: an item's length of rows a pair.
    shared = first.join(seeds, "item").join(hits, ["doc", "seed"], "left_semi")
    # An item's words that a shared seed covers: places as intervals, merged per pair.
    pairs = shared.groupBy("doc", "item", "n_words").agg(F.array_sort(F.collect_set("place")).alias("at"))
    step = F.least(F.lit(size), F.col("n_words"))
    bound = F.aggregate(
        "at", F.struct(F.lit(0).cast("bigint").alias("sum"), F.lit(0).cast("bigint").alias("end")),
        lambda s, x: F.struct((s["sum"] + x + step - F.greatest(s["end"], x)).alias("sum"), (x + step).alias("end")), lambda s: s["sum"])
    pairs = staged(pairs.where(bound >= F.col("n_words") * coverage).select("doc", "item"), "pairs")
    texts = keyed(docs, id_col, text_col, "doc", "text").join(pairs.select("doc").distinct(), "doc", "left_semi")
    texts = texts.dropDuplicates(["doc"])
    tests = keyed(items, item_col, item_text, "item", "test").dropDuplicates(["item"])
    joined = pairs.join(tests, "item").join(texts, "doc").select("doc", "item", "test", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            test, at = word_hashes(batch.column(2), FOLD_ALNUM)
            text, to = word_hashes(batch.column(3), FOLD_ALNUM)
            out = []
            for k in range(batch.num_rows):
                a = test[at[k]:at[k + 1]]
                found = tiles(a, text[to[k]:to[k + 1]], min(size, max(len(a), 1)))
                out.append((len(found), sum(n for _, _, n in found), len(a)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array([o[c] for o in out], pa.int64()) for c in range(3))],
                ["doc", "item", "n_tiles", "covered", "item_words"])

    doc, item = joined.schema["doc"].dataType.simpleString(), joined.schema["item"].dataType.simpleString()
    got = joined.mapInArrow(run, f"doc {doc}, item {item}, n_tiles bigint, covered bigint, item_words bigint")
    return got.withColumn("coverage", F.col("covered") / F.col("item_words")).where(F.col("coverage") >= coverage)


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text: str = "text", size: int = SEED, coverage: float = COVERAGE) -> DataFrame:
    """``id_col, item_col, n_tiles, covered, item_words, coverage`` of each pair of a document
    and an item whose tiles cover at least ``coverage`` of the item."""
    got = contaminated(docs, items, id_col, text_col, item_col, item_text, size, coverage)
    return got.select(F.col("doc.id").alias(id_col), F.col("item.id").alias(item_col), "n_tiles", "covered", "item_words", "coverage")


def without_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                         item_text: str = "text", size: int = SEED, coverage: float = COVERAGE) -> DataFrame:
    """``docs`` without those that hold an item of ``size`` words or more; shorter items stand
    in clean texts too and drop nothing.  Of rows that repeat an id only those whose own
    text holds the item go."""
    found = contaminated(docs, items, id_col, text_col, item_col, item_text, size, coverage).where(F.col("item_words") >= size)
    found = staged(found.select(F.col("doc.id").alias("__id"), F.col("doc.v").alias("__v")).distinct(), "contaminated")
    same = (F.col(id_col) == F.col("__id")) & (F.xxhash64(F.col(text_col).cast("string")) == F.col("__v"))
    return docs.join(found, same, "left_anti").select(*docs.columns)
