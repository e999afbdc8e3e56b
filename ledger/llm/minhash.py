"""Near-duplicate documents by b-bit MinHash.

1. Every text becomes the set of its distinct word shingles.  Minima of the set are taken;
   the lowest ``BITS`` bits of the first ``HASHES`` are packed into a signature, and bands,
   each of its own minima that no other band uses, give band keys.
2. Texts with the same set are one *class*; its smallest id stands for it from here on, so
   a third of the corpus being copies of one text is one row.
3. Classes that share a band key are candidates.  Small buckets give their pairs.  Classes
   of large ones are first compared with a central class each, which joins most of a group
   of near copies; pairs of classes that are still apart are then looked for by their
   rarest shingles, an exact test that lets few through, so no list of all pairs is made.
4. A candidate pair survives if its signatures' bit counts, with chance agreement counted in
   (``2 ** -BITS`` of unequal minima agree), do not rule the wanted similarity out, and is
   then confirmed on the full sets.
5. Links make components; every row gets its component's smallest id.

Bands and the signature's bound follow the wanted similarity (``plan``): a pair that just
reaches it is missed by all bands with probability ``MISS`` at most, as no two bands share
a minimum, and by the signature test with ``MISS`` at most; more similar pairs less often.
At 0.85 there are 36 bands of 7, at 0.80 46 bands of 6.

Defined results: NULL, empty and blank texts have no shingles and are linked with nothing;
a text of fewer words than a shingle is one shingle of all its words; rows that repeat an
id with different sets are different nodes of the graph (``node``), each linked by its own
text, and all rows keep theirs; only the id and the text column are read, other columns may
have any name; a row without an id is linked with nothing and has no component; an empty
table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledger.llm.bits import passing
from ledger.llm.common import staged
from ledger.llm.hashing import FOLD_SPACE, mix, shingles, word_hashes

SHINGLE = 5
HASHES, BITS = 128, 2
# A link needs this share of shingles in common, in hundredths.
LEAST = 85
# The same where copies are dropped from a corpus.
LEAST_COPY = 80
# Chance that a pair that just reaches the wanted similarity is lost, by the bands and by the signature.
MISS = 1e-6
# The bands use so many minima at most.
MOST_MINIMA = 320
# So many ids (8 bytes each) may be sent to every task.
BROADCAST_IDS = 1_000_000
# So many shingles of a text are hashed at a time, for all minima.
BLOCK = 1 << 10
# Buckets up to this many classes give all their pairs.
SMALL = 24


class Plan(NamedTuple):
    factors: np.ndarray
    shifts: np.ndarray
    band_seeds: np.ndarray  # bands x rows; band k uses the minima from k * rows on
    least_agreeing: int     # of the signature's HASHES pairs of bits


def _shape(share: float) -> tuple[int, int]:
    """(bands, rows): the most rows whose bands, as many as MISS asks for, use MOST_MINIMA at most."""
    best = None
    for rows in range(1, 33):
        held = share ** rows
        bands = 1 if held >= 1.0 else math.ceil(math.log(MISS) / math.log1p(-held))
        if best is None or bands * rows <= MOST_MINIMA:
            best = bands, rows
    return best


@cache
def plan(least: int) -> Plan:
    """Hash functions, bands and the signature's bound for a similarity of ``least`` hundredths."""
    share = least / 100
    bands, rows = _shape(share)
    rng = np.random.default_rng(20240229)
    n = max(HASHES, bands * rows)
    factors = rng.integers(1, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = rng.integers(0, 1 << 63, n, np.uint64)
    seeds = mix(np.arange(1, bands * rows + 1, dtype=np.uint64)).reshape(bands, rows) | np.uint64(1)
    # The agreeing pairs of bits are binomial; fewer than the bound come with MISS at most.
    agree, below, bound = share + (1 - share) * 2.0 ** -BITS, 0.0, 0
    while bound < HASHES:
        below += math.comb(HASHES, bound) * agree ** bound * (1 - agree) ** (HASHES - bound)
        if below > MISS:
            break
        bound += 1
    return Plan(factors, shifts, seeds, bound)


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingles (64-bit hashes) of each text."""
    words, offsets = word_hashes(column, FOLD_SPACE)
    out = []
    for a, b in zip(offsets[:-1], offsets[1:]):
        own = words[a:b]
        out.append(np.unique(shingles(own, min(size, len(own)))) if len(own) else np.zeros(0, np.uint64))
    return out


def minima(own: np.ndarray, least: int = LEAST) -> np.ndarray:
    """The plan's minima of a set of shingles, in blocks of bounded size."""
    out, (factors, shifts, *_) = None, plan(least)
    for k in range(0, len(own), BLOCK):
        block = own[None, k:k + BLOCK] * factors[:, None]
        block += shifts[:, None]
        low = block.min(axis=1)
        out = low if out is None else np.minimum(out, low)
    return out


def signature(low: np.ndarray) -> np.ndarray:
    """The packed low bits: 2 x 128 bits in four 64-bit numbers."""
    bits = (mix(low[:HASHES]) & np.uint64((1 << BITS) - 1)).reshape(-1, 64 // BITS)
    return (bits << (np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS))).sum(axis=1, dtype=np.uint64)


def band_keys(low: np.ndarray, least: int = LEAST) -> np.ndarray:
    seeds = plan(least).band_seeds
    return mix((low[:seeds.size].reshape(seeds.shape) * seeds).sum(axis=1, dtype=np.uint64) + np.arange(len(seeds), dtype=np.uint64))


def name_of(own: np.ndarray) -> tuple[int, int]:
    """A set's 128-bit name."""
    spread = mix(own + np.uint64(0x51ED270B))
    return tuple(np.array([spread.sum(dtype=np.uint64), np.bitwise_xor.reduce(mix(spread))]).view(np.int64).tolist())


def text_hash(text: Column) -> Column:
    """Tells rows of one id apart that differ in their text."""
    return F.xxhash64(text.cast("string"))


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """``id, v, n, s1, s2, sig, bands`` of every row: the text's hash, and size, 128-bit name,
    signature and band keys of its set (no signature and no bands for an empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = []
            for own in shingle_sets(batch.column(1)):
                if not len(own):
                    cells.append((0, None, None, None, None))
                    continue
                low = minima(own, least)
                cells.append((len(own), *name_of(own), signature(low).view(np.int64), band_keys(low, least).view(np.int64)))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *(pa.array([c[k] for c in cells], t) for k, t in enumerate(kinds))],
                                             ["id", "v", "n", "s1", "s2", "sig", "bands"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), text_hash(F.col(text_col)).alias("v"))
    return rows.mapInArrow(run, "id bigint, v bigint, n bigint, s1 bigint, s2 bigint, sig array<bigint>, bands array<bigint>")


def full_sets(docs: DataFrame) -> DataFrame:
    """``id, v, own``: the whole shingle set of every row of ``docs(id, v, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [s.view(np.int64) for s in shingle_sets(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(own, pa.list_(pa.int64()))], ["id", "v", "own"])

    return docs.select("id", "v", "text").mapInArrow(run, "id bigint, v bigint, own array<bigint>")


def agreeing_bits(a: Column, b: Column) -> Column:
    """How many of the HASHES minima agree in their bits."""
    even = F.lit(0x5555555555555555)

    def agreeing(k: int) -> Column:
        x = a[k].bitwiseXOR(b[k])
        return F.lit(64 // BITS) - F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(even))

    return sum((agreeing(k) for k in range(1, HASHES * BITS // 64)), agreeing(0))


def estimate(a: Column, b: Column) -> Column:
    """Similarity from two packed signatures, corrected for minima that agree by chance."""
    chance = 2.0 ** -BITS
    return (agreeing_bits(a, b) / F.lit(float(HASHES)) - F.lit(chance)) / F.lit(1.0 - chance)


def confirmed(pairs: DataFrame, classes: DataFrame, sets: DataFrame, least: int = LEAST) -> DataFrame:
    """The pairs ``a, b`` whose full sets share at least ``least`` hundredths."""
    side = lambda x, c: classes.select(F.col("id").alias(x), F.col("sig").alias(f"sig_{x}"), F.col("n").alias(f"n_{x}"))
    near = pairs.join(side("a", 0), "a").join(side("b", 0), "b")
    n_a, n_b = F.col("n_a"), F.col("n_b")
    near = near.where((F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * least)
                      & (agreeing_bits(F.col("sig_a"), F.col("sig_b")) >= plan(least).least_agreeing)).select("a", "b")
    full = lambda x: sets.select(F.col("id").alias(x), F.col("own").alias(f"own_{x}"))
    both = near.join(full("a"), "a").join(full("b"), "b")
    shared = F.size(F.array_intersect("own_a", "own_b"))
    union = F.size("own_a") + F.size("own_b") - shared
    return both.where(shared * 100 >= union * least).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """``id, comp`` (smallest id reachable) of every id in ``links(a, b)``.

    Each round points every node at the smallest node next to it and then at where that
    one points; links between nodes of one group vanish, so the table shrinks until it is
    empty.  Every round is written to the shared folder.
    """
    edges = staged(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    label = staged(edges.select(F.explode(F.array("a", "b")).alias("id")).distinct().withColumn("comp", F.col("id")), "label")
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        to = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("to"))
        to = staged(to, "to")
        hop = to.select(F.col("a").alias("to"), F.col("to").alias("far"))
        root = staged(to.join(hop, "to", "left").select("a", F.coalesce(F.least("to", "far"), "to").alias("to")), "root")
        at = root.select(F.col("a").alias("comp"), F.col("to").alias("to"))
        label = staged(label.join(at, "comp", "left").select("id", F.coalesce("to", "comp").alias("comp")), "label")
        x, y = root.select("a", F.col("to").alias("x")), root.select(F.col("a").alias("b"), F.col("to").alias("y"))
        edges = staged(edges.join(x, "a").join(y, "b").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))
                       .where("a <> b").distinct(), "edges")
    return label


def _pairs_within(rows: DataFrame) -> DataFrame:
    """All pairs of buckets that hold SMALL classes at most."""
    members = rows.groupBy("key").agg(F.sort_array(F.collect_list("id")).alias("m"))
    firsts = members.select(F.posexplode("m").alias("k", "a"), "m")
    return firsts.select("a", F.explode(F.slice("m", F.col("k") + 2, SMALL)).alias("b")).where("a <> b").distinct()


def _star_pairs(large: DataFrame) -> DataFrame:
    """Each class of a large bucket with the most central class it shares one with: that
    which lies in the most large buckets."""
    weight = large.groupBy("id").agg(F.count(F.lit(1)).alias("w"))
    centre = large.join(weight, "id").groupBy("key").agg(F.max(F.struct("w", "id")).alias("x"))
    best = large.join(centre, "key").groupBy("id").agg(F.max("x").alias("x"))
    pairs = best.select(F.least("id", "x.id").alias("a"), F.greatest("id", "x.id").alias("b"))
    return pairs.where("a <> b").distinct()


def _prefix_pairs(sets: DataFrame, members: DataFrame, least: int) -> DataFrame:
    """The pairs of ``members(id, n, comp)`` of different groups that can still be linked.

    Shingles are put in one order, rarest first.  Sets that share ``least`` hundredths have
    a shingle in common among their first ``n - least n / 100 + 1``, and where the first
    one stands bounds what they can share at all; both tests are exact.  The own edits of
    a near copy are rare and come first, so copies that differ too much never meet.
    """
    inside = sets.join(members.select("id"), "id", "left_semi").select("id", F.explode("own").alias("s"))
    common = inside.groupBy("s").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    # One document's own shingles that others have too, in order; those it has alone come before.
    own = inside.join(common, "s").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("c", "s"))).alias("own"))
    alone = F.col("n") - F.size("own")
    ahead = F.col("n") - F.ceil(F.col("n") * least / 100) + 1
    first = own.join(members, "id").select(
        "id", "n", "comp", alone.alias("alone"), F.posexplode(F.slice("own", F.lit(1), F.greatest(ahead - alone, F.lit(0)).cast("int"))).alias("k", "x"))
    first = staged(first.select("id", "n", "comp", (F.col("alone") + F.col("k")).alias("at"), F.col("x.s").alias("s")), "prefixes")
    a, b = first.alias("a"), first.alias("b")
    n_a, n_b = F.col("a.n"), F.col("b.n")
    shared = F.least(n_a - F.col("a.at"), n_b - F.col("b.at"))
    able = (F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * least) & (shared * (100 + least) >= (n_a + n_b) * least)
    pairs = a.join(b, (F.col("a.s") == F.col("b.s")) & (F.col("a.id") < F.col("b.id")) & (F.col("a.comp") != F.col("b.comp")) & able)
    return pairs.select(F.col("a.id").alias("a"), F.col("b.id").alias("b")).distinct()


def links_of(classes: DataFrame, docs: DataFrame, id_col: str, text_col: str, least: int = LEAST) -> DataFrame:
    """Links between classes: enough of them to join all that belong together."""
    keyed = classes.select("id", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    rows = staged(keyed.join(shared, "key"), "buckets")
    active = staged(rows.select("id").distinct(), "active")
    # A list of ids of checked size goes to the tasks, or a bit table, so the other texts are not shuffled.
    few = active.count() <= BROADCAST_IDS
    if few:
        active = F.broadcast(active)
    # A class's text is that of the row it was named by: its id and the text's hash.
    wanted = staged(classes.join(active, "id", "left_semi").select("id", "class_id", "v"), "wanted")
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), text_hash(F.col(text_col)).alias("h"), F.col(text_col).cast("string").alias("text"))
    if few:
        wanted = F.broadcast(wanted)
    else:
        texts = texts.where(passing(wanted.select(F.xxhash64("class_id", "v").alias("row")), "row")(F.xxhash64("doc", "h")))
    texts = texts.join(wanted, (F.col("doc") == F.col("class_id")) & (F.col("h") == F.col("v"))).select("id", "v", "text")
    sets = staged(full_sets(texts).select("id", "own").dropDuplicates(["id"]), "sets")
    near = staged(classes.join(active, "id", "left_semi").select("id", "n", "sig"), "classes")

    large = staged(rows.where(F.col("c") > SMALL).select("key", "id"), "large")
    pairs = _pairs_within(rows.where(F.col("c") <= SMALL)).union(_star_pairs(large)).distinct()
    links = staged(confirmed(pairs, near, sets, least), "links")
    if large.isEmpty():
        return links
    members = near.join(large.select("id").distinct(), "id", "left_semi").select("id", "n")
    members = staged(members.join(components(links), "id", "left").select("id", "n", F.coalesce("comp", "id").alias("comp")), "members")
    return staged(links.union(confirmed(_prefix_pairs(sets, members, least), near, sets, least)), "links")


def grouped(docs: DataFrame, id_col: str, text_col: str, least: int) -> DataFrame:
    """``id, v, n, class_id, node, comp, smallest`` of every row: its class, named by the
    smallest id and that row's text, and its component's number and smallest id (NULL where
    the class stands alone).

    ``node`` is the class's number in the graph: its smallest id, and where several classes
    have the same one (an id that repeats with different texts) a hash of id and set."""
    sketch = staged(sketches(docs, id_col, text_col, least), "sketches")
    named = sketch.where("n > 0 and id is not null")
    key = ["s1", "s2", "n"]
    classes = named.groupBy(*key).agg(F.min(F.struct("id", "v")).alias("first")).select(*key, F.col("first.id").alias("class_id"), F.col("first.v").alias("v"))
    classes = staged(classes, "named")
    several = classes.groupBy("class_id").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("class_id", F.lit(True).alias("several"))
    several = staged(several, "several")
    node = F.when(F.col("several"), F.xxhash64("class_id", *key)).otherwise(F.col("class_id"))
    classes = staged(classes.join(several, "class_id", "left").select(*key, "class_id", "v", node.alias("node")), "nodes")
    member = sketch.select("id", "v", *key).join(classes.select(*key, "class_id", "node"), key, "left")
    alone = F.col("id").isNotNull()
    member = member.select("id", "v", "n", F.when(alone, F.coalesce("class_id", "id")).alias("class_id"), F.when(alone, F.col("node")).alias("node"))
    # The row that names a class has its sketch; equal rows give it once.
    chosen = named.withColumnRenamed("id", "class_id").join(classes, [*key, "class_id", "v"]).dropDuplicates(["node"])
    chosen = staged(chosen.select(F.col("node").alias("id"), "class_id", "v", "n", "sig", "bands"), "chosen")
    label = components(links_of(chosen, docs, id_col, text_col, least)).join(chosen.select("id", "class_id"), "id")
    smallest = label.groupBy("comp").agg(F.min("class_id").alias("smallest"))
    label = staged(label.select(F.col("id").alias("node"), "comp").join(smallest, "comp"), "components")
    return member.join(label, "node", "left").select("id", "v", "n", "class_id", "node", "comp", "smallest")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """``id_col, n_shingles, class_id, component_id`` of every row."""
    return grouped(docs, id_col, text_col, least).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "class_id",
                      F.coalesce("smallest", "class_id").alias("component_id"))


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_COPY) -> DataFrame:
    """``docs`` with one row of each component (its smallest id, of several texts under that id
    the one with the smallest hash), every row without a word and every row without an id.

    Only ids and hashes of the rows to drop meet the texts, and only texts that a bit table of
    these rows lets pass: the others, most of a corpus, are not shuffled.  Rows equal in id and
    text are thinned to one where there are any; rows of one id whose texts differ are only
    dropped for being copies."""
    got = staged(grouped(docs, id_col, text_col, least).where("id is not null"), "grouped")
    group = F.coalesce("comp", "node")
    linked = got.where("node is not null").select("id", "v", group.alias("g"))
    first = linked.groupBy("g").agg(F.min(F.struct("id", "v")).alias("first"), F.count(F.lit(1)).alias("c"))
    first = staged(first.where("c > 1"), "first")
    drop = linked.join(first, "g").where(F.struct("id", "v") != F.col("first")).select("id", "v").distinct()
    drop = staged(drop.select(F.col("id").alias("__id"), F.col("v").alias("__v")), "dropped")
    repeats = got.groupBy("id", "v").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    repeats = staged(repeats.select(F.col("id").alias("__id"), F.col("v").alias("__v")), "repeats")
    row = F.col(id_col).cast("long"), text_hash(F.col(text_col))
    met = passing(drop.union(repeats).select(F.xxhash64("__id", "__v").alias("row")), "row")(F.xxhash64(*row))
    same = (row[0] == F.col("__id")) & (row[1] == F.col("__v"))
    kept = docs.where(met).join(drop, same, "left_anti")
    if not repeats.isEmpty():
        several = kept.join(repeats, same, "left_semi").withColumn("__v", row[1]).dropDuplicates([id_col, "__v"]).drop("__v")
        kept = kept.join(repeats, same, "left_anti").unionByName(several)
    return docs.where(~met).unionByName(kept).select(*docs.columns)
