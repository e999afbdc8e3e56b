"""Phrase collocation mining with weighted acyclic automata.

Phrases are runs of 2 to 4 words of a piece of text (``TEXT`` is lower-cased and cut at
punctuation and line ends), counted for each language.

1. *What can be frequent.*  A frequent phrase has frequent parts only.  For lengths 1, 2, 3
   and 4 in turn the hashes of the phrases whose parts have all passed are counted by Spark;
   those that reach ``least`` set bits in a table of bounded size, which goes to the tasks of
   the next pass.  A table lets some others pass as well, but never stops a frequent one.
2. *Shards.*  A task counts the phrases that pass exactly, by their words, and each time it has
   about ``SHARD`` of them puts them in order and builds count transducers from them, depth by
   depth, one for each prefix range.
3. *Union.*  The transducers of a range meet in one task, which adds them up, a
   few at a time; what stays below ``least`` goes, so sums are exact.
4. *Parts.*  A phrase's counts are looked up for its parts: a range builds an automaton of the
   parts it needs from every other range, that range composes it with its transducer, and
   the answers go back.  Then each phrase has its score and tells which parts it makes superfluous.

Prefix ranges are ranges of the hash of a phrase's language and first word; a first word with
more than a range's share of all words has ranges of its own by the second word.  Their number
follows the number of frequent phrases (``RANGE`` each) and the session's shuffle partitions,
so a task holds a bounded part of the phrases whatever the corpus or its most frequent word.

Counts are Python's integers in the tasks and 64 bits in the tables.  Defined results: NULL
texts are empty, a NULL language is ``und``; repeated rows count each; ties are ordered as
stated in ``collocations``; only the named columns are read; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledger.llm.automata import Automaton, Rows, padded, summed
from ledger.llm.bits import bit_table, held
from ledger.llm.common import staged
from ledger.llm.hashing import _powers, mix, text_bytes

LONGEST = 4
LEAST = 30
# A part of which so many hundredths of the occurrences lie in one longer phrase is superfluous.
SWALLOWED = 80
SCALE = 2_000_000
TOP = 2000
UNKNOWN = "und"
# Bytes of text looked at together, hashes counted together, phrases of a shard and of a range.
BLOCK = 1 << 22
HASHES = 1 << 20
SHARD = 1_500_000
RANGE = 200_000
# Transducers of a range that are added up at a time.
TOGETHER = 8

# A-Z lower-cased, blank and tab between words, punctuation and line ends between pieces.
SPACE, BREAK = 0x20, 0x0A
FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x41:0x5B] += 32
FOLD[0x09] = SPACE
FOLD[0x0A:0x0E] = BREAK
FOLD[list(b".,;:!?")] = BREAK

_U = np.uint64
_NEXT = _U(0xD6E8FEB86659FD93)


class Words(NamedTuple):
    data: np.ndarray    # folded bytes
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    pieces: np.ndarray  # words of one piece have one number
    texts: np.ndarray   # the text each word belongs to


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    """The words of folded bytes; ``offsets`` are the texts' n + 1 bounds."""
    n = len(data)
    inside = (data != SPACE) & (data != BREAK)
    new = np.zeros(n + 1, bool)
    new[offsets] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | new[1:n]
    last[:-1] &= ~inside[1:] | new[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    texts = np.searchsorted(offsets, starts, "right") - 1
    if not len(starts):
        return Words(data, starts, ends, np.zeros(0, _U), starts, texts)
    lengths = np.diff(np.append(starts, n))
    place = np.arange(n - starts[0]) - np.repeat(starts - starts[0], lengths)
    own, letters = inside[starts[0]:], data[starts[0]:]
    values = (letters.astype(_U) + _U(1)) * own * _powers(int(lengths.max()))[place]
    hashes = mix(np.add.reduceat(values, starts - starts[0]) + (ends - starts).astype(_U))
    return Words(data, starts, ends, hashes, np.cumsum(data == BREAK)[starts] + texts, texts)


def blocks(column: pa.Array) -> Iterator[tuple[Words, int]]:
    """The words of a column of texts in blocks of about ``BLOCK`` bytes, cut between pieces,
    and the number of the first text of each."""
    data, offsets = text_bytes(column)
    data, at, n = FOLD[data], 0, len(data)
    while at < n:
        to = min(n, at + BLOCK)
        if to < n:
            text_end = int(offsets[np.searchsorted(offsets, to, "right") - 1])
            breaks = np.flatnonzero(data[at:to] == BREAK)
            best = max(text_end, at + int(breaks[-1]) + 1 if len(breaks) else 0)
            if best <= at:  # one piece is longer than a block: it stays whole
                best = int(offsets[np.searchsorted(offsets, to, "right")])
                later = np.flatnonzero(data[to:best] == BREAK)
                best = to + int(later[0]) + 1 if len(later) else best
            to = best
        a, b = np.searchsorted(offsets, at, "right") - 1, np.searchsorted(offsets, to, "left")
        yield words_of(data[at:to], np.clip(offsets[a:b + 1], at, to) - at), int(a)
        at = to


def label_hashes(labels: Sequence[str]) -> np.ndarray:
    """Hash of each of some labels (languages or words), whatever characters they hold."""
    data, offsets = text_bytes(pa.array(labels, pa.string()))
    out = np.zeros(len(labels), _U)
    lengths = np.diff(offsets)
    if len(data):
        place = np.arange(len(data)) - np.repeat(offsets[:-1], lengths)
        values = (data.astype(_U) + _U(1)) * _powers(int(lengths.max()))[place]
        full = lengths > 0
        out[full] = np.add.reduceat(values, offsets[:-1][full])
    return mix(out + lengths.astype(_U))


def passing(words: Words, lang: np.ndarray, tables: list[tuple[bytes, int]], longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For lengths 1, 2, ... the places where a phrase begins whose parts have passed, and its
    hash; ``lang`` is the hash of each word's language."""
    n = len(words.hashes)
    at, hashes = np.arange(n), mix(words.hashes + lang)
    for k in range(1, longest + 1):
        yield at, hashes
        if k == longest:
            return
        good = held(*tables[k - 1], hashes)
        at, hashes = at[good], hashes[good]
        passed = np.zeros(n + 1, bool)
        passed[at] = True
        last = at + k
        good = passed[at + 1] & (last < n)
        good[good] = words.pieces[at[good]] == words.pieces[last[good]]
        at, hashes = at[good], mix(hashes[good] * _NEXT + words.hashes[at[good] + k])


def hash_counts(docs: DataFrame, tables: list[tuple[bytes, int]], length: int) -> DataFrame:
    """``h, c`` of the phrases of ``length`` words whose parts have passed, counted in parts."""
    shared = docs.sparkSession.sparkContext.broadcast(tables)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0

        def counted() -> pa.RecordBatch:
            h, c = np.unique(np.concatenate(waiting), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c.astype(np.int64))], ["h", "c"])

        for batch in batches:
            langs = label_hashes(batch.column(0).to_pylist())
            for words, first in blocks(batch.column(1)):
                *_, (_, hashes) = passing(words, langs[words.texts + first], shared.value, length)
                waiting.append(hashes)
                size += len(hashes)
                if size >= HASHES:
                    yield counted()
                    waiting, size = [], 0
        if size:
            yield counted()

    return docs.mapInArrow(run, "h bigint, c bigint")


class Ranges(NamedTuple):
    """Prefix ranges: ``count`` by language and first word; those of ``hot`` (hash of both ->
    first range, how many) have further ones by the second word."""
    count: int
    hot: dict[int, tuple[int, int]]


def _part(h: np.ndarray, count: int | np.ndarray) -> np.ndarray:
    """Which of ``count`` equal ranges of 32 high bits a hash lies in."""
    return (h >> _U(32)) * np.asarray(count, _U) >> _U(32)


def range_of(labels: Sequence[str], rows: Rows, ranges: Ranges) -> np.ndarray:
    """The range of each sequence ``(language, word, ...)`` of label numbers."""
    hashes = np.append(label_hashes(labels), _U(0))
    size = (rows >= 0).sum(axis=1)
    lang, word = hashes[rows[:, 0]], hashes[rows[:, 1]] if rows.shape[1] > 1 else _U(0)
    first = np.where(size > 1, mix(word + lang), lang)
    out = _part(first, ranges.count).astype(np.int64)
    if ranges.hot and rows.shape[1] > 2:
        hot = np.flatnonzero(np.isin(first, np.fromiter(ranges.hot, _U, len(ranges.hot))) & (size > 2))
        second = mix(hashes[rows[hot, 2]] + first[hot])
        own = np.array([ranges.hot[h] for h in first[hot].tolist()], np.int64).reshape(-1, 2)
        out[hot] = own[:, 0] + _part(second, own[:, 1]).astype(np.int64)
    return out


def plan_ranges(frequent: DataFrame, phrases: int, partitions: int) -> Ranges:
    """Ranges for so many frequent phrases; ``frequent(h, c)`` are the words."""
    count = max(1, partitions, math.ceil(phrases / RANGE))
    total = frequent.agg(F.sum("c")).first()[0] or 0
    # Words that have more than a range's share: there are fewer of them than ranges.
    hot, base = {}, count
    for r in frequent.where(F.col("c") * count > total).orderBy("h").collect():
        parts = -(-r["c"] * count // total)
        hot[r["h"] % (1 << 64)] = base, parts
        base += parts
    return Ranges(count, hot)


class Counts:
    """A task's phrases, counted exactly: sequences of the numbers of their labels (the language
    and the words by their bytes)."""

    def __init__(self) -> None:
        self.numbers: dict[str, int] = {}
        self.rows: list[Rows] = []
        self.counts: list[np.ndarray] = []
        self.size = 0

    def number(self, labels: Sequence[str]) -> np.ndarray:
        known = self.numbers
        return np.array([known.setdefault(label, len(known)) for label in labels], np.int64)

    def take(self, rows: Rows, counts: np.ndarray) -> None:
        self.rows.append(padded(rows.astype(np.int32), LONGEST + 1))
        self.counts.append(counts.astype(np.int64))
        self.size += len(rows)

    def add(self, words: Words, langs: Sequence[str], lang: np.ndarray, tables: list[tuple[bytes, int]]) -> None:
        """Count a block's phrases that pass; ``langs`` are its texts' languages."""
        if not len(words.starts):
            return
        text_lang = self.number(langs)
        head, size = np.unique(text_lang[words.texts], return_counts=True)
        self.take(head[:, None], size)
        number, before, heads = np.full(len(words.hashes), -1, np.int64), text_lang[words.texts], np.arange(len(self.numbers))[:, None]
        for k, (at, hashes) in enumerate(passing(words, lang, tables, LONGEST)):
            at = at[held(*tables[k], hashes)]
            if not len(at):
                return
            if not k:
                own, spelled = _spelled(words, at)
                number[at] = self.number(spelled)[own]
            width = len(self.numbers)
            pair, which, times = np.unique(before[at] * width + number[at + k], return_inverse=True, return_counts=True)
            heads = np.hstack([heads[pair // width], (pair % width)[:, None]])
            before = np.full(len(words.hashes), -1, np.int64)
            before[at] = which
            self.take(heads, times)

    def merge(self) -> None:
        rows, counts = summed(np.vstack(self.rows), np.concatenate(self.counts))
        self.rows, self.counts, self.size = [rows], [counts], len(rows)

    def by_range(self, ranges: Ranges) -> Iterator[pa.RecordBatch]:
        """One transducer for each range."""
        if not self.size:
            return
        labels = sorted(self.numbers)
        place = np.full(len(labels) + 1, -1, np.int32)
        place[self.number(labels)] = np.arange(len(labels))
        rows, counts = summed(place[np.vstack(self.rows)], np.concatenate(self.counts))
        yield from _by_range(labels, rows, counts, ranges)


def _spelled(words: Words, at: np.ndarray) -> tuple[np.ndarray, list[str]]:
    """Numbers of the words at some places, equal for equal bytes, and the words by number."""
    starts, lengths = words.starts[at], (words.ends - words.starts)[at]
    ends = np.cumsum(lengths)
    place = np.arange(int(ends[-1])) + np.repeat(starts - (ends - lengths), lengths)
    offsets = np.append(0, ends).astype(np.int64)
    own = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(words.data[place])).dictionary_encode()
    return own.indices.to_numpy().astype(np.int64), own.dictionary.to_pylist()


def shards(docs: DataFrame, tables: list[tuple[bytes, int]], ranges: Ranges) -> DataFrame:
    """``range, blob``: count transducers of the phrases that pass, shard by shard."""
    shared, full = docs.sparkSession.sparkContext.broadcast((tables, ranges)), SHARD

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, ranges = shared.value
        counts = Counts()
        for batch in batches:
            langs = batch.column(0).to_pylist()
            hashes = label_hashes(langs)
            for words, first in blocks(batch.column(1)):
                last = first + int(words.texts[-1]) + 1 if len(words.texts) else first
                counts.add(words, langs[first:last], hashes[words.texts + first], tables)
                if counts.size >= full:
                    counts.merge()
                    if 2 * counts.size >= full:
                        yield from counts.by_range(ranges)
                        counts = Counts()
        yield from counts.by_range(ranges)

    return docs.mapInArrow(run, "range int, blob binary")


def _by_range(labels: list[str], rows: Rows, counts: np.ndarray, ranges: Ranges) -> Iterator[pa.RecordBatch]:
    """Transducers of sorted sequences, one for each range."""
    if not len(rows):
        return
    own = range_of(labels, rows, ranges)
    order = np.argsort(own, kind="stable")
    for group in np.split(order, np.flatnonzero(np.diff(own[order])) + 1):
        blob = Automaton.of_sorted(labels, rows[group], counts[group]).dumps()
        yield pa.RecordBatch.from_arrays([pa.array([int(own[group[0]])], pa.int32()), pa.array([blob], pa.binary())], ["range", "blob"])


def _grouped(rows: DataFrame, *order: str) -> DataFrame:
    """Rows of a range together in one task, in order, to be read one after the other."""
    return rows.repartition("range").sortWithinPartitions("range", *order)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def united(parts: DataFrame, least: int) -> DataFrame:
    """``range, blob``: the sum of all transducers of each range, frequent phrases only.

    ``TOGETHER`` at a time, so a task holds a range's distinct phrases and a few transducers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, waiting = None, []

        def whole() -> pa.RecordBatch:
            # Sequences of one label, the language, count all its words: they always stay.
            blob = Automaton.union(waiting, least).dumps()
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([blob], pa.binary())], ["range", "blob"])

        for where, blob in _rows(batches):
            if where != at and waiting:
                yield whole()
                waiting = []
            at = where
            waiting.append(Automaton.loads(blob))
            if len(waiting) == TOGETHER:
                waiting = [Automaton.union(waiting)]
        if waiting:
            yield whole()

    return _grouped(parts.select("range", "blob")).mapInArrow(run, "range int, blob binary")


def cut_out(rows: Rows, start: int, end: int) -> Rows:
    """The language and words ``start`` to ``end`` (from 0, exclusive) of each phrase."""
    return padded(np.hstack([rows[:, :1], rows[:, 1 + start:1 + end]]), LONGEST + 1)


def phrases_by_size(rows: Rows, counts: np.ndarray) -> Iterator[tuple[int, Rows, np.ndarray]]:
    """The phrases of 2, 3, ... words."""
    size = (rows >= 0).sum(axis=1) - 1
    for k in range(2, LONGEST + 1):
        own = np.flatnonzero(size == k)
        if len(own):
            yield k, padded(rows[own], LONGEST + 1), counts[own]


def asked(whole: DataFrame, ranges: Ranges) -> DataFrame:
    """``range, source, blob``: the parts that the phrases of range ``source`` need from ``range``:
    those of every cut, and every run of words within a phrase."""
    shared = whole.sparkSession.sparkContext.broadcast(ranges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for source, blob in _rows(batches):
            counts = Automaton.loads(blob)
            parts = [cut_out(rows, i, j) for k, rows, _ in phrases_by_size(*counts.rows()) for i in range(k) for j in range(i + 1, k + 1)
                     if j - i < k and (i == 0 or j == k or j - i > 1)]
            if parts:
                rows = np.vstack(parts)
                rows, ones = summed(rows, np.ones(len(rows), np.int64))
                for batch in _by_range(counts.labels, rows, np.ones_like(ones), shared.value):
                    yield batch.append_column("source", pa.array([source], pa.int32()))

    return whole.select("range", "blob").mapInArrow(run, "range int, blob binary, source int")


def answered(whole: DataFrame, questions: DataFrame) -> DataFrame:
    """``range, blob``: for the range that asked, the counts of the parts it asked for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, counts = None, None
        for where, source, blob in _rows(batches):
            if source < 0:
                at, counts = where, Automaton.loads(blob)
            elif where == at:
                found = counts.compose(Automaton.loads(blob))
                yield pa.RecordBatch.from_arrays([pa.array([source], pa.int32()), pa.array([found.dumps()], pa.binary())], ["range", "blob"])

    rows = whole.select("range", F.lit(-1).alias("source"), "blob").union(questions.select("range", "source", "blob"))
    return _grouped(rows, "source").select("range", "source", "blob").mapInArrow(run, "range int, blob binary")


def weakest_cut(rows: Rows, a: np.ndarray, size: int, labels: list[str], parts: Automaton) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``score, l, r`` of each phrase's cut with the lowest score, the first of equal ones."""
    left = np.stack([parts.look_up(labels, cut_out(rows, 0, k)) for k in range(1, size)])
    right = np.stack([parts.look_up(labels, cut_out(rows, k, size)) for k in range(1, size)])
    # Products beyond 64 bits are taken with Python's integers.
    exact = a if int(a.max()) < 1 << 42 else a.astype(object)
    scores = SCALE * exact[None] // (left + right)
    best, own = np.argmin(scores.astype(np.int64), axis=0), np.arange(len(a))
    return scores[best, own], left[best, own], right[best, own]


ROW = "lang string, phrase string, a bigint, l bigint, r bigint, score bigint, kind string"


def scored(whole: DataFrame, answers: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, score, kind``: candidates (``phrase``), what longer ones make
    superfluous (``part``) and the languages' words (``total``)."""
    kinds = [pa.string(), pa.string(), *[pa.int64()] * 4, pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, waiting, out = None, [], []

        def full() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["lang", "phrase", "a", "l", "r", "score", "kind"])

        for where, last, blob in _rows(batches):
            if where != at:
                at, waiting = where, []
            if not last:
                waiting.append(blob)
                continue
            own = Automaton.loads(blob)
            parts = Automaton.union([Automaton.loads(b) for b in waiting])
            waiting, names = [], own.labels
            rows, counts = own.rows()
            told = lambda part: (names[part[0]], " ".join(names[w] for w in part[1:] if w >= 0))
            single = (rows >= 0).sum(axis=1) == 1
            out += [(names[k], None, c, None, None, None, "total") for k, c in zip(rows[single, 0].tolist(), counts[single].tolist())]
            for size, phrases, a in phrases_by_size(rows, counts):
                score, left, right = (x.tolist() for x in weakest_cut(phrases, a, size, names, parts))
                out += [(*told(p), *x, "phrase") for p, *x in zip(phrases.tolist(), a.tolist(), left, right, score)]
                for i, j in ((i, j) for i in range(size) for j in range(i + 2, size + 1) if j - i < size):
                    part = cut_out(phrases, i, j)
                    over = 100 * a >= SWALLOWED * parts.look_up(names, part)
                    out += [(*told(p), None, None, None, None, "part") for p in np.unique(part[over], axis=0).tolist()]
                if len(out) >= 10_000:
                    yield full()
                    out = []
        if out:
            yield full()

    rows = answers.select("range", F.lit(0).alias("last"), "blob").union(whole.select("range", F.lit(1), "blob"))
    return _grouped(rows, "last").select("range", "last", "blob").mapInArrow(run, ROW)


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first ``top`` phrases by score
    (falling), count (falling) and phrase (bytes)."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    tables: list[tuple[bytes, int]] = []
    words, phrases = None, 0
    for length in range(1, LONGEST + 1):
        frequent = hash_counts(rows, tables, length).groupBy("h").agg(F.sum("c").alias("c")).where(F.col("c") >= least)
        frequent = staged(frequent, f"frequent-{length}")
        words = words or frequent
        n = frequent.count()
        phrases += n
        tables.append(bit_table(frequent, "h", n))
    ranges = plan_ranges(words, phrases, int(spark.conf.get("spark.sql.shuffle.partitions")))
    whole = staged(united(shards(rows, tables, ranges), least), "transducers")
    found = staged(scored(whole, answered(whole, asked(whole, ranges))), "phrases")
    superfluous = found.where("kind = 'part'").select("lang", "phrase").distinct()
    kept = found.where("kind = 'phrase'").join(superfluous, ["lang", "phrase"], "left_anti")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    kept = kept.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    totals = found.where("kind = 'total'").select("lang", F.col("a").alias("n"))
    return kept.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
