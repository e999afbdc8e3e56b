"""Language identification by rank-order n-gram profiles.

A profile is the list of a language's most frequent character n-grams (one to three
characters of a padded word), most frequent first.  A text gets a list of its own and the
language whose profile is least *out of place*: the sum over the text's n-grams of the
distance between the two ranks, or the profile's length where the profile lacks the n-gram.

Counting covers every labelled row: each task adds up the counts of its rows by language,
Spark sums them and keeps the top ``PROFILE`` per language.  Only the profiles (languages
x PROFILE rows) reach the driver; they go to the tasks with the scoring function.

Defined results: NULL text and text without a letter are ``und`` with score 0; ties go to
the first language in alphabetical order, ties of n-gram counts to the smaller code
points; with no labelled row at all every text is ``und``; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PROFILE = 400
UNKNOWN = "und"
# Stands for the end of a word in n-gram codes; no letter has this code point.
BOUNDARY = np.int64(1)
_FLUSH = 2_000_000


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point, itself where it is a letter, else BOUNDARY."""
    table = np.full(0x110000, BOUNDARY)
    letters = [c for c in range(0x110000) if chr(c).isalpha()]
    table[letters] = letters
    return table


def ngrams(text: str) -> np.ndarray:
    """Codes (21 bits a character) of all n-grams of the text's padded words."""
    points = _letters()[np.frombuffer(("\n" + text.lower() + "\n").encode("utf-32-le", "replace"), np.uint32)]
    line = points[np.append(True, (points[1:] != BOUNDARY) | (points[:-1] != BOUNDARY))]
    if len(line) < 3:
        return np.zeros(0, np.int64)
    a, b, c = line[:-2], line[1:-1], line[2:]
    pairs = line[:-1] | (line[1:] << 21)
    return np.concatenate([line[line != BOUNDARY], pairs, (a | (b << 21) | (c << 42))[b != BOUNDARY]])


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(ngrams(text), return_counts=True)


def top(grams: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent n-grams first; equal counts in the order of their codes."""
    if len(grams) > 4 * size:
        least = np.partition(counts, -size)[-size]
        grams, counts = grams[counts >= least], counts[counts >= least]
    return grams[np.lexsort((grams, -counts))][:size]


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    grams, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return grams, np.bincount(at, np.concatenate([p[1] for p in parts])).astype(np.int64)


def ngram_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang, gram, n`` partial counts: one row per task, language and n-gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def flush():
            for lang, parts in held.items():
                grams, counts = _merged(parts)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(counts)],
                                                 ["lang", "gram", "n"])

        for batch in batches:
            texts: dict[str, list[str]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                texts.setdefault(lang, []).append(text)
            for lang, own in texts.items():
                parts = held.setdefault(lang, [])
                parts.append(counted("\n".join(own)))
                if len(parts) > 16:
                    held[lang] = [_merged(parts)]
            if sum(len(p[0]) for parts in held.values() for p in parts) > _FLUSH:
                yield from flush()
                held.clear()
        yield from flush()

    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    return rows.where("lang is not null and text is not null").mapInArrow(run, "lang string, gram bigint, n bigint")


def learn_profiles(docs: DataFrame, size: int = PROFILE, text_col: str = "text", lang_col: str = "lang") -> dict[str, list[int]]:
    """The profile of every language among the labelled rows of ``docs``."""
    total = ngram_counts(docs, text_col, lang_col).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    rows = total.withColumn("rank", rank).where(F.col("rank") <= size).select("lang", "rank", "gram").collect()
    profiles: dict[str, list[int]] = {}
    for lang, _, gram in sorted(rows):
        profiles.setdefault(lang, []).append(gram)
    return profiles


class Scorer:
    def __init__(self, profiles: dict[str, list[int]], size: int = PROFILE):
        self.size = size
        self.profiles = []
        for lang in sorted(profiles):
            grams = np.array(profiles[lang], np.int64)
            order = np.argsort(grams)
            self.profiles.append((lang, grams[order], order))

    def predict(self, text: str | None) -> tuple[str, float]:
        mine = top(*counted(text), self.size) if text else np.zeros(0, np.int64)
        if not len(mine) or not self.profiles:
            return UNKNOWN, 0.0
        places, best = np.arange(len(mine)), None
        for lang, grams, ranks in self.profiles:
            at = np.minimum(np.searchsorted(grams, mine), len(grams) - 1)
            away = np.where(grams[at] == mine, np.abs(ranks[at] - places), self.size).sum()
            if best is None or away < best[0]:
                best = (away, lang)
        return best[1], float(1.0 - best[0] / (self.size * len(mine)))


def identify(docs: DataFrame, profiles: dict[str, list[int]], id_col: str = "doc_id", text_col: str = "text",
             size: int = PROFILE) -> DataFrame:
    """``id_col, lang_pred, score`` for every row; the text is all that is looked at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(profiles, size)
        for batch in batches:
            got = [scorer.predict(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([g[0] for g in got], pa.string()),
                                              pa.array([g[1] for g in got], pa.float64())], ["id", "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return out.mapInArrow(run, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)


def held_out(id_col: str = "doc_id") -> Column:
    """The agreed split: a quarter of the ids, by their checksum, is never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))
