"""License scan: exact phrases, and fuzzy search for short notices.

A notice of ``n`` characters that occurs with at most ``k`` edits still holds one of its
``k + 1`` equal pieces unchanged (pigeonhole).  So all pieces of all notices are searched
exactly in one pass (Aho-Corasick), each hit opens a window around the place where its
notice would stand, and only there the regex library's bounded-error matching looks for
the notice, counts the edits and gives the span.

Texts are compared as words: A-Z is lower-cased and words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``
are joined by one blank, so layout and punctuation cost no edits.

Defined results: NULL and empty texts have no words, no places, no spans; ties between
notices give one span each; repeated rows give repeated results; only the id and the text
column are read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Phrase -> label.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Opening words of well-known notices -> label (texts as the licences print them).
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the apache license version 2 0": "apache",
    "under the terms of the gnu general public license": "gpl",
    "licensed under the gnu general public license": "gpl",
    "under the terms of the gnu lesser general public license": "lgpl",
    "redistribution and use in source and binary forms": "bsd",
    "subject to the terms of the mozilla public license": "mpl",
    "permission to use copy modify and or distribute this software": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "licensed under a creative commons attribution": "cc-by",
    "licensed under cc by": "cc-by",
    "the eclipse public license": "epl",
    "released under the mit license": "mit",
}
# One edit is allowed for so many characters of a notice.
CHARS_PER_EDIT = 12

_OTHER = [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_FOLD = bytes(0x20 if b in _OTHER else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """The words of a text in UTF-8, A-Z lower-cased."""
    return (text or "").encode().translate(_FOLD).split()


class NoticeFinder:
    """Seeds, windows and verification for one set of notices."""

    def __init__(self, notices: Mapping[str, str], chars_per_edit: int = CHARS_PER_EDIT):
        self.seeds = ahocorasick.Automaton()
        seeds: dict[str, list[tuple[int, int]]] = {}
        self.notices = []
        for n, (text, label) in enumerate(notices.items()):
            edits = max(1, len(text) // chars_per_edit)
            cuts = [len(text) * i // (edits + 1) for i in range(edits + 2)]
            for a, b in zip(cuts, cuts[1:]):
                seeds.setdefault(text[a:b], []).append((n, a))
            self.notices.append((label, edits, len(text), regex.compile(f"(?e)(?:{regex.escape(text)}){{e<={edits}}}")))
        for seed, uses in seeds.items():
            self.seeds.add_word(seed, (len(seed), uses))
        self.seeds.make_automaton()
        self.verify = lru_cache(maxsize=4096)(self._verify)

    def _verify(self, n: int, window: str) -> tuple[tuple[int, int, int], ...]:
        return tuple((m.start(), m.end(), sum(m.fuzzy_counts)) for m in self.notices[n][3].finditer(window))

    def find(self, text: str) -> list[tuple[str, int, int, int, float]]:
        """(label, start, end, edits, similarity) of each notice in the normal text."""
        windows: dict[int, list[list[int]]] = {}
        for end, (size, uses) in self.seeds.iter(text):
            for n, offset in uses:
                _, edits, length, _ = self.notices[n]
                # A match whose seed stands here lies between these bounds.
                at = end + 1 - size - offset
                a, b = max(0, at - edits), at + length + edits
                spans = windows.setdefault(n, [])
                if spans and a <= spans[-1][1]:
                    spans[-1][0], spans[-1][1] = min(a, spans[-1][0]), max(b, spans[-1][1])
                else:
                    spans.append([a, b])
        out = []
        for n, spans in windows.items():
            label, _, length, _ = self.notices[n]
            for a, b in spans:
                for s, e, edits in self.verify(n, text[a:b]):
                    out.append((label, a + s, a + e, edits, 1.0 - edits / length))
        return sorted(out, key=lambda x: (x[1], x[2], x[0]))


def phrase_places(words: list[bytes], phrases: Mapping[str, str]) -> list[tuple[str, int]]:
    """(label, first word) of every place where a phrase's words stand in a row."""
    line, out = b" " + b" ".join(words) + b" ", []
    for phrase, label in phrases.items():
        needle = f" {phrase} ".encode()
        at, counted, n = line.find(needle), 0, 0
        while at >= 0:
            n += line.count(b" ", counted, at)
            counted = at
            out.append((label, n))
            at = line.find(needle, at + 1)
    return out


SCHEMA = ("n_words bigint, phrases array<struct<label:string,word:bigint>>, "
          "spans array<struct<label:string,first_word:bigint,last_word:bigint,edits:int,similarity:double,text:string>>")

ARROW = [
    pa.int64(),
    pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())])),
    pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("edits", pa.int32()),
                        ("similarity", pa.float64()), ("text", pa.string())])),
]


def scan_licenses(docs: DataFrame, phrases: Mapping[str, str] = PHRASES, notices: Mapping[str, str] = NOTICES,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: word count, the exact phrase places and the fuzzy notice spans
    (in words, the last one included, with edits and the text found).  One pass, no shuffle."""
    phrases, notices = dict(phrases), dict(notices)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = NoticeFinder(notices)
        for batch in batches:
            counts, places, spans = [], [], []
            for text in batch.column(1).to_pylist():
                words = words_of(text)
                counts.append(len(words))
                places.append([{"label": x, "word": w} for x, w in phrase_places(words, phrases)])
                line = b" ".join(words).decode()
                spans.append([
                    {"label": x, "first_word": (first := line.count(" ", 0, a)), "last_word": first + line.count(" ", a, b),
                     "edits": edits, "similarity": like, "text": line[a:b]}
                    for x, a, b, edits, like in finder.find(line)])
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(v, k) for v, k in zip((counts, places, spans), ARROW))],
                                             ["id", "n_words", "phrases", "spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return out.mapInArrow(run, f"id {kind}, {SCHEMA}").withColumnRenamed("id", id_col)
