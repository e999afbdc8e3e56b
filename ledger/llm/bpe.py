"""BPE encoding and decoding by prefix-sharing trie traversal.

Spark deals out the documents; inside a task the distinct new words of a batch, put in
order, are a trie read depth first: a word shares the states on the path of the word before
it as far as the two begin alike, and every prefix is encoded once, by its *last token*:

* the encoding of a prefix is the encoding of a shorter prefix plus one last token;
* the last token of a prefix is the one vocabulary token that ends it and is compatible
  with the last token of what precedes it (the two tokens encode to themselves when put
  side by side).

Words that share a prefix share its states, so ``walk walked walking`` costs the prefix
``walk`` once.  The final character carries the word-end mark and is a symbol of its own,
so the word's own last token is found at the end of its path and the shared prefixes
stay as they are.

A prefix's state is its last token and the place where that begins; a word's encoding is
read backwards along its path, so memory is linear in the letters of a word however long.

Only the path of the current word is held, never the whole trie.  Finished words are kept
for later batches of the task in two generations of at most ``MAX_WORDS`` (a word that is
met again moves to the younger one, the older one is dropped when the younger is full);
both are dropped where a batch brings the younger one over ``MAX_LETTERS`` characters.  When
the task ends all of it goes (``rest``): an idle worker holds the vocabulary alone.

Defined results: NULL text encodes like the empty text (no ids, empty decoded text);
repeated rows give repeated results; only the id and text columns are read, so further
columns may have any name; an empty table gives an empty result.
"""

from __future__ import annotations

import gc
import json
import unicodedata
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

# Bounds of what a task keeps between batches: words of a generation and their characters
# (about 200 bytes a word), and pairs of tokens that were compared.
MAX_WORDS, MAX_LETTERS = 250_000, 4_000_000
MAX_PAIRS = 150_000

# Splitting rules of the vocabulary's own file (fixed values).
PIECE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"


def newer_characters() -> frozenset[str]:
    """Characters that Python's own Unicode tables do not know yet: for texts that hold one,
    the library's tables decide on case and letters."""
    known = regex.compile(r"[^\p{Cn}\p{Cs}]")
    return frozenset(c for c in map(chr, range(0x110000)) if unicodedata.category(c) == "Cn" and known.match(c))


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself where it is printable,
    else the next free code point from 256 on."""
    keep = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in keep else chr(next(spare)) for b in range(256)]


class TrieEncoder:
    """Encodes words against a vocabulary with word ends, prefix by prefix.

    Tokens are numbered by merge rank inside (single symbols first), so that of two tokens
    the one made later has the larger number; ``out_ids`` maps back to the file's ids.
    """

    def __init__(self, vocabulary: str):
        spec = json.loads(vocabulary)
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab: dict[str, int] = spec["model"]["vocab"]
        merges = [tuple(m if isinstance(m, list) else m.split(" ", 1)) for m in spec["model"]["merges"]]
        made = {a + b for a, b in merges}
        names = [s for s in sorted(vocab, key=vocab.get) if s not in made]
        self.parts = [(k, k) for k in range(len(names))]
        number = {s: k for k, s in enumerate(names)}
        self.pairs: dict[tuple[int, int], int] = {}
        for a, b in merges:
            if a in number and b in number and a + b in vocab and a + b not in number:
                number[a + b] = self.pairs[number[a], number[b]] = len(names)
                self.parts.append((number[a], number[b]))
                names.append(a + b)
        self.names = names
        self.out_ids = [vocab[s] for s in names]
        strings = {i: s for s, i in vocab.items()} | {i: s for s, i in self.specials.items()}
        self.strings = pa.array([strings.get(i) for i in range(max(strings, default=-1) + 1)], pa.string())
        self.inner = self._backward({s: k for s, k in number.items() if not s.endswith(WORD_END)})
        self.final = self._backward({s[: -len(WORD_END)]: k for s, k in number.items() if s.endswith(WORD_END)})
        self.alphabet = byte_alphabet()
        self.piece = regex.compile(PIECE)
        self.newer = newer_characters()
        self.vocabulary = vocabulary
        self.special = regex.compile("|".join(regex.escape(s) for s in self.specials)) if self.specials else None
        self.rest()

    @staticmethod
    def _backward(table: dict[str, int]) -> dict:
        """The tokens as a trie over their characters from the last to the first; the
        token itself is kept under the empty key."""
        root: dict = {}
        for s, k in table.items():
            at = root
            for c in reversed(s):
                at = at.setdefault(c, {})
            at[""] = k
        return root

    def rest(self) -> None:
        """Drop all but the vocabulary."""
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.letters = 0
        self.fits: dict[int, bool] = {}
        self.path, self.tokens, self.begins = "", [-1], [0]
        self._library = None

    @property
    def library(self) -> Tokenizer:
        """The library's own normalizer and splitter, built where a text needs them."""
        if self._library is None:
            self._library = Tokenizer.from_str(self.vocabulary)
        return self._library

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two tokens stay as they are side by side.

        Undo merges, latest first, on the two sides of the seam: if two parts that touch
        it could have merged before the later of the undone merges, the pair is not what
        merging by rank would have made.
        """
        limit, a, b = 1 << 60, left, right
        while True:
            if self.pairs.get((a, b), 1 << 60) < limit:
                return False
            undo_left = a > b
            for _ in range(2):
                if undo_left:
                    part = self.parts[a][1]
                    if part != a:
                        limit, a = a, part
                        break
                else:
                    part = self.parts[b][0]
                    if part != b:
                        limit, b = b + 1, part
                        break
                undo_left = not undo_left
            else:
                return True

    # -- trie ------------------------------------------------------------------------

    def _last(self, tokens: Sequence[int], text: str, end: int, backward: dict) -> tuple[int, int]:
        """The last token of ``text[:end]`` and where it begins; ``tokens[at]`` is the last
        token of ``text[:at]``."""
        found, at = [], end
        while at:
            at -= 1
            backward = backward.get(text[at])
            if backward is None:
                break
            if "" in backward:
                found.append((backward[""], at))
        fits = self.fits
        for token, at in reversed(found):
            if at == 0:
                return token, 0
            pair = tokens[at] << 32 | token
            ok = fits.get(pair)
            if ok is None:
                ok = fits[pair] = self.compatible(tokens[at], token)
            if ok:
                return token, at
        raise ValueError("the vocabulary cannot spell this word")

    def _insert(self, piece: str) -> list[int]:
        """Go from the path of the piece before to that of ``piece``; its full encoding."""
        path, tokens, begins = self.path, self.tokens, self.begins
        shared, most = 0, min(len(path), len(piece) - 1)
        while shared < most and path[shared] == piece[shared]:
            shared += 1
        del tokens[shared + 1:], begins[shared + 1:]
        for k in range(shared + 1, len(piece)):
            token, at = self._last(tokens, piece, k, self.inner)
            tokens.append(token)
            begins.append(at)
        self.path = piece[:-1]
        token, at = self._last(tokens, piece, len(piece), self.final)
        out = [token]
        while at:
            out.append(tokens[at])
            at = begins[at]
        out.reverse()
        return out

    def learn(self, words: set[str]) -> None:
        """Encode distinct ``words`` not met before, in sorted (depth-first) order."""
        split: dict[str, list[str]] = {}
        for w in words:
            if w[0] == " ":
                split[w] = [] if w[1:] in self.specials else [w[1:]]
            elif w.isascii() and w.isprintable():
                split[w] = [w] if w.isalpha() else self.piece.findall(w)
            else:
                letters = self.alphabet
                split[w] = ["".join([letters[b] for b in p.encode()]) for p in self.piece.findall(w)]
        out = self.out_ids
        ids = {p: array("i", [out[t] for t in self._insert(p)]).tobytes() for p in sorted({p for ps in split.values() for p in ps})}
        self.path, self.tokens, self.begins = "", [-1], [0]
        for w, ps in split.items():
            if len(ps) == 1:
                self.words[w] = ids[ps[0]]
            elif ps or w[0] != " ":
                self.words[w] = b"".join([ids[p] for p in ps])
            else:
                self.words[w] = array("i", [self.specials[w[1:]]]).tobytes()

    # -- texts -----------------------------------------------------------------------

    @staticmethod
    def normal(text: str) -> str:
        # Lower-casing is per character: no special form for a sigma that ends a word.
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def _plain(self, text: str) -> list[str]:
        """The words of a text without special tokens.  A word that begins with a blank is
        one ready piece, cut by the library's own Unicode tables."""
        if not text.isascii() and not self.newer.isdisjoint(text):
            pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
            return [" " + p for p, _ in pieces]
        if ODD.search(text):
            return [w for w in SPACES.split(self.normal(text)) if w]
        return self.normal(text).split()

    def split(self, text: str | None) -> list[str]:
        text = text or ""
        if not (self.special and "<" in text):
            return self._plain(text)
        words, at = [], 0
        for m in self.special.finditer(text):
            words += [*self._plain(text[at:m.start()]), " " + m[0]]
            at = m.end()
        return words + self._plain(text[at:])

    def encode_batch(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text."""
        split = [self.split(t) for t in texts]
        known, older, new = self.words, self.older, set()
        for w in set().union(*split).difference(known):
            if w in older:
                known[w] = older[w]
                self.letters += len(w)
            else:
                new.add(w)
        self.learn(new)
        self.letters += sum(map(len, new))
        out = [np.frombuffer(b"".join(map(known.__getitem__, words)), "<i4") for words in split]
        if self.letters > MAX_LETTERS:
            # The words of one batch may be any size: they are not kept.
            self.words, self.older, self.letters = {}, {}, 0
        elif len(known) > MAX_WORDS:
            self.words, self.older, self.letters = {}, known, 0
        if len(self.fits) > MAX_PAIRS:
            self.fits = {}
        return out

    def encode(self, text: str | None) -> np.ndarray:
        return self.encode_batch([text])[0]

    def decode_batch(self, ids: pa.ListArray) -> pa.Array:
        """The decoded texts: token strings joined by a blank, as the vocabulary's file names
        no decoder."""
        return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, self.strings.take(ids.values)), " ")

    def decode(self, ids) -> str:
        return self.decode_batch(pa.array([ids], pa.list_(pa.int32())))[0].as_py()


# White space of the splitting rule, where str.split() has a wider idea of it.
ODD = regex.compile(r"[\x1c-\x1f]")
SPACES = regex.compile(r"\s+")

_ENCODERS: dict[int, TrieEncoder] = {}


def _encoder(vocabulary: str) -> TrieEncoder:
    """One encoder a worker: its vocabulary outlives the task."""
    key = hash(vocabulary)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = TrieEncoder(vocabulary)
    return _ENCODERS[key]


def encode_documents(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, ids array<int>, decoded string`` for every row of ``docs``.

    The vocabulary file (a fixed public file of about 2 MB) is read once by the driver and
    broadcast.  No shuffle: one pass over the texts.
    """
    with open(vocabulary_path, encoding="utf-8") as f:
        vocabulary = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary.value)
        gc.disable()  # the word tables hold no cycles; walking them again and again costs a third of the time
        try:
            for batch in batches:
                got = encoder.encode_batch(batch.column(1).to_pylist())
                ends = np.cumsum([0, *map(len, got)]).astype("i4")
                flat = np.concatenate(got) if got else np.zeros(0, "i4")
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0), ids, encoder.decode_batch(ids)], ["id", "ids", "decoded"])
        finally:
            encoder.rest()
            gc.enable()
            pa.default_memory_pool().release_unused()

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return out.mapInArrow(run, f"id {kind}, ids array<int>, decoded string").withColumnRenamed("id", id_col)
