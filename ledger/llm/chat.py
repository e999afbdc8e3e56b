"""Chat formatting by incremental black-box rendering.

A template is any function from a list of ``(role, text)`` turns to a string; nothing is
known of how it works.  Where each turn lies in its output is found by rendering alone:

* the prefixes of 0, 1, 2, ... turns are rendered one after the other; where each output
  begins with the one before, what it adds is the new turn's span;
* the newest turn is rendered once more with a probe in place of its text, a character that
  the output does not hold; the two outputs differ exactly where the text stands, so the
  text's own span is known whatever the template puts around it;
* an output that does not begin with the one before has *rewritten history* (some templates
  drop earlier reasoning, move a system turn, or close the last turn in a special way).
  The turns of such a conversation are found in the final output instead: each turn's text
  in turn is replaced by a probe there, and a text that the template has dropped has no span.

The texts of the roles in ``learn_from`` make the loss mask.  ``chatml`` is the template
used here; it marks turns by control strings and escapes these inside roles and texts by one
backslash more, which ``unescaped`` takes away again, so a text that holds control strings
can neither end its turn nor begin another.

A conversation is one row of the result, so it is put together in one task.  Whole prefixes
are rendered whatever its length, so its time grows with the square of its turns; a template
that says by ``by_turn`` that it renders each turn by itself, as ``chatml`` does, is rendered
in windows of ``WINDOW`` turns, each beginning with the last turn of the one before, and so
in linear time.  The windows' output must be the template's own for the whole conversation,
else the template does more than it says and whole prefixes are rendered after all.  The way
follows from the template alone, never from the size of the input.

Defined results: NULL roles and texts are empty; turns that tie are ordered by role, then
text; repeated rows are turns of their own; a row without a conversation's id is a
conversation of its own; other columns may have any name; an empty table gives no rows.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator, Sequence
from itertools import chain
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]
Template = Callable[[Sequence[Turn]], str]
Span = tuple[int, int] | None

START, END = "<|im_start|>", "<|im_end|>"
WINDOW = 64
LEARN_FROM = ("assistant",)


def escaped(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescaped(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escaped_role(role: str) -> str:
    return escaped(role).replace("%", "%25").replace("\n", "%0A")


def unescaped_role(role: str) -> str:
    return unescaped(role.replace("%0A", "\n").replace("%25", "%"))


def by_turn(template: Template) -> Template:
    """Marks a template as one that renders each turn by itself, whatever stands around it."""
    template.by_turn = True
    return template


@by_turn
def chatml(turns: Sequence[Turn]) -> str:
    return "".join(f"{START}{escaped_role(role)}\n{escaped(text)}{END}\n" for role, text in turns)


def read_turn(piece: str) -> Turn:
    """Role and text of a turn as ``chatml`` wrote it."""
    role, body = piece[len(START):].split("\n", 1)
    return unescaped_role(role), unescaped(body[:body.index(END)])


class Rendered(NamedTuple):
    text: str
    turns: list[Span]    # each turn's place in the text; None where history was rewritten
    bodies: list[Span]   # the place of its text; None where the template has dropped it
    rewrites: bool


def _probe(out: str, text: str) -> str:
    """A private character that neither the output nor the text holds."""
    return next(c for c in map(chr, chain(range(0xE000, 0xF900), range(0xF0000, 0x10FFFE))) if c not in out and c not in text)


def _alike(a: str, b: str) -> int:
    """How many characters two strings share from the start."""
    if b.startswith(a):
        return len(a)
    return len(os.path.commonprefix([a, b]))


def _body(template: Template, turns: Sequence[Turn], k: int, out: str) -> Span:
    """Where the text of turn ``k`` stands in ``out``, the rendering of ``turns``."""
    role, text = turns[k]
    probe = _probe(out, text)
    other = template([*turns[:k], (role, probe), *turns[k + 1:]])
    if other.count(probe) != 1:
        return None  # dropped, or written several times
    start = other.index(probe)
    end = len(out) - (len(other) - start - 1)
    return (start, end) if start <= end and out[:start] == other[:start] and out[end:] == other[start + 1:] else None


def _grown(template: Template, turns: Sequence[Turn]) -> tuple[str, list[Span], list[Span]] | None:
    """Spans from successive prefixes; None where one rewrites what came before."""
    out, spans, bodies = template([]), [], []
    for k in range(len(turns)):
        more = template(turns[:k + 1])
        if _alike(out, more) < len(out):
            return None
        spans.append((len(out), len(more)))
        bodies.append(_body(template, turns[:k + 1], k, more))
        out = more
    return out, spans, bodies


def _in_windows(template: Template, turns: Sequence[Turn]) -> tuple[str, list[Span], list[Span]] | None:
    """The same from windows of turns; None where a window's first turn is not rendered as it
    was at the end of the window before."""
    pieces, spans, bodies, at = [], [], [], 0
    for first in range(0, len(turns), WINDOW - 1):
        got = _grown(template, turns[first:first + WINDOW])
        if got is None:
            return None
        out, own, inside = got
        if first:
            a, b = own[0]
            if out[:a] or out[a:b] != pieces[-1]:
                return None
            own, inside = own[1:], inside[1:]
        elif own and own[0][0]:
            return None  # the template writes something before the first turn
        for (a, b), body in zip(own, inside):
            spans.append((at, at + b - a))
            bodies.append(body and (body[0] - a + at, body[1] - a + at))
            pieces.append(out[a:b])
            at += b - a
        if first + WINDOW >= len(turns):
            break
    return "".join(pieces), spans, bodies


def render(template: Template, turns: Sequence[Turn]) -> Rendered:
    """The conversation's output and where its turns and their texts stand in it."""
    got = _in_windows(template, turns) if getattr(template, "by_turn", False) else None
    if got is None or got[0] != template(turns):
        got = _grown(template, turns)
    if got:
        return Rendered(*got, rewrites=False)
    out = template(turns)
    return Rendered(out, [None] * len(turns), [_body(template, turns, k, out) for k in range(len(turns))], True)


SPAN = "struct<start:int,end:int>"
SCHEMA = f"formatted string, turns array<{SPAN}>, bodies array<{SPAN}>, loss array<boolean>, rewrites boolean"
_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])


def _spans(rows: list[list[Span]]) -> pa.Array:
    return pa.array([[s and {"start": s[0], "end": s[1]} for s in row] for row in rows], pa.list_(_SPAN))


def format_conversations(turns: DataFrame, template: Template = chatml, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", learn_from: Sequence[str] = LEARN_FROM) -> DataFrame:
    """``id_col, formatted, turns, bodies, loss, rewrites`` of every conversation: the output,
    the spans (code points, the end exclusive) of its turns and of their texts, which turns
    are learnt from, and whether the template rewrites history."""
    learn = frozenset(learn_from)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(1).to_pylist()
            got = [render(template, [(t["role"], t["text"]) for t in row]) for row in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([g.text for g in got], pa.string()), _spans([g.turns for g in got]), _spans([g.bodies for g in got]),
                 pa.array([[t["role"] in learn for t in row] for row in rows], pa.list_(pa.bool_())), pa.array([g.rewrites for g in got], pa.bool_())],
                ["id", "formatted", "turns", "bodies", "loss", "rewrites"])

    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = turns.select(F.col(id_col).alias("id"), F.struct(F.col(turn_col).alias("turn"), empty(role_col).alias("role"), empty(text_col).alias("text")).alias("t"),
                        F.when(F.col(id_col).isNull(), F.monotonically_increasing_id()).alias("own"))
    whole = rows.groupBy("id", "own").agg(F.sort_array(F.collect_list("t")).alias("turns")).select("id", F.transform("turns", lambda t: t.dropFields("turn")).alias("turns"))
    kind = turns.schema[id_col].dataType.simpleString()
    return whole.mapInArrow(run, f"id {kind}, {SCHEMA}").withColumnRenamed("id", id_col)


def read_back(formatted: DataFrame, id_col: str = "conv_id", reader: Callable[[str], Turn] = read_turn,
              plain: Callable[[str], str] = unescaped) -> DataFrame:
    """``id_col, said array<struct<role, text>>, learnt array<string>``: the turns, and the
    texts under the loss mask, read from the output and its spans alone."""
    said_type = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said, learnt = [], []
            for out, spans, bodies, loss in zip(*(batch.column(k).to_pylist() for k in range(1, 5))):
                read = [reader(out[s["start"]:s["end"]]) for s in spans if s]
                said.append([{"role": r, "text": t} for r, t in read])
                learnt.append([plain(out[b["start"]:b["end"]]) for b, mine in zip(bodies, loss) if mine and b])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(said, said_type), pa.array(learnt, pa.list_(pa.string())), batch.column(5)],
                                             ["id", "said", "learnt", "formatted_chars"])

    kind = formatted.schema[id_col].dataType.simpleString()
    rows = formatted.select(F.col(id_col).alias("id"), "formatted", "turns", "bodies", "loss", F.length("formatted").cast("long").alias("n"))
    out = rows.mapInArrow(run, f"id {kind}, said array<struct<role:string,text:string>>, learnt array<string>, formatted_chars bigint")
    return out.withColumnRenamed("id", id_col)
