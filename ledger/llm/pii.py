"""Personal data by weak supervision, in Spark expressions only.

Candidate spans come from strict patterns (the base kinds) and looser ones.  Labelers vote
on each candidate (1 personal, -1 not, 0 no opinion): the pattern's own check (digits,
Luhn, parts), a gazetteer (domains, dial codes, issuer prefixes, reserved networks), the
words before it, and the characters around it.  Candidates with the same kind and votes
are alike, so Spark counts vote patterns (a table of at most kinds x 3 ** labelers rows);
on that table expectation-maximisation estimates each labeler's reliability.

The final classifier does not see the votes.  It learns the posteriors from the span's own
build (``SHAPE``: length, groups of digits, separators, share of digits, place in its
line), so it can disagree with the labelers: a span that nobody knew is accepted where it
is built like those that they agree on.  The shape is a few small numbers, so its training
table is counted by Spark too and has a bounded number of rows.  A span is added where
posterior and classifier, as independent evidence, make it likely.  Base spans always stay.

Places count code points from 0, the end is exclusive.  All work on a text is linear in its
length and its matches: places are summed up in blocks, and surroundings are read from
chunks of the text, never by counting from its start.

Defined results: NULL and empty texts have no spans; a candidate found by several patterns
of one kind is taken once, from the strict one; ties of places are ordered by kind; with
no candidates at all nothing is added; repeated rows give repeated results; only the named
columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledger.llm.common import let, staged

# The agreed base patterns.  They are written with possessive quantifiers and
# with starts that cannot lie inside a run that has failed already, which finds the same
# matches without trying a long run again from each of its characters.
EMAIL_CHAR = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:\G|(?<![{EMAIL_CHAR}]))[{EMAIL_CHAR}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}+",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "phone": r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])",
    "email": rf"(?<![{EMAIL_CHAR}])[{EMAIL_CHAR}]{{1,64}}+\x20?(?:\[at\]|\(at\))\x20?[A-Za-z0-9-]{{1,64}}+\x20?(?:\[dot\]|\(dot\)|\.)\x20?[A-Za-z]{{2,12}}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}+(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
KINDS = ["email", "ip", "card", "phone", "iban", "ssn"]

# Gazetteers (fixed values).
TOP_DOMAINS = ["com", "org", "net", "edu", "gov", "info", "io", "co", "de", "fr", "es", "uk", "it", "eu", "us", "ch", "at", "nl"]
DIAL_CODES = ["1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49",
              "51", "52", "54", "55", "56", "57", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91"]
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35|36)"
RESERVED = r"^(?:0|10|127|192\.168|169\.254|22[4-9]|2[3-5][0-9])\."
CUES = {
    "email": "mail|contact|write|kontakt|correo|courriel",
    "ip": "ip|host|server|address|adresse|login",
    "card": "card|visa|master|credit|karte|carte|tarjeta|pay",
    "phone": "phone|tel|call|mobile|fax|anruf|llam|appel",
    "iban": "iban|account|bank|konto|compte|cuenta",
    "ssn": "ssn|social|security",
}
COUNTER_CUES = "version|release|isbn|invoice|order no|part no|serial|build|chapter|section"
BEFORE = 24
LABELERS = ["check", "gazetteer", "context", "around"]
# What the final classifier sees besides the kind, with the number of levels of each.
SHAPE = {"size": 10, "groups": 7, "seps": 8, "digits": 5, "edge": 4}
# Matches of a block, and code points of a chunk of text.
BLOCK, CHUNK = 64, 4096


def luhn(digits: Column) -> Column:
    """Whether a string of digits has a valid Luhn check digit."""
    def worth(i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.transform(F.sequence(F.lit(1), F.length(digits)), worth), F.lit(0), lambda s, x: s + x) % 10 == 0


def passes(kind: str, found: Column) -> Column:
    """The agreed test on a base match."""
    digits = F.regexp_replace(found, "[^0-9]", "")
    if kind == "ip":
        # Leading zeros go, but never the last digit: a part of zeros is the number 0.
        plain = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
        return F.forall(F.split(found, r"\."), lambda p: F.coalesce(F.when(F.length(plain(p)) <= 3, plain(p)).try_cast("int") <= 255, F.lit(False)))
    if kind == "card":
        return F.length(digits).between(13, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


MATCH = "array<struct<s:int,e:int,m:string,g:int>>"


def matches(text: Column, pattern: str) -> Column:
    """``array<struct<s, e, m, g>>`` of the leftmost non-overlapping matches: place, match and
    the length of the text between it and the match before.

    Places are sums over all matches before: they are taken within blocks of ``BLOCK``
    matches, then over the blocks, so a text of many matches costs no square of them."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.array().cast(MATCH)

    def block(items: Column, b: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), none.alias("out"))
        return F.aggregate(F.slice(items, b * BLOCK + 1, F.lit(BLOCK)), start, lambda a, x: F.struct(
            (a["at"] + x["g"] + F.length(x["m"])).alias("at"),
            F.concat(a["out"], F.array(F.struct((a["at"] + x["g"]).alias("s"), (a["at"] + x["g"] + F.length(x["m"])).alias("e"),
                                                x["m"].alias("m"), x["g"].alias("g")))).alias("out")))

    def joined(blocks: Column) -> Column:
        ends = F.aggregate(blocks, F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x["at"])))
        return F.flatten(F.zip_with(blocks, F.slice(ends, F.lit(1), F.size(blocks)), lambda x, o: F.transform(
            x["out"], lambda y: F.struct((y["s"] + o).alias("s"), (y["e"] + o).alias("e"), y["m"].alias("m"), y["g"].alias("g")))))

    def placed(m: Column) -> Column:
        gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
        items = F.zip_with(m, F.slice(gaps, F.lit(1), F.size(m)), lambda x, g: F.struct(x.alias("m"), g.alias("g")))
        return let(items, lambda i: let(F.transform(F.sequence(F.lit(0), F.floor((F.size(i) - 1) / BLOCK).cast("int")), lambda b: block(i, b)), joined))

    return let(found, lambda m: F.when(F.size(m) > 0, placed(m)).otherwise(none))


def chunked(text: Column) -> Column:
    """The text in chunks of ``CHUNK`` code points."""
    return F.when(F.length(text) <= CHUNK, F.array(text)).otherwise(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}+"), F.lit(0)))


def piece(chunks: Column, start: Column, size: Column) -> Column:
    """``size`` (``CHUNK`` at most) code points from ``start`` of a chunked text."""
    k = F.floor(start / CHUNK).cast("int")
    here, more = F.coalesce(F.get(chunks, k), F.lit("")), F.coalesce(F.get(chunks, k + 1), F.lit(""))
    return F.substring(F.when(start % CHUNK + size > CHUNK, F.concat(here, more)).otherwise(here), start % CHUNK + 1, size)


def surroundings(chunks: Column, x: Column, size: int) -> tuple[Column, Column]:
    """Up to ``size`` code points before and after a match."""
    return piece(chunks, F.greatest(x["s"] - size, F.lit(0)), F.least(x["s"], F.lit(size))), piece(chunks, x["e"], F.lit(size))


def _gazetteer(kind: str, found: Column) -> Column:
    if kind == "email":
        known = F.lower(F.regexp_extract(found, r"([A-Za-z0-9-]+)$", 1)).isin(TOP_DOMAINS)
    elif kind == "phone":
        digits = F.regexp_replace(found, "[^0-9]", "")
        known = F.substring(digits, 1, 2).isin(DIAL_CODES) | F.substring(digits, 1, 1).isin(DIAL_CODES)
    elif kind == "card":
        known = F.regexp_replace(found, "[^0-9]", "").rlike(ISSUERS)
    elif kind == "ip":
        known = ~found.rlike(RESERVED)
    else:
        return F.lit(0)
    return F.when(known, 1).otherwise(-1)


def _judged(kind: str, chunks: Column, x: Column, base: Column) -> Column:
    """A candidate with its votes and its shape."""
    def described(p: Column) -> Column:
        found, before, after, near = p["m"], p["before"], p["after"], F.lower(p["before"])
        context = F.when(near.rlike(CUES[kind]), 1).when(near.rlike(COUNTER_CUES), -1).otherwise(0)
        around = F.concat(F.right(before, F.lit(1)), F.lit(" "), F.substring(after, 1, 1))
        votes = [F.when(p["base"], 1).otherwise(-1 if kind in BASE else 0), _gazetteer(kind, found), context,
                 F.when(around.rlike(r"[\p{L}\p{N}_@/=]"), -1).otherwise(1)]
        size, bit = F.length(found), lambda c, n: F.when(c, n).otherwise(0)
        shape = {
            "size": F.least(F.floor(size / 4), F.lit(9)),
            "groups": F.least(F.regexp_count(found, F.lit("[0-9]+")), F.lit(6)),
            "seps": bit(F.contains(found, F.lit("-")), 1) + bit(F.contains(found, F.lit(".")), 2) + bit(F.contains(found, F.lit(" ")), 4),
            "digits": F.floor(F.regexp_count(found, F.lit("[0-9]")) * 4 / size),
            "edge": bit(before.rlike(r"(?:^|\n)\s*$"), 1) + bit(after.rlike(r"^[.,;]?\s*(?:$|\n)"), 2),
        }
        return F.struct(F.lit(KINDS.index(kind)).alias("k"), p["s"].alias("s"), p["e"].alias("e"), p["base"].alias("base"),
                        *(v.cast("int").alias(n) for n, v in zip(LABELERS, votes)), *(v.cast("int").alias(n) for n, v in shape.items()))

    before, after = surroundings(chunks, x, BEFORE)
    return let(F.struct(x["s"].alias("s"), x["e"].alias("e"), x["m"].alias("m"), base.alias("base"), before.alias("before"), after.alias("after")), described)


def candidates(text: Column) -> Column:
    """All candidate spans of a text with the labelers' votes and their shapes, by kind and place."""
    needs = {"email": "@", "phone": "+"}
    kind = "array<struct<k:int,s:int,e:int,base:boolean," + ",".join(f"{n}:int" for n in [*LABELERS, *SHAPE]) + ">>"
    none, no_match = F.array().cast(kind), F.array().cast(MATCH)

    def strict(k: str, t: Column) -> Column:
        return F.when(F.contains(t, F.lit(needs[k])), matches(t, BASE[k])).otherwise(no_match) if k in needs else matches(t, BASE[k])

    def loose(k: str, t: Column) -> Column:
        found = matches(t, LOOSE[k])
        return F.when(F.contains(t, F.lit("at]")) | F.contains(t, F.lit("at)")), found).otherwise(no_match) if k == "email" else found

    def judged(k: str, c: Column, found: Column, base: bool) -> Column:
        out = F.transform(found, lambda x: _judged(k, c, x, passes(k, x["m"]) if base else F.lit(False))).cast(kind)
        return F.when(F.size(found) > 0, out).otherwise(none)

    def both(k: str, t: Column, c: Column) -> Column:
        """A looser find that overlaps a strict one of its kind adds nothing.  The strict ones
        are marked in a string of 0 and 1 for each code point."""
        def apart(b: Column, m: Column) -> Column:
            marks = F.array_join(F.transform(b, lambda x: F.concat(F.repeat(F.lit("0"), x["g"]), F.repeat(F.lit("1"), x["e"] - x["s"]))), "")
            return let(chunked(marks), lambda z: F.filter(m, lambda x: ~F.contains(piece(z, x["s"], x["e"] - x["s"]), F.lit("1"))))

        kept = lambda b, m: F.when((F.size(b) > 0) & (F.size(m) > 0), apart(b, m)).otherwise(m)
        pair = F.struct(strict(k, t).alias("b"), loose(k, t).alias("m"))
        return let(pair, lambda p: F.concat(judged(k, c, p["b"], True), let(kept(p["b"], p["m"]), lambda m: judged(k, c, m, False))))

    def merged(p: Column) -> Column:
        t, c = p["t"], p["c"]
        def alone(k: str, found: Column, base: bool) -> Column:
            return let(found, lambda m: judged(k, c, m, base))

        return F.concat(*(both(k, t, c) if k in LOOSE else alone(k, strict(k, t), True) for k in BASE),
                        *(alone(k, loose(k, t), False) for k in LOOSE if k not in BASE))

    whole = F.coalesce(text.cast("string"), F.lit(""))
    return let(whole, lambda t: let(F.struct(t.alias("t"), chunked(t).alias("c")), merged))


# -- weak supervision ---------------------------------------------------------------------


def expectation_maximisation(patterns: list[tuple[int, tuple[int, ...], int]], rounds: int = 50) -> dict[tuple[int, tuple[int, ...]], float]:
    """Posterior that a vote pattern is personal data, from ``(kind, votes, count)``.

    Each labeler has, for each class, a chance of every vote; starts from the share of
    votes in favour and is smoothed by one row, so a single pattern cannot settle at 0 or 1.
    """
    n_votes = len(LABELERS)
    belief = {(k, v): (1 + sum(x > 0 for x in v)) / (2 + sum(x != 0 for x in v)) for k, v, _ in patterns}
    for _ in range(rounds):
        mass = [1.0, 1.0]
        chance = [[{x: 1 / 3 for x in (-1, 0, 1)} for _ in range(n_votes)] for _ in (0, 1)]
        for k, v, n in patterns:
            for y, p in ((1, belief[k, v]), (0, 1 - belief[k, v])):
                mass[y] += n * p
                for i, x in enumerate(v):
                    chance[y][i][x] += n * p
        new = {}
        for k, v, _ in patterns:
            logs = [math.log(mass[y]) + sum(math.log(chance[y][i][x] / mass[y]) for i, x in enumerate(v)) for y in (0, 1)]
            new[k, v] = 1 / (1 + math.exp(min(50.0, max(-50.0, logs[0] - logs[1]))))
        moved = max((abs(new[p] - belief[p]) for p in new), default=0.0)
        belief = new
        if moved < 1e-6:
            break
    return belief


def log_odds(p: float) -> float:
    p = min(max(p, 1e-6), 1 - 1e-6)
    return math.log(p / (1 - p))


LEVELS = {"k": len(KINDS), **SHAPE}


class Model:
    """The labelers' posteriors by vote pattern, and the weights of the span classifier: a
    bias, one for each kind and one for each level of the shape."""

    def __init__(self, belief: dict[tuple[int, tuple[int, ...]], float], share: float):
        self.belief, self.prior, self.bias = belief, log_odds(share), 0.0
        self.weights = {n: [0.0] * m for n, m in LEVELS.items()}

    def vote_odds(self, value: Callable[[str], Column]) -> Column:
        """The posterior's log odds.  A vote pattern's code is a number below kinds x 3 **
        labelers, so the posteriors are a list of that size."""
        code = value("k")
        for n in LABELERS:
            code = code * 3 + value(n) + 1
        odds = [0.0] * (len(KINDS) * 3 ** len(LABELERS))
        for (k, votes), p in self.belief.items():
            for vote in votes:
                k = k * 3 + vote + 1
            odds[k] = log_odds(p)
        return F.get(F.array(*map(F.lit, odds)), code)

    def shape_odds(self, value: Callable[[str], Column]) -> Column:
        """The span classifier's log odds."""
        return sum((F.get(F.array(*map(F.lit, w)), value(n)) for n, w in self.weights.items()), F.lit(self.bias))

    def probability(self, x: Column) -> Column:
        """Votes and shape taken together, the share of personal data among all spans counted once."""
        value = lambda n: x[n]
        return 1 / (1 + F.exp(F.lit(self.prior) - self.vote_odds(value) - self.shape_odds(value))) if self.belief else F.lit(0.0)


def learn(found: DataFrame, column: str = "found") -> Model:
    """The label model and the span classifier from all candidates in ``found``."""
    x = found.select(F.explode(column).alias("x"))
    names = ["k", *LABELERS, *SHAPE]
    # Kinds, votes and levels of the shape: a table whose size does not follow the corpus.
    table = staged(x.groupBy(*(F.col(f"x.{n}").alias(n) for n in names)).agg(F.count(F.lit(1)).alias("n")), "patterns")
    votes = table.groupBy("k", *LABELERS).agg(F.sum("n").alias("n")).collect()
    patterns = [(r[0], tuple(r[1:-1]), r[-1]) for r in votes]
    belief = expectation_maximisation(patterns)
    total = sum(n for *_, n in patterns)
    if not total:
        return Model({}, 0.5)
    model = Model(belief, sum(n * belief[k, v] for k, v, n in patterns) / total)
    flags = F.array(*((F.col(n) == level).cast("double") for n, m in LEVELS.items() for level in range(m)))
    believed = 1 / (1 + F.exp(-model.vote_odds(F.col)))
    rows = table.groupBy(*LEVELS).agg(F.sum(F.col("n") * believed).alias("yes"), F.sum(F.col("n") * (1 - believed)).alias("no"))
    # Each shape stands for both answers, weighed by how far the labelers believe them; one task
    # in a fixed order, so the fit does not depend on how rows were dealt out.
    rows = rows.select(*LEVELS, flags.alias("flags"), F.inline(F.array(F.struct(F.lit(1.0).alias("y"), F.col("yes").alias("w")), F.struct(F.lit(0.0).alias("y"), F.col("no").alias("w")))))
    rows = rows.where("w > 0").orderBy(*LEVELS, "y").coalesce(1).select(array_to_vector("flags").alias("x"), "y", "w")
    fit = LogisticRegression(featuresCol="x", labelCol="y", weightCol="w", regParam=0.001, maxIter=80, standardization=False).fit(rows)
    at, coefficients = 0, fit.coefficients.toArray().tolist()
    model.bias = float(fit.intercept)
    for n, m in LEVELS.items():
        model.weights[n] = coefficients[at:at + m]
        at += m
    return model


def accepted(found: Column, model: Model, least: float = 0.5) -> Column:
    """Base spans, and those the votes and the classifier add."""
    return F.sort_array(F.filter(found, lambda x: x["base"] | (model.probability(x) >= least)))


def kind_name(k: Column) -> Column:
    return F.get(F.array(*(F.lit(n) for n in KINDS)), k)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, spans array<struct<k, s, e, base, votes...>>`` of every row."""
    found = staged(docs.select(F.col(id_col), candidates(F.col(text_col)).alias("found")), "pii")
    model = learn(found)
    return found.select(id_col, accepted(F.col("found"), model).alias("spans"))


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by ``<KIND>``; overlapping spans are replaced once,
    by the kind of the first.

    Spans are taken in blocks of ``BLOCK``, each with the text up to the next block's first
    span, so a text of many spans is not copied anew for each of them."""
    by_place = F.sort_array(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e"))))

    def stretch(chunks: Column, start: Column, end: Column) -> Column:
        k = F.floor(start / CHUNK).cast("int")
        own = F.slice(chunks, k + 1, F.floor(end / CHUNK).cast("int") - k + 1)
        return F.substring(F.array_join(own, ""), start - k * CHUNK + 1, end - start)

    def block(b: Column) -> Column:
        """``b``: the block's spans, its place, what the spans before reach to, and its text."""
        def step(a: Column, x: Column) -> Column:
            more = F.concat(a["out"], F.substring(b["text"], a["at"] - b["start"] + 1, x["s"] - a["at"]), F.lit("<"), F.upper(kind_name(x["k"])), F.lit(">"))
            return F.struct(F.greatest(a["at"], x["e"]).alias("at"), F.when(x["s"] >= a["at"], more).otherwise(a["out"]).alias("out"))

        begin = F.struct(F.greatest(b["start"], b["reached"]).alias("at"), F.lit("").alias("out"))
        return F.aggregate(b["own"], begin, step, lambda a: F.concat(
            a["out"], F.substring(b["text"], F.least(a["at"], b["end"]) - b["start"] + 1, F.greatest(b["end"] - a["at"], F.lit(0)))))

    def whole(p: Column) -> Column:
        last = F.floor((F.size(p["x"]) - 1) / BLOCK).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(p["x"], b * BLOCK + 1, F.lit(BLOCK)))

        def with_places(own: Column) -> Column:
            reach = F.aggregate(own, F.array(F.lit(0)), lambda a, o: F.concat(a, F.array(F.greatest(F.element_at(a, -1), F.array_max(F.transform(o, lambda x: x["e"]))))))
            starts = F.transform(own, lambda o, b: F.when(b == 0, 0).otherwise(F.get(o, 0)["s"]))
            ends = F.concat(F.slice(starts, F.lit(2), F.size(own)), F.array(F.length(p["t"])))
            return F.transform(F.arrays_zip(own.alias("own"), starts.alias("start"), ends.alias("end"), F.slice(reach, F.lit(1), F.size(own)).alias("reached")),
                               lambda z: let(F.struct(z["own"].alias("own"), z["start"].alias("start"), z["end"].alias("end"), z["reached"].alias("reached"),
                                                      stretch(p["c"], z["start"], z["end"]).alias("text")), block))

        return F.array_join(let(blocks, with_places), "")

    bound = F.struct(text.alias("t"), by_place.alias("x"), chunked(text).alias("c"))
    return F.when(F.size(spans) > 0, let(bound, whole)).otherwise(text)


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with personal data in ``text_col`` replaced; all columns stay.

    Two passes over the texts (one to learn, one to replace) and no join."""
    found = candidates(F.col(text_col))
    model = learn(docs.select(found.alias("found")))
    clean = let(F.struct(F.col(text_col).alias("t"), accepted(found, model).alias("x")), lambda p: redacted(p["t"], p["x"]))
    return docs.withColumn(text_col, clean)
