"""Quality rules: text statistics and a learned decision list, all in Spark expressions.

Statistics are one projection over the texts.  The decision list is learned by sequential
covering: a rule is grown condition by condition (the threshold with the best information
gain over the rows not covered yet), pruned from its end on rows set aside, and kept while
it is precise there; the rows it covers leave and the next rule is grown.  Every step is
one grouped count over all labelled rows, of which only a table of features x bins
reaches the driver.  The result is an ordered CASE expression.

Defined results: NULL and empty texts have statistics of 0; a label given several times
counts as its smallest value, NULL labels are ignored; ties between thresholds go to the
first in feature order; with no labels, or labels of one kind, the list is empty and keeps
everything; repeated rows give repeated results; columns other than the named ones are
never read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledger.llm.common import SPACE, let, staged, unit_hash

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 3

FEATURES = ["n_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "digit_share",
            "mark_share", "distinct_share", "line_words"]
BINS = 32
MAX_RULES, MAX_CONDITIONS = 8, 3
MIN_COVER, MIN_PRECISION = 5, 0.8


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE + "+", -1), "")


def dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def repeat_words(words: Column, size: int = WINDOW) -> Column:
    """Words that stand in a run of ``size`` words found twice or more in the text.

    Runs are compared by a 64-bit hash; equal hashes meet by sorting, so a text costs
    n log n whatever repeats in it.
    """

    def covered(places: Column) -> Column:
        start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("end"))
        step = lambda s, i: F.struct((s["sum"] + i + size - F.greatest(s["end"], i)).alias("sum"), (i + size).alias("end"))
        return F.aggregate(places, start, step, lambda s: s["sum"])

    def repeated(runs: Column) -> Column:
        placed = F.sort_array(F.transform(runs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(placed, lambda s: covered(F.sort_array(F.transform(
            F.filter(s, lambda x, k: F.coalesce(x["h"] == F.get(s, k - 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get(s, k + 1)["h"], F.lit(False))),
            lambda x: x["i"]))))

    def counted(w: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.size(w) - size), lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(size))))
        several = let(runs, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(repeated(h)))
        return F.when(F.size(w) <= size, F.lit(0)).otherwise(several)

    return let(words, counted)


def text_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, the base counts and the features of every row."""
    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    gone = lambda pattern: F.length("text") - F.length(F.regexp_replace("text", pattern, ""))
    parts = F.struct(F.size("w").alias("n"), F.size(F.array_distinct("w")).alias("d"), repeat_words(F.col("w")).alias("r"))
    rows = rows.withColumn("w", words_of(F.col("text"))).select(
        id_col, parts.alias("p"),
        F.length(F.regexp_replace("text", SPACE, "")).alias("word_chars"),
        gone(SYMBOLS).alias("n_symbols"),
        dup_lines(F.col("text")).alias("n_dup_lines"),
        gone(r"\p{Lu}").alias("upper"), gone("[0-9]").alias("digits"), gone("[!?|]").alias("marks"),
        (F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit("")))).alias("breaks"))
    long = {c: F.col(e).cast("long") for c, e in {
        "n_words": "p.n", "word_chars": "word_chars", "n_symbols": "n_symbols", "n_dup_lines": "n_dup_lines", "n_repeat_words": "p.r"}.items()}
    words, chars, lines = (F.greatest(F.col(c), F.lit(1)).cast("double") for c in ("p.n", "word_chars", "breaks"))
    lines = (F.col("breaks") + 1).cast("double")
    shares = {
        "mean_word": F.col("word_chars") / words, "symbol_share": F.col("n_symbols") / chars, "dup_line_share": F.col("n_dup_lines") / lines,
        "repeat_share": F.col("p.r") / words, "upper_share": F.col("upper") / chars, "digit_share": F.col("digits") / chars,
        "mark_share": F.col("marks") / chars, "distinct_share": F.col("p.d") / words, "line_words": F.col("p.n") / lines}
    return rows.select(id_col, *(e.alias(c) for c, e in (long | shares).items()))


def base_failed(n_words: Column, n_repeat: Column) -> Column:
    return (n_words < 50) | (n_repeat * 100 > n_words * 50)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.feature).cast("double")
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


def holds(rule: list[Condition]) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.column()
    return out


def fired(rules: list[list[Condition]]) -> Column:
    """Number (from 1) of the first rule that holds, as one ordered CASE; NULL if none."""
    out = F.when(F.lit(False), F.lit(0))
    for k, rule in enumerate(rules, 1):
        out = out.when(holds(rule), F.lit(k))
    return out


def thresholds(rows: DataFrame, features: list[str]) -> dict[str, list[float]]:
    """Cut points of each feature: quantiles of the rows of either class."""
    at = [k / (BINS // 2) for k in range(BINS // 2 + 1)]
    got = rows.groupBy("y").agg(*(F.percentile_approx(F.col(f).cast("double"), at, 10_000).alias(f) for f in features)).collect()
    return {f: sorted({v for r in got for v in (r[f] or [])}) for f in features}


def _gain(p: int, n: int, base: float) -> float:
    return p * (math.log2(p / (p + n)) - base) if p else 0.0


def _bin(value: Column, cuts: list[float]) -> Column:
    """How many cut points lie below the value."""
    return F.size(F.filter(F.array(*(F.lit(float(c)) for c in cuts)), lambda t: t < value))


def grow(rows: DataFrame, cuts: dict[str, list[float]]) -> list[Condition]:
    """One conjunction, from counts by feature, bin and class over ``rows``."""
    rule: list[Condition] = []
    while len(rule) < MAX_CONDITIONS:
        inside = rows.where(holds(rule))
        cells = F.array(*(F.struct(F.lit(f).alias("f"), _bin(F.col(f), c).alias("bin")) for f, c in cuts.items() if c))
        counts: dict[str, dict[int, list[int]]] = {}
        for r in inside.select("y", F.explode(cells).alias("x")).groupBy("x.f", "x.bin", "y").count().collect():
            counts.setdefault(r["f"], {}).setdefault(r["bin"], [0, 0])[r["y"]] += r["count"]
        if not counts:
            break
        first = next(iter(counts.values()))
        total = [sum(v[k] for v in first.values()) for k in (0, 1)]
        if not total[0] or not total[1]:
            break
        base, best = math.log2(total[0] / sum(total)), (1e-9, None)
        for f in cuts:
            below = [0, 0]
            for k, cut in enumerate(cuts[f]):
                below = [below[i] + counts.get(f, {}).get(k, [0, 0])[i] for i in (0, 1)]
                for above, (p, n) in ((False, below), (True, [total[i] - below[i] for i in (0, 1)])):
                    gain = _gain(p, n, base)
                    if gain > best[0] and p >= MIN_COVER:
                        best = (gain, Condition(f, above, cut))
        if best[1] is None or best[1] in rule:
            break
        rule.append(best[1])
    return rule


def prune(rows: DataFrame, rule: list[Condition]) -> tuple[list[Condition], int, int]:
    """The start of ``rule`` that is best on rows set aside, with what it covers there."""
    sums = [F.sum(F.when(holds(rule[:k]) & (F.col("y") == y), 1).otherwise(0)) for k in range(1, len(rule) + 1) for y in (0, 1)]
    got = [v or 0 for v in rows.agg(*sums).first()]
    scored = [((p - n) / (p + n) if p + n else -1.0, -k, p, n) for k, (p, n) in enumerate(zip(got[::2], got[1::2]), 1)]
    worth, k, p, n = max(scored)
    return rule[:-k], p, n


def learn(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
          features: list[str] = FEATURES) -> list[list[Condition]]:
    """Rules that find rows labelled 0, in order, from ``stats`` and ``labels``."""
    given = labels.where(F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias(id_col)).agg(F.min(label_col).cast("int").alias("y"))
    rows = stats.dropDuplicates([id_col]).join(given, id_col).select(id_col, "y", *features)
    rows = staged(rows.withColumn("aside", unit_hash(F.col(id_col), seed=9) < 1 / 3), "labelled")
    cuts, rules = thresholds(rows, features), []
    if not any(cuts.values()):
        return rules
    while len(rules) < MAX_RULES:
        left = rows.where(fired(rules).isNull())
        rule = grow(left.where(~F.col("aside")), cuts)
        if not rule:
            break
        rule, p, n = prune(left.where("aside"), rule)
        if p < MIN_COVER or p < MIN_PRECISION * (p + n):
            break
        rules.append(rule)
    return rules


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, list[list[Condition]]]:
    """The statistics of every row with ``base_failed``, ``rule`` (the first that fired) and
    ``kept``; and the rules."""
    stats = staged(text_stats(docs, id_col, text_col), "stats")
    rules = learn(stats, labels, id_col)
    out = stats.withColumn("base_failed", base_failed(F.col("n_words"), F.col("n_repeat_words"))).withColumn("rule", fired(rules))
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()), rules
