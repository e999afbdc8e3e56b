"""Secret scan with a random forest against false positives, in Spark expressions only.

Candidates are tokens of ``LONG`` characters or more, without an upper bound, of those that
secrets are made of, and values of any length that are assigned to a credential's name.  A
name before ``=`` or ``:`` is no part of its value; it counts as words around it.  Each is
described by
its length, by the transitions between neighbouring characters (letter to digit, case
changes, hex runs, vowels after consonants), by how much of it dictionary words cover
(frequent words of the corpus itself, counted over all documents), by
the path or source it comes from and by the words around it.  A random forest trained on
labelled findings tells real secrets from hashes of words, numbers and long ordinary words.

Labelled findings are a table ``(id, start, label)``.  Where none is given, they are the
findings that need no judgement, and these keep their label: a key in the form of a known
issuer is a secret wherever it stands, and so is a bare hexadecimal digest that is assigned
to a credential's name; a plain word or number that is assigned to nothing is not.  As two
of the forest's inputs (``LABELLING``) take part in that rule, the forest that learns from
it is not given them; one that learns from a table is given all.

The secret itself is never returned: findings carry its place and its SHA-256.  Places
count code points from 0, the end is exclusive.

Defined results: NULL and empty texts have no findings; with labels of one kind or none no
forest can be trained and the labels' own rule decides; equal candidates each give a row;
repeated rows give repeated results; only the id, text and path columns are read.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledger.llm.common import let, staged, unit_hash
from ledger.llm.pii import chunked, matches, surroundings

# At most this many labelled findings train the forest; more are thinned by a hash.
SAMPLE_ROWS = 20_000
TREES, DEPTH, SEED = 24, 6, 7
LEAST = 0.5
AROUND = 32

# Fixed values.
LONG = 16
CREDENTIAL = r"(?:api[_-]?key|secret|token|passw(?:or)?d|pwd|auth|credential|private[_-]?key|access[_-]?key|bearer)"
# What stands before a value that is assigned to a credential's name.  The look ahead finds
# the name in the token once; the token is then taken whole, so long tokens cost linear time.
NAMED = (r"(?<![A-Za-z0-9_/+.-])(?=[A-Za-z0-9_/+.-]*?(?i:" + CREDENTIAL + r"))[A-Za-z0-9_/+.-]++[\"'`\])]*+\s*+(?:=>|:=|==?|:)\s*+"
         r"(?:(?i:bearer|basic)\s++)?[\"'`]?")
# A value: a long token, or all up to a blank, a quote or a delimiter, but not a further name that is assigned to.
VALUE = (r"(?:[A-Za-z0-9_/+-]{" + str(LONG) + r",}+=*+(?![A-Za-z0-9_/+-])"
         r"|(?!(?=[A-Za-z0-9_/+.-]*?(?i:" + CREDENTIAL + r"))[A-Za-z0-9_/+.-]++[\"'`\])]*+\s*+[=:])[^\s\"'`,;&<>(){}\[\]|?=:]++=*+)")
CANDIDATE = NAMED + VALUE + r"|(?<![A-Za-z0-9_/+-])[A-Za-z0-9_/+-]{" + str(LONG) + r",}+=*+"
ISSUER_FORMS = r"^(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}|sk-[A-Za-z0-9]{20,}|AIza[0-9A-Za-z_-]{35})$"
DIGEST_FORMS = r"^(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})$"
PLAIN_PATHS = r"(?:test|example|sample|fixture|mock|doc)"
FRAGMENTS = ["the", "and", "that", "with", "for", "from", "this", "are", "not", "you", "have", "was", "will", "more", "tion", "ing", "ment", "heit",
              "keit", "lich", "ung", "que", "eau", "eux", "elle", "mente", "ción", "ado", "name", "data", "file", "path", "user", "test", "value",
              "type", "list", "config", "index", "class", "function", "return", "http", "www", "com", "org", "html", "image", "page", "ation", "able"]

# Words that stand alone in a text, shorter than a candidate, and the words that a candidate is put together from.
ALONE = r"(?<![\p{L}0-9_/+=-])[A-Za-z]{4,15}(?![\p{L}0-9_/+=-])"
WITHIN = r"[A-Z]?[a-z]{3,14}|[A-Z]{4,15}"
# A dictionary word occurs so many times at least, and once in so many words of the corpus.
LEAST_TIMES, ONE_IN = 5, 1_000_000

FEATURES = ["length", "letter_digit", "case_change", "symbol_share", "digit_share", "hex_share", "upper_share", "vowel_share", "bigram_share",
            "distinct_share", "fragment_cover", "word_cover", "plain_path", "credential_near", "assigned", "quoted", "prose_before"]
# Inputs that take part in the labels of findings that need no judgement.
LABELLING = ["credential_near", "assigned"]


def described(found: Column, before: Column, after: Column, path: Column) -> dict[str, Column]:
    """The forest's inputs for one candidate."""
    size = F.length(found).cast("double")
    count = lambda pattern: F.regexp_count(found, F.lit(pattern)).cast("double")
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    lower = F.lower(found)
    uncovered = F.length(F.regexp_replace(lower, "|".join(sorted(FRAGMENTS, key=len, reverse=True)), ""))
    return {
        "length": size,
        "letter_digit": count("(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])") / size,
        "case_change": count("(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])") / size,
        "symbol_share": count("[_/+=-]") / size,
        "digit_share": count("[0-9]") / size,
        "hex_share": count("[0-9a-f]") / size,
        "upper_share": count("[A-Z]") / size,
        "vowel_share": count("(?i)[aeiouy]") / size,
        "bigram_share": count("(?i)(?:th|he|in|er|an|re|on|at|en|nd|ti|es|or|te|ou|it|is|st|de|le|ch|qu)") / size,
        "distinct_share": F.size(F.array_distinct(F.split(found, ""))) / size,
        "fragment_cover": 1.0 - uncovered / size,
        "plain_path": flag(F.lower(path).rlike(PLAIN_PATHS)),
        "credential_near": flag(F.lower(before).rlike(CREDENTIAL)),
        "assigned": flag(before.rlike(r"(?:=|:|=>)\s*[\"']?$")),
        "quoted": flag(before.rlike("[\"'`]$") & after.rlike("^[\"'`]")),
        "prose_before": flag(before.rlike(r"[a-z]{2,} $")),
    }


def find_candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """``id, start, end, sha256, shape..., features`` of every candidate."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    path = F.coalesce(F.col(path_col).cast("string"), F.lit("")) if path_col else F.lit("")
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), path.alias("path"))
    def near(chunks: Column, x: Column) -> Column:
        before, after = surroundings(chunks, x, AROUND)
        return F.struct(x["s"].alias("start"), x["e"].alias("end"), x["m"].alias("found"), before.alias("before"), after.alias("after"))

    def value(x: Column) -> Column:
        """The match without the name it is assigned to and without full stops that end it."""
        bare = F.regexp_replace(x["m"], "^" + NAMED + "(?=" + VALUE + "$)", "")
        start = x["s"] + F.length(x["m"]) - F.length(bare)
        bare = F.regexp_replace(bare, r"(?<![.])[.]++$", "")
        return F.struct(start.alias("s"), (start + F.length(bare)).alias("e"), bare.alias("m"))

    def found(t: Column) -> Column:
        values = F.filter(F.transform(matches(t, CANDIDATE), value), lambda x: F.length(x["m"]) > 0)
        return let(chunked(t), lambda c: F.transform(values, lambda x: near(c, x)))

    rows = rows.select("id", "path", F.explode(let(F.col("text"), found)).alias("x")).select("id", "path", "x.*")
    f = described(F.col("found"), F.col("before"), F.col("after"), F.col("path"))
    # Words within a candidate are kept as hashes, so no part of a secret is written anywhere.
    parts = F.transform(F.regexp_extract_all("found", F.lit(WITHIN), F.lit(0)), lambda w: F.struct(F.xxhash64(F.lower(w)).alias("h"), F.length(w).alias("n")))
    return rows.select("id", "start", "end", F.sha2("found", 256).alias("sha256"), parts.alias("parts"), F.col("found").rlike(ISSUER_FORMS).alias("issuer_form"),
                       F.col("found").rlike(DIGEST_FORMS).alias("digest_form"),
                       F.col("found").rlike("^(?:[0-9]+|[A-Za-z]+)$").alias("plain"), *(v.alias(k) for k, v in f.items()))


def with_word_cover(rows: DataFrame, docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``rows`` with ``word_cover``: the share of a candidate's characters that lie in frequent words of ``docs``.

    Words are counted in parts before they are shuffled; a token that many documents hold is looked up once."""
    words = docs.select(F.explode(F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(ALONE), F.lit(0))).alias("w"))
    counts = staged(words.groupBy(F.xxhash64(F.lower("w")).alias("h")).agg(F.count(F.lit(1)).alias("c")), "words")
    total = counts.agg(F.sum("c")).first()[0] or 0
    dictionary = counts.where((F.col("c") >= LEAST_TIMES) & (F.col("c") * ONE_IN >= total)).select("h")
    tokens = rows.groupBy("sha256").agg(F.first("parts").alias("parts")).select("sha256", F.explode("parts").alias("x"))
    covered = tokens.select("sha256", "x.h", "x.n").join(dictionary, "h").groupBy("sha256").agg(F.sum("n").alias("covered"))
    return rows.join(covered, "sha256", "left").withColumn("word_cover", F.coalesce("covered", F.lit(0)) / F.col("length")).drop("covered", "parts")


def precision_recall(found: DataFrame, findings: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row ``hits, false_alarms, missed, precision, recall`` of ``found`` (``scan_secrets``) against labelled
    findings ``(id, start, label)``; a labelled secret that is no candidate is missed, shares of nothing are NULL."""
    given = findings.where("label is not null and id is not null").groupBy("id", "start").agg(F.min("label").cast("int").alias("y"))
    told = found.groupBy(F.col(id_col).alias("id"), "start").agg(F.max("is_secret").alias("told"))
    judged = given.join(told, ["id", "start"], "left").select((F.col("y") == 1).alias("y"), F.coalesce("told", F.lit(False)).alias("told"))
    got = judged.agg(F.count_if(F.col("y") & F.col("told")).alias("hits"), F.count_if(~F.col("y") & F.col("told")).alias("false_alarms"),
                     F.count_if(F.col("y") & ~F.col("told")).alias("missed"))
    share = lambda other: F.try_divide(F.col("hits"), F.col("hits") + F.col(other))
    return got.select("*", share("false_alarms").alias("precision"), share("missed").alias("recall"))


def sure_label() -> Column:
    """1 and 0 for the findings that need no judgement, else NULL."""
    assigned = (F.col("credential_near") == 1) & (F.col("assigned") == 1)
    return F.when(F.col("issuer_form") | (F.col("digest_form") & assigned), 1).when(F.col("plain") & (F.col("assigned") == 0), 0).otherwise(F.lit(None).cast("int"))


def scan_secrets(docs: DataFrame, findings: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
                 path_col: str | None = "source", sample_rows: int = SAMPLE_ROWS, least: float = LEAST) -> DataFrame:
    """``id_col, start, end, sha256, detector, score, is_secret``: one row per candidate."""
    rows = staged(find_candidates(docs, id_col, text_col, path_col), "candidates")
    rows = staged(with_word_cover(rows, docs, text_col), "described")
    if findings is None:
        known = rows.withColumn("y", sure_label()).where("y is not null")
    else:
        given = findings.where("label is not null and id is not null").groupBy("id", "start").agg(F.min("label").cast("int").alias("y"))
        known = rows.join(given, ["id", "start"])
    counts = {r[0]: r[1] for r in known.groupBy("y").count().collect()}
    detector = F.when(F.col("issuer_form") | F.col("digest_form"), "provider-form").otherwise("long-token")
    if len(counts) == 2:
        # Either label may fill half of the sample; thinned by a hash, in a fixed order.
        share = F.element_at(F.create_map(*(x for y, n in counts.items() for x in (F.lit(y), F.lit(min(1.0, 0.45 * sample_rows / n))))), F.col("y"))
        draw = unit_hash(F.col("id"), F.col("start"), F.col("sha256"), seed=1)
        sample = known.where(draw < share).orderBy(draw, "id", "start").limit(sample_rows).coalesce(1)
        inputs = [f for f in FEATURES if findings is not None or f not in LABELLING]
        vectors = VectorAssembler(inputCols=inputs, outputCol="x")
        forest = RandomForestClassifier(featuresCol="x", labelCol="y", numTrees=TREES, maxDepth=DEPTH, seed=SEED, minInstancesPerNode=2)
        model = forest.fit(vectors.transform(sample).select("x", "y"))
        scored = model.transform(vectors.transform(rows)).withColumn("score", vector_to_array("probability")[1])
        if findings is None:
            scored = scored.withColumn("score", F.coalesce(sure_label().cast("double"), "score"))
    else:
        scored = rows.withColumn("score", F.coalesce(sure_label(), F.lit(0)).cast("double"))
    return scored.select(F.col("id").alias(id_col), F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "sha256",
                         detector.alias("detector"), "score", (F.col("score") >= least).alias("is_secret"))
