"""Quality classifier with host and path evidence by hierarchical empirical Bayes.

Three kinds of evidence are put together in log odds:

* the document: a logistic model over text statistics, fitted on a bounded sample of
  labelled rows, gives the likelihood ratio of the text being good;
* the host: its labelled rows, shrunk toward the corpus-wide share of good rows by a beta
  prior whose strength is estimated from how much hosts differ (method of moments);
* the path below the host: its labelled rows, shrunk toward the host's posterior in the
  same way.

A site with few labelled rows thus has the prior of what lies above it; a site with many
speaks for itself.  Counts are grouped aggregates over all labelled rows, one row per path
and per host, joined back on their keys.

``score`` is the posterior probability of good quality; rows below ``REJECT`` are rejected.

Defined results: a NULL host or path is a site of its own; NULL and empty texts have
statistics of 0 like any other text; several labels of one id count as their smallest;
without labels of both kinds the document evidence is neutral; without any labels every
score is the neutral prior 0.5 and every row is kept; repeated rows give repeated results.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledger.llm.common import SPACE, staged, unit_hash

# At most this many labelled rows fit the document model; more are thinned by a hash of the id.
SAMPLE_ROWS = 50_000
REJECT = 0.3
FEATURES = ["log_words", "mean_word", "symbol_share", "upper_share", "digit_share", "mark_share", "distinct_share", "dup_line_share"]
# Names of the classifier's own columns begin with this.
IN = "__q_"
ID = IN + "id"
# Prior strengths lie between these numbers of rows.
WEAKEST, STRONGEST = 1.0, 1000.0


def features(text: Column) -> dict[str, Column]:
    """Shares that set apart junk, boilerplate and shouting from prose."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    words = F.array_remove(F.split(text, SPACE + "+", -1), "")
    lines = F.array_remove(F.split(text, r"\s*\n\s*", -1), "")
    count = lambda pattern: F.regexp_count(text, F.lit(pattern)).cast("double")
    chars = F.greatest(F.length(text), F.lit(1)).cast("double")
    n = F.greatest(F.size(words), F.lit(1)).cast("double")
    return {
        "log_words": F.log1p(F.size(words)),
        "mean_word": F.least(chars / n, F.lit(50.0)),
        "symbol_share": count(r"[#*$%&|<>{}\[\]=_^~\\]") / chars,
        "upper_share": count(r"\p{Lu}+") / n,
        "digit_share": count("[0-9]") / chars,
        "mark_share": count("[!?]") / n,
        "distinct_share": F.size(F.array_distinct(words)) / n,
        "dup_line_share": 1.0 - F.size(F.array_distinct(lines)) / F.greatest(F.size(lines), F.lit(1)),
    }


def prior(groups: DataFrame, above: Column) -> float:
    """Strength (in rows) of the beta prior that fits how far ``good`` of ``n`` differs from
    ``above`` between the groups: binomial scatter plus ``above (1 - above) / (1 + strength)``."""
    n, m = F.col("n"), above
    miss = F.col("good") - n * m
    # E[miss^2] = n m (1 - m) (1 + (n - 1) / (1 + strength)).
    got = groups.where("n > 1").agg(F.sum(miss * miss - n * m * (1 - m)), F.sum(n * (n - 1) * m * (1 - m))).first()
    if not got[0] or not got[1] or got[0] <= 0:
        return STRONGEST
    return min(STRONGEST, max(WEAKEST, got[1] / got[0] - 1))


def _logit(p: Column) -> Column:
    p = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), p))
    return F.log(p / (1 - p))


class Classifier:
    """A fitted model: document odds, host and path posteriors, and what they rest on."""

    def __init__(self, stats: DataFrame, labels: DataFrame, id_col: str, label_col: str, sample_rows: int):
        given = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
                 .groupBy(F.col(id_col).alias(ID)).agg(F.min(label_col).cast("int").alias("y")))
        known = staged(stats.dropDuplicates([ID]).join(given, ID), "labelled")
        n_known, n_good = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()
        self.overall = (n_good + 0.5) / (n_known + 1.0)
        self.vectors = VectorAssembler(inputCols=[IN + f for f in FEATURES], outputCol=IN + "x")
        self.model = None
        if 0 < n_good < n_known:
            # One partition in a fixed order: the fit must not depend on how rows were dealt out.
            sample = known.where(unit_hash(F.col(ID), seed=2) < min(1.0, 0.9 * sample_rows / n_known))
            sample = sample.orderBy(unit_hash(F.col(ID), seed=3), ID).limit(sample_rows).coalesce(1)
            fit = LogisticRegression(featuresCol=IN + "x", labelCol="y", rawPredictionCol=IN + "raw", regParam=0.002, maxIter=60)
            self.model = fit.fit(self.vectors.transform(sample).select(IN + "x", "y"))
        overall = F.lit(self.overall)
        paths = staged(known.groupBy(IN + "host", IN + "path").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("good")), "paths")
        hosts = paths.groupBy(IN + "host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
        strength = prior(hosts, overall)
        hosts = hosts.select(IN + "host", ((F.col("good") + overall * strength) / (F.col("n") + strength)).alias("host_prior"))
        self.hosts = staged(hosts, "hosts")
        paths = paths.join(self.hosts, IN + "host")
        strength = prior(paths, F.col("host_prior"))
        paths = paths.select(IN + "path", ((F.col("good") + F.col("host_prior") * strength) / (F.col("n") + strength)).alias("path_prior"))
        self.paths = staged(paths, "path-priors")

    def apply(self, stats: DataFrame, reject: float = REJECT) -> DataFrame:
        """``stats`` with ``text_odds, host_prior, path_prior, score, kept``.

        The priors are two tables of one row a site; the planner sends them to the tasks
        where their files are small and joins on the keys where they are not."""
        overall = F.lit(self.overall)
        if self.model is None:
            rows = stats.withColumn("text_odds", F.lit(0.0))
        else:
            rows = self.model.transform(self.vectors.transform(stats))
            rows = rows.withColumn("text_odds", vector_to_array(IN + "raw")[1] - _logit(overall)).drop(IN + "x", IN + "raw", "probability", "prediction")
        out = rows.join(self.hosts, IN + "host", "left").join(self.paths, IN + "path", "left")
        out = out.withColumn("host_prior", F.coalesce("host_prior", overall)).withColumn("path_prior", F.coalesce("path_prior", "host_prior"))
        out = out.withColumn("score", 1 / (1 + F.exp(-F.col("text_odds") - _logit(F.col("path_prior")))))
        return out.withColumn("kept", F.col("score") >= reject)


def inputs(id_col: str, text_col: str, host: str, path: str) -> list[Column]:
    """The id, the site's names and the statistics, under names of the classifier's own."""
    site = F.struct(F.col(host).cast("string").alias("h"), F.col(path).cast("string").alias("p"))
    return [F.col(id_col).alias(ID), F.to_json(F.struct(site["h"])).alias(IN + "host"), F.to_json(site).alias(IN + "path"),
            *(v.alias(IN + k) for k, v in features(F.col(text_col)).items())]


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host: str = "source",
             path: str = "lang", label_col: str = "quality", sample_rows: int = SAMPLE_ROWS, reject: float = REJECT) -> DataFrame:
    """``id_col, text_odds, host_prior, path_prior, score, kept`` of every row of ``docs``."""
    stats = staged(docs.select(*inputs(id_col, text_col, host, path)), "quality")
    out = Classifier(stats, labels, id_col, label_col, sample_rows).apply(stats, reject)
    return out.select(F.col(ID).alias(id_col), "text_odds", "host_prior", "path_prior", "score", "kept")


def without_rejected(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host: str = "source",
                     path: str = "lang", label_col: str = "quality", sample_rows: int = SAMPLE_ROWS, reject: float = REJECT) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns as they were; the texts are read
    twice and not shuffled."""
    fitted = Classifier(staged(docs.select(*inputs(id_col, text_col, host, path)), "quality"), labels, id_col, label_col, sample_rows)
    rows = docs.select(F.struct("*").alias(IN + "row"), *inputs(id_col, text_col, host, path))
    return fitted.apply(rows, reject).where("kept").select(IN + "row.*")
