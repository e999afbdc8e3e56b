"""The corpus pipeline: raw documents to clean, distinct, encoded training text.

Each stage reads all rows that the stage before it kept, and its decisions take effect:
rejected, copied and contaminated documents go, personal data is replaced by its kind, and
the last stage returns the token ids.  ``run`` writes each stage's result to the shared
folder as Parquet and reads it back, so a lost executor repeats tasks of one stage only.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledger.llm import bpe, decontaminate, minhash, pii, quality
from ledger.llm.common import read_documents, staged, tune
from ledger.llm.queries import VOCABULARY


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.without_rejected(docs, tune(spark).read.parquet(f"{sf_dir}/labels.parquet"))


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near copies (0.8 or more)."""
    tune(spark)
    return minhash.without_copies(docs, least=minhash.LEAST_COPY)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item of ``SEED`` words or more; shorter items stand in
    clean texts too, so their matches (``item_words`` tells them) drop nothing."""
    items = tune(spark).read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.without_contaminated(docs, items)


def private_data_replaced(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; ``n_chars`` follows the text."""
    out = pii.redact(docs)
    if "n_chars" in docs.columns:
        size = F.coalesce(F.length("text"), F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", size)
    return out.select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, token count, ids, and the checksum of the text they decode to."""
    got = bpe.encode_documents(docs, public_tokenizers.path(VOCABULARY))
    tune(spark)
    return got.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", distinct_texts),
    ("decontamination", decontaminated),
    ("pii", private_data_replaced),
    ("bpe", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents under ``sf_dir``."""
    docs = read_documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


# Trained models, iterative components and tokenisation have no SQL form; the stages are
# tested against brute force (tests/llm).
ORACLE_SQL = None
