"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledger.session import checkpoint_dir

# ASCII white space as the contracts define it: blank and \t \n \v \f \r.
SPACE = r"[\x20\x09-\x0D]"

# Rows of one Arrow batch: whole texts are shipped, so batches are kept small.
ARROW_ROWS = 256


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tune(spark: SparkSession) -> SparkSession:
    """Small Arrow batches: a batch of whole texts must fit beside the executor's heap."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    return spark


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts the lineage and gives the planner real sizes.  The folder is the one the session
    names in ``spark.checkpoint.dir``, so a lost executor loses no staged row.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, even where ``body`` uses it inside
    lambdas (an inlined expression would be evaluated again for every element)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def unit_hash(*cols: Column, seed: int = 0) -> Column:
    """A value in [0, 1) that depends on ``cols`` alone: samples drawn by it do not depend
    on how rows are partitioned."""
    return (F.xxhash64(F.lit(seed), *cols).bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(float(1 << 52)))
