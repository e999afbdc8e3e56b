"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every ledger job relies on.  Billing days are UTC days; the IST display
# columns are computed explicitly, so the session zone must not shift DATE(ts).
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "ledger",
                  checkpoint: str | None = None) -> SparkSession:
    """A local session for tests and the bench; cluster jobs use their own builder + JOB_CONF.

    ``spark.checkpoint.dir`` is a static setting: it is set here (to ``checkpoint`` or a
    fresh scratch folder) only because a local session has no shared storage to name.
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("LEDGER_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.checkpoint.dir", checkpoint or tempfile.mkdtemp(prefix="ledger-ckpt-"))
    )
    for k, v in JOB_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_job_conf(spark)
    return spark


def apply_job_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable part of JOB_CONF to an existing session."""
    for k, v in JOB_CONF.items():
        if k == "spark.ui.enabled":
            continue
        spark.conf.set(k, v)


_LOCAL_FALLBACK: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names shared storage and is only read; a cluster session
    without it is an error (a machine-local folder would not survive an executor loss).
    A local session without it (e.g. created by a test harness) gets a scratch folder.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name shared storage for ledger jobs")
        if sc.applicationId not in _LOCAL_FALLBACK:
            _LOCAL_FALLBACK[sc.applicationId] = tempfile.mkdtemp(prefix="ledger-ckpt-")
        configured = _LOCAL_FALLBACK[sc.applicationId]
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured
