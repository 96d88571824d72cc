"""Session helpers.

The library never creates a session behind the caller's back: every operator takes
DataFrames. These helpers exist for tests, ``bench.py`` and command-line use.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale; all are plain Spark SQL configuration.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8,
                  checkpoint_dir: str | None = None, app: str = "opinio") -> SparkSession:
    """A local session for tests and benchmarks (cluster jobs bring their own)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", os.environ.get("OPINIO_DRIVER_MEMORY", "16g")))
    for k, v in SCALE_CONF.items():
        b = b.config(k, v)
    if checkpoint_dir:
        b = b.config("spark.checkpoint.dir", checkpoint_dir)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark, checkpoint_dir)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str | None:
    """Use the cluster's ``spark.checkpoint.dir``; only set ``fallback`` where it is unset."""
    try:
        sc = spark.sparkContext
    except Exception:  # sessions without a SparkContext handle (e.g. Spark Connect)
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    target = configured or fallback
    if target:
        sc.setCheckpointDir(target)
    return target


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss).

    Requires ``spark.checkpoint.dir`` (cluster) or a test fallback; never a
    machine-local temp folder and never ``localCheckpoint``.
    """
    spark = df.sparkSession
    if not ensure_checkpoint_dir(spark):
        raise RuntimeError("spark.checkpoint.dir is not set; a shared folder is required")
    return df.checkpoint(eager=True)
