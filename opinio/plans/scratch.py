"""Intermediate tables: written once to the folder that all executors share, then read again.

Parquet keeps what later reads need apart from what they don't (columns, ranges of a key), is
safe to lose an executor, and gives the optimizer real sizes to choose joins by.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; only a local session without one gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    if not folder:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="opinio-", dir="/tmp"))
    return folder.rstrip("/")


def materialise(df: DataFrame, name: str, spread_by: str | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, whatever reads it later.

    ``spread_by``: a key to deal the rows out by first, into as many files as the session has shuffle
    partitions, for tables whose rows are few but costly to work on."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/opinio/{name}-{uuid.uuid4().hex}"
    if spread_by:
        df = df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), spread_by)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
