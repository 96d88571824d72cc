"""Parquet table sources (S7, S10) and the adapters from the driver tables to our model.

Readers never infer: the driver tables are Parquet (self-describing) and every derived
column is an explicit expression. Column pruning and filter pushdown reach the scan
because adapters are plain projections.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# Adapter constants for the driver data (see README: corpus adapter).
ADAPTER_BASE_DATE = "2024-01-01"
ADAPTER_DAYS = 365


# Tables whose rows carry long text: per-row work (regex, tokenising) dominates their cost.
TEXT_TABLES = ("documents", "pages", "conversations", "benchmark")


def read_table(spark: SparkSession, sf_dir: str, name: str, text_work: bool = False) -> DataFrame:
    """A driver table. ``text_work``: the caller runs per-row text work (regex, tokenising)
    over it, so a table that arrives in too few splits is spread first; plain scans keep
    column pruning and filter pushdown down to Parquet."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df) if (text_work and name in TEXT_TABLES) else df


#: A text table in fewer files than this is spread, into as many parts.
SPREAD_FILES, SPREAD_PARTS = 16, 16


def spread(df: DataFrame) -> DataFrame:
    """Spread the rows of a table that lies in few files.

    A large table lies in many files and is returned untouched (no extra shuffle), whatever the
    number of cores. A table in a few files of one row group each would run every regex and
    tokeniser of the job in as few tasks (byte-range splits don't divide a row group). Rows are
    hash-spread by their position in the scan (``monotonically_increasing_id``: the same on a
    retried task of a file scan, so a lost executor recomputes the same part) and the spread copy
    is persisted (memory and disk; it is small by the rule above, and ``spark.catalog.clearCache``
    frees it). The persisted relation is also a barrier for the optimizer: filters that Spark
    infers from costly expressions (e.g. ``size(regex…) > 0`` before an explode) would otherwise
    be pushed back below the exchange into the few scan tasks.
    """
    if len(df.inputFiles()) >= SPREAD_FILES:
        return df
    return df.repartition(SPREAD_PARTS, F.monotonically_increasing_id()).persist(StorageLevel.MEMORY_AND_DISK)


def corpus_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-column scan ``SELECT id FROM corpus``; only ``doc_id`` is read from Parquet."""
    return read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``corpus`` table modelled on the driver's ``documents``.

    id = doc_id; title = first line; content = text; source = lang; media_name = source;
    type = text/image/video by ``doc_id % 3``; publish_date = base date + ``doc_id % 365``.
    """
    d = read_table(spark, sf_dir, "documents")
    return corpus_from_documents(d)


def corpus_from_documents(d: DataFrame) -> DataFrame:
    t = F.pmod(F.col("doc_id"), F.lit(3))
    return d.select(
        F.col("doc_id").alias("id"),
        F.substring_index(F.col("text"), "\n", 1).alias("title"),
        F.col("text").alias("content"),
        F.col("lang").alias("source"),
        F.col("source").alias("media_name"),
        F.when(t == 0, "text").when(t == 1, "image").otherwise("video").alias("type"),
        F.date_add(F.lit(ADAPTER_BASE_DATE).cast("date"),
                   F.pmod(F.col("doc_id"), F.lit(ADAPTER_DAYS)).cast("int")).alias("publish_date"),
    )


def bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article bodies for the text chains: ``(doc_id, body)`` with the body stripped."""
    d = read_table(spark, sf_dir, "documents", text_work=True)
    return d.select("doc_id", T.ustrip(F.col("text")).alias("body"))


def labelled_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that carry a sentiment row (``labels`` marks them)."""
    return read_table(spark, sf_dir, "labels").select(F.col("doc_id").alias("corpus_id")).distinct()
