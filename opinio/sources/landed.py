"""Folders of landed files, loaded load by load (S1 articles, S10 pages; one file is one row).

The stored table is its own manifest: each row carries its file's path, size and time, so a file counts as loaded
exactly when its row is stored. A load lists the folder without opening a file, keeps the files that the
stored columns lack by an anti join, opens only those and merges them into compacted Parquet
(``sinks.merge``). No list of files passes through the driver beyond Spark's own listing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as TX
from ..functions.urls import loader_title
from ..plans.scratch import materialise
from ..sinks.merge import PARTS, merge_into, read_stored
from .articles import REPLACEMENT_CHAR

FILE_SCHEMA = T.StructType([T.StructField("file_path", T.StringType()), T.StructField("file_size", T.LongType()),
                            T.StructField("file_time", T.TimestampType())])
LANDED_SCHEMA = T.StructType([*FILE_SCHEMA.fields, T.StructField("file_name", T.StringType()), T.StructField("content", T.StringType())])


def _files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder)


def listing(spark: SparkSession, folder: str, pattern: str = "*.txt") -> DataFrame:
    """``(file_path, file_size, file_time)`` of the folder's files; their content is not read."""
    return _files(spark, folder, pattern).select(
        F.col("path").alias("file_path"), F.col("length").alias("file_size"), F.col("modificationTime").alias("file_time"))


def new_files(spark: SparkSession, folder: str, store: str, pattern: str = "*.txt") -> DataFrame:
    """The listed files that are not stored, or are stored with another size or time."""
    stored = read_stored(spark, store, LANDED_SCHEMA).select(*FILE_SCHEMA.names)
    return listing(spark, folder, pattern).join(stored, FILE_SCHEMA.names, "left_anti")


def load_landed(spark: SparkSession, folder: str, store: str, load_id: str, pattern: str = "*.txt", parts: int = PARTS) -> int:
    """Merge the folder's new and changed files into the table at ``store``; the number of files that were merged.

    Spark opens the files whose time is at least that of the oldest new one (a filter that the file reader
    takes), and only new ones are stored: a load after which nothing was copied in with an old time reads new
    files alone. A changed file replaces its row; a file that left the folder keeps its row. A load id
    that ended before merges nothing. Defined results: an empty file is left out, as by every file source; bytes that are no
    UTF-8 become the replacement character; a folder without matching files loads nothing.
    """
    new = materialise(new_files(spark, folder, store, pattern), "new-files")
    count, oldest = new.agg(F.count(F.lit(1)), F.min("file_time")).first()
    if not count:
        return 0
    rows = (_files(spark, folder, pattern).where(F.col("modificationTime") >= F.lit(oldest))
            .join(new.select(F.col("file_path").alias("path")), "path", "left_semi")
            .select(F.col("path").alias("file_path"), F.col("length").alias("file_size"), F.col("modificationTime").alias("file_time"),
                    F.element_at(F.split("path", "/"), -1).alias("file_name"),
                    F.call_function("make_valid_utf8", F.col("content").cast("string")).alias("content")))
    return count if merge_into(rows, store, ["file_path"], load_id, parts=parts) else 0


def stored_articles(spark: SparkSession, store: str, tolerant: bool = False) -> DataFrame:
    """S1 (+S2) from the stored table: ``(file_name, file_path, title, content, type, raw)`` as ``scan_articles`` gives them."""
    content = F.regexp_replace("content", REPLACEMENT_CHAR, "") if tolerant else F.col("content")
    return read_stored(spark, store, LANDED_SCHEMA).select(
        "file_name", "file_path", loader_title(F.col("file_name")).alias("title"), TX.ustrip(content).alias("content"),
        F.lit("text").alias("type"), content.alias("raw"))
