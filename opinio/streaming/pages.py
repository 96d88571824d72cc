"""Incremental ingest (the reference's seen-URL set as streaming state).

``stream_new_pages``: pages landing in a folder → dedupe by URL within an event-time watermark → those
whose URL is not stored yet → paragraphs (the same native expressions as the batch operators).
``stream_source_counts``: a running count per source (G2/Q2) in update mode. Both are plain Structured
Streaming plans; state is bounded by the watermark (URLs are forgotten ``dedupe_window`` after
their event time; what lands later than that behind the newest row is dropped as late).

Event time is a column of the landed rows or, where they have none, the time their file landed: it is
the same when a batch is run again. ``store_available`` writes every batch as one load of
a stored table, named by the stream and the batch number, so a batch that was written but not
committed is not stored twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import pages as P
from ..sinks.merge import PARTS, merge_into

PAGES_SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])
DOCUMENTS_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])


EVENT_TIME = "landed_at"


def read_landing(spark: SparkSession, folder: str, schema: T.StructType = PAGES_SCHEMA,
                 max_files_per_trigger: int | None = None, event_time: str = EVENT_TIME) -> DataFrame:
    """The rows landing in a folder, with ``event_time``: their own column, else their file's time."""
    r = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = r.load(folder)
    return rows if event_time in schema.names else rows.withColumn(event_time, F.col("_metadata.file_modification_time"))


def unseen_pages(pages: DataFrame, dedupe_window: str = "1 day", stored: DataFrame | None = None,
                 event_time: str = EVENT_TIME) -> DataFrame:
    """M10 in streaming form: each URL once within the watermark, and only URLs that the static table
    ``stored`` (a column ``url``) does not have."""
    unique = pages.withWatermark(event_time, dedupe_window).dropDuplicatesWithinWatermark(["url"])
    return unique if stored is None else unique.join(stored.select("url").distinct(), "url", "left_anti")


def stream_new_pages(pages: DataFrame, dedupe_window: str = "1 day", stored: DataFrame | None = None,
                     event_time: str = EVENT_TIME) -> DataFrame:
    """The paragraphs (C6) of ``unseen_pages``."""
    return P.page_paragraphs(unseen_pages(pages, dedupe_window, stored, event_time).select("page_id", "url", "html"))


def stream_source_counts(documents: DataFrame) -> DataFrame:
    """Running Q2: documents per source (the corpus adapter maps ``lang`` to source)."""
    return documents.groupBy(F.col("lang").alias("source")).agg(F.count(F.lit(1)).alias("count"))


def run_available(df: DataFrame, checkpoint: str, mode: str, sink_table: str):
    """Process everything available now (``availableNow``) into a memory table; for tests and
    back-fills. Production jobs use ``processingTime`` triggers and a durable sink."""
    q = (df.writeStream.outputMode(mode).format("memory").queryName(sink_table)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def store_available(df: DataFrame, checkpoint: str, path: str, keys: list[str], stream: str, parts: int = PARTS):
    """Process everything available now into the stored table at ``path`` (``sinks.merge``): a row is
    added once for its key, whatever is replayed."""
    def store(batch: DataFrame, number: int) -> None:
        if not merge_into(batch, path, keys, f"{stream}-{number}", update=False, parts=parts):
            batch.write.format("noop").mode("overwrite").save()      # stored before, but the state must move on too

    q = (df.writeStream.outputMode("append").foreachBatch(store).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
