"""Sinks: K1 (corpus load with stable ids), K3 (statistics refresh), K4 (keyword rows),
K7 (ranked report text), K8/K9 (sheets as CSV), K10 (run report as JSON lines).

All writers are plain DataFrameWriter calls; none funnels rows through the driver. Ids are
derived from the data (a hash of the file path), so a recomputed partition after an
executor loss produces the same ids (``monotonically_increasing_id`` would not).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def to_corpus(articles: DataFrame, source: str, media_name: str, id_col: str | None = None) -> DataFrame:
    """K1 + F8 + F12: corpus rows from scanned articles ``(file_path, title, content, type)``.

    ``id`` = ``id_col`` when given, else ``xxhash64(file_path)`` (stable across recomputation).
    ``source`` and ``media_name`` are constants of the load (the reference writes 'uk'/'BBC';
    a source outside the table's domain is reported by the audit, not dropped).
    """
    ident = F.col(id_col) if id_col else F.xxhash64("file_path")
    return articles.select(ident.alias("id"), "title", "content", F.lit(source).alias("source"),
                           F.lit(media_name).alias("media_name"), "type", "file_path",
                           T.publish_date(F.col("content")).alias("publish_date"))


def write_table(df: DataFrame, path: str, mode: str = "append", partition_by=None, fmt: str = "parquet") -> None:
    """K1 / K2 / K4: append rows (partitioned writes; at JDBC targets use ``batchsize``)."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def refresh_statistics(stats: DataFrame, path: str, keep_history: bool = False) -> None:
    """K3: the reference deletes all statistics and inserts the new ones (full overwrite).
    ``keep_history`` [ours]: dynamic partition overwrite by ``stat_date`` keeps other days."""
    w = stats.write.format("parquet")
    if keep_history:
        w.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("stat_date").save(path)
    else:
        w.mode("overwrite").save(path)


def write_report_text(lines: DataFrame, path: str) -> None:
    """K7: the ranked report in (section, rank) order.

    The lines are range-sorted across tasks and each task writes its range as one part
    file; the part files in name order are the report (no single-task funnel — a report over
    every article is as large as the corpus).
    """
    lines.orderBy("section", "rank").select("line").write.mode("overwrite").text(path)


def write_sheet(df: DataFrame, path: str) -> None:
    """K8 / K9: a sheet as CSV with a header (xlsx styling is not built)."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    """The run report as JSON lines (one hit per line, each carrying the total)."""
    df.write.mode("overwrite").json(path)
