"""Article text files: S1 (scan a folder), S2 (tolerant decoding), K11 (render an article).

One file is one article, so the folder is read with ``wholetext`` (one row per file) and
the file name comes from the ``_metadata`` column; partitions are files, and a large
folder is split across tasks by Spark's file listing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.urls import loader_title

REPLACEMENT_CHAR = "�"


def _decoded(name: Column) -> Column:
    """``_metadata.file_name`` is URI-encoded ('%20' for a space); a literal '+' must survive."""
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def scan_articles(spark: SparkSession, folder: str, tolerant: bool = False) -> DataFrame:
    """S1 (+S2): ``(file_name, file_path, title, content, type)`` for every ``*.txt`` file.

    title = file name with ``.txt`` removed; content stripped; type 'text'. ``tolerant``
    drops the replacement character that undecodable bytes turn into.
    """
    raw = (spark.read.text(folder, wholetext=True, pathGlobFilter="*.txt", recursiveFileLookup=False)
           .select(F.col("value"), _decoded(F.col("_metadata.file_name")).alias("file_name"),
                   F.col("_metadata.file_path").alias("file_path")))
    content = F.regexp_replace("value", REPLACEMENT_CHAR, "") if tolerant else F.col("value")
    return raw.select("file_name", "file_path", loader_title(F.col("file_name")).alias("title"),
                      T.ustrip(content).alias("content"), F.lit("text").alias("type"),
                      content.alias("raw"))


def _numbered(items: Column, render) -> Column:
    """``"1. …\\n2. …\\n"`` from an array, numbering from 1."""
    return F.array_join(F.transform(items, lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), render(x),
                                                                    F.lit("\n"))), "")


def render_article(title: Column, url: Column, paragraphs: Column,
                   images: Column | None = None, videos: Column | None = None) -> Column:
    """K11 (+N5): the article file text.

    ``images``: array<struct<filename, caption>>; ``videos``: array<struct<filename>>; lists
    are written only when non-empty, numbered from 1.
    """
    parts = [F.lit(T.TITLE_MARKER), F.coalesce(title.cast("string"), F.lit("None")), F.lit("\n"),
             F.lit(T.URL_MARKER), url, F.lit("\n\n"), F.lit(T.BODY_MARKER + "\n"),
             F.array_join(paragraphs, "\n\n")]
    if images is not None:
        parts.append(F.when(F.size(images) > 0, F.concat(
            F.lit("\n\n" + T.IMAGE_LIST_MARKER + "\n"),
            _numbered(images, lambda x: F.concat(x["filename"], F.lit(" - "), x["caption"])))).otherwise(F.lit("")))
    if videos is not None:
        parts.append(F.when(F.size(videos) > 0, F.concat(
            F.lit("\n\n" + T.VIDEO_LIST_MARKER + "\n"),
            _numbered(videos, lambda x: x["filename"]))).otherwise(F.lit("")))
    return F.concat(*parts)


def paragraphs_of(text: Column) -> Column:
    """Paragraphs of a plain document: lines after the first, stripped, non-empty."""
    lines = F.split(text, "\n")
    rest = F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(1)))
    return F.filter(F.transform(rest, lambda x: T.ustrip(x)), lambda x: x != "")
