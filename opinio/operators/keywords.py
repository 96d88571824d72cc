"""Keyword tables: frequency sheet (S4, K9), hot keywords (W8, W10, K5), article keywords
(W9, M6, K4) and row-level rejects (K6).

The sheet is the top-``n`` word list, so everything broadcast here is bounded by ``n``
(a parameter, 100 by default), never by the corpus.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import heat_score, keyword_weight

SHEET_SCHEMA = T.StructType([
    T.StructField("keyword", T.StringType()),
    T.StructField("count", T.StringType()),
    T.StructField("freq", T.StringType()),
])
KEYWORD_MAX_CHARS = 100     # VARCHAR(100) of keywords / hot_keywords
DEFAULT_HOT_SOURCE = "all"  # column default of hot_keywords.source


def sheet_from_top_words(top: DataFrame) -> DataFrame:
    """K9: the frequency sheet as the reference writes it (three text cells per row)."""
    return top.select(F.col("word").alias("keyword"), F.col("count").cast("string").alias("count"),
                      F.col("percent").alias("freq"))


def read_sheet(spark, path: str, fmt: str = "csv") -> DataFrame:
    """A frequency sheet file read by position with an explicit all-text schema."""
    r = spark.read.schema(SHEET_SCHEMA)
    return r.option("header", True).csv(path) if fmt == "csv" else r.format(fmt).load(path)


def typed_sheet(sheet: DataFrame) -> DataFrame:
    """S4 + F9 + W8 + W9: trimmed keyword, 64-bit count (a hot word of a large corpus passes 2^31), heat and weight; blank / 'nan'
    keywords are skipped; a count that is not an integer gives NULLs (see ``rejects``)."""
    kw = F.trim(F.col("keyword"))
    cnt = F.trim(F.col("count")).try_cast("bigint")
    freq = F.trim(F.col("freq"))
    return (sheet.where(kw.isNotNull() & ~kw.isin("", "nan"))
            .select(kw.alias("keyword"), cnt.alias("count"), freq.alias("freq"),
                    heat_score(freq, cnt).alias("heat_score"),
                    keyword_weight(freq, cnt).alias("weight")))


def _reason(sheet: DataFrame):
    kw = F.trim(F.col("keyword"))
    cnt = F.trim(F.col("count")).try_cast("bigint")
    freq = F.trim(F.col("freq"))
    return (F.when(kw.isNull() | kw.isin("", "nan"), "blank keyword")
            .when(F.length(kw) > KEYWORD_MAX_CHARS, "keyword too long")
            .when(cnt.isNull(), "count not an integer")
            .when(heat_score(freq, cnt).isNull(), "heat not a DECIMAL(5,2)")
            .when(keyword_weight(freq, cnt).isNull(), "weight not a DECIMAL(5,2)"))


def rejects(sheet: DataFrame) -> DataFrame:
    """K6: rows that cannot be loaded, each with the first failing rule as ``reason``."""
    return (sheet.select("keyword", "count", "freq", _reason(sheet).alias("reason"))
            .where(F.col("reason").isNotNull()))


def accepted(sheet: DataFrame) -> DataFrame:
    """K6 complement: the typed rows that pass every rule (same pass, no join)."""
    return typed_sheet(sheet.where(_reason(sheet).isNull()))


def hot_keywords(sheet: DataFrame, stat_date: str, source: str = DEFAULT_HOT_SOURCE,
                 now: str | None = None) -> DataFrame:
    """W8 + W10: ``hot_keywords`` rows (keyword, source, count, heat_score, stat_date, times)."""
    t = typed_sheet(sheet).where(F.col("count").isNotNull() & F.col("heat_score").isNotNull())
    ts = F.lit(now or f"{stat_date} 00:00:00").cast("timestamp_ntz")
    return t.select("keyword", F.lit(source).alias("source"), "count", "heat_score",
                    F.lit(stat_date).cast("date").alias("stat_date"),
                    ts.alias("create_time"), ts.alias("update_time"))


def upsert_hot_keywords(existing: DataFrame, incoming: DataFrame,
                        key=("keyword", "source", "stat_date")) -> DataFrame:
    """K5: keyed upsert. On a key match take count, heat score and update time from the
    incoming row and keep the existing create time; unmatched rows of either side stay.

    A full outer join on the key (shuffle on the key at scale, no broadcast assumption);
    on a table format with MERGE this is ``MERGE INTO … WHEN MATCHED UPDATE … WHEN NOT
    MATCHED INSERT``.
    """
    e = existing.select(*key, *[F.col(c).alias("e_" + c) for c in
                                ("count", "heat_score", "create_time", "update_time")])
    i = incoming.select(*key, *[F.col(c).alias("i_" + c) for c in
                                ("count", "heat_score", "create_time", "update_time")])
    j = e.join(i, list(key), "full_outer")
    hit = F.col("i_count").isNotNull() | F.col("i_heat_score").isNotNull() | F.col("i_update_time").isNotNull()
    return j.select(*key,
                    F.when(hit, F.col("i_count")).otherwise(F.col("e_count")).alias("count"),
                    F.when(hit, F.col("i_heat_score")).otherwise(F.col("e_heat_score")).alias("heat_score"),
                    F.coalesce(F.col("e_create_time"), F.col("i_create_time")).alias("create_time"),
                    F.when(hit, F.col("i_update_time")).otherwise(F.col("e_update_time")).alias("update_time"))


def assign_keywords(corpus_ids: DataFrame, sheet: DataFrame) -> DataFrame:
    """M6 + W9: every sheet keyword for every article (reference semantics: a global list).

    The sheet (≤ n rows) is folded into one array value, attached to each article as a
    broadcast scalar and exploded; output is |corpus| × n rows, produced map-side with no
    shuffle and no pair enumeration beyond the result itself.
    """
    t = typed_sheet(sheet).where(F.col("count").isNotNull())
    kw = t.agg(F.collect_list(F.struct("keyword", "weight", F.col("count").alias("frequency"))).alias("kws"))
    return (corpus_ids.select(F.col("id").alias("corpus_id"))
            .crossJoin(F.broadcast(kw))
            .select("corpus_id", F.explode("kws").alias("k"))
            .select("corpus_id", "k.keyword", "k.weight", "k.frequency"))
