"""Opinion statistics (G1-G5) and the post-load verification reports (Q1-Q18).

All are single-pass aggregations: a left/inner equi-join on the article id (sort-merge or
shuffle-hash at scale, AQE-converted to broadcast when a side is small) followed by a
partial + final hash aggregate on a low-cardinality key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def avg_as(c: Column, dtype: str) -> Column:
    """Average stored into a DECIMAL column: Spark's decimal average (6 extra places,
    half-up), then the column's scale — the same two steps the reference's server takes."""
    return F.avg(c).cast(dtype)


def source_statistics(corpus: DataFrame, sentiment: DataFrame, stat_date: str) -> DataFrame:
    """G1 (+G4): per source totals, type counts, class counts and average score.

    LEFT JOIN, so unscored articles count in ``total_count``; an article with several
    sentiment rows counts once per row (reference semantics). ``stat_date`` is a parameter.
    """
    c = corpus.select("id", "source", "type")
    s = sentiment.select(F.col("corpus_id").alias("id"), "sentiment", "sentiment_score")
    j = c.join(s, "id", "left")
    sent, typ = F.col("sentiment"), F.col("type")
    return (j.groupBy("source").agg(
        F.count(F.lit(1)).alias("total_count"),
        F.count_if(typ == "text").alias("text_count"),
        F.count_if(typ == "image").alias("image_count"),
        F.count_if(typ == "video").alias("video_count"),
        F.count_if(sent == "positive").alias("positive_count"),
        F.count_if(sent == "neutral").alias("neutral_count"),
        F.count_if(sent == "negative").alias("negative_count"),
        avg_as(F.col("sentiment_score"), "decimal(3,2)").alias("avg_sentiment"))
        .select(F.lit(stat_date).cast("date").alias("stat_date"), "*"))


def corpus_statistics(corpus: DataFrame) -> DataFrame:
    """G2 (view): count by source, type and month ``yyyy-MM``."""
    month = F.date_format("publish_date", "yyyy-MM")
    return (corpus.groupBy("source", "type", month.alias("month"))
            .agg(F.count(F.lit(1)).alias("count")))


def sentiment_statistics(corpus: DataFrame, sentiment: DataFrame) -> DataFrame:
    """G3 (view): count and average score by source and sentiment; NULL sentiment = unscored."""
    s = sentiment.select(F.col("corpus_id").alias("id"), "sentiment", "sentiment_score")
    j = corpus.select("id", "source").join(s, "id", "left")
    return (j.groupBy("source", "sentiment")
            .agg(F.count(F.lit(1)).alias("count"), F.avg("sentiment_score").alias("avg_score")))


def media_activity(corpus: DataFrame) -> DataFrame:
    """G5 [ours]: articles per media and month (the table's key); score = 100·count / max count
    of that month; the source is the media's most frequent one of the month, ties by name.

    Counts per source come first (partial sums), then few rows per media and month. The max
    per month is an aggregate of the aggregate joined back on the month, not a window.
    """
    month = F.date_format("publish_date", "yyyy-MM")
    by_source = (corpus.groupBy("media_name", "source", month.alias("stat_month"))
                 .agg(F.count(F.lit(1)).alias("_n")))
    return activity_of(by_source)


def activity_of(by_source: DataFrame) -> DataFrame:
    """G5 from counts ``_n`` per media, source and month."""
    per = (by_source.groupBy("media_name", "stat_month")
           .agg(F.sum("_n").alias("article_count"), F.min_by("source", F.struct(-F.col("_n"), "source")).alias("source")))
    mx = per.groupBy("stat_month").agg(F.max("article_count").alias("_max"))
    return (per.join(mx, "stat_month")
            .select("media_name", "source", "article_count",
                    (F.col("article_count") * 100 / F.col("_max")).cast("decimal(5,2)").alias("activity_score"),
                    "stat_month"))


# ---------------------------- Q1-Q7: corpus and sentiment ------------------------------

def q_count(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def q_source_count(corpus: DataFrame) -> DataFrame:
    return corpus.groupBy("source").agg(F.count(F.lit(1)).alias("count"))


def q_sentiment_distribution(sentiment: DataFrame) -> DataFrame:
    return sentiment.groupBy("sentiment").agg(F.count(F.lit(1)).alias("count"),
                                              F.avg("sentiment_score").alias("avg_score"))


def q_top_sentiment(corpus: DataFrame, sentiment: DataFrame, n: int = 5, descending: bool = True) -> DataFrame:
    """Q5 / Q6: the ``n`` most positive (or negative) loaded articles; ties by article id."""
    s = sentiment.select(F.col("corpus_id").alias("id"), "sentiment", "sentiment_score")
    j = corpus.select("id", "title", "source").join(s, "id")
    key = F.col("sentiment_score").desc() if descending else F.col("sentiment_score").asc()
    return j.orderBy(key, F.col("id").asc()).limit(n).select("id", "title", "source", "sentiment",
                                                             "sentiment_score")


# ------------------------------- Q8-Q13: hot keywords ----------------------------------

# Heat bands of the verification report (lower bound, label).
HEAT_BANDS = ((50, "高热度 (>=50)"), (10, "中热度 (10-50)"), (1, "低热度 (1-10)"))
LOWEST_BAND = "极低热度 (<1)"


def q_distinct(df: DataFrame, col: str, name: str) -> DataFrame:
    return df.agg(F.count_distinct(col).alias(name))


def q_hot_by_source(hot: DataFrame) -> DataFrame:
    return hot.groupBy("source").agg(F.count(F.lit(1)).alias("keyword_count"),
                                     F.avg("heat_score").alias("avg_heat_score"))


def q_hot_top(hot: DataFrame, n: int = 15) -> DataFrame:
    return (hot.orderBy(F.col("heat_score").desc(), F.col("keyword").asc(), F.col("source").asc())
            .limit(n).select("keyword", "source", "count", "heat_score", "stat_date"))


def q_hot_dates(hot: DataFrame) -> DataFrame:
    return hot.select("stat_date").distinct().orderBy(F.col("stat_date").desc())


def heat_band(h):
    out = None
    for lo, name in HEAT_BANDS:
        out = F.when(h >= lo, name) if out is None else out.when(h >= lo, name)
    return out.otherwise(LOWEST_BAND)


def q_heat_bands(hot: DataFrame) -> DataFrame:
    """Q13: keywords per heat band, ordered by the band's minimum heat (descending)."""
    return (hot.groupBy(heat_band(F.col("heat_score")).alias("heat_level"))
            .agg(F.count(F.lit(1)).alias("keyword_count"), F.min("heat_score").alias("min_heat"))
            .orderBy(F.col("min_heat").desc()))


# ------------------------------- Q14-Q18: article keywords -----------------------------

def q_keyword_totals(kw: DataFrame) -> DataFrame:
    return kw.agg(F.count(F.lit(1)).alias("keyword_rows"),
                  F.count_distinct("keyword").alias("distinct_keywords"),
                  F.count_distinct("corpus_id").alias("distinct_articles"))


def q_keyword_top(kw: DataFrame, n: int = 10) -> DataFrame:
    g = kw.groupBy("keyword").agg(F.count(F.lit(1)).alias("article_count"),
                                  F.avg("frequency").alias("avg_frequency"),
                                  F.avg("weight").alias("avg_weight"))
    return g.orderBy(F.col("avg_weight").desc(), F.col("keyword").asc()).limit(n)


def q_keywords_per_article(kw: DataFrame) -> DataFrame:
    """Q16: histogram of keywords per article (an aggregate of an aggregate)."""
    per = kw.groupBy("corpus_id").agg(F.count(F.lit(1)).alias("keyword_count"))
    return per.groupBy("keyword_count").agg(F.count(F.lit(1)).alias("article_count")).orderBy("keyword_count")


def q_keywords_by_source(kw: DataFrame, corpus: DataFrame) -> DataFrame:
    j = kw.join(corpus.select(F.col("id").alias("corpus_id"), "source"), "corpus_id")
    return j.groupBy("source").agg(F.count(F.lit(1)).alias("keyword_count"),
                                   F.count_distinct("keyword").alias("unique_keywords"))


def q_keyword_examples(kw: DataFrame, corpus: DataFrame, words, n: int = 10) -> DataFrame:
    """Q18 (+F10): example rows for an IN-list of keywords; ties by article id and keyword."""
    k = kw.where(F.col("keyword").isin(list(words)))
    j = k.join(corpus.select(F.col("id").alias("corpus_id"), "title"), "corpus_id")
    return (j.orderBy(F.col("weight").desc(), F.col("frequency").desc(), F.col("corpus_id").asc(),
                      F.col("keyword").asc())
            .limit(n).select("corpus_id", "title", "keyword", "weight", "frequency"))
