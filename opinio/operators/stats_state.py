"""K3, G1-G3, G5 kept up load by load: mergeable state instead of a full refresh.

A load adds state rows: counts and sums of its own articles per source, type, media, month and
sentiment, under its load id. They are stored by key (``sinks.merge``), so a load that is run again
replaces its own rows and changes nothing. A deletion (D2) is a load of the deleted articles with
the sign turned. Statistics are sums over the state, whose size is that of the groups and loads, never
of the articles; ``compacted`` folds the loads of a state into one.

A load brings articles with all of their sentiment rows, as the loader writes them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks.merge import merge_into, read_stored
from .stats import activity_of

GROUP = ["kind", "source", "type", "media_name", "stat_month", "sentiment"]
SCHEMA = T.StructType([T.StructField("load_id", T.StringType()), *[T.StructField(c, T.StringType()) for c in GROUP],
                       T.StructField("n", T.LongType()), T.StructField("scored", T.LongType()), T.StructField("score_sum", T.DecimalType(38, 2))])


def state_rows(corpus: DataFrame, sentiment: DataFrame, load_id: str, sign: int = 1) -> DataFrame:
    """The state of a load: ``article`` rows count each article once, ``row`` rows count it once per
    sentiment row (once without one), as the joined statistics do."""
    c = corpus.select("id", "source", "type", "media_name", F.date_format("publish_date", "yyyy-MM").alias("stat_month"))
    s = sentiment.select(F.col("corpus_id").alias("id"), "sentiment", "sentiment_score")
    joined = c.join(s, "id", "left").withColumn("kind", F.lit("row"))
    both = joined.unionByName(c.withColumns({"kind": F.lit("article"), "sentiment": F.lit(None).cast("string"),
                                             "sentiment_score": F.lit(None).cast(sentiment.schema["sentiment_score"].dataType)}))
    cells = both.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n"), F.count("sentiment_score").alias("scored"),
                                     F.coalesce(F.sum("sentiment_score"), F.lit(0)).alias("score_sum"))
    return cells.select(F.lit(load_id).alias("load_id"), *GROUP, (F.col("n") * sign).alias("n"), (F.col("scored") * sign).alias("scored"),
                        (F.col("score_sum") * sign).cast("decimal(38,2)").alias("score_sum"))


def add_load(corpus: DataFrame, sentiment: DataFrame, path: str, load_id: str) -> bool:
    """Add a load's articles to the state at ``path``; False if the load already ended."""
    return merge_into(state_rows(corpus, sentiment, load_id), path, ["load_id", *GROUP], load_id)


def subtract(corpus: DataFrame, sentiment: DataFrame, deleted: DataFrame, path: str, load_id: str) -> bool:
    """Take the articles of ``deleted`` (a column ``id``) and their sentiment rows out of the state."""
    ids = deleted.select("id").distinct()
    gone = corpus.join(ids, "id", "left_semi")
    rows = sentiment.join(ids.select(F.col("id").alias("corpus_id")), "corpus_id", "left_semi")
    return merge_into(state_rows(gone, rows, load_id, -1), path, ["load_id", *GROUP], load_id)


def state(spark: SparkSession, path: str) -> DataFrame:
    """The state summed over its loads; groups that all loads together emptied are gone."""
    return (read_stored(spark, path, SCHEMA).groupBy(*GROUP)
            .agg(F.sum("n").alias("n"), F.sum("scored").alias("scored"), F.sum("score_sum").alias("score_sum")).where("n <> 0"))


def compacted(spark: SparkSession, path: str, into: str, load_id: str = "compacted") -> bool:
    """Write the state of ``path`` as one load of a new table at ``into``."""
    rows = state(spark, path).select(F.lit(load_id).alias("load_id"), *GROUP, "n", "scored", F.col("score_sum").cast("decimal(38,2)").alias("score_sum"))
    return merge_into(rows, into, ["load_id", *GROUP], load_id)


def _average(dtype: str):
    """The average of two-digit scores, rounded like an average column (six places first)."""
    mean = F.sum("score_sum").cast("decimal(20,2)") / F.sum("scored").cast("decimal(17,0)")
    return F.when(F.sum("scored") > 0, mean.cast("decimal(7,6)")).cast(dtype)


def source_statistics(cells: DataFrame, stat_date: str) -> DataFrame:
    """G1 + G4 from the state."""
    rows = cells.where("kind = 'row'")
    of = lambda column, value: F.coalesce(F.sum(F.when(F.col(column) == value, F.col("n"))), F.lit(0)).alias(f"{value}_count")
    return (rows.groupBy("source").agg(
        F.sum("n").alias("total_count"), *[of("type", t) for t in ("text", "image", "video")],
        *[of("sentiment", s) for s in ("positive", "neutral", "negative")], _average("decimal(3,2)").alias("avg_sentiment"))
        .select(F.lit(stat_date).cast("date").alias("stat_date"), "*"))


def corpus_statistics(cells: DataFrame) -> DataFrame:
    """G2 from the state."""
    return (cells.where("kind = 'article'").groupBy("source", "type", F.col("stat_month").alias("month")).agg(F.sum("n").alias("count")))


def sentiment_statistics(cells: DataFrame) -> DataFrame:
    """G3 from the state."""
    return (cells.where("kind = 'row'").groupBy("source", "sentiment")
            .agg(F.sum("n").alias("count"), _average("decimal(7,6)").alias("avg_score")))


def media_activity(cells: DataFrame) -> DataFrame:
    """G5 from the state."""
    return activity_of(cells.where("kind = 'article'").groupBy("media_name", "source", "stat_month").agg(F.sum("n").alias("_n")))
