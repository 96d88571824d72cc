"""Word-frequency chain: W1-W7, L6 (top words with relative frequency).

Plan shape: one scan → per-row expressions → ``explode`` → filter (InSet stop words) →
partial hash aggregate → one shuffle on ``word`` → final aggregate. Hot words are
absorbed by the map-side partial aggregate, so a word holding a third of all tokens costs
one row per map task, not a third of the shuffle. The total is a global aggregate over
the (already aggregated) counts and joins back as a one-row broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.numbers import percent_text


def doc_tokens(docs: DataFrame, body_col: str = "body", id_col: str = "doc_id") -> DataFrame:
    """W1 per document: ``(doc_id, tokens array<string>)``."""
    return docs.select(F.col(id_col).alias("doc_id"), T.tokens(F.col(body_col)).alias("tokens"))


def exploded_tokens(docs: DataFrame, body_col: str = "body", id_col: str = "doc_id") -> DataFrame:
    """W1 as rows ``(doc_id, pos, token)``; ``pos`` is 0-based in the token list.

    The outer form keeps the optimizer from testing first whether there are tokens, which makes
    them twice; the row of a text without tokens is dropped behind it."""
    return (doc_tokens(docs, body_col, id_col)
            .select("doc_id", F.posexplode_outer("tokens").alias("pos", "token")).where("pos IS NOT NULL"))


def corpus_words(docs: DataFrame, body_col: str = "body", stop_words=T.STOP_WORDS) -> DataFrame:
    """W1 → W2 → W3 as one column ``word`` (one row per kept token). F7's skip of empty
    bodies needs no filter here: an empty body yields no tokens (the outer form's null is no
    kept word)."""
    body = F.col(body_col)
    return (docs.select(F.explode_outer(T.tokens(body)).alias("token"))
            .where(~T.is_stop_word(F.col("token"), stop_words))
            .select(T.singular(F.col("token")).alias("word")))


def stopword_counts(docs: DataFrame, body_col: str = "body", id_col: str = "doc_id",
                    stop_words=T.STOP_WORDS) -> DataFrame:
    """W2 per document: tokens before and after stop-word removal (array-side, no shuffle)."""
    toks = T.tokens(F.col(body_col))
    kept = F.filter(toks, lambda x: ~T.is_stop_word(x, stop_words))
    return docs.select(F.col(id_col).alias("doc_id"),
                       F.size(toks).alias("n_tokens"), F.size(kept).alias("n_kept"))


def singular_map(docs: DataFrame, body_col: str = "body", stop_words=T.STOP_WORDS) -> DataFrame:
    """W3 audit: each kept token, the word it becomes, and how often."""
    return (docs.select(F.explode_outer(T.tokens(F.col(body_col))).alias("token"))
            .where(~T.is_stop_word(F.col("token"), stop_words))
            .groupBy("token").agg(F.count(F.lit(1)).alias("n"))
            .select("token", T.singular(F.col("token")).alias("word"), "n"))


def word_count(docs: DataFrame, body_col: str = "body", stop_words=T.STOP_WORDS) -> DataFrame:
    """``(word, count)`` over the corpus (partial + final hash aggregate)."""
    return corpus_words(docs, body_col, stop_words).groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def with_total(counts: DataFrame) -> DataFrame:
    """W5 denominator: attach ``total_words`` (a one-row aggregate, broadcast) to every count."""
    total = counts.agg(F.sum("count").alias("total_words"))
    return counts.crossJoin(F.broadcast(total))


def processed_count(docs: DataFrame, body_col: str = "body", id_col: str = "doc_id",
                    stop_words=T.STOP_WORDS) -> DataFrame:
    """Articles with a non-empty body, and the total number of counted words."""
    body = F.col(body_col)
    kept = F.filter(T.tokens(body), lambda x: ~T.is_stop_word(x, stop_words))
    return (docs.where(F.length(body) > 0)
            .agg(F.count(F.lit(1)).alias("processed_articles"),
                 F.sum(F.size(kept)).cast("long").alias("total_words")))


def top_words(docs: DataFrame, n: int = 100, body_col: str = "body",
              stop_words=T.STOP_WORDS) -> DataFrame:
    """L6 + W5 + W7: the ``n`` most frequent words with relative frequency and percent text.

    Tokens are counted per word first (partial sums before the shuffle); ``rollup`` then adds
    the grand total (the W5 denominator) over the counts, so the expansion doubles one row per
    word and not the token stream. The total row is ordered first, so
    a single TakeOrdered of ``n + 1`` rows carries both; the window below runs over those
    ``n + 1`` rows only. Ties are broken by the word (the reference leaves them open).
    ``frequency`` is ``count / total`` (double); ``percent`` is that ratio times 100 with
    four decimals, rounded half-up from the exact ratio.
    """
    counts = (word_count(docs, body_col, stop_words).rollup("word")
              .agg(F.coalesce(F.sum("count"), F.lit(0)).alias("count"), F.grouping("word").alias("_is_total")))
    top = counts.orderBy(F.col("_is_total").desc(), F.col("count").desc(), F.col("word").asc()).limit(n + 1)
    whole = Window.partitionBy(F.lit(1))
    rows = top.withColumn("total_words", F.max(F.when(F.col("_is_total") == 1, F.col("count"))).over(whole)) \
        .where(F.col("_is_total") == 0)
    w = Window.orderBy(F.col("count").desc(), F.col("word").asc())
    return rows.select(
        F.row_number().over(w).alias("rank"), "word", "count",
        (F.col("count") / F.col("total_words")).alias("frequency"),
        percent_text(F.col("count"), F.col("total_words")).alias("percent"),
        "total_words")


def frequency_table(docs: DataFrame, body_col: str = "body", stop_words=T.STOP_WORDS) -> DataFrame:
    """W7 for the whole vocabulary: ``(word, count, percent)``."""
    return (with_total(word_count(docs, body_col, stop_words))
            .select("word", "count", percent_text(F.col("count"), F.col("total_words")).alias("percent")))
