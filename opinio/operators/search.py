"""W11 [ours]: n-gram document search, the capability the schema declares with an n-gram
full-text index on (title, content). Phrases and documents meet by an equi join on their distinct
character bigrams (whitespace-free); relevance = number of the phrase's bigrams in the
document, a count per (phrase, document) with a partial aggregate before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NGRAM = 2


def phrase_ngrams(phrase):
    p = F.lower(phrase)
    grams = F.transform(F.sequence(F.lit(1), F.greatest(F.length(p) - (NGRAM - 1), F.lit(1))),
                        lambda i: F.substring(p, i, NGRAM))
    return F.array_distinct(F.filter(grams, lambda g: (F.length(g) == NGRAM) & ~g.rlike("\\s")))


def text_bigrams(text: Column) -> Column:
    """The distinct whitespace-free bigrams of a text, each from two neighbouring characters."""
    of = lambda chars: F.transform(chars, lambda c, i: F.concat(c, F.coalesce(F.get(chars, i + 1), F.lit(""))))
    grams = F.transform(F.array(F.split(F.lower(text), "")), of)[0]
    return F.filter(F.array_distinct(grams), lambda g: (F.length(g) == NGRAM) & ~g.rlike("\\s"))


def ngram_search(docs: DataFrame, phrases: DataFrame) -> DataFrame:
    """``(phrase_seq, doc_id, shared, n_grams)`` for documents sharing at least one bigram."""
    grams = phrases.select("phrase_seq", phrase_ngrams(F.col("phrase")).alias("grams"))
    p = grams.select("phrase_seq", F.size("grams").alias("n_grams"), F.explode("grams").alias("gram"))
    d = docs.select("doc_id", F.explode(text_bigrams(F.concat_ws(" ", "title", "text"))).alias("gram"))
    return (d.join(p, "gram").groupBy("phrase_seq", "doc_id", "n_grams").agg(F.count(F.lit(1)).cast("int").alias("shared"))
            .select("phrase_seq", "doc_id", "shared", "n_grams"))
