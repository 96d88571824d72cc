"""The reference's data model built from the driver tables (the corpus adapter).

corpus            ← documents (see ``sources.tables.corpus``)
scores            ← V1 over every document body with a lexicon (the scoring step)
sentiment_analysis← K2: scores of the documents that ``labels`` marks as loaded
titles            ← (doc_id, title) for reports
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import sentiment as V
from ..sources import lexicon as LX
from ..sources import tables as S

# Fixed parameter for reproducible statistics (the reference uses "today").
STAT_DATE = "2024-12-31"


def lexicon(spark: SparkSession) -> DataFrame:
    return LX.lexicon_from_pairs(spark)


def scores(spark: SparkSession, sf: str) -> DataFrame:
    return V.scored(S.bodies(spark, sf), lexicon(spark))


def sentiment_table(spark: SparkSession, sf: str) -> DataFrame:
    return V.sentiment_rows(scores(spark, sf), S.labelled_ids(spark, sf))


def titles(spark: SparkSession, sf: str) -> DataFrame:
    d = S.read_table(spark, sf, "documents")
    return d.select("doc_id", F.substring_index(F.col("text"), "\n", 1).alias("title"))


def sheet(spark: SparkSession, sf: str, n: int = 100) -> DataFrame:
    """The frequency sheet (top ``n`` words of the corpus bodies) as text cells."""
    from ..operators import keywords as K
    from ..operators import wordfreq as WF
    return K.sheet_from_top_words(WF.top_words(S.bodies(spark, sf), n))


def hot_keywords(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import keywords as K
    return K.hot_keywords(sheet(spark, sf), STAT_DATE)


def keywords(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import keywords as K
    return K.assign_keywords(S.corpus_ids(spark, sf), sheet(spark, sf))


def conversation_bodies(spark: SparkSession, sf: str) -> DataFrame:
    """A second text source: conversation turns as ``(doc_id, body)`` (doc_id = conv·1000+turn)."""
    from ..functions import text as T
    c = S.read_table(spark, sf, "conversations", text_work=True)
    return c.select((F.col("conv_id") * 1000 + F.col("turn")).alias("doc_id"), T.ustrip(F.col("text")).alias("body"))


# ------------------------------ articles and the report --------------------------------

# Adapter value: documents carry no URL; this prefix plus doc_id stands in for one.
ARTICLE_URL_PREFIX = "https://news.example.org/articles/"
REPORT_SECTION_STRIDE = 10_000_000_000  # seq = section · stride + rank (report line order)


def article_url(doc_id):
    """Adapter URL with a date path ``2024-<m>-<d>`` (m, d from the id; some dates are invalid
    on purpose, like real-world links, which exercises F8's fallback)."""
    return F.concat(F.lit(ARTICLE_URL_PREFIX + "2024-"), (F.pmod(doc_id, F.lit(12)) + 1).cast("string"), F.lit("-"),
                    (F.pmod(doc_id, F.lit(31)) + 1).cast("string"), F.lit("/"), doc_id.cast("string"))


def articles(spark: SparkSession, sf: str) -> DataFrame:
    """Loaded articles: ``(a_id, a_title)``; the title is the saved file name minus ``.txt``
    (header title cleaned and cut to 100 characters), as the loader sees it."""
    from ..functions import urls as U
    d = S.read_table(spark, sf, "documents", text_work=True)
    header = F.substring_index(F.col("text"), "\n", 1)
    return d.select(F.col("doc_id").alias("a_id"),
                    U.loader_title(U.article_filename(article_url(F.col("doc_id")), header)).alias("a_title"))


def report_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The ranked report over every scored document as ``(seq, value)`` lines."""
    lines = V.ranked_report_lines(scores(spark, sf), titles(spark, sf))
    return lines.select((F.col("section") * REPORT_SECTION_STRIDE + F.col("rank")).alias("seq"),
                        F.col("line").alias("value"))


def report(spark: SparkSession, sf: str) -> DataFrame:
    from ..sources.reports import parse_ranked_report
    return parse_ranked_report(report_lines(spark, sf))


def report_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """M5 over the parsed report, written once: the matching plans read it several times."""
    from ..operators.matching import dedupe_last
    from .scratch import materialise
    return materialise(dedupe_last(report(spark, sf)), "report")


def rendered(spark: SparkSession, sf: str) -> DataFrame:
    """K11 round trip input: every document rendered as an article file ``(doc_id, file_name, text, article)``."""
    from ..functions import urls as U
    from ..sources.articles import paragraphs_of, render_article
    d = S.read_table(spark, sf, "documents", text_work=True)
    header = F.substring_index(F.col("text"), "\n", 1)
    url = article_url(F.col("doc_id"))
    return d.select("doc_id", U.article_filename(url, header).alias("file_name"), "text",
                    render_article(header, url, paragraphs_of(F.col("text"))).alias("article"))


# ----------------------------------- search stand-in -----------------------------------

# Fixed parameters: search phrases that occur in the driver prose, and the date ranges each
# phrase is searched in.
SEARCH_PHRASES = ("the and", "de la", "und der", "que el", "whst", "eau", "ción", "ouen")
SEARCH_RANGES = (("2024-01-01", "2024-03-31"), ("2024-07-01", "2024-09-30"))


def searchable(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as search results: ``(doc_id, url, title, text, publish_date)``."""
    d = S.read_table(spark, sf, "documents", text_work=True)
    t = F.pmod(F.col("doc_id"), F.lit(S.ADAPTER_DAYS)).cast("int")
    return d.select("doc_id", article_url(F.col("doc_id")).alias("url"),
                    F.substring_index(F.col("text"), "\n", 1).alias("title"), "text",
                    F.date_add(F.lit(S.ADAPTER_BASE_DATE).cast("date"), t).alias("publish_date"))


def search_hits(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import ingest as I
    return I.phrase_search(searchable(spark, sf), I.phrases_df(spark, SEARCH_PHRASES))


def landed_urls(spark: SparkSession, sf: str) -> DataFrame:
    """URLs already landed: the loaded (labelled) articles."""
    ids = S.labelled_ids(spark, sf)
    return ids.select(article_url(F.col("corpus_id")).alias("url"))


# ------------------------------------ media stand-in -----------------------------------

def media_pages(spark: SparkSession, sf: str) -> DataFrame:
    """The pages with figures, pictures and players before the end of each article: ``page_id % 4`` images
    (some narrow, some without a caption) and, on some pages, a video or a player."""
    p = S.read_table(spark, sf, "pages", text_work=True)
    k, text = F.col("page_id"), lambda *parts: F.concat(*[x if not isinstance(x, str) else F.lit(x) for x in parts])
    def figure(j):
        width = ((k + j) * 40 % 300).cast("string")
        caption = F.when((k + j) % 3 != 0, text("<figcaption>Picture ", j.cast("string"), " of ", k.cast("string"), "</figcaption>")).otherwise("")
        return text('<figure><div><img width="', width, '" src="/img/', k.cast("string"), "-", j.cast("string"), '"></div>', caption, "</figure>")
    figures = F.array_join(F.transform(F.filter(F.sequence(F.lit(0), F.lit(3)), lambda j: j < k % 4), figure), "")
    player = (F.when(k % 5 == 0, text('<video src="//media.example/', k.cast("string"), '"></video>'))
              .when(k % 5 == 1, text("<div data-e2e='media-player'><iframe src='/player/", k.cast("string"), "'></iframe></div>")).otherwise(""))
    return p.withColumn("html", F.replace(F.col("html"), F.lit("</article>"), F.concat(figures, player, F.lit("</article>"))))


def media_answers(spark: SparkSession, sf: str) -> DataFrame:
    """Landed answers ``(src, content_type)`` for the images of ``media_pages``; every fourth is missing."""
    from ..functions import html as H
    p = S.read_table(spark, sf, "pages").select("page_id", H.base_of(F.col("url")).alias("base"), F.explode(F.sequence(F.lit(0), F.lit(2))).alias("j"))
    kind = F.element_at(F.array(F.lit("image/png"), F.lit("image/webp; q=1"), F.lit("image/jpeg")), ((F.col("page_id") + F.col("j")) % 4 + 1).cast("int"))
    return p.where((F.col("page_id") + F.col("j")) % 4 < 3).select(
        F.concat("base", F.lit("/img/"), F.col("page_id").cast("string"), F.lit("-"), F.col("j").cast("string")).alias("src"), kind.alias("content_type"))


def landed_media(spark: SparkSession, sf: str) -> DataFrame:
    """Media stored before: those of every seventh page."""
    return media_answers(spark, sf).where(F.regexp_extract("src", "/img/([0-9]+)-", 1).cast("long") % 7 == 0).select("src")


def search_files(spark: SparkSession, sf: str) -> str:
    """Stand-in for landed search results: a folder of JSON lists, one hit a line with the URL and first line of each document;
    the line of every 13th document ends after its URL."""
    import uuid

    from .scratch import shared_folder
    path = f"{shared_folder(spark)}/opinio/search-{uuid.uuid4().hex}"
    url = F.concat(F.lit("https://news.example/"), F.col("doc_id"))
    hit = F.struct(url.alias("url"), F.substring_index("text", "\n", 1).alias("title"))
    cut = F.concat(F.lit('{"url":"'), url, F.lit('","title":'))
    S.read_table(spark, sf, "documents").select(
        F.when(F.col("doc_id") % 13 == 5, cut).otherwise(F.concat(F.to_json(hit), F.lit(","))).alias("value")).write.text(path)
    return path
