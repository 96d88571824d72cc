"""Page ingest (the crawler re-aimed as batch jobs over a landed ``pages`` table):
C1-C15, N2 (untitled names), S10.

Every step is a per-row native expression over ``html``; a page is one row, so the work
splits by pages with no shuffle until a report aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import structure as S
from ..functions import text as T
from ..functions import urls as U
from ..plans.ranking import rank_within
from .ingest import new_media_only


PARTS = ("title", "paragraphs", "images", "videos")


def parse_pages(pages: DataFrame, *parts: str) -> DataFrame:
    """``(page_id, url, found)`` and the asked ``parts`` (all by default); ``found`` is false (and the
    arrays are NULL) when the page has no body container and no fallback paragraphs (C5), ``title`` is
    NULL when the cascade found none (C3)."""
    c = F.col
    p = S.with_structure(pages.select("page_id", "url", H.clean_html(c("html")).alias("clean")), "clean", H.TEXT_BLOCK)
    p = p.withColumn("at", H.container_at(c("segs"), c("tree")))
    p = p.withColumn("end", S.node(c("tree"), c("at"))["end"])
    blocks = F.when(c("at").isNull(), H.text_block_paragraphs(c("tree")))    # only without a container
    p = S.fenced(p.withColumn("blocks", blocks), "at", "end", "blocks")
    segs, tree, at, end = c("segs"), c("tree"), c("at"), c("end")
    found = at.isNotNull() | (F.size("blocks") > 0)
    in_block = lambda i: F.exists("blocks", lambda b: (b < i) & (i < S.node(tree, b)["end"]))
    imgs = F.when(at.isNotNull(), S.between(S.places(tree, "img"), at, end)).otherwise(F.filter(S.places(tree, "img"), in_block))
    no_videos = F.array().cast("array<struct<src:string>>")      # nothing that plays lies in a paragraph
    made = {
        "title": lambda: H.page_title(c("clean")),
        "paragraphs": lambda: F.when(found, F.when(at.isNotNull(), H.container_paragraphs(segs, tree, at, end))
                                     .otherwise(H.fallback_paragraphs(segs, tree))),
        "images": lambda: F.when(found, H.images_in(segs, tree, imgs, T.NO_CAPTION)),
        "videos": lambda: F.when(found, F.when(at.isNotNull(), H.videos_in(segs, tree, at, end)).otherwise(no_videos)),
    }
    parts = parts or PARTS
    out = p.select("page_id", "url", F.coalesce(found, F.lit(False)).alias("found"), *[made[n]().alias(n) for n in parts])
    return S.fenced(out, "found", *parts)


def page_paragraphs(pages: DataFrame) -> DataFrame:
    """One row per paragraph ``(page_id, pos, paragraph)``. Pages without a container
    have NULL paragraphs and ``posexplode`` emits nothing for them (no filter needed)."""
    return parse_pages(pages, "paragraphs").select("page_id", F.posexplode("paragraphs").alias("pos", "paragraph"))


def page_titles(pages: DataFrame, hits: DataFrame | None = None) -> DataFrame:
    """C3 + C4: page title, else the search-hit title unless it is "No Title"."""
    t = pages.select("page_id", "url", H.page_title(H.clean_html(F.col("html"))).alias("title"))
    if hits is None:
        return t
    h = hits.select("url", F.col("title").alias("hit_title"))
    return (t.join(h, "url", "left")
            .select("page_id", "url", F.coalesce("title", F.when(F.col("hit_title") != H.NO_TITLE,
                                                                  F.col("hit_title"))).alias("title")))


def page_rejects(pages: DataFrame) -> DataFrame:
    """Pages that produce no article, with the reason."""
    p = parse_pages(pages, "paragraphs")
    reason = (F.when(~F.col("found"), "no body container")
              .when(F.size("paragraphs") == 0, "no text"))
    return p.select("page_id", "url", reason.alias("reason")).where(F.col("reason").isNotNull())


def page_body(pages: DataFrame) -> DataFrame:
    """The body text of each accepted page (paragraphs joined by blank lines)."""
    p = parse_pages(pages, "paragraphs").where(F.col("found") & (F.size("paragraphs") > 0))
    return p.select("page_id", F.size("paragraphs").alias("n_paragraphs"),
                    F.array_join("paragraphs", "\n\n").alias("body"))


def extract_links(pages: DataFrame) -> DataFrame:
    """C2 + C1: anchors with their absolute URL and title (default "No Title")."""
    p = pages.select("page_id", "url", F.posexplode(H.links(H.clean_html(F.col("html")))).alias("pos", "a"))
    title = F.when(F.col("a.text") != "", F.col("a.text")).otherwise(F.lit(H.NO_TITLE))
    return p.select("page_id", "pos", U.absolutize(F.col("a.href"), H.base_of(F.col("url"))).alias("link"),
                    title.alias("title")).where(F.col("a.href") != "")


def media_counts(pages: DataFrame) -> DataFrame:
    """C14: kept images and videos per accepted page."""
    p = parse_pages(pages, "paragraphs", "images", "videos").where(F.col("found") & (F.size("paragraphs") > 0))
    return p.select("page_id", F.size("images").alias("images"), F.size("videos").alias("videos"))


def page_images(pages: DataFrame) -> DataFrame:
    """C8 + C1: kept images with absolute URL and caption (``media_files`` adds the file names)."""
    p = parse_pages(pages, "images").where("found")
    e = p.select("page_id", "url", F.posexplode("images").alias("pos", "i"))
    src = U.absolutize(F.col("i.src"), H.base_of(F.col("url")))
    return e.select("page_id", "pos", src.alias("src"), F.col("i.caption").alias("caption"))


def page_videos(pages: DataFrame) -> DataFrame:
    """C9 + C1."""
    p = parse_pages(pages, "videos").where("found")
    e = p.select("page_id", "url", F.posexplode("videos").alias("pos", "v"))
    return e.select("page_id", "pos", U.absolutize(F.col("v.src"), H.base_of(F.col("url"))).alias("src"))


def media_files(pages: DataFrame, content_types: DataFrame, landed: DataFrame) -> DataFrame:
    """C8-C11 + M11 as one job: ``(page_id, kind, pos, src, caption, file_name)`` of the kept images and
    videos whose absolute URL is not landed yet.

    ``content_types`` has ``(src, content_type)`` of the media that answered; its join gives the file
    name's extension (the default of the kind where nothing or nothing known came back).
    ``landed`` has the ``src`` of media already stored.
    """
    p = parse_pages(pages, "images", "videos").where("found")
    def one(kind: str, caption) -> DataFrame:
        e = p.select("page_id", "url", F.posexplode(f"{kind}s").alias("pos", "m"))
        return e.select("page_id", F.lit(kind).alias("kind"), "pos", U.absolutize(F.col("m.src"), H.base_of(F.col("url"))).alias("src"), caption.alias("caption"))
    media = one("image", F.col("m.caption")).unionByName(one("video", F.lit(None).cast("string")))
    types = content_types.groupBy("src").agg(F.max("content_type").alias("content_type"))     # one row per URL
    typed = media.join(types, "src", "left").withColumn("ext", F.when(
        F.col("kind") == "image", U.media_extension(F.col("content_type"))).otherwise(U.media_extension(F.col("content_type"), "video")))
    return new_media_only(typed, landed).select("page_id", "kind", "pos", "src", "caption", "file_name")


def article_files(pages: DataFrame) -> DataFrame:
    """C11: the article file name of each accepted page (from its title, else md5 of the URL)."""
    p = parse_pages(pages, "title", "paragraphs").where(F.col("found") & (F.size("paragraphs") > 0))
    return p.select("page_id", "url", "title", U.article_filename(F.col("url"), F.col("title")).alias("file_name"))


# Fixed value: name given to articles without a title, numbered in crawl order.
UNTITLED = "Untitled Article {n}"


def untitled_names(parsed: DataFrame, order_cols) -> DataFrame:
    """Number untitled accepted articles 1.. in crawl order (a distributed rank,
    no single-task window), and give them ``Untitled Article n``."""
    u = parsed.where(F.col("title").isNull())
    r = rank_within(u, [], list(order_cols), "n")
    name = F.concat(F.lit(UNTITLED.split("{n}")[0]), F.col("n").cast("string"))
    return r.select("page_id", "url", "n", name.alias("title"),
                    U.article_filename(F.col("url"), name).alias("file_name"))


def search_page_hits(result_pages: DataFrame, base: str | None = None) -> DataFrame:
    """C2 + C1: hits ``(page_id, pos, url, title)`` from landed search-result pages; relative
    links resolve against ``base`` (the site) or the result page's own scheme://host."""
    p = result_pages.select("page_id", "url", F.posexplode(H.result_hits(H.clean_html(F.col("html")))).alias("pos", "h"))
    b = F.lit(base) if base else H.base_of(F.col("url"))
    return p.select("page_id", "pos", U.absolutize(F.col("h.href"), b).alias("url"), F.col("h.title").alias("title"))
