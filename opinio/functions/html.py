"""HTML column builders for landed pages.

Pages are parsed natively inside the Spark job, not with a per-row HTML library: script/style/
comment blocks are removed first, then one pass over the tags gives the element structure
(``structure``) on which container, paragraphs, figures and players are looked up. The extraction
rules follow the reference's selector cascades.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import structure as S
from .text import ustrip

# ------------------------------------ fixed values -------------------------------------

SITE_NAME = "BBC News"                    # a title equal to the site name is skipped
NO_TITLE = "No Title"
H_CLASSES = ("ssrcss-15xko80-StyledHeading", "ssrcss-1f3bvyz-Headline", "article__title",
             "story-body__h1", "article-headline", "headline", "title")
BODY_DIV_CLASSES = ("ssrcss-1ocoo3l-Wrap", "story-body__inner", "article__body", "article-body",
                    "article-content", "article-text", "article-body-content", "article__body-content",
                    "article__content")
TEXT_BLOCK_HINTS = ("content", "body", "text")   # div[class*=…] p fallback
EXCLUDE_PARENT_HINTS = ("footer", "caption")
MIN_IMAGE_WIDTH = 100
# Named entities decoded after tag removal (&amp; last so "&amp;lt;" stays "&lt;").
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
            ("&nbsp;", "\u00a0"), ("&copy;", "\u00a9"), ("&middot;", "\u00b7"), ("&amp;", "&"))

NOISE = "(?is)<script\\b[^>]*>.*?</script>|<style\\b[^>]*>.*?</style>|<!--.*?-->"
TAG = "<[^>]*>"


def clean_html(html: Column) -> Column:
    """Drop script, style and comment blocks (a ``</p>`` inside a script must not count)."""
    return F.regexp_replace(html, NOISE, "")


def unescape(c: Column) -> Column:
    for ent, ch in ENTITIES:
        c = F.replace(c, F.lit(ent), F.lit(ch))
    return c


def text_of(fragment: Column) -> Column:
    """``element.get_text().strip()`` for a fragment: tags removed, entities decoded, stripped."""
    return ustrip(unescape(F.regexp_replace(fragment, TAG, "")))


def _nonblank(c: Column) -> Column:
    return F.when((c != "") & (c != SITE_NAME), c)


def _quoted(name: str, value: str) -> str:
    """Pattern of an attribute in either kind of quotes; ``value`` may hold one ``{any}``."""
    return (f"\\b{name}\\s*=\\s*(?:\"" + value.replace("{any}", "[^\"]") + "\"|'" + value.replace("{any}", "[^']") + "')")


def open_tag(tag: str, cls: str | None = None) -> str:
    """Pattern of an opening tag (optionally with a class token), upper or lower case."""
    mark = "" if cls is None else "[^>]*" + _quoted("class", "(?:{any}*\\s)?" + cls + "(?:\\s{any}*)?")
    return f"(?is)<{tag}\\b{mark}[^>]*>"


def balanced(rest: Column, tag: str) -> Column:
    """What stands before the closing tag that matches a ``<tag>`` just before ``rest``: tags of
    the same name are counted; an element that is never closed runs to the end."""
    segs = F.split(rest, f"(?i)(?=<{tag}\\b|</{tag}\\s*>)")
    start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("n"))

    def step(acc, seg):
        depth = acc["depth"] + F.when(seg.rlike(f"(?i)^</{tag}\\s*>"), -1).when(seg.rlike(f"(?i)^<{tag}\\b"), 1).otherwise(0)
        return F.when(acc["depth"] == 0, acc).otherwise(F.struct(depth.alias("depth"), (acc["n"] + 1).alias("n")))
    end = F.aggregate(segs, start, step)
    keep = F.when(end["depth"] == 0, end["n"] - 1).otherwise(F.size(segs))
    return F.array_join(F.slice(segs, F.lit(1), keep), "")


def element_inner(html: Column, tag: str, cls: str | None = None) -> Column:
    """Inner HTML of the first ``<tag>`` (optionally with a class token) up to its own closing
    tag; '' if none."""
    parts = F.split(html, open_tag(tag, cls), 2)
    return F.when(F.size(parts) > 1, balanced(F.element_at(parts, -1), tag)).otherwise("")


def elements_inner(html: Column, tag: str, opening: str) -> Column:
    """Inner HTML of every element whose opening tag matches, in document order."""
    segs = F.split(html, "(?=" + opening + ")")
    at = F.filter(F.sequence(F.lit(1), F.size(segs)), lambda i: F.element_at(segs, i).rlike("^" + opening))
    return F.transform(at, lambda i: balanced(
        F.regexp_replace(F.array_join(F.slice(segs, i, F.size(segs)), ""), "^" + opening, ""), tag))


def has_element(html: Column, tag: str, cls: str | None = None) -> Column:
    return html.rlike(open_tag(tag, cls))


def meta_content(html: Column, prop: str) -> Column:
    """``<meta property=prop content=…>`` in either attribute order ('' if absent)."""
    tag = F.regexp_extract(html, "(?is)(<meta\\b[^>]*" + _quoted("property", prop) + "[^>]*>)", 1)
    return attr(tag, "content")


def page_title(html: Column) -> Column:
    """h1 selectors (classed, then any), h2 likewise, og:title, then the last og:url part."""
    cands = []
    for tag in ("h1", "h2"):
        for cls in H_CLASSES + (None,):
            cands.append(F.when(has_element(html, tag, cls), _nonblank(text_of(element_inner(html, tag, cls)))))
    cands.append(_nonblank(ustrip(unescape(meta_content(html, "og:title")))))
    og_url = meta_content(html, "og:url")
    last = F.element_at(F.split(F.regexp_replace(og_url, "/+\\z", ""), "/"), -1)
    cands.append(F.when(og_url != "", F.when(ustrip(F.replace(last, F.lit("-"), F.lit(" "))) != "",
                                              ustrip(F.replace(last, F.lit("-"), F.lit(" "))))))
    return F.coalesce(*cands)


#: Divs whose descendant paragraphs are the fallback body.
TEXT_BLOCK = "(?is)^<div\\b[^>]*" + _quoted("class", "{any}*(?:" + "|".join(TEXT_BLOCK_HINTS) + "){any}*")


def container_at(segs: Column, tree: Column) -> Column:
    """The place of the first element of the first selector that matches (article, then the
    known body divs); null if none does."""
    def rank(n, i):
        tag = S.own_tag(F.get(segs, i))
        by_class = S.let(tag, lambda t: F.coalesce(*[F.when(t.rlike(open_tag("div", c)), k) for k, c in enumerate(BODY_DIV_CLASSES, 1)]))
        return F.struct(F.when(n["name"] == "article", 0).when(n["name"] == "div", by_class).alias("rank"), (i + 1).alias("at"))
    return F.array_min(F.filter(F.transform(tree, rank), lambda x: x["rank"].isNotNull()))["at"]


def text_block_paragraphs(tree: Column) -> Column:
    """C5 fallback: the places of the paragraphs inside divs whose class mentions content/body/text
    (``tree`` hinted by ``TEXT_BLOCK``), each once, in document order."""
    return F.filter(S.places(tree, "p"), lambda i: S.node(tree, i)["hinted"])


def _element(segs: Column, tree: Column, at: Column) -> Column:
    """The HTML of the element at a place; of the whole page for place 0."""
    return S.inner_html(segs, F.greatest(at, F.lit(1)), F.when(at == 0, F.size(segs) + 1).otherwise(S.node(tree, at)["end"]))


def _mentions(html: Column) -> Column:
    low, found = F.lower(html), F.lit(False)
    for h in EXCLUDE_PARENT_HINTS:
        found = found | (F.instr(low, h) > 0)
    return found


def _texts(fragments: Column, whole: Column) -> Column:
    """Trimmed texts that are not empty; if there are none, the whole text."""
    return S.let(F.filter(F.transform(fragments, text_of), lambda x: x != ""), lambda ps: F.when(F.size(ps) > 0, ps).otherwise(
        F.filter(F.array(text_of(whole)), lambda x: x != "")))


def container_paragraphs(segs: Column, tree: Column, at: Column, end: Column) -> Column:
    """The paragraphs of the container [at, end). A paragraph is left out if the HTML of its own
    parent mentions footer or caption; if none is left, the whole text is the paragraph."""
    def kept(ps: Column, whole: Column) -> Column:
        parent = lambda p: S.node(tree, p)["parent"]
        # a parent lies in the container or is the container: what the whole does not mention, no parent does
        shunned = F.when(_mentions(whole), F.filter(F.array_distinct(F.transform(ps, parent)), lambda q: _mentions(_element(segs, tree, q)))) \
            .otherwise(F.array().cast("array<int>"))
        return S.let(shunned, lambda bad: _texts(F.transform(
            F.filter(ps, lambda p: ~F.array_contains(bad, parent(p))), lambda p: _element(segs, tree, p)), whole))
    return S.let(S.inner_html(segs, F.greatest(at, F.lit(1)), end), lambda whole: S.let(
        S.between(S.places(tree, "p"), at, end), lambda ps: kept(ps, whole)))


def fallback_paragraphs(segs: Column, tree: Column) -> Column:
    """C6 over the C5 fallback, whose paragraphs all have one new parent: the element of them all."""
    return S.let(F.transform(text_block_paragraphs(tree), lambda p: _element(segs, tree, p)), lambda ps: S.let(
        F.array_join(ps, ""), lambda whole: _texts(F.when(_mentions(whole), F.array().cast("array<string>")).otherwise(ps), whole)))


def _whole_page(html: Column, then) -> Column:
    """``then(segs, tree, at, end)`` of a fragment taken as a whole."""
    return S.let(S.segments(html), lambda segs: S.let(S.nodes(segs, TEXT_BLOCK), lambda tree: then(
        segs, tree, F.lit(0), F.size(segs) + 1)))


def body_container(html: Column) -> Column:
    """C5 on a page's HTML alone: inner HTML of the container; NULL if there is none."""
    out = F.when(has_element(html, "article"), element_inner(html, "article"))
    for cls in BODY_DIV_CLASSES:
        out = out.when(has_element(html, "div", cls), element_inner(html, "div", cls))
    return out


def paragraphs(container: Column) -> Column:
    """C6 on the HTML of a container."""
    return _whole_page(container, container_paragraphs)


def base_of(url: Column) -> Column:
    """``scheme://host`` of a URL (the base for relative links)."""
    return F.regexp_extract(url, "^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)", 1)


def links(html: Column) -> Column:
    """C2 (page form): anchors with an href, as array<struct<href, text>> in document order."""
    anchors = F.regexp_extract_all(html, F.lit("(?is)<a\\b[^>]*" + _quoted("href", "{any}*") + "[^>]*>.*?</a\\s*>"), F.lit(0))
    return F.transform(anchors, lambda a: F.struct(
        attr(F.regexp_extract(a, "(?is)^(<a\\b[^>]*>)", 1), "href").alias("href"),
        text_of(F.regexp_extract(a, "(?is)<a\\b[^>]*>(.*?)</a\\s*>", 1)).alias("text")))


def attr(tag: Column, name: str) -> Column:
    """An attribute value of one tag ('' if missing); double or single quotes."""
    d = F.regexp_extract(tag, f"(?i)\\b{name}\\s*=\\s*\"([^\"]*)\"", 1)
    s = F.regexp_extract(tag, f"(?i)\\b{name}\\s*=\\s*'([^']*)'", 1)
    return F.when(d != "", d).otherwise(s)


def images_in(segs: Column, tree: Column, imgs: Column, no_caption: str) -> Column:
    """array<struct<src, width, caption>> of the kept images among the places ``imgs``, in order.

    Width below 100 drops the image (a non-numeric width is kept [ours]; the reference
    raised and lost the article); no src drops it; the caption is the text of the first
    figcaption in the nearest figure around the image, else the "none" marker.
    """
    def image(caps: Column, i: Column) -> Column:
        fig = S.node(tree, i)["figure"]
        cap = F.when(fig > 0, F.array_min(F.filter(caps, lambda c: (c > fig) & (c < S.node(tree, fig)["end"]))))
        return S.let(S.own_tag(F.get(segs, i - 1)), lambda t: F.struct(
            attr(t, "src").alias("src"), attr(t, "width").alias("width"), S.let(cap, lambda c: F.when(
                c.isNotNull(), text_of(_element(segs, tree, c))).otherwise(no_caption)).alias("caption")))

    found = S.let(S.places(tree, "figcaption"), lambda caps: F.transform(imgs, lambda i: image(caps, i)))
    return F.filter(found, lambda i: (F.coalesce(i["width"].try_cast("int"), F.lit(MIN_IMAGE_WIDTH)) >= MIN_IMAGE_WIDTH)
                    & (i["src"] != ""))


def videos_in(segs: Column, tree: Column, at: Column, end: Column) -> Column:
    """The videos of [at, end): video elements, then player iframes, then the first video, else the
    first iframe, of each media-player container; entries without src are dropped. (Same element may
    repeat, as in the reference.)"""
    tag = lambda i: S.own_tag(F.get(segs, i - 1))
    inside = lambda *names: S.between(S.places(tree, *names), at, end)
    player = "(?is)^<div\\b[^>]*" + _quoted("data-e2e", "media-player")

    def all_of(vids: Column, frames: Column) -> Column:
        boxes = F.filter(inside("div"), lambda d: F.get(segs, d - 1).rlike(player))
        first = F.transform(boxes, lambda d: S.let(S.node(tree, d)["end"], lambda e: F.coalesce(
            F.get(S.between(vids, d, e), F.lit(0)), F.get(S.between(frames, d, e), F.lit(0)))))
        return F.concat(vids, F.filter(frames, lambda f: F.instr(attr(tag(f), "src"), "player") > 0),
                        F.filter(first, lambda x: x.isNotNull()))
    chosen = S.let(inside("video"), lambda vids: S.let(inside("iframe"), lambda frames: all_of(vids, frames)))
    return F.filter(F.transform(chosen, lambda i: F.struct(attr(tag(i), "src").alias("src"))), lambda v: v["src"] != "")


def images(container: Column, no_caption: str) -> Column:
    """C8 on the HTML of a container."""
    return _whole_page(container, lambda segs, tree, at, end: images_in(segs, tree, S.places(tree, "img"), no_caption))


def videos(container: Column) -> Column:
    """C9 on the HTML of a container."""
    return _whole_page(container, videos_in)


# Result-block containers of the search page, tried in order, and the title
# element cascade inside a block.
RESULT_BLOCK_CLASSES = ("ssrcss-1v7bxtk-StyledContainer", "ssrcss-1qt4x4l-PromoContent", "PromoContent")
RESULT_TITLE_SPAN_CLASS = "promo-heading__title"


def _blocks(html: Column, cls: str) -> Column:
    return elements_inner(html, "div", open_tag("div", cls))


def result_blocks(html: Column) -> Column:
    """The result blocks of a search page (first container class that has any)."""
    out = None
    for cls in RESULT_BLOCK_CLASSES:
        b = _blocks(html, cls)
        out = F.when(F.size(b) > 0, b) if out is None else out.when(F.size(b) > 0, b)
    return out.otherwise(F.array().cast("array<string>"))


def result_hits(html: Column) -> Column:
    """array<struct<href, title>> — first link of each block (blocks without a link or
    href are skipped); title from h3, else h2, else the heading span, else "No Title"."""
    def hit(b):
        a_tag = F.regexp_extract(b, "(?i)(<a\\b[^>]*>)", 1)
        href = attr(a_tag, "href")
        t = F.coalesce(F.when(has_element(b, "h3"), text_of(element_inner(b, "h3"))),
                       F.when(has_element(b, "h2"), text_of(element_inner(b, "h2"))),
                       F.when(has_element(b, "span", RESULT_TITLE_SPAN_CLASS),
                              text_of(element_inner(b, "span", RESULT_TITLE_SPAN_CLASS))),
                       F.lit(NO_TITLE))
        return F.struct(href.alias("href"), t.alias("title"))
    return F.filter(F.transform(result_blocks(html), hit), lambda h: h["href"] != "")
