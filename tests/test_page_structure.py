"""C5, C6, C8, C9 on the element structure: hand-made pages, and a plain stack parser over every page of the table."""

from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from opinio.functions import structure as S
from opinio.operators import pages as P


def parsed(spark, pages, *parts):
    df = spark.createDataFrame([(i, "https://h.example/x", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    return {r["page_id"]: r for r in P.parse_pages(df, *parts).collect()}


def test_repeated_paragraphs_of_the_fallback_are_kept_and_nested_blocks_read_once(spark):
    pages = ['<div class="my-content"><p>Same line.</p><p>Other.</p><p>Same line.</p></div>',
             '<div class="content"><p>a</p><div class="text"><p>b</p><p>a</p></div></div><p>outside</p>']
    got = parsed(spark, pages, "paragraphs")
    assert [got[i]["paragraphs"] for i in (0, 1)] == [["Same line.", "Other.", "Same line."], ["a", "b", "a"]]


@pytest.mark.parametrize("page, expected", [
    # only the paragraphs whose own parent mentions a caption or footer go
    ('<div class="article-body"><section><p>one</p></section><section><p>two</p><i class="caption">c</i></section><section><p>three</p></section></div>', ["one", "three"]),
    ('<article><section><p>kept</p></section><footer><p>gone</p></footer></article>', ["kept"]),
    # a mention in the container itself drops its own paragraphs, not those of other parents
    ('<article data-x="Caption"><p>gone</p><div><p>kept</p></div></article>', ["kept"]),
    # nothing left: the whole text
    ('<article><p>one</p><p>two</p><span class="footer">three</span></article>', ["onetwothree"]),
    # paragraphs end before blocks, items before the next item, and inner closing tags end them too
    ('<article><p>one<div>block</div><p>two</article>', ["one", "two"]),
    ('<article><ul><li><p>one<li><p>two</ul><p>three</p></article>', ["one", "two", "three"]),
    ('<article><div><p>one</div><p>two</p></span></article>', ["one", "two"]),
    ('<article><table><tr><td><p>a<td><p>b</table></article>', ["a", "b"]),
    ('<article><p>a<br>b<img src="x"/>c</p></article>', ["abc"]),
])
def test_paragraphs_by_their_own_parent(spark, page, expected):
    assert parsed(spark, [page], "paragraphs")[0]["paragraphs"] == expected


def test_captions_of_nested_figures(spark):
    page = ('<article><figure><img src="/a.jpg"><figure><img src="/b.jpg"><figcaption>inner</figcaption></figure><figcaption>outer</figcaption></figure>'
            '<img src="/c.jpg"><figure><div><img src="/d.jpg" width="640"></div></figure><img src="/e.jpg" width="20"></article><figure><img src="/f.jpg"></figure>')
    got = [(i["src"], i["caption"]) for i in parsed(spark, [page], "images")[0]["images"]]
    # the first caption inside the nearest figure, which for the outer one is the inner one's
    assert got == [("/a.jpg", "inner"), ("/b.jpg", "inner"), ("/c.jpg", "无说明"), ("/d.jpg", "无说明")]


def test_players(spark):
    page = ('<article><video src="/v1"></video><iframe src="/player/2"></iframe><iframe src="/other"></iframe>'
            '<div data-e2e="media-player"><iframe src="/i3"></iframe><div><video src="/v4"></video></div></div>'
            "<div data-e2e='media-player'><iframe src='/i5'></iframe></div><video></video></article><video src='/out'></video>")
    got = [v["src"] for v in parsed(spark, [page], "videos")[0]["videos"]]
    assert got == ["/v1", "/v4", "/player/2", "/v4", "/i5"]


def test_rejects_and_images_of_the_fallback(spark):
    pages = ["<body><p>no block</p></body>", "<article>  </article>", '<div class="text"><p>a<img src="/1"></p><img src="/2"></div>', None, ""]
    got = parsed(spark, pages, "paragraphs", "images", "videos")
    assert [got[i]["found"] for i in range(5)] == [False, True, True, False, False]
    assert got[1]["paragraphs"] == [] and [i["src"] for i in got[2]["images"]] == ["/1"] and got[2]["videos"] == []
    df = spark.createDataFrame([(i, "u", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    assert {(r["page_id"], r["reason"]) for r in P.page_rejects(df).collect()} == {
        (0, "no body container"), (1, "no text"), (3, "no body container"), (4, "no body container")}


class Stack(HTMLParser):
    """Elements with their parent, by the same rules of what ends what, on another tokenizer."""

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.open, self.found = [], []

    def handle_starttag(self, tag, attrs, empty=False):
        ends = S.SIBLINGS.get(tag, ()) + (("p",) if tag in S.BLOCKS or tag == "li" else ())
        within = ("table",) if tag in ("tr", "td", "th") else S.LISTS.get(tag, ()) + S.BARRIERS
        last = max((i for i, (n, _) in enumerate(self.open) if n in within), default=-1)
        first = next((i for i, (n, _) in enumerate(self.open) if i > last and n in ends), None)
        if first is not None:
            del self.open[first:]
        self.found.append((tag, self.open[-1][0] if self.open else ""))
        if tag not in S.VOID and not empty:
            self.open.append((tag, len(self.found)))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs, True)

    def handle_endtag(self, tag):
        at = max((i for i, (n, _) in enumerate(self.open) if n == tag), default=None)
        if at is not None:
            del self.open[at:]


def test_structure_equals_a_plain_stack_parser_on_every_page(spark):
    from opinio.functions import html as H
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", H.clean_html(F.col("html")).alias("clean"))
    tree = S.with_structure(pages, "clean")
    got = tree.select("clean", F.filter(F.transform("tree", lambda n: F.struct(
        n["name"].alias("name"), F.coalesce(F.get("tree", n["parent"] - 1)["name"], F.lit("")).alias("parent"))), lambda e: e["name"] != "").alias("e")).collect()
    assert len(got) == 50
    for r in got:
        parser = Stack()
        parser.feed(r["clean"])
        assert [(e["name"], e["parent"]) for e in r["e"]] == parser.found


def test_long_pages_cost_in_proportion(spark):
    page = "<article>" + "<div><p>a <b>b</b></p></div>" * 20_000 + "</article>"
    assert len(parsed(spark, [page], "paragraphs")[0]["paragraphs"]) == 20_000
