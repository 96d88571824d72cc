"""Extraction on nested, re-quoted and upper-case markup."""

import pytest
from pyspark.sql import functions as F

from opinio.functions import html as H


@pytest.mark.parametrize("page, expected", [
    ('<div class="article-body"><div><p>one</p></div><div><p>two</p></div><p>three</p></div><p>out</p>', ["one", "two", "three"]),
    ("<div class='article-body'><p>one</p></div>", ["one"]),
    ("<ARTICLE><P>one</P><P>two</P></ARTICLE>", ["one", "two"]),
    ('<article><p>open <div class="x"><p>in</p></div>', ["open", "in"]),
])
def test_body_of_nested_containers(spark, page, expected):
    df = spark.createDataFrame([(page,)], "html string")
    got = df.select(H.paragraphs(H.body_container(F.col("html"))).alias("p")).first()["p"]
    assert got == expected


def test_links_of_either_quote_and_case(spark):
    df = spark.createDataFrame([("<a href='/l1'>x</a><A HREF=\"/l2\">y</A><a href=\"/l3\" title='q'>z</a>",)], "html string")
    got = df.select(H.links(F.col("html")).alias("l")).first()["l"]
    assert [(x["href"], x["text"]) for x in got] == [("/l1", "x"), ("/l2", "y"), ("/l3", "z")]


def test_result_block_with_an_inner_div(spark):
    page = '<div class="PromoContent"><div>i</div><a href="/a"><h3>T</h3></a></div><div class="PromoContent"><a href="/b">U</a></div>'
    df = spark.createDataFrame([(page,)], "html string")
    got = df.select(H.result_hits(F.col("html")).alias("h")).first()["h"]
    assert [(x["href"], x["title"]) for x in got] == [("/a", "T"), ("/b", "No Title")]


def test_unclosed_element_runs_to_the_end(spark):
    df = spark.createDataFrame([("<article><div><p>a</p></div><p>b",)], "html string")
    assert df.select(H.element_inner(F.col("html"), "article").alias("x")).first()["x"] == "<div><p>a</p></div><p>b"
